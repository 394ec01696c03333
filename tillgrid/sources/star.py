"""Star schema derived from the input tables.

Mapping (see FIXTURES.md §3):
  store            = region
  fact_sales       = lineitem ⋈ supplier ⋈ nation, grain (part, ship month, region)
  product line     = part: brand, description, freight tag
  brand defaults   = brand number → category (brand 25 left unconfirmed)
  known SKUs       = every third part, classified under an older rule set
  fact_channel     = orders ⋈ customer ⋈ nation ⋈ lineitem by order priority
  monthly_context  = per (region, order month) from orders ⋈ customer ⋈ nation

All derivations are DataFrame plans.  The fact tables and the product
dimension are written once per input version (``warehouse``), partitioned by
``period``, so report filters on a month prune partitions; the builders can
also be given a month, which becomes an ``l_shipdate`` range on the scan.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import rules as R
from ..functions.numeric import money
from ..operators import classify as C
from ..operators import fuzzy as FZ
from . import warehouse
from .tables import Tables, month_start, next_month_start

CHANNEL_BY_PRIORITY = {"1-URGENT": "member_price", "2-HIGH": "wholesale",
                       "3-MEDIUM": "export_gst_free", "4-NOT SPECIFIED": "wechat_pay",
                       "5-LOW": "courier_export"}


def _periodise(df: DataFrame, ts: str, period: str | None, through: str | None) -> DataFrame:
    if period is not None:
        df = df.filter((F.col(ts) >= F.lit(month_start(period)))
                       & (F.col(ts) < F.lit(next_month_start(period))))
    if through is not None:
        df = df.filter(F.col(ts) < F.lit(next_month_start(through)))
    return df


def _small_map(mapping: dict[str, str]):
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def dim_store(t: Tables) -> DataFrame:
    """store_id, store_code, store_name."""
    return t.region.select(F.col("r_regionkey").alias("store_id"),
                           F.col("r_name").alias("store_code"),
                           F.initcap("r_name").alias("store_name"))


def _nation_region(t: Tables) -> DataFrame:
    # nation is a fixed 25-row table: broadcasting it is size-safe.
    return F.broadcast(t.nation.select("n_nationkey", F.col("n_regionkey").alias("store_id")))


def sales_lines(t: Tables, period: str | None = None, through: str | None = None) -> DataFrame:
    """Line-level sales: l_orderkey, partkey, period, store_id, qty, amount.

    lineitem joins supplier first (size left to the planner/AQE: supplier
    grows with the data) and the 25-row nation table last, so the planner
    never sees a join-product estimate that makes lineitem look small."""
    li = _periodise(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                                      "l_extendedprice", "l_shipdate"),
                    "l_shipdate", period, through)
    sup = t.supplier.select("s_suppkey", "s_nationkey")
    return (li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(_nation_region(t), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("l_orderkey", F.col("l_partkey").alias("partkey"),
                    F.date_format("l_shipdate", "yyyy-MM").alias("period"), "store_id",
                    F.col("l_quantity").cast("bigint").alias("qty"),
                    money("l_extendedprice").alias("amount")))


def build_fact_sales(t: Tables, period: str | None = None,
                     through: str | None = None) -> DataFrame:
    """fact_sales at grain (sku, period, store): order_count, qty, amount(decimal).

    The lines are dealt once, by ranges of (period, store, sku), as the table is
    stored: both levels of count(distinct order) run where the lines lie, and no
    range holds more than one hot group."""
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return (sales_lines(t, period, through)
            .repartitionByRange(n, "period", "store_id", "partkey")
            .groupBy("partkey", "period", "store_id")
            .agg(F.count_distinct("l_orderkey").alias("order_count"),
                 F.sum("qty").alias("qty"),
                 F.sum("amount").alias("amount"))
            .withColumn("sku_code", F.concat(F.lit("SKU"), F.col("partkey").cast("string"))))


def _inputs(t: Tables, names: list[str]) -> list[str]:
    return [f"{t.root.rstrip('/')}/{n}.parquet" for n in names]


def fact_sales(t: Tables, period: str | None = None, through: str | None = None) -> DataFrame:
    """The stored fact table (written once per input version, partitioned by
    period); month filters prune partitions."""
    f = warehouse.materialized(t.spark, "fact_sales",
                               _inputs(t, ["lineitem", "supplier", "nation"]),
                               lambda: build_fact_sales(t), partition_by=["period"], dealt=True)
    if period is not None:
        f = f.filter(F.col("period") == period)
    if through is not None:
        f = f.filter(F.col("period") <= through)
    return f


def dim_date(t: Tables, through: str | None = None) -> DataFrame:
    """K7 over the months present in the facts: period, year, month, quarter."""
    periods = fact_sales(t, through=through).select("period").distinct()
    return periods.select(
        "period",
        F.substring("period", 1, 4).cast("int").alias("year"),
        F.substring("period", 6, 2).cast("int").alias("month"),
        ((F.substring("period", 6, 2).cast("int") - 1) / 3 + 1).cast("int").alias("quarter"))


def _brand_number():
    return F.substring_index("p_brand", "#", -1).cast("int")


def _brand_name(bn):
    return F.element_at(F.array(*[F.lit(b) for b in vocab.FIXTURE_BRANDS]), bn)


def brand_spellings(name) -> dict:
    """The ways a brand is typed: as it is, in capitals, a character dropped, without
    spaces, two characters swapped."""
    return {"plain": name, "capitals": F.upper(name),
            "dropped": F.concat(F.substr(name, F.lit(1), F.lit(2)), F.substr(name, F.lit(4))),
            "joined": F.replace(name, F.lit(" "), F.lit("")),
            "swapped": F.concat(F.substr(name, F.lit(1), F.lit(3)), F.substr(name, F.lit(5), F.lit(1)),
                                F.substr(name, F.lit(4), F.lit(1)), F.substr(name, F.lit(6)))}


def products(t: Tables) -> DataFrame:
    """One product line per part: sku_code, partkey, brand, bn, product_desc,
    freight_tag (the parsed form of ``[SKUn] [brand]desc{tag}``)."""
    p = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    typed = brand_spellings(_brand_name(_brand_number()))
    turn = F.col("p_partkey") % 19
    tag = (F.when(F.col("p_size") == 50, F.lit("Drone Courier"))
           .when(F.col("p_size") % 4 == 1, F.lit("Express Freight"))
           .when(F.col("p_size") % 4 == 2, F.lit("Standard Freight"))
           .when(F.col("p_size") % 4 == 3, F.lit("15-Day Express"))
           .otherwise(F.lit("")))
    return p.select(
        F.col("p_partkey").alias("partkey"),
        F.concat(F.lit("SKU"), F.col("p_partkey").cast("string")).alias("sku_code"),
        F.when(F.col("p_partkey") % 7 == 0, typed["capitals"]).when(turn == 3, typed["dropped"])
        .when(turn == 7, typed["joined"]).when(turn == 11, typed["swapped"]).otherwise(typed["plain"])
        .alias("brand"),
        _brand_number().alias("bn"),
        F.concat(F.col("p_name"), F.lit(" "), F.lower("p_type")).alias("product_desc"),
        tag.alias("freight_tag"))


def _category_by_bn(bn, shift: int = 0):
    cats = F.array(*[F.lit(c) for c in vocab.CATEGORIES])
    return F.element_at(cats, ((bn + F.lit(shift)) % 6 + 1).cast("int"))


def brand_categories(t: Tables) -> DataFrame:
    """Reference brand list: brand_variants 'Name/NAME/Nme/Joined' (the spellings decided
    earlier; those with swapped letters are new), confirmed_category (brand 25 left
    blank → new-brand queue), line_no."""
    # an aggregate's result, not its key: no filter on what follows is asked of every part
    b = t.part.groupBy(F.col("p_brand").alias("_b")).agg(F.max("p_brand").alias("p_brand"))
    bn = _brand_number()
    typed = brand_spellings(_brand_name(bn))
    return b.select(
        F.concat_ws("/", *(typed[k] for k in ("plain", "capitals", "dropped", "joined"))).alias("brand_variants"),
        F.when(bn == 25, F.lit("")).otherwise(_category_by_bn(bn)).alias("confirmed_category"),
        bn.cast("bigint").alias("line_no"))


def sku_overrides(t: Tables) -> DataFrame:
    """Reference SKU overrides: every 50th part → supplement."""
    return (t.part.select("p_partkey").filter(F.col("p_partkey") % 50 == 0)
            .select(F.concat(F.lit("SKU"), F.col("p_partkey").cast("string")).alias("sku_code"),
                    F.lit("supplement").alias("override_category"),
                    F.lit("store decision").alias("reason")))


def known_skus(t: Tables) -> DataFrame:
    """SKUs already in the dimension (every third part), classified under an
    older rule set: category shifted by one, premium for brands 1-4."""
    p = products(t).filter(F.col("partkey") % 3 == 0)
    cat = _category_by_bn(F.col("bn"), 1)
    return p.select("sku_code", "brand", "product_desc",
                    cat.alias("category"),
                    F.when(F.col("bn") <= 4, F.lit("premium")).otherwise(F.lit("regular"))
                    .alias("tier"),
                    R.shipping_for(cat, F.col("freight_tag")).alias("shipping_channel"))


def conflict_reviewed(t: Tables) -> DataFrame:
    """Reference list of settled conflicts: every 13th part."""
    return (t.part.select("p_partkey").filter(F.col("p_partkey") % 13 == 0)
            .select(F.concat(F.lit("SKU"), F.col("p_partkey").cast("string")).alias("sku_code"),
                    F.lit("keep brand default").alias("decision")))


def brand_resolutions(t: Tables) -> DataFrame:
    """The stored fuzzy resolutions (norm_brand, fuzzy_brand, ratio), with every spelling of the
    product lines scored; a load that brings no new spelling leaves the table as it is."""
    table = FZ.resolution_table(t.spark, f"{warehouse.folder(t.spark, _inputs(t, ['part']))}/brand_resolutions")
    if not table.version():
        FZ.keep_resolutions(table, products(t).select("brand"))
    return table.read().select("norm_brand", "fuzzy_brand", "ratio")


def classified(t: Tables, rules: vocab.RuleSet = vocab.FIXTURE_RULES) -> DataFrame:
    """Product lines after J6 precedence + tier + shipping, brands resolved fuzzily too."""
    fuzzy = (brand_resolutions(t) if rules is vocab.FIXTURE_RULES
             else FZ.fuzzy_resolve(products(t).select("brand"), rules))
    return C.classify_products(products(t), brand_categories(t), sku_overrides(t),
                               known_skus(t), rules, fuzzy)


def dim_product(t: Tables, rules: vocab.RuleSet = vocab.FIXTURE_RULES) -> DataFrame:
    """dim_product: partkey, sku_code, brand, product_desc, category, tier,
    shipping_channel, product_type (stored once for the default rule set)."""
    def build() -> DataFrame:
        return (C.with_product_type(classified(t, rules), rules)
                .select("partkey", "sku_code", "brand", "product_desc", "category", "tier",
                        "shipping_channel", "product_type"))
    return warehouse.materialized(t.spark, "dim_product", _inputs(t, ["part"]), build,
                                  store=rules is vocab.FIXTURE_RULES)


def sales(t: Tables, period: str | None = None, through: str | None = None,
          rules: vocab.RuleSet = vocab.FIXTURE_RULES) -> DataFrame:
    """fact_sales ⋈ dim_product — the facts with their product attributes.

    Every report block reads facts together with product attributes, so the
    joined relation is stored once (partitioned by period, like the facts)
    instead of being re-joined by every query; the join itself is left to
    the planner/AQE (both sides grow with the data)."""
    def build() -> DataFrame:
        return fact_sales(t).join(dim_product(t, rules).drop("sku_code"), "partkey")
    s = warehouse.materialized(t.spark, "sales",
                               _inputs(t, ["lineitem", "supplier", "nation", "part"]), build,
                               partition_by=["period"], cluster_by=["store_id", "partkey"],
                               store=rules is vocab.FIXTURE_RULES)
    if period is not None:
        s = s.filter(F.col("period") == period)
    if through is not None:
        s = s.filter(F.col("period") <= through)
    return s


def fact_channel(t: Tables, period: str | None = None, through: str | None = None) -> DataFrame:
    """The stored channel fact table (partitioned by period)."""
    f = warehouse.materialized(t.spark, "fact_channel",
                               _inputs(t, ["orders", "customer", "nation", "lineitem"]),
                               lambda: build_fact_channel(t), partition_by=["period"],
                               cluster_by=["store_id", "channel_code"])
    if period is not None:
        f = f.filter(F.col("period") == period)
    if through is not None:
        f = f.filter(F.col("period") <= through)
    return f


def build_fact_channel(t: Tables, period: str | None = None,
                       through: str | None = None) -> DataFrame:
    """fact_channel at grain (period, store, channel_code)."""
    o = _periodise(t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"),
                   "o_orderdate", period, through)
    cust = t.customer.select("c_custkey", "c_nationkey")
    li = t.lineitem.select("l_orderkey", "l_quantity", "l_extendedprice")
    code = F.element_at(_small_map(CHANNEL_BY_PRIORITY), F.col("o_orderpriority"))
    lines = (li.join(o, F.col("o_orderkey") == F.col("l_orderkey"))
             .join(cust, F.col("o_custkey") == F.col("c_custkey"))
             .join(_nation_region(t), F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.date_format("o_orderdate", "yyyy-MM").alias("period"), "store_id",
                     code.alias("channel_code"), "o_orderkey",
                     F.col("l_quantity").cast("bigint").alias("qty"),
                     money("l_extendedprice").alias("amount")))
    return (lines.groupBy("period", "store_id", "channel_code")
            .agg(F.count_distinct("o_orderkey").alias("order_count"),
                 F.sum("qty").alias("qty"), F.sum("amount").alias("amount"))
            .withColumn("channel_group",
                        F.element_at(_small_map(vocab.CHANNEL_GROUP), F.col("channel_code"))))


def monthly_context_source(t: Tables) -> DataFrame:
    """Hand-entered context rows as they would arrive (all strings):
    line_no, store_id, period (one malformed), foot_traffic (blank every
    10th month), leads, completion rate, flag, note, activity text."""
    o = t.orders.select("o_custkey", "o_orderdate", "o_orderstatus")
    cust = t.customer.select("c_custkey", "c_nationkey")
    g = (o.join(cust, F.col("o_custkey") == F.col("c_custkey"))
         .join(_nation_region(t), F.col("c_nationkey") == F.col("n_nationkey"))
         .groupBy("store_id", F.date_format("o_orderdate", "yyyy-MM").alias("period"))
         .agg(F.count_distinct("o_custkey").alias("ft"),
              F.count_if(F.col("o_orderstatus") == "P").alias("leads"),
              F.count_if(F.col("o_orderstatus") == "F").alias("n_f"),
              F.count(F.lit(1)).alias("n")))
    mnum = F.substring("period", 1, 4).cast("int") * 12 + F.substring("period", 6, 2).cast("int")
    rate = F.round((F.lit(100.0) * F.col("n_f") / F.col("n")).cast("decimal(38,10)"), 2)
    return g.select(
        (F.col("store_id") * 100000 + mnum).cast("bigint").alias("line_no"),
        "store_id",
        F.when((F.col("store_id") == 4) & (F.col("period") == "1995-01"), F.lit("1995-1"))
        .otherwise(F.col("period")).alias("period"),
        F.when((mnum + F.col("store_id")) % 10 == 0, F.lit(" "))
        .otherwise(F.col("ft").cast("string")).alias("foot_traffic"),
        F.col("leads").cast("string").alias("miniprogram_leads"),
        rate.cast("string").alias("miniprogram_completion_rate"),
        F.when(F.col("leads") % 3 == 0, F.lit("Yes")).alias("study_tour_flag"),
        F.when(F.col("leads") % 3 == 0, F.concat(F.lit("group of "), F.col("leads").cast("string")))
        .alias("study_tour_note"),
        F.when(F.col("n") % 2 == 0, F.lit("Member night; tasting, ;window display"))
        .alias("activity_description"))


def report_period(t: Tables) -> str:
    """The reporting month — the latest month with orders (one scalar)."""
    return (t.orders.select(F.max(F.date_format("o_orderdate", "yyyy-MM")).alias("p"))
            .first()["p"])


@lru_cache(maxsize=16)
def _cached_period(version: str, root: str, spark) -> str:
    return report_period(Tables(spark, root))


def reporting_month(t: Tables) -> str:
    """``report_period``, read once per version of the orders."""
    return _cached_period(warehouse.folder(t.spark, _inputs(t, ["orders"])), t.root, t.spark)
