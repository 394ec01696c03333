"""The report query set, computed for every (store, period) group at once.

Each function takes a ``Tables`` handle plus an optional ``period`` (one
reporting month: the filter becomes a ship-date range on the scan) or
``through`` (as-of bound for trend queries) and returns a DataFrame whose
first columns are the report grain ``store_id, period``.

Scale notes
  * Shares use a window partitioned by the report grain over *aggregated*
    rows (a handful of buckets/categories/brands per group), never an empty
    ``OVER ()``.
  * SKU-level ranking (top-k, deciles) never puts a whole group in one task:
    ``ranking.top_k`` uses a partial group limit, ``ranking.ranged_ntile``
    range-partitions the group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions import rules as R
from ..functions.numeric import mom_pct, mom_pct_zero_baseline, pct, pct_or_zero, ratio
from ..functions.text import context_line, display_label, month_label
from ..sources import star
from ..sources.tables import Tables
from . import ranking

G = ["store_id", "period"]


def _d(c: str):
    return F.col(c).cast("double")


# ---------------------------------------------------------------- presentation
# ENUM columns sort by declaration order, not alphabetically (trap T2).
ENUM_ORDER = {
    "bucket": ["premium", "regular", "milk_powder"],
    "tier": vocab.TIERS,
    "shipping_channel": vocab.SHIPPING,
    "category": vocab.CATEGORIES,
    "channel_group": ["local", "export"],
}


def enum_rank(col: str) -> "F.Column":
    order = ENUM_ORDER[col]
    return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col)),
                      F.lit(len(order) + 1))


def presentation_order(df: DataFrame, keys: list) -> DataFrame:
    """O3: sort a finished (small) report block for display; ENUM columns by
    their declared order, anything else as given (e.g. ``F.desc('amount')``).
    Only for presentation: results are otherwise unordered sets."""
    cols = [enum_rank(k) if isinstance(k, str) and k in ENUM_ORDER else k for k in keys]
    return df.orderBy(*cols)


# ---------------------------------------------------------------- headline
def headline(t: Tables, period: str | None = None) -> DataFrame:
    """A1 + P22: revenue, units, orders and average order value."""
    return (star.fact_sales(t, period=period).groupBy(*G)
            .agg(F.sum("amount").alias("_amt"), F.sum("qty").alias("units"),
                 F.sum("order_count").alias("orders"))
            .select(*G, _d("_amt").alias("revenue"), "units", "orders",
                    ratio("_amt", "orders", 2).alias("avg_order_value")))


def monthly_totals(t: Tables, through: str | None = None) -> DataFrame:
    return (star.fact_sales(t, through=through).groupBy(*G)
            .agg(F.sum("amount").alias("amount"), F.sum("qty").alias("qty")))


def mom_sql(t: Tables, through: str | None = None) -> DataFrame:
    """LAG month-on-month per store over the months present (NULL on the
    first month and on a zero baseline)."""
    w = Window.partitionBy("store_id").orderBy("period")
    m = (monthly_totals(t, through)
         .withColumn("prev_amount", F.lag("amount").over(w))
         .withColumn("prev_qty", F.lag("qty").over(w)))
    return m.select(*G, _d("amount").alias("amount"), _d("prev_amount").alias("prev_amount"),
                    mom_pct("amount", "prev_amount").alias("amount_mom_pct"),
                    mom_pct("qty", "prev_qty").alias("qty_mom_pct"))


def mom_pipeline(t: Tables, through: str | None = None) -> DataFrame:
    """The pipeline's list form — one value per month after the first,
    0.0 on a zero baseline."""
    w = Window.partitionBy("store_id").orderBy("period")
    m = (monthly_totals(t, through)
         .withColumn("prev_amount", F.lag("amount").over(w))
         .withColumn("prev_qty", F.lag("qty").over(w))
         .filter(F.col("prev_amount").isNotNull()))
    return m.select(*G, mom_pct_zero_baseline("amount", "prev_amount").alias("amount_mom_pct"),
                    mom_pct_zero_baseline("qty", "prev_qty").alias("qty_mom_pct"))


# ---------------------------------------------------------------- shares and mixes
def _with_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("bucket", R.report_bucket("category", "tier"))


def tier_split(t: Tables, period: str | None = None) -> DataFrame:
    """A2 + P17 + W1: revenue by bucket with its share of the store-month."""
    a = _with_bucket(star.sales(t, period=period)).groupBy(*G, "bucket") \
        .agg(F.sum("amount").alias("amount"))
    tot = F.sum("amount").over(Window.partitionBy(*G))
    return a.select(*G, "bucket", _d("amount").alias("amount"),
                    pct("amount", tot, 2).alias("pct_of_total"))


def bucket_trend(t: Tables, through: str | None = None) -> DataFrame:
    """A3 + F7: amount and units per (period, bucket) up to the reporting month."""
    a = _with_bucket(star.sales(t, through=through)).groupBy(*G, "bucket") \
        .agg(F.sum("amount").alias("amount"), F.sum("qty").alias("qty"))
    return a.select(*G, "bucket", _d("amount").alias("amount"), "qty")


def _mix(s: DataFrame) -> DataFrame:
    a = s.groupBy(*G, "category").agg(F.sum("amount").alias("amount"), F.sum("qty").alias("qty"))
    w = Window.partitionBy(*G)
    return a.select(*G, "category", _d("amount").alias("amount"), "qty",
                    pct_or_zero("amount", F.sum("amount").over(w), 1).alias("amount_pct"),
                    pct_or_zero("qty", F.sum("qty").over(w), 1).alias("qty_pct"))


def category_mix(t: Tables, period: str | None = None) -> DataFrame:
    """A4: revenue share against unit share per category."""
    return _mix(star.sales(t, period=period))


def premium_mix(t: Tables, period: str | None = None) -> DataFrame:
    """A5: the same, within premium (premium milk powder included)."""
    return _mix(star.sales(t, period=period).filter(F.col("tier") == "premium"))


def _sku_rows(t: Tables, period: str | None) -> DataFrame:
    # fact_sales is already at SKU grain per (store, period)
    return star.sales(t, period=period).select(
        *G, "sku_code", "brand", "product_desc", "category", "tier", "shipping_channel",
        "product_type", "qty", "amount")


def _best_sellers(t: Tables, period: str | None, k: int) -> DataFrame:
    """The SKU rows of the first k by units (sku_code breaks ties) with ``rnk``.  The units of the
    k-th are counted first, by hash, so that only rows that reach them are sorted."""
    rows = _sku_rows(t, period)
    down = Window.partitionBy(*G).orderBy(F.desc("qty")).rowsBetween(Window.unboundedPreceding, 0)
    least = (rows.groupBy(*G, "qty").count().withColumn("_n", F.sum("count").over(down))
             .where(F.col("_n") >= k).groupBy(*[F.col(c).alias(f"_{c}") for c in G])
             .agg(F.max("qty").alias("_least")))
    same = F.col("store_id").eqNullSafe(F.col("_store_id")) & F.col("period").eqNullSafe(F.col("_period"))
    # one row a report at most; without a bound (fewer rows, or units unknown) all rows are ranked
    near = (rows.join(F.broadcast(least), same, "left")
            .where(F.col("_least").isNull() | (F.col("qty") >= F.col("_least"))).select(*rows.columns))
    return ranking.top_k(near, G, [F.desc("qty"), F.asc("sku_code")], k)


def top_products(t: Tables, period: str | None = None, k: int = 10) -> DataFrame:
    """O1 + W5: best sellers by units (sku_code breaks ties)."""
    top = _best_sellers(t, period, k)
    return top.select(*G, "rnk", "sku_code", "brand", "product_desc", "category", "tier",
                      "qty", _d("amount").alias("amount"))


def structure_intro(t: Tables, period: str | None = None, k: int = 10) -> DataFrame:
    """Premium amount and share, leading premium category and its share,
    premium seats in the top k."""
    s = star.sales(t, period=period)
    total = s.groupBy(*G).agg(F.sum("amount").alias("store_amount"))
    prem = (s.filter(F.col("tier") == "premium").groupBy(*G, "category")
            .agg(F.sum("amount").alias("amount")))
    prem_tot = prem.groupBy(*G).agg(
        F.sum("amount").alias("premium_amount"),
        F.min_by("category", F.struct(-F.col("amount"), F.col("category"))).alias("lead_cat"),
        F.max("amount").alias("lead_amount"))
    top = (_best_sellers(t, period, k)
           .groupBy(*G).agg(F.count_if(F.col("tier") == "premium").alias("premium_in_top10"),
                            F.count(F.lit(1)).alias("top_n")))
    j = total.join(prem_tot, G, "left").join(top, G, "left")
    pa = F.coalesce(F.col("premium_amount"), F.lit(0).cast("decimal(22,2)"))
    return j.select(
        *G, pa.cast("double").alias("premium_amount"),
        pct_or_zero(pa, "store_amount", 1).alias("premium_pct_of_store"),
        F.col("lead_cat").alias("leading_premium_category"),
        pct_or_zero("lead_amount", "premium_amount", 1).alias("leading_premium_pct"),
        F.coalesce("premium_in_top10", F.lit(0)).cast("bigint").alias("premium_in_top10"),
        F.coalesce("top_n", F.lit(0)).cast("bigint").alias("top_n"))


def _brand_key(df: DataFrame) -> DataFrame:
    """Brand grouping is case/accent-insensitive with trailing-space padding."""
    return df.withColumn("brand_key", F.collate(F.col("brand"), "UNICODE_CI_AI_RTRIM"))


def _brand_cells(s: DataFrame) -> DataFrame:
    """Per spelling and category: amount, the largest row's (``top``) and whether a row has none
    (``gaps``).  A collated key can only be grouped by sorting, so the facts are summed by the
    spelling as typed first, and only these few rows are collated."""
    return _brand_key(s.groupBy(*G, "brand", "category").agg(
        F.sum("amount").alias("ca"), F.max("amount").alias("top"),
        F.max(F.col("amount").isNull()).alias("gaps")))


def _largest_rows(s: DataFrame, cells: DataFrame) -> DataFrame:
    """``cells`` with ``main`` (a struct of the category of the brand's largest row, a row without an
    amount first) on those that hold it, and rows of brands where categories tie: there the smallest
    sku_code among the largest rows decides, and only for these the facts are read again."""
    w = Window.partitionBy(*G, "brand_key")
    led = (cells.withColumn("_lead", F.when(~F.max("gaps").over(w), F.max("top").over(w)))
           .withColumn("_leads", F.when(F.col("_lead").isNull(), F.col("gaps")).otherwise(
               F.col("top").eqNullSafe(F.col("_lead")))))
    led = led.withColumn("_n", F.size(F.collect_set(F.when(F.col("_leads"), F.struct("category"))).over(w)))
    main = F.when(F.col("_leads") & (F.col("_n") == 1), F.struct("category")).alias("main")
    tied = led.where("_leads AND _n > 1").select(
        *[F.col(c).alias(f"_{c}") for c in [*G, "brand", "category"]], "_lead")
    same = F.lit(True)
    for c in [*G, "brand", "category"]:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    # at most a few cells per brand and report; unhinted, all facts would be shuffled to meet them
    rows = s.join(F.broadcast(tied), same & F.col("amount").eqNullSafe(F.col("_lead")))
    settled = _brand_key(rows).groupBy(*G, "brand_key").agg(
        F.struct(F.min_by("category", F.struct("sku_code")).alias("category")).alias("main"))
    return led.select(*cells.columns, main).unionByName(settled, allowMissingColumns=True)


def top_brands(t: Tables, period: str | None = None, k: int = 10,
               main_category: str = "largest_sum") -> DataFrame:
    """A7 + A8 + O2: brand revenue, share of the store-month and main
    category; ``main_category`` is ``largest_sum`` (category with the largest
    total) or ``largest_row`` (category of the largest single fact row)."""
    s = star.sales(t, period=period)
    cells = _brand_cells(s)
    money = cells.schema["ca"].dataType
    if main_category == "largest_sum":
        bc = (cells.groupBy(*G, "brand_key", "category").agg(F.sum("ca").cast(money).alias("ca"),
                                                              F.min("brand").alias("b"))
              .groupBy(*G, "brand_key")
              .agg(F.sum("ca").alias("amount"), F.min("b").alias("brand"),
                   F.min_by("category", F.struct(-F.col("ca"), F.col("category")))
                   .alias("main_category")))
    else:
        bc = (_largest_rows(s, cells).groupBy(*G, "brand_key")
              .agg(F.sum("ca").cast(money).alias("amount"), F.min("brand").alias("brand"),
                   F.first("main", ignorenulls=True)["category"].alias("main_category")))
    bc = bc.withColumn("store_total", F.sum("amount").over(Window.partitionBy(*G)))
    top = ranking.top_k(bc, G, [F.desc("amount"), F.asc("brand")], k)
    return top.select(*G, "rnk", "brand", _d("amount").alias("amount"),
                      pct("amount", "store_total", 1).alias("pct_of_store"), "main_category")


def milk_brands(t: Tables, period: str | None = None) -> DataFrame:
    """Milk powder brands with their share of the category."""
    cells = _brand_cells(star.sales(t, period=period).filter(F.col("category") == "milk_powder"))
    b = cells.groupBy(*G, "brand_key").agg(F.sum("ca").cast(cells.schema["ca"].dataType).alias("amount"),
                                            F.min("brand").alias("brand"))
    tot = F.sum("amount").over(Window.partitionBy(*G))
    return b.select(*G, "brand", _d("amount").alias("amount"),
                    pct("amount", tot, 1).alias("pct_of_category"))


# ---------------------------------------------------------------- trends
def pickup_tier_trend(t: Tables, through: str | None = None) -> DataFrame:
    """A10 + F10: in-store pickup milk powder by tier and month."""
    s = star.sales(t, through=through).filter(
        (F.col("category") == "milk_powder") & (F.col("shipping_channel") == "local"))
    return (s.groupBy(*G, "tier").agg(F.sum("amount").alias("amount"), F.sum("qty").alias("qty"))
            .select(*G, "tier", _d("amount").alias("amount"), "qty"))


def functional_trend(t: Tables, through: str | None = None, variant: str = "sql") -> DataFrame:
    """A11 + F9 (trap T7): ``sql`` keeps the catch-all type and filters on
    category; ``pipeline`` drops not_applicable and other_supplement."""
    s = star.sales(t, through=through)
    if variant == "sql":
        s = s.filter((F.col("category") == "supplement") & F.col("product_type").isNotNull()
                     & (F.col("product_type") != vocab.NOT_APPLICABLE))
    else:
        s = s.filter(~F.col("product_type").isin(vocab.NOT_APPLICABLE, vocab.CATCH_ALL_TYPE))
    return (s.groupBy(*G, "product_type")
            .agg(F.sum("qty").alias("qty"), F.sum("amount").alias("amount"))
            .select(*G, "product_type", "qty", _d("amount").alias("amount")))


def channel_trend(t: Tables, through: str | None = None) -> DataFrame:
    """A12 + W2: units per channel group with its share of the month."""
    c = (star.fact_channel(t, through=through).groupBy(*G, "channel_group")
         .agg(F.sum("qty").alias("qty"), F.sum("amount").alias("amount")))
    tot = F.sum("qty").over(Window.partitionBy(*G))
    return c.select(*G, "channel_group", "qty", _d("amount").alias("amount"),
                    pct("qty", tot, 1).alias("qty_pct"))


def channel_totals(t: Tables, through: str | None = None) -> DataFrame:
    """Channel group totals over all months per store."""
    return (star.fact_channel(t, through=through).groupBy("store_id", "channel_group")
            .agg(F.sum("order_count").alias("order_count"), F.sum("qty").alias("qty"),
                 F.sum("amount").alias("_a"))
            .select("store_id", "channel_group", "order_count", "qty",
                    _d("_a").alias("amount")))


def pickup_share(t: Tables, through: str | None = None) -> DataFrame:
    """Premium share of in-store pickup milk powder per month (0 when
    there is none)."""
    s = star.sales(t, through=through).filter(
        (F.col("category") == "milk_powder") & (F.col("shipping_channel") == "local"))
    a = s.groupBy(*G).agg(F.sum(F.when(F.col("tier") == "premium", F.col("amount"))).alias("p"),
                          F.sum("amount").alias("a"))
    return a.select(*G, _d("a").alias("pickup_amount"),
                    pct_or_zero(F.coalesce("p", F.lit(0)), "a", 1).alias("premium_pickup_pct"))


def sku_pareto(t: Tables, period: str | None = None, k: int = 10) -> DataFrame:
    """A13 + W7 + W8: SKU revenue deciles (NTILE 10, amount desc, sku_code
    tie-break), decile totals and the cumulative share."""
    skus = star.fact_sales(t, period=period).select(*G, "sku_code", "amount")
    ranked = ranking.ranged_ntile(skus, G, [F.desc("amount"), F.asc("sku_code")], k,
                                  out="decile")
    d = ranked.groupBy(*G, "decile").agg(F.count(F.lit(1)).alias("sku_count"),
                                         F.sum("amount").alias("decile_amount"))
    run = F.sum("decile_amount").over(
        Window.partitionBy(*G).orderBy("decile").rowsBetween(Window.unboundedPreceding, 0))
    tot = F.sum("decile_amount").over(Window.partitionBy(*G))
    return d.select(*G, "decile", "sku_count", _d("decile_amount").alias("decile_amount"),
                    pct(run, tot, 1).alias("cumulative_pct"))


# ---------------------------------------------------------------- trend window
def trend_window(monthly: DataFrame, months: int = vocab.TREND_MONTHS) -> DataFrame:
    """F8: keep the last ``months`` distinct periods present per store."""
    w = Window.partitionBy("store_id").orderBy(F.desc("period"))
    return monthly.withColumn("_r", F.dense_rank().over(w)).filter(F.col("_r") <= months) \
        .drop("_r")


def bucket_matrix(t: Tables, through: str | None = None,
                  months: int = vocab.TREND_MONTHS) -> DataFrame:
    """Period x bucket over the trend window, 0 for absent cells."""
    trend = bucket_trend(t, through)
    periods = trend_window(trend.select(*G).distinct(), months)
    grid = periods.withColumn("bucket", F.explode(F.array(*[F.lit(b) for b in
                                                            ["premium", "regular",
                                                             "milk_powder"]])))
    return (grid.join(trend, [*G, "bucket"], "left")
            .select(*G, "bucket", F.coalesce("amount", F.lit(0.0)).alias("amount"),
                    F.coalesce("qty", F.lit(0)).cast("bigint").alias("qty")))


def trend_series(t: Tables, through: str | None = None,
                 months: int = vocab.TREND_MONTHS) -> DataFrame:
    """R6 + W4: per store, arrays over the trend window — periods, labels,
    amount/qty totals and their month-on-month lists."""
    m = trend_window(monthly_totals(t, through), months)
    arr = (m.groupBy("store_id")
           .agg(F.array_sort(F.collect_list(F.struct("period", "amount", "qty"))).alias("s")))
    from ..functions.numeric import mom_list
    amounts = F.transform("s", lambda x: x["amount"].cast("double"))
    qtys = F.transform("s", lambda x: x["qty"].cast("double"))
    return arr.select(
        "store_id",
        F.transform("s", lambda x: x["period"]).alias("trend_periods"),
        F.transform("s", lambda x: month_label(x["period"])).alias("trend_labels"),
        amounts.alias("amount_totals"), mom_list(amounts).alias("amount_mom_pct"),
        qtys.alias("qty_totals"), mom_list(qtys).alias("qty_mom_pct"))


def trend_series_rows(t: Tables, through: str | None = None,
                      months: int = vocab.TREND_MONTHS) -> DataFrame:
    """``trend_series`` flattened to one row per (store, position) for checking."""
    s = trend_series(t, through, months)
    z = s.select("store_id", F.posexplode(F.arrays_zip(
        "trend_periods", "trend_labels", "amount_totals", "qty_totals")).alias("i", "z"),
        "amount_mom_pct", "qty_mom_pct")
    return z.select("store_id", (F.col("i") + 1).alias("idx"),
                    F.col("z.trend_periods").alias("period"),
                    F.col("z.trend_labels").alias("period_label"),
                    F.col("z.amount_totals").alias("amount_total"),
                    F.col("z.qty_totals").alias("qty_total"),
                    F.when(F.col("i") > 0, F.element_at("amount_mom_pct", F.col("i")))
                    .alias("amount_mom_pct"),
                    F.when(F.col("i") > 0, F.element_at("qty_mom_pct", F.col("i")))
                    .alias("qty_mom_pct"))


def channel_series(t: Tables, through: str | None = None,
                   months: int = vocab.TREND_MONTHS) -> DataFrame:
    """The four channel series over the trend window, one row per (store, position): local
    and export units and their month-on-month lists (0 units for a group without sales)."""
    units = lambda g: F.coalesce(F.sum(F.when(F.col("channel_group") == g, F.col("qty"))), F.lit(0)).cast("double")
    per = (star.fact_channel(t, through=through).groupBy(*G)
           .agg(units("local").alias("local_qty"), units("export").alias("export_qty")))
    w = Window.partitionBy("store_id").orderBy("period")
    out = trend_window(per, months).withColumn("idx", F.row_number().over(w))
    for c in ("local_qty", "export_qty"):
        out = out.withColumn("_prev", F.lag(c).over(w)).withColumn(
            f"{c}_mom_pct", F.when(F.col("idx") > 1, mom_pct_zero_baseline(c, "_prev")))
    return out.select("store_id", "idx", "period", month_label("period").alias("period_label"), "local_qty",
                      "local_qty_mom_pct", "export_qty", "export_qty_mom_pct")


def functional_top(t: Tables, through: str | None = None, n: int = 6) -> DataFrame:
    """Top-n functional types by units over all months, under their display
    labels, the rest summed into 'Other (k types)', missing months filled with 0."""
    f = functional_trend(t, through, variant="pipeline")
    periods = f.select(*G).distinct()
    tot = f.groupBy("store_id", "product_type").agg(F.sum("qty").alias("tq"))
    w = Window.partitionBy("store_id").orderBy(F.desc("tq"), F.asc("product_type"))
    ranked = (tot.withColumn("_r", F.row_number().over(w))
              .withColumn("_others", F.count_if(F.col("_r") > n)
                          .over(Window.partitionBy("store_id"))))
    lab = ranked.select("store_id", "product_type",
                        F.when(F.col("_r") <= n, display_label("product_type", "product_type"))
                        .otherwise(F.concat(F.lit("Other ("), F.col("_others").cast("string"),
                                            F.lit(" types)"))).alias("label"))
    labelled = f.join(lab, ["store_id", "product_type"]).groupBy(*G, "label") \
        .agg(F.sum("qty").alias("qty"))
    grid = periods.join(lab.select("store_id", "label").distinct(), "store_id")
    return (grid.join(labelled, [*G, "label"], "left")
            .select(*G, "label", F.coalesce("qty", F.lit(0)).cast("bigint").alias("qty")))


def functional_leader(t: Tables, through: str) -> DataFrame:
    """Each store's leading functional type by units in the reporting month
    (``through``); NULL where the store sold none in it."""
    f = functional_trend(t, through, variant="pipeline").where(F.col("period") == through)
    best = (f.groupBy("store_id")
            .agg(F.min_by("product_type", F.struct(-F.col("qty"), F.col("product_type")))
                 .alias("leader"), F.max("qty").alias("leader_qty")))
    stores = star.fact_sales(t, through=through).select("store_id").distinct()
    return (stores.join(best, "store_id", "left")
            .select("store_id", F.lit(through).alias("period"),
                    display_label("leader", "product_type").alias("leader"), "leader_qty"))


# ---------------------------------------------------------------- context, header
def parse_monthly_context(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trim, blank -> NULL, malformed periods reported, flag default
    'no' lower-cased, last row per (store, period) wins.  Returns (rows, malformed)."""
    cols = ["foot_traffic", "miniprogram_leads", "miniprogram_completion_rate",
            "study_tour_flag", "study_tour_note", "activity_description"]
    clean = raw.select("line_no", "store_id", F.nullif(F.trim("period"), F.lit("")).alias("period"),
                       *[F.nullif(F.trim(c), F.lit("")).alias(c) for c in cols])
    clean = clean.filter(F.col("period").isNotNull())
    ok = F.col("period").rlike(r"^\d{4}-\d{2}$")
    malformed = clean.filter(~ok)
    from .classify import first_per_key
    rows = first_per_key(clean.filter(ok), ["store_id", "period"], ["line_no"], last=True)
    rows = rows.select(
        "store_id", "period",
        F.col("foot_traffic").try_cast("int").alias("foot_traffic"),
        F.col("miniprogram_leads").try_cast("int").alias("miniprogram_leads"),
        F.col("miniprogram_completion_rate").try_cast("decimal(5,2)")
        .alias("miniprogram_completion_rate"),
        F.lower(F.coalesce("study_tour_flag", F.lit("no"))).alias("study_tour_flag"),
        "study_tour_note", "activity_description")
    return rows, malformed


def operating_context(t: Tables, through: str | None = None) -> DataFrame:
    """The six hand-entered columns per report month (NULL when the
    month has no row)."""
    rows, _ = parse_monthly_context(star.monthly_context_source(t))
    grain = star.fact_sales(t, through=through).select(*G).distinct()
    j = grain.join(rows, G, "left")
    return j.select(*G, "foot_traffic", "miniprogram_leads",
                    F.col("miniprogram_completion_rate").cast("double")
                    .alias("miniprogram_completion_rate"),
                    "study_tour_flag", "study_tour_note", "activity_description")


def context_gaps(t: Tables, through: str | None = None) -> DataFrame:
    """Report months with no context row (missing) or with a blank
    foot traffic figure (incomplete)."""
    rows, _ = parse_monthly_context(star.monthly_context_source(t))
    grain = star.fact_sales(t, through=through).select(*G).distinct()
    missing = grain.join(rows, G, "left_anti").withColumn("issue", F.lit("missing"))
    incomplete = (grain.join(rows.filter(F.col("foot_traffic").isNull()), G, "left_semi")
                  .withColumn("issue", F.lit("incomplete")))
    return missing.unionByName(incomplete)


def report_header(t: Tables, through: str | None = None) -> DataFrame:
    """P30 + P19: one header row per (store, period)."""
    grain = star.fact_sales(t, through=through).select(*G).distinct()
    return (grain.join(star.dim_store(t), "store_id")
            .select(*G, month_label("period").alias("period_label"), "store_code",
                    F.lit(vocab.TREND_MONTHS).alias("trend_months"),
                    context_line("period").alias("context_line")))


def category_labels(t: Tables, period: str | None = None) -> DataFrame:
    """P20: the category mix with display labels for category and bucket."""
    s = _with_bucket(star.sales(t, period=period))
    a = s.groupBy(*G, "category", "bucket").agg(F.sum("amount").alias("amount"))
    return a.select(*G, "category", "bucket",
                    display_label("category", "category").alias("category_label"),
                    display_label("bucket", "tier").alias("bucket_label"),
                    _d("amount").alias("amount"))
