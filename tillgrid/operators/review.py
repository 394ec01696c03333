"""Review queues and import summaries over the classified catalogue.

The source system stops and asks a person at these points; here each one is
a DataFrame a caller inspects (the run proceeds when it is empty)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions import rules as R
from ..functions.text import brand_key
from ..sources import star
from ..sources.tables import Tables
from . import classify as C
from . import fuzzy as FZ

G = ["store_id", "period"]


def classified_view(t: Tables) -> DataFrame:
    return star.classified(t).select(
        "sku_code", "brand", "brand_key", "category", "is_known", "was_overridden",
        "resolved_brand", "resolve_how", "tier", "tier_reason", "shipping_channel")


def dim_product_view(t: Tables) -> DataFrame:
    return star.dim_product(t)


def keyword_conflicts(t: Tables, rules: vocab.RuleSet = vocab.FIXTURE_RULES) -> DataFrame:
    """P9 + P10 for every product line."""
    return (C.conflicts(star.products(t), star.brand_categories(t), rules)
            .select("sku_code", "brand", "product_desc", "brand_category", "keyword_guess",
                    "verdict"))


def new_conflicts(t: Tables, rules: vocab.RuleSet = vocab.FIXTURE_RULES) -> DataFrame:
    """Q2 / J8."""
    checked = keyword_conflicts(t, rules)
    return C.new_conflicts(checked, star.conflict_reviewed(t), star.known_skus(t),
                           star.sku_overrides(t))


def unclassified_brand_skus(t: Tables, rules: vocab.RuleSet = vocab.FIXTURE_RULES) -> DataFrame:
    """Q3: SKUs whose brand has no confirmed category."""
    return keyword_conflicts(t, rules).filter(F.col("verdict") == "brand_not_classified") \
        .select("sku_code", "brand", "product_desc")


def _month_products(t: Tables) -> DataFrame:
    """Product lines sold per (store, month) with their amount."""
    f = star.fact_sales(t).select(*G, "partkey", "amount")
    return f.join(star.products(t), "partkey").select(*G, "sku_code", "brand", "product_desc",
                                                      F.col("amount").alias("total_amt"))


def brand_inventory(t: Tables) -> DataFrame:
    """A14 per (store, month)."""
    inv = (_month_products(t).withColumn("brand_key", brand_key("brand"))
           .groupBy(*G, "brand_key")
           .agg(F.array_join(F.array_sort(F.collect_set("brand")), "/").alias("brand_variants"),
                F.count("sku_code").alias("n_sku"),
                F.sum("total_amt").alias("total_amt"),
                F.min_by("product_desc", F.struct("brand", "sku_code")).alias("sample_product")))
    return inv


def brand_inventory_view(t: Tables) -> DataFrame:
    return brand_inventory(t).withColumn("total_amt", F.col("total_amt").cast("double"))


def new_brands(t: Tables) -> DataFrame:
    """Q1: brands sold in a store-month that have no confirmed category, by revenue
    (``place``), each with the names of known brands that it is close to."""
    cats = C.variant_categories(star.brand_categories(t), skip_blank=True)
    new = brand_inventory(t).join(cats, "brand_key", "left_anti")
    close = (FZ.close_names(new.select("brand_key"), cats).groupBy("brand_key")
             .agg(F.array_sort(F.collect_list(F.struct("rank", "close_name"))).alias("c"))
             .select("brand_key", F.array_join(F.transform("c", lambda x: x["close_name"]), "/").alias("close_names")))
    by_revenue = Window.partitionBy(*G).orderBy(F.desc("total_amt"), "brand_key")
    return (new.join(close, "brand_key", "left").withColumn("place", F.row_number().over(by_revenue))
            .select(*G, "place", "brand_key", "brand_variants", "n_sku",
                    F.col("total_amt").cast("double").alias("total_amt"), "sample_product",
                    F.coalesce("close_names", F.lit("")).alias("close_names")))


def brand_carry_forward(t: Tables) -> DataFrame:
    """Brands in a store's list from any earlier month none of whose spellings
    sold this month are carried with n_sku=0, total_amt=0 and their category; the
    spellings are those of the last month in which the brand sold."""
    inv = brand_inventory(t).select(*G, "brand_key", "brand_variants")
    first = inv.groupBy("store_id", "brand_key").agg(F.min("period").alias("first"))
    months = inv.select(*G).distinct()
    # one row per store, listed brand and month since its first: the size of the result
    listed = months.join(first, "store_id").where(F.col("period") >= F.col("first"))
    since = Window.partitionBy("store_id", "brand_key").orderBy("period")
    carried = (listed.join(inv.withColumnRenamed("brand_variants", "sold"), [*G, "brand_key"], "left")
               .withColumn("brand_variants", F.last("sold", ignorenulls=True).over(since))
               .where(F.col("sold").isNull()))
    cats = C.variant_categories(star.brand_categories(t))
    return (carried.join(cats, "brand_key", "left")
            .select(*G, "brand_variants", F.lit(0).cast("bigint").alias("n_sku"),
                    F.lit(0.0).alias("total_amt"),
                    F.coalesce("category", F.lit("")).alias("confirmed_category")))


def category_spread(t: Tables) -> DataFrame:
    """Brands whose SKUs span more than one category, with counts."""
    d = star.dim_product(t)
    per = d.groupBy("brand", "category").agg(F.count(F.lit(1)).alias("n"))
    multi = per.groupBy("brand").agg(F.count(F.lit(1)).alias("n_categories")) \
        .filter(F.col("n_categories") > 1)
    return per.join(multi, "brand").select("brand", "category", "n", "n_categories")


def _sku_totals(t: Tables) -> DataFrame:
    totals = star.fact_sales(t).groupBy("partkey").agg(F.sum("amount").alias("total_amt"))
    return star.classified(t).join(totals, "partkey")


def summary_by_category(t: Tables) -> DataFrame:
    """Revenue by category plus the total line (rollup)."""
    kept, _ = C.split_excluded(_sku_totals(t))
    return (kept.rollup("category").agg(F.sum("total_amt").alias("amount"),
                                         F.grouping("category").alias("is_total"))
            .select("category", F.col("amount").cast("double").alias("amount"),
                    F.col("is_total").cast("int").alias("is_total")))


def summary_by_bucket(t: Tables) -> DataFrame:
    """A16 + P18: premium / regular / milk powder (unless overridden)."""
    kept, _ = C.split_excluded(_sku_totals(t))
    b = R.variant_bucket("category", "tier", "was_overridden")
    return (kept.groupBy(b.alias("bucket")).agg(F.sum("total_amt").alias("amount"))
            .select("bucket", F.col("amount").cast("double").alias("amount")))


def summary_by_shipping(t: Tables) -> DataFrame:
    """Revenue by shipping mode."""
    kept, _ = C.split_excluded(_sku_totals(t))
    return (kept.groupBy("shipping_channel").agg(F.sum("total_amt").alias("amount"))
            .select("shipping_channel", F.col("amount").cast("double").alias("amount")))


def invalid_categories(t: Tables) -> DataFrame:
    """F3."""
    kept, _ = C.split_excluded(star.classified(t))
    return C.invalid_category(kept).select("sku_code", "brand", "product_desc", "category")


def odd_shipping(t: Tables) -> DataFrame:
    """F4."""
    kept, _ = C.split_excluded(star.classified(t))
    return C.odd_shipping(kept).select("sku_code", "brand", "shipping_channel")


def unknown_tags(t: Tables) -> DataFrame:
    """Q5: freight tags that are neither blank nor a known export tag."""
    return (star.products(t).filter(R.is_unknown_tag("freight_tag"))
            .groupBy(F.trim("freight_tag").alias("freight_tag"))
            .agg(F.count(F.lit(1)).alias("n_skus")))


def type_counts(t: Tables) -> DataFrame:
    """A18 + Q9: SKU count and revenue per supplement type, the catch-all share
    and the > 40 % warning flag."""
    s = _sku_totals(t)
    s = C.with_product_type(s, vocab.FIXTURE_RULES).filter(F.col("category") == "supplement")
    per = s.groupBy("product_type").agg(F.count(F.lit(1)).alias("n_skus"),
                                        F.sum("total_amt").alias("revenue"))
    # the share is taken over the per-type rows (a dozen at most), so the
    # unpartitioned window below never sees fact-sized data
    w = Window.partitionBy()
    catch = F.sum(F.when(F.col("product_type") == vocab.CATCH_ALL_TYPE, F.col("n_skus"))
                  .otherwise(0)).over(w)
    share = F.try_divide(catch.cast("double"), F.sum("n_skus").over(w).cast("double"))
    return per.select("product_type", "n_skus", F.col("revenue").cast("double").alias("revenue"),
                      share.alias("catch_all_share"),
                      (share > vocab.CATCH_ALL_WARN_SHARE).alias("warn"))


def reviewed_seed(t: Tables, rules: vocab.RuleSet = vocab.FIXTURE_RULES) -> DataFrame:
    """Conflicts across all months -> first month per SKU, minus SKU
    overrides, with a pending decision.

    The verdict depends only on the SKU's brand and name, so it is computed
    once per SKU; the first month is a grouped min over the facts (a
    partial aggregate) — no regex runs per (month, SKU) row."""
    checked = C.conflicts(star.products(t), star.brand_categories(t), rules) \
        .filter(F.col("verdict").startswith("CONFLICT"))
    first_month = star.fact_sales(t).groupBy("sku_code").agg(F.min("period").alias("first_seen"))
    return (checked.join(first_month, "sku_code")
            .join(star.sku_overrides(t), "sku_code", "left_anti")
            .select("sku_code", "brand", "product_desc", "first_seen",
                    F.lit("pending").alias("decision"), F.col("verdict").alias("note")))


def settled_skus(t: Tables) -> DataFrame:
    """SKUs settled by review, the dimension or an override (set union)."""
    return (star.conflict_reviewed(t).select("sku_code")
            .union(star.known_skus(t).select("sku_code"))
            .union(star.sku_overrides(t).select("sku_code")).distinct())
