"""Layered-precedence product classification and review queues.

Every step is a join or a projection over whole DataFrames; the rule sets
are compiled into expressions (``functions.rules``).  Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import rules as R
from ..functions.text import brand_key, normalise_brand


def variant_categories(brand_categories: DataFrame, skip_blank: bool = False) -> DataFrame:
    """Every spelling in 'A/B/C' maps to the row's confirmed category;
    a later row (higher ``line_no``) overrides an earlier one.

    Classification reads blank rows too (a later blank row clears an earlier
    category); the new-brand queue's memory of earlier decisions skips blank
    rows (``skip_blank``).

    Input: brand_variants, confirmed_category, line_no.  Output: brand_key, category.
    """
    if skip_blank:
        brand_categories = brand_categories.filter(
            F.coalesce(F.trim("confirmed_category"), F.lit("")) != "")
    exploded = brand_categories.select(
        F.explode(F.split("brand_variants", "/")).alias("variant"),
        F.coalesce(F.trim("confirmed_category"), F.lit("")).alias("category"),
        "line_no")
    return (exploded.select(brand_key("variant").alias("brand_key"), "category", "line_no")
            .groupBy("brand_key")
            .agg(F.max_by("category", "line_no").alias("category")))


def classify_products(products: DataFrame, brand_categories: DataFrame, overrides: DataFrame,
                      known: DataFrame, rules: vocab.RuleSet,
                      fuzzy_brands: DataFrame | None = None) -> DataFrame:
    """J6/J7 + P11 + P13: category, shipping and tier with precedence
    known dimension row -> SKU override -> brand default.

    products: sku_code, brand, product_desc, freight_tag (+ any other columns)
    overrides: sku_code, override_category
    known: sku_code, category, tier, shipping_channel
    fuzzy_brands (optional): norm_brand, fuzzy_brand — output of operators.fuzzy
    """
    cats = variant_categories(brand_categories)
    k = known.select("sku_code",
                     F.nullif(F.col("category"), F.lit("")).alias("_k_category"),
                     F.nullif(F.col("tier"), F.lit("")).alias("_k_tier"),
                     F.nullif(F.col("shipping_channel"), F.lit("")).alias("_k_shipping"))
    o = overrides.select("sku_code",
                         F.nullif(F.col("override_category"), F.lit("")).alias("_o_category"))
    df = (products.withColumn("brand_key", brand_key("brand"))
          .join(cats.withColumnRenamed("category", "_b_category"), "brand_key", "left")
          .join(o, "sku_code", "left")
          .join(k, "sku_code", "left"))
    df = (df.withColumn("is_known", F.col("_k_category").isNotNull() | F.col("_k_tier").isNotNull())
          .withColumn("was_overridden", F.col("_o_category").isNotNull())
          .withColumn("category", F.coalesce("_k_category", "_o_category",
                                             F.nullif(F.col("_b_category"), F.lit("")), F.lit(""))))
    resolved = R.resolve_brand_exact_tight("brand", rules)
    df = df.withColumn("_res", resolved).withColumn("norm_brand", normalise_brand("brand"))
    if fuzzy_brands is not None:
        df = df.join(fuzzy_brands.select("norm_brand", "fuzzy_brand"), "norm_brand", "left")
        df = (df.withColumn("resolved_brand", F.coalesce("_res.brand", "fuzzy_brand"))
              .withColumn("resolve_how", F.when(F.col("_res.brand").isNotNull(), F.col("_res.how"))
                          .when(F.col("fuzzy_brand").isNotNull(), F.lit("fuzzy"))
                          .otherwise(F.lit("none")))
              .drop("fuzzy_brand"))
    else:
        df = (df.withColumn("resolved_brand", F.col("_res.brand"))
              .withColumn("resolve_how", F.col("_res.how")))
    rule_tier = R.tier_for("resolved_brand", "product_desc", "freight_tag", rules)
    df = (df.withColumn("_tier", rule_tier)
          .withColumn("tier", F.coalesce("_k_tier", "_tier.tier"))
          .withColumn("tier_reason", F.when(F.col("_k_tier").isNotNull(), F.lit("known SKU"))
                      .otherwise(F.col("_tier.reason")))
          .withColumn("shipping_channel",
                      F.coalesce("_k_shipping",
                                 R.shipping_for("category", "freight_tag", rules.export_tags))))
    return df.drop("_k_category", "_k_tier", "_k_shipping", "_o_category", "_b_category",
                   "_res", "_tier")


def with_product_type(classified: DataFrame, rules: vocab.RuleSet) -> DataFrame:
    """P15."""
    return classified.withColumn("product_type",
                                 R.product_type_for("category", "product_desc", rules))


def split_excluded(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded); a NULL category stays in the kept half."""
    is_ex = F.coalesce(F.col("category"), F.lit("")) == vocab.EXCLUDED_CATEGORY
    return classified.filter(~is_ex), classified.filter(is_ex)


def invalid_category(kept: DataFrame) -> DataFrame:
    """category outside the legal domain (NULL counts as invalid)."""
    return kept.filter(~F.coalesce(F.col("category").isin(*vocab.CATEGORIES), F.lit(False)))


def odd_shipping(kept: DataFrame) -> DataFrame:
    """unrecognised freight tag on a milk powder line."""
    return kept.filter(F.col("shipping_channel").startswith("other:"))


def conflicts(products: DataFrame, brand_categories: DataFrame, rules: vocab.RuleSet) -> DataFrame:
    """P9 + P10 over every product line: brand default vs keyword guess."""
    cats = variant_categories(brand_categories)
    return (products.withColumn("brand_key", brand_key("brand"))
            .join(cats.withColumnRenamed("category", "brand_category"), "brand_key", "left")
            .withColumn("brand_category", F.coalesce("brand_category", F.lit("")))
            .withColumn("keyword_guess", R.keyword_guess("product_desc", rules))
            .withColumn("verdict", R.verdict("brand_category", "keyword_guess")))


def new_conflicts(checked: DataFrame, reviewed: DataFrame, known: DataFrame,
                  overrides: DataFrame) -> DataFrame:
    """CONFLICT rows not settled by a review, a known SKU or an override."""
    settled = (reviewed.select("sku_code").union(known.select("sku_code"))
               .union(overrides.select("sku_code")))
    return (checked.filter(F.col("verdict").startswith("CONFLICT"))
            .join(settled, "sku_code", "left_anti"))


def first_per_key(df: DataFrame, keys: list[str], order_cols: list[str],
                  last: bool = False) -> DataFrame:
    """First (or last) row per key in the given order.

    Expressed as a grouped ``min_by``/``max_by`` over a struct so Spark runs
    it as a partial (map-side) aggregate: a hot key is reduced to one row per
    task before the shuffle instead of being sorted in a single window task.
    """
    other = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    return (df.groupBy(*keys)
            .agg(pick(F.struct(*other), F.struct(*order_cols)).alias("_r"))
            .select(*keys, "_r.*"))
