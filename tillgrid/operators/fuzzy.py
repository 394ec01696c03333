"""Fuzzy brand resolution (Ratcliff-Obershelp ratio, stdlib difflib).

Only distinct spellings that exact and space-free matching leave unresolved are
scored, and only against the known names that ``operators.similar`` finds within the
threshold.  What was scored is stored, one row per spelling, and kept up by load:
a spelling is scored once, and the product dimension joins the stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions.text import normalise_brand, tight_brand
from ..sources.versioned import VersionedTable
from .similar import seq_ratio, shares_enough, similar

__all__ = ["seq_ratio", "shares_enough"]

#: The stored resolutions: fuzzy_brand and ratio are null where no known name is near enough.
RESOLUTIONS = "norm_brand string, fuzzy_brand string, ratio double, shelf string"
#: Shelves (parts) of the stored resolutions: a load rewrites those of its new spellings.
SHELVES = 16


def known_frame(spark: SparkSession, names: list[str]) -> DataFrame:
    """The known list by its space-free spellings; a later duplicate keeps the first
    position but the later brand, as a dict built in order."""
    entries: dict[str, tuple[int, str]] = {}
    for i, brand in enumerate(names):
        key = brand.replace(" ", "")
        entries[key] = (entries[key][0] if key in entries else i, brand)
    return spark.createDataFrame([(k, b, i) for k, (i, b) in entries.items()],
                                 "b string, known_brand string, ordinal int")


def spellings(brands: DataFrame) -> DataFrame:
    """The distinct spellings (brand).  The column is an aggregate's result and not its key, so
    what later steps ask of a spelling is asked once each and never of every product line."""
    return (brands.groupBy(F.col("brand").alias("typed")).agg(F.max("brand").alias("brand"))
            .select("brand"))


def unresolved(brands: DataFrame, rules: vocab.RuleSet) -> DataFrame:
    """(norm_brand, a) of the distinct spellings that exact and tight matching leave; ``a`` has no spaces."""
    tight = {b.replace(" ", "") for b in rules.known_brands}
    return (spellings(brands).select(normalise_brand("brand").alias("norm_brand"), tight_brand("brand").alias("a")).distinct()
            .filter(~F.col("norm_brand").isin(*rules.known_brands) & ~F.col("a").isin(*tight)))


def _scored(names: DataFrame, rules: vocab.RuleSet, threshold: float) -> DataFrame:
    """(a, fuzzy_brand, ratio): the best known brand within the threshold, the first of equals."""
    known = known_frame(names.sparkSession, rules.known_brands)
    near = similar(names, known, threshold).join(known, "b")
    best = near.groupBy("a").agg(F.max_by(F.struct("known_brand", "ratio"),
                                          F.struct(F.col("ratio"), -F.col("ordinal"))).alias("best"))
    return best.select("a", F.col("best.known_brand").alias("fuzzy_brand"), "best.ratio")


def fuzzy_resolve(brands: DataFrame, rules: vocab.RuleSet = vocab.FIXTURE_RULES,
                  threshold: float = vocab.FUZZY_THRESHOLD) -> DataFrame:
    """U1 / J14 stage 3 for every distinct brand spelling that exact and tight matching
    leave unresolved: norm_brand, fuzzy_brand, ratio, for those with a brand near enough."""
    names = unresolved(brands, rules)
    return names.join(_scored(names, rules, threshold), "a").select("norm_brand", "fuzzy_brand", "ratio")


def resolution_table(spark: SparkSession, root: str) -> VersionedTable:
    schema = spark.createDataFrame([], RESOLUTIONS).schema
    return VersionedTable(spark, root, schema, part="shelf")


def keep_resolutions(table: VersionedTable, brands: DataFrame, rules: vocab.RuleSet = vocab.FIXTURE_RULES,
                     threshold: float = vocab.FUZZY_THRESHOLD) -> int:
    """Score the spellings that the table does not hold yet, and add them.  Returns its version."""
    new = unresolved(brands, rules).join(table.read().select("norm_brand"), "norm_brand", "left_anti")
    shelf = F.pmod(F.xxhash64("norm_brand"), F.lit(SHELVES)).cast("string")
    rows = (new.join(_scored(new, rules, threshold), "a", "left")
            .select("norm_brand", "fuzzy_brand", "ratio", shelf.alias("shelf")))
    return table.upsert(rows, ["norm_brand"])


def headroom(names: DataFrame, floor: float = 0.3, threshold: float = vocab.FUZZY_THRESHOLD) -> DataFrame:
    """Q11: pairs of different brands (``brand``) with a ratio of ``floor`` or more, and whether
    fuzzy matching would merge them.  The threshold has headroom while it merges none."""
    own = spellings(names).select(normalise_brand("brand").alias("a")).distinct()
    pairs = similar(own, own.withColumnRenamed("a", "b"), floor).where("a < b")
    return pairs.select(F.col("a").alias("brand_a"), F.col("b").alias("brand_b"),
                        F.round("ratio", 3).alias("ratio"), (F.col("ratio") >= threshold).alias("merged"))


def resolution(brands: DataFrame, rules: vocab.RuleSet = vocab.FIXTURE_RULES,
               threshold: float = vocab.FUZZY_THRESHOLD) -> DataFrame:
    """Every distinct raw spelling -> (brand, how) with how in
    exact / tight / fuzzy / none, plus the fuzzy ratio."""
    from ..functions.rules import resolve_brand_exact_tight
    raw = spellings(brands)
    staged = raw.select("brand", normalise_brand("brand").alias("norm_brand"),
                        resolve_brand_exact_tight("brand", rules).alias("r"))
    fz = fuzzy_resolve(raw, rules, threshold)
    j = staged.join(fz, "norm_brand", "left")
    return j.select(
        "brand", F.coalesce("r.brand", "fuzzy_brand").alias("resolved_brand"),
        F.when(F.col("r.brand").isNotNull(), F.col("r.how"))
        .when(F.col("fuzzy_brand").isNotNull(), F.lit("fuzzy")).otherwise(F.lit("none"))
        .alias("how"),
        F.when(F.col("r.brand").isNull(), F.round("ratio", 3)).alias("ratio"))


def fuzzy_merges(brands: DataFrame, rules: vocab.RuleSet = vocab.FIXTURE_RULES,
                 threshold: float = vocab.FUZZY_THRESHOLD) -> DataFrame:
    """Q4: distinct (raw spelling, matched brand, ratio rounded to 3)."""
    r = resolution(brands, rules, threshold)
    return r.filter(F.col("how") == "fuzzy").select(
        F.col("brand").alias("raw"), F.col("resolved_brand").alias("matched"), "ratio").distinct()


def close_names(new_keys: DataFrame, known_keys: DataFrame, n: int = vocab.CLOSE_NAME_COUNT,
                cutoff: float = vocab.CLOSE_NAME_CUTOFF) -> DataFrame:
    """Up to n known keys with ratio(known, new) >= cutoff, best
    first, ties by the larger key (as a heap of (score, name) would)."""
    near = similar(known_keys.select(F.col("brand_key").alias("a")),
                   new_keys.select(F.col("brand_key").alias("b")), cutoff)
    w = Window.partitionBy("b").orderBy(F.desc("ratio"), F.desc("a"))
    return (near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .select(F.col("b").alias("brand_key"), "rank", F.col("a").alias("close_name"),
                    F.round("ratio", 3).alias("ratio")))
