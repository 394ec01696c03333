"""Pairs of similar names from an inverted index of character pairs.

The Ratcliff-Obershelp ratio of two names with T characters together is 2M/T for M
matched characters in blocks.  Between two blocks stands at least one of the T - 2M
unmatched characters, so there are at most T - 2M + 1 blocks, and the names share at
least M less that many character pairs: a ratio of ``t`` needs T(1.5t - 1) - 1 of them.
Where that bound is positive, a name need only be indexed under its rarest pairs, as
many as leave fewer than the bound: two names within the ratio then meet under one
(prefix filter).  Names so short, or thresholds so low, that no pair need be shared
are indexed under single characters, of which they share M >= tT/2.  All bounds only
widen: every pair within the ratio is found.

The candidates pass the length bound, the count of shared pairs and of shared
characters as column expressions; the ratio itself, defined by the standard library,
is then computed in an Arrow-batched UDF.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_EPS = 1e-9


@F.pandas_udf(DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib ratio of (a, b) — argument order matters (not symmetric)."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)],
                     dtype="float64")


def shares_enough(a: str, b: str, threshold: float) -> Column:
    """Whether the characters that ``a`` and ``b`` share, in any order, still allow
    the threshold: a lossless bound of the ratio that needs no Python."""
    chars = F.array_distinct(F.split(F.col(b), ""))

    def times(s: str, c: Column) -> Column:
        return F.length(s) - F.length(F.replace(F.col(s), c, F.lit("")))

    common = F.aggregate(chars, F.lit(0), lambda n, c: n + F.least(times(a, c), times(b, c)))
    return 2 * common >= (threshold - _EPS) * (F.length(a) + F.length(b))


def _grams(s: str, width: int) -> Column:
    """The runs of ``width`` characters, each with how often it came before: a set whose
    intersections count as those of the multisets do.  The empty name has a mark of its own."""
    n = F.length(s)
    runs = F.when(n >= width, F.transform(F.sequence(F.lit(1), n - (width - 1)),
                                          lambda i: F.substr(F.col(s), i, F.lit(width)))).otherwise(F.array())
    told = F.transform(runs, lambda g, i: F.concat(
        F.lit(f"{width}."), F.size(F.filter(F.slice(runs, F.lit(1), i), lambda x: x == g)).cast("string"),
        F.lit("."), g))
    return F.when(n == 0, F.array(F.lit(f"{width}.empty"))).otherwise(told)


def _indexed(names: DataFrame, threshold: float, width: int) -> DataFrame:
    """(name, grams, need): the least number of grams that a partner must share."""
    n = F.length("name")
    least = F.ceil(threshold * n / (2 - threshold) - _EPS)  # the shortest partner
    if width == 1:
        need = F.ceil(threshold * (n + least) / 2 - _EPS)
    else:
        need = F.ceil((n + least) * (1.5 * threshold - 1) - 1 - _EPS)
    rows = names.select("name", _grams("name", width).alias("grams"),
                        F.greatest(need, F.lit(1)).cast("int").alias("need"))
    if width == 1 and threshold > 2 / 3:  # only names that can have a partner without a common pair
        rows = rows.where((n + least) * (1.5 * threshold - 1) - 1 <= _EPS)
    return rows.where(F.size("grams") > 0)


def _prefixes(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """(name, grams, prefix): the rarest grams, of which a partner shares one at least."""
    each = rows.select("name", "need", "grams", F.explode("grams").alias("gram")).join(seen, "gram")
    order = F.array_sort(F.collect_list(F.struct("times", "gram")))
    return (each.groupBy("name", "need", "grams").agg(order.alias("order"))
            .select("name", "grams", F.slice(F.transform("order", lambda x: x["gram"]), F.lit(1), F.greatest(
                F.size("grams") - F.col("need") + 1, F.lit(1))).alias("prefix")))


def candidates(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Distinct (a, b) of the names (columns ``a`` of ``left``, ``b`` of ``right``) that may
    reach the threshold, each pair once."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies above 0 and at most at 1")
    sides = [d.select(F.col(c).alias("name")).where(F.col(c).isNotNull()).distinct()
             for d, c in ((left, "a"), (right, "b"))]
    found = None
    for width in ([2, 1] if threshold > 2 / 3 else [1]):
        one, two = (_indexed(s, threshold, width) for s in sides)
        seen = (one.unionByName(two).select(F.explode("grams").alias("gram"))
                .groupBy("gram").agg(F.count(F.lit(1)).alias("times")))
        a, b = (_prefixes(x, seen).select(
            F.col("name").alias(c), F.col("grams").alias(f"grams_{c}"), F.col("prefix").alias(f"prefix_{c}"),
            F.explode("prefix").alias("gram")) for x, c in ((one, "a"), (two, "b")))
        total = F.length("a") + F.length("b")
        near = 2 * F.least(F.length("a"), F.length("b")) >= (threshold - _EPS) * total
        met = a.join(b, "gram").where(
            near & (F.element_at(F.array_intersect("prefix_a", "prefix_b"), 1) == F.col("gram")))
        if width == 2:
            met = met.where(F.size(F.array_intersect("grams_a", "grams_b"))
                            >= total * (1.5 * threshold - 1) - 1 - _EPS)
        elif threshold > 2 / 3:  # pairs that must share a run of two came from there
            met = met.where(total * (1.5 * threshold - 1) - 1 <= _EPS)
        met = met.where(shares_enough("a", "b", threshold)).select("a", "b")
        found = met if found is None else found.unionByName(met)
    return found if threshold <= 2 / 3 else found.distinct()


def similar(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(a, b, ratio) of all pairs of distinct names whose ``seq_ratio(a, b)`` reaches the threshold."""
    return (candidates(left, right, threshold).withColumn("ratio", seq_ratio("a", "b"))
            .where(F.col("ratio") >= threshold))
