"""Connected components of a link table, by alternating large and small stars.

Large star: every node sends its larger neighbours to the smallest node it
sees; small star: the same for its smaller neighbours and itself.  Both keep
components and shrink paths, so about log(longest path) rounds leave one star
per component.  Minima combine before their shuffle; the join back on a hot
centre has one row per node on the other side, so Spark can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import settle


def _stars(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (both.join(least, "u").where("v > u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    centre = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(centre, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(centre.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every node is a centre or has one centre, and not both."""
    ends = links.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max(F.expr("up > 1 or up > 0 and down > 0"))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns ``u``, ``v``, of one
    orderable type) but the roots themselves; a root is its component's smallest node."""
    now = settle(links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while not _are_stars(now):
        now = settle(_stars(now), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
