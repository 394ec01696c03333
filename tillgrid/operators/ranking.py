"""Ranking operators that stay distributed when one group is huge.

``ranged_ntile`` computes SQL ``NTILE(k) OVER (PARTITION BY g ORDER BY o)``
without putting a whole group into one task: rows are range-partitioned on
(g, o) across many tasks, each task numbers its rows locally, and a tiny
per-(group, task) count table turns local numbers into group ranks.

``top_k`` is ``row_number() <= k`` per group; Spark plans it with a partial
``WindowGroupLimit`` before the shuffle, so a hot group ships at most k rows
per map task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOC_BITS = 33  # monotonically_increasing_id = (partition << 33) + row-in-partition


def _sort_key(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntile_from_rank(rank: Column, n: Column, k: int) -> Column:
    """Bucket of 1-based ``rank`` among ``n`` rows split into ``k`` NTILE groups."""
    q = (n / k).cast("bigint")          # n div k
    m = n % k                            # first m buckets get q+1 rows
    big = m * (q + 1)
    return (F.when(rank <= big, ((rank - 1) / (q + 1)).cast("bigint") + 1)
            .otherwise(m + ((rank - 1 - big) / F.greatest(q, F.lit(1))).cast("bigint") + 1)
            ).cast("int")


def ranged_ntile(df: DataFrame, group_cols: list[str], order_cols: list[Column | str], k: int,
                 out: str = "ntile", rank_out: str | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """NTILE(k) per group, ordered by ``order_cols`` (which must end in a
    unique tie-breaker so the order is total and recomputation-stable).

    The count table has one row per (group, range partition) it touches, i.e.
    at most ``num_partitions + number of groups`` rows; the planner picks its
    join by its size in bytes.
    """
    spark = df.sparkSession
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g) for g in group_cols] + [_sort_key(c) for c in order_cols]
    ordered = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # Both the count table and the final join must see the *same* numbering.
    # Each use of a range exchange samples its own bounds, so the numbered
    # rows are frozen once in the shared checkpoint folder (reliable: a lost
    # executor cannot change them) and both branches read that copy.
    ided = (ordered.withColumn("_id", F.monotonically_increasing_id())
            .withColumn("_pid", F.shiftright("_id", _LOC_BITS))
            .withColumn("_loc", F.col("_id").bitwiseAND(F.lit((1 << _LOC_BITS) - 1))).drop("_id"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ranked-{uuid.uuid4().hex}"
    ided.write.parquet(path)
    ided = spark.read.schema(ided.schema).parquet(path)
    seg = (ided.groupBy(*group_cols, "_pid")
           .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_loc").alias("_min")))
    seg = (seg.withColumn("_before",
                          F.sum("_cnt").over(Window.partitionBy(*group_cols).orderBy("_pid")
                                             .rowsBetween(Window.unboundedPreceding, -1)))
           .withColumn("_n", F.sum("_cnt").over(Window.partitionBy(*group_cols)))
           .fillna(0, subset=["_before"]))
    joined = ided.join(seg, [*group_cols, "_pid"])
    rank = F.col("_before") + (F.col("_loc") - F.col("_min")) + 1
    res = joined.withColumn(out, ntile_from_rank(rank, F.col("_n"), k))
    if rank_out:
        res = res.withColumn(rank_out, rank)
    return res.drop("_pid", "_loc", "_cnt", "_min", "_before", "_n")


def top_k(df: DataFrame, group_cols: list[str], order_cols: list[Column | str], k: int,
          rank_col: str = "rnk") -> DataFrame:
    """First k rows per group (ROW_NUMBER <= k)."""
    w = Window.partitionBy(*group_cols).orderBy(*[_sort_key(c) for c in order_cols])
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
