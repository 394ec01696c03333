"""Idempotent keyed loads into the star schema.

Every load is a pure DataFrame transformation ``(old, new) -> table``; the
caller writes the result to a *new* snapshot directory (``write_snapshot``)
rather than overwriting the path being read, so a failed job leaves the
previous snapshot intact and a re-run produces the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .classify import first_per_key


def latest_per_key(batch: DataFrame, keys: list[str], seq_col: str = "load_seq") -> DataFrame:
    """K8: within one batch a later row for the same key wins."""
    return first_per_key(batch, keys, [seq_col], last=True)


def upsert_rows(old: DataFrame, new: DataFrame, keys: list[str],
                touched: list[str] | None = None) -> DataFrame:
    """K2/K3: replace the measures of keys present in ``new``; rows of
    ``old`` that the new batch does not mention survive (T14).

    With ``touched`` (e.g. ``["period"]``) only old rows in the partitions
    the batch touches take part in the anti join; the rest pass through."""
    cols = old.columns
    new = new.select(*cols)
    if touched:
        parts = new.select(*touched).distinct()
        hot = old.join(parts, touched, "left_semi")
        cold = old.join(parts, touched, "left_anti").select(*cols)
        kept = hot.join(new.select(*keys), keys, "left_anti").select(*cols)
        return cold.unionByName(kept).unionByName(new)
    return old.join(new.select(*keys), keys, "left_anti").select(*cols).unionByName(new)


def upsert_columns(old: DataFrame, new: DataFrame, key: str, update: list[str],
                   keep: dict[str, Column]) -> DataFrame:
    """K1: for keys in ``new`` overwrite the ``update`` columns; columns in
    ``keep`` are left alone on existing rows and take the given default on
    inserted rows (e.g. product_type survives a re-import, T15).

    The dimension is never shuffled as a whole: rows whose key is not in the
    batch pass through a semi/anti filter against the batch's key set (small,
    so the planner can broadcast it); only the matching rows are joined."""
    keys = new.select(key).distinct()
    untouched = old.join(keys, key, "left_anti")
    touched = old.join(keys, key, "left_semi")
    n = new.select(key, *[F.col(c).alias(f"_new_{c}") for c in update])
    updated = touched.join(n, key).select(
        *[F.col(f"_new_{c}").alias(c) if c in update else F.col(c) for c in old.columns])
    inserted = (new.join(touched.select(key), key, "left_anti")
                .select(*[F.col(c) if c in update or c == key
                          else (keep[c] if c in keep else F.lit(None)).cast(
                              old.schema[c].dataType).alias(c)
                          for c in old.columns]))
    return untouched.unionByName(updated).unionByName(inserted)


def update_join(dim: DataFrame, values: DataFrame, key: str, col: str) -> tuple[DataFrame, DataFrame]:
    """K6 + J13: set ``col`` on existing keys only; also return the keys
    that have a value but no dimension row."""
    v = values.select(key, F.col(col).alias("_v"))
    updated = (dim.join(v, key, "left")
               .withColumn(col, F.coalesce("_v", col)).drop("_v"))
    missing = values.join(dim.select(key), key, "left_anti")
    return updated, missing


def ensure_dim_date(dim_date: DataFrame, periods: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K7: add unseen months with year, month, quarter; skip unparseable or
    out-of-range ones.  Returns (dim_date, skipped)."""
    cand = periods.select(F.trim("period").alias("period")).distinct() \
        .join(dim_date.select("period"), "period", "left_anti")
    y = F.substring("period", 1, 4).try_cast("int")
    m = F.substring("period", 6, 2).try_cast("int")
    ok = (F.col("period").rlike(r"^\d{4}-\d{2}$") & y.isNotNull() & m.between(1, 12))
    ok = F.coalesce(ok, F.lit(False))
    new = cand.filter(ok).select("period", y.alias("year"), m.alias("month"),
                                 ((m - 1) / 3 + 1).cast("int").alias("quarter"))
    return dim_date.unionByName(new.select(*dim_date.columns)), cand.filter(~ok)


def upsert_context(existing: DataFrame, rows: DataFrame, dim_date: DataFrame,
                   keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """K4: the whole context file each run; months absent from dim_date are
    skipped.  Returns (table, skipped)."""
    loadable = rows.join(dim_date.select("period"), "period", "left_semi")
    skipped = rows.join(dim_date.select("period"), "period", "left_anti")
    return upsert_rows(existing, loadable, keys), skipped


def seed_if_absent(table: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Insert candidate rows whose key is not present yet."""
    return table.unionByName(candidates.select(*table.columns).join(table.select(key), key,
                                                                    "left_anti"))


def reconcile(stored: DataFrame, loaded: DataFrame, by: list[str], measure: str = "amount",
              tolerance: float = 0.01) -> DataFrame:
    """Σ stored vs Σ loaded for the loaded groups only."""
    lo = loaded.groupBy(*by).agg(F.sum(measure).alias("loaded"))
    st = stored.join(lo.select(*by), by, "left_semi").groupBy(*by).agg(F.sum(measure)
                                                                       .alias("stored"))
    j = lo.join(st, by, "left")
    diff = F.coalesce("stored", F.lit(0)) - F.col("loaded")
    return j.select(*by, F.col("loaded").cast("double").alias("loaded"),
                    F.col("stored").cast("double").alias("stored"),
                    (F.abs(diff) <= tolerance).alias("ok"))


def write_snapshot(df: DataFrame, table_root: str, version: str,
                   partition_by: list[str] | None = None) -> str:
    """Write a table version to ``<table_root>/v=<version>`` (a new folder;
    the folder being read is never overwritten) and return its path."""
    path = f"{table_root.rstrip('/')}/v={version}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
