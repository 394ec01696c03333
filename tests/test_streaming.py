"""Incremental month loads through Structured Streaming (foreachBatch upsert)."""

from pyspark.sql.types import (DecimalType, IntegerType, LongType, StringType, StructField,
                               StructType)

from tillgrid.sources.versioned import VersionedTable
from tillgrid.streaming import incremental as INC

SCHEMA = StructType([StructField("store_id", IntegerType()), StructField("period", StringType()),
                     StructField("partkey", LongType()), StructField("qty", LongType()),
                     StructField("amount", DecimalType(12, 2))])


def _drop(spark, landing, name, rows):
    from decimal import Decimal
    df = spark.createDataFrame([(s, p, k, q, Decimal(a), seq) for s, p, k, q, a, seq in rows],
                               "store_id int, period string, partkey long, qty long, "
                               "amount decimal(12,2), load_seq long")
    df.coalesce(1).write.mode("append").parquet(landing)


def test_late_correction_is_upserted(spark, tmp_path):
    landing, table, ckpt = (str(tmp_path / x) for x in ("landing", "table", "ckpt"))
    _drop(spark, landing, "a", [(1, "2026-01", 10, 5, "50.00", 1), (1, "2026-01", 11, 1, "9.99", 1),
                                (1, "2026-02", 10, 2, "20.00", 1)])
    q = INC.start_fact_stream(spark, landing, table, ckpt, SCHEMA, once=True)
    q.awaitTermination()
    # correction for January: SKU 10 re-stated (twice; the later line wins), SKU 11 absent
    _drop(spark, landing, "b", [(1, "2026-01", 10, 6, "60.00", 1), (1, "2026-01", 10, 7, "70.00", 2),
                                (1, "2026-01", 12, 1, "5.00", 1)])
    q = INC.start_fact_stream(spark, landing, table, ckpt, SCHEMA, once=True)
    q.awaitTermination()
    assert _rows(spark, table) == CORRECTED


CORRECTED = [("2026-01", 10, 7, 70.0), ("2026-01", 11, 1, 9.99), ("2026-01", 12, 1, 5.0), ("2026-02", 10, 2, 20.0)]


def _rows(spark, table):
    return sorted((r.period, r.partkey, r.qty, float(r.amount))
                  for r in VersionedTable(spark, table, SCHEMA).read().collect())


def test_a_reset_stream_neither_loses_nor_repeats_a_file(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")

    def run(checkpoint):
        INC.start_fact_stream(spark, landing, table, str(tmp_path / checkpoint), SCHEMA, once=True).awaitTermination()

    _drop(spark, landing, "a", [(1, "2026-01", 10, 5, "50.00", 1), (1, "2026-01", 11, 1, "9.99", 1),
                                (1, "2026-02", 10, 2, "20.00", 1)])
    run("one")
    _drop(spark, landing, "b", [(1, "2026-01", 10, 6, "60.00", 1), (1, "2026-01", 10, 7, "70.00", 2),
                                (1, "2026-01", 12, 1, "5.00", 1)])
    run("one")
    versions = VersionedTable(spark, table, SCHEMA)
    before = versions.version()
    # the checkpoint is gone: batch 0 is the first file again and must not undo the correction
    run("two")
    assert (versions.version(), _rows(spark, table)) == (before, CORRECTED)
    # and a batch number that was used before does not hide a new file
    _drop(spark, landing, "c", [(1, "2026-03", 1, 1, "1.00", 1)])
    run("three")
    assert _rows(spark, table) == [*CORRECTED, ("2026-03", 1, 1, 1.0)]
    assert VersionedTable(spark, table, SCHEMA).applied("fact stream").count() == 3
