"""The stored-table layer: written once, reused, and re-derived when inputs change."""

from pyspark.sql import functions as F

from tillgrid.sources import warehouse


def test_materialized_reuses_and_tracks_inputs(spark, tmp_path):
    src = str(tmp_path / "src.parquet")
    spark.range(5).withColumn("period", F.lit("2026-01")).write.parquet(src)
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(src).withColumn("twice", F.col("id") * 2)

    a = warehouse.materialized(spark, "t", [src], build, partition_by=["period"])
    b = warehouse.materialized(spark, "t", [src], build, partition_by=["period"])
    assert a.count() == b.count() == 5 and a.columns == ["id", "period", "twice"]
    assert [f.dataType.simpleString() for f in b.schema.fields] == ["bigint", "string", "bigint"]
    assert len(calls) == 1  # second call read the stored table
    spark.range(7).withColumn("period", F.lit("2026-02")).write.mode("append").parquet(src)
    spark.conf.set("spark.tillgrid.fingerprintCache", "false")
    try:
        c = warehouse.materialized(spark, "t", [src], build, partition_by=["period"])
        assert c.count() == 12 and len(calls) == 2  # new input -> new table
    finally:
        spark.conf.set("spark.tillgrid.fingerprintCache", "true")


class Named:
    """A session that knows its settings only."""

    def __init__(self, **settings):
        self.conf = {f"spark.{k.replace('_', '.')}": v for k, v in settings.items()}


def test_stored_tables_outlive_the_application():
    """They lie below the folder that the cluster names, not below the application's own."""
    assert warehouse.root(Named(checkpoint_dir="hdfs://x/shared/")) == "hdfs://x/shared/tillgrid-star"
    assert warehouse.root(Named(checkpoint_dir="hdfs://x/shared", tillgrid_warehouse="hdfs://x/own")) == "hdfs://x/own"
