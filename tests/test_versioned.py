"""The versioned table: touched parts only, older versions, refused loads, applied names."""

import os

import pytest
from pyspark.sql import functions as F

from tillgrid.operators import loads as LD
from tillgrid.sources.versioned import LoadRefused, VersionedTable

SCHEMA = "k long, v string, period string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def table(spark, path):
    return VersionedTable(spark, str(path), frame(spark, []).schema)


def held(t, version=None):
    return sorted(map(tuple, t.read(version).collect()))


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_load_leaves_untouched_months_and_older_versions_alone(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert t.version() == 0 and held(t) == []
    first = [(1, "a", "2026-01"), (2, "b", "2026-01"), (1, "c", "2026-02")]
    assert t.upsert(frame(spark, first), ["k", "period"]) == 1
    before, reader = files(tmp_path / "t"), t.read(1)
    assert t.upsert(frame(spark, [(2, "B", "2026-01"), (3, "d", "2026-01")]), ["k", "period"]) == 2
    assert held(t) == [(1, "a", "2026-01"), (1, "c", "2026-02"), (2, "B", "2026-01"), (3, "d", "2026-01")]
    after = files(tmp_path / "t")
    assert all(after[f] == at for f, at in before.items())
    assert t.folders(1)["2026-02"] == t.folders(2)["2026-02"] and t.folders(1)["2026-01"] != t.folders(2)["2026-01"]
    assert sorted(map(tuple, reader.collect())) == held(t, 1) == sorted(first)
    assert t.upsert(frame(spark, [(9, "z", "2026-03")]), ["k", "period"]) == 3
    assert held(t, 2) == [r for r in held(t) if r[2] != "2026-03"]
    assert [r.k for r in t.read(parts=["2026-03"]).collect()] == [9]


def test_the_same_load_again_gives_the_same_table(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    batch = frame(spark, [(1, "a", "m"), (2, "b", "n")])
    t.upsert(batch, ["k", "period"])
    once = held(t)
    t.upsert(batch, ["k", "period"])
    assert held(t) == once


def test_a_stored_folder_is_adopted_without_a_copy(spark, tmp_path):
    base = str(tmp_path / "stored")
    frame(spark, [(1, "a", "2026-01"), (2, "b", "2026-02")]).write.partitionBy("period").parquet(base)
    before = files(base)
    t = table(spark, tmp_path / "t")
    t.adopt(base)
    assert held(t) == [(1, "a", "2026-01"), (2, "b", "2026-02")] and not os.path.exists(tmp_path / "t" / "data")
    t.upsert(frame(spark, [(1, "A", "2026-01")]), ["k", "period"])
    assert held(t) == [(1, "A", "2026-01"), (2, "b", "2026-02")] and files(base) == before


def test_a_refused_load_publishes_nothing(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.upsert(frame(spark, [(1, "a", "2026-01")]), ["k", "period"])
    batch = frame(spark, [(1, "x", "2026-01"), (2, "bad", "2026-01"), (3, "bad", "2026-02")])
    with pytest.raises(LoadRefused) as refused:
        t.upsert(batch, ["k", "period"], checks={"bad value": F.col("v") == "bad", "none": F.col("k") > 9})
    assert refused.value.counts == {"bad value": 2}
    with pytest.raises(LoadRefused, match="without a part"):
        t.upsert(frame(spark, [(1, "x", None)]), ["k", "period"])
    with pytest.raises(LoadRefused, match="without a part"):
        t.upsert(frame(spark, [(1, "x", "a/b")]), ["k", "period"])
    assert t.version() == 1 and held(t) == [(1, "a", "2026-01")]


def test_a_batch_is_applied_once(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.upsert(frame(spark, [(1, "a", "m")]), ["k", "period"], log=("s", ["one"]))
    t.upsert(frame(spark, [(1, "later", "m")]), ["k", "period"], log=("s", ["two"]))
    assert t.upsert(frame(spark, [(1, "a", "m")]), ["k", "period"], log=("s", ["one"])) == 2
    assert held(t) == [(1, "later", "m")]
    assert t.upsert(frame(spark, [(1, "other", "m")]), ["k", "period"], log=("r", ["one"])) == 3
    assert t.upsert(frame(spark, []), ["k", "period"], log=("s", ["empty"])) == 4
    assert held(t) == [(1, "other", "m")]
    assert {r["name"] for r in t.applied("s").collect()} == {"one", "two", "empty"}


def test_the_last_line_of_a_key_counts(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    batch = frame(spark, [(1, "a", "m"), (1, "b", "m")]).withColumn("n", F.when(F.col("v") == "a", 2).otherwise(1))
    t.upsert(batch, ["k", "period"], order="n")
    assert held(t) == [(1, "a", "m")]


def test_an_unregistered_sku_stops_the_sales_load(spark, tmp_path):
    schema = "partkey long, sku_code string, period string, store_id int, order_count long, qty long, amount double"
    rows = [(1, "SKU1", "2026-01", 0, 1, 1, 1.0), (2, "SKU2", "2026-01", 0, 1, 1, 1.0)]
    t = VersionedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema)
    dim = spark.createDataFrame([("SKU1",)], "sku_code string")
    with pytest.raises(LoadRefused) as refused:
        LD.load_sales(t, spark.createDataFrame(rows, schema), dim, order=None)
    assert refused.value.counts == {"unregistered SKU": 1} and t.version() == 0
    assert LD.load_sales(t, spark.createDataFrame(rows[:1], schema), dim, order=None) == 1


def test_a_load_that_died_while_publishing_does_not_stand_in_the_way(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.upsert(frame(spark, [(1, "a", "m")]), ["k", "period"])
    os.makedirs(tmp_path / "t" / "manifest" / "v=2" / "_temporary" / "0")
    assert t.version() == 1 and held(t) == [(1, "a", "m")]
    assert t.upsert(frame(spark, [(2, "b", "m")]), ["k", "period"]) == 2
    assert held(t) == [(1, "a", "m"), (2, "b", "m")]


def test_two_loads_from_one_version_do_not_both_publish(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.upsert(frame(spark, [(1, "a", "m")]), ["k", "period"])
    with pytest.raises(RuntimeError, match="another load"):
        t._publish(1, t.folders(), None)
    assert held(t) == [(1, "a", "m")]
