"""Property tests of the distributed operators against brute force."""

import json
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillgrid.operators import grounding as GR
from tillgrid.operators import ranking, upsert
from tillgrid.operators.narrative import _asof
from tillgrid.sources import wide


def test_ranged_ntile_equals_window_ntile(spark):
    rnd = random.Random(3)
    rows = []
    for g in range(4):
        n = [1, 9, 11, 157][g]
        rows += [(g, f"s{i:04d}", float(rnd.randint(0, 20))) for i in range(n)]
    # one hot group holding most rows
    rows += [(9, f"s{i:05d}", float(rnd.randint(0, 50))) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, sku string, amount double")
    got = ranking.ranged_ntile(df, ["g"], [F.desc("amount"), F.asc("sku")], 10, out="d",
                               num_partitions=7)
    want = df.withColumn("d", F.ntile(10).over(
        Window.partitionBy("g").orderBy(F.desc("amount"), F.asc("sku"))))
    assert sorted(got.collect()) == sorted(want.collect())


def test_ntile_formula_small_sizes(spark):
    for n in [1, 3, 9, 10, 11, 25, 99, 100, 101]:
        df = spark.createDataFrame([(0, f"{i:03d}", float(i)) for i in range(n)],
                                   "g int, k string, v double")
        got = ranking.ranged_ntile(df, ["g"], [F.asc("k")], 10, num_partitions=3)
        want = df.withColumn("ntile", F.ntile(10).over(Window.partitionBy("g").orderBy("k")))
        assert sorted(got.collect()) == sorted(want.collect()), n


def test_upsert_is_idempotent_and_keeps_stale_rows(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "a", 20), (3, "b", 30)],
                                "id int, period string, v int")
    new = spark.createDataFrame([(1, "a", 11), (4, "a", 40)], "id int, period string, v int")
    once = upsert.upsert_rows(old, new, ["id"], touched=["period"])
    twice = upsert.upsert_rows(once, new, ["id"], touched=["period"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert sorted(tuple(r) for r in once.collect()) == [(1, "a", 11), (2, "a", 20), (3, "b", 30),
                                                        (4, "a", 40)]


def test_later_batch_row_wins(spark):
    b = spark.createDataFrame([(1, 5, 1), (1, 7, 2), (2, 3, 1)], "id int, v int, load_seq int")
    out = {r.id: r.v for r in upsert.latest_per_key(b, ["id"]).collect()}
    assert out == {1: 7, 2: 3}


def test_partial_column_upsert_keeps_product_type(spark):
    old = spark.createDataFrame([("s1", "x", "fish_oil"), ("s2", "y", "calcium")],
                                "sku string, brand string, product_type string")
    new = spark.createDataFrame([("s1", "X2"), ("s3", "Z")], "sku string, brand string")
    out = {r.sku: (r.brand, r.product_type) for r in upsert.upsert_columns(
        old, new, "sku", ["brand"], {"product_type": F.lit("not_applicable")}).collect()}
    assert out == {"s1": ("X2", "fish_oil"), "s2": ("y", "calcium"),
                   "s3": ("Z", "not_applicable")}


def test_ensure_dim_date_skips_bad_months(spark):
    dim = spark.createDataFrame([("2026-01", 2026, 1, 1)],
                                "period string, year int, month int, quarter int")
    p = spark.createDataFrame([("2026-01",), ("2026-05",), ("2026-13",), ("abc",)], "period string")
    d, skipped = upsert.ensure_dim_date(dim, p)
    assert sorted(tuple(r) for r in d.collect()) == [("2026-01", 2026, 1, 1), ("2026-05", 2026, 5, 2)]
    assert sorted(r.period for r in skipped.collect()) == ["2026-13", "abc"]


def test_write_snapshot_never_overwrites(spark, tmp_path):
    df = spark.range(3)
    p = upsert.write_snapshot(df, str(tmp_path / "t"), "1")
    assert spark.read.parquet(p).count() == 3
    with pytest.raises(Exception):
        upsert.write_snapshot(df, str(tmp_path / "t"), "1")


def _sheet_csv(tmp_path, with_total):
    lines = ["Column0,Jan,,,Feb,," + (",Total,," if with_total else ""),
             ",Order,Product Quantity,Total Price,Order,Product Quantity,Total Price"
             + (",Order,Product Quantity,Total Price" if with_total else ""),
             "Demo Store,3,5,60.00,1,1,10.00" + (",4,6,70.00" if with_total else ""),
             "[SKU1]  [Solwave]Liver  Support 60s,2,3,30.00,,," + (",2,3,30.00" if with_total else ""),
             "[SKU2] [Clearfield]Whole Milk Powder (800g){Standard Freight},1,2,30.00,1,1,10.00"
             + (",2,3,40.00" if with_total else ""),
             "[DIS15] $5 off your order,,,,,," + (",,," if with_total else ""),
             "Total,3,5,60.00,1,1,10.00" + (",4,6,70.00" if with_total else "")]
    p = tmp_path / f"sheet{int(with_total)}.csv"
    p.write_text("﻿" + "\n".join(lines) + "\n", encoding="utf-8")
    return str(p)


@pytest.mark.parametrize("with_total", [False, True])
def test_read_parse_unpivot_sheet(spark, tmp_path, with_total):
    months = wide.months_for(2026, 1, 2)
    prefixes = [m for m, _ in months]
    df = wide.read_sheet_csv(spark, _sheet_csv(tmp_path, with_total), prefixes)
    kept, excluded = wide.parse_sales_sheet(df, prefixes)
    rows = {r.sku_code: r for r in kept.collect()}
    assert set(rows) == {"SKU1", "SKU2"}
    assert rows["SKU1"].product_desc == "Liver Support 60s" and rows["SKU1"].freight_tag == ""
    assert rows["SKU2"].freight_tag == "Standard Freight"
    assert rows["SKU2"].product_desc == "Whole Milk Powder (800g)"
    assert [r.product_name for r in excluded.collect()] == ["[DIS15] $5 off your order"]
    long = wide.unpivot_sales(kept, months)
    assert long.count() == 3  # SKU1 has no February cells
    # unpivot conserves money
    total = sum(float(r.total_amt) for r in kept.collect())
    assert float(long.agg(F.sum("amount")).first()[0]) == pytest.approx(total)


def test_sheet_width_is_checked(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("a,b,c\n1,2,3\n")
    with pytest.raises(ValueError):
        wide.read_sheet_csv(spark, str(p), ["jan", "feb"])


def test_holiday_calendar_json(spark):
    """Period -> list of holidays, plus a free-text note key."""
    cal = {"_note": "dates are local", "2026-02": [{"date": "2026-02-15", "end": "2026-02-23",
                                                    "region": "CN", "name": "New Year",
                                                    "impact": "high"}], "2026-03": []}
    df = spark.createDataFrame([(json.dumps(cal),)], "j string")
    m = df.select(F.explode(F.from_json("j", "map<string,string>")).alias("period", "v"))
    h = (m.filter(F.col("period").rlike(r"^\d{4}-\d{2}$"))
         .select("period", F.explode_outer(F.from_json(
             "v", "array<struct<date:string,end:string,region:string,name:string,impact:string>>"))
             .alias("h")))
    rows = sorted((r.period, r.h.name if r.h else None) for r in h.collect())
    assert rows == [("2026-02", "New Year"), ("2026-03", None)]


def test_lenient_json(spark):
    df = spark.createDataFrame([('```json\n{"a": "x", "b": "y",}\n```',), ('{"a": "z"',)],
                               "t string")
    out = [r.m for r in df.select(GR.parse_lenient("t").alias("m")).collect()]
    assert out[0] == {"a": "x", "b": "y"} and out[1] is None


def test_asof_attach(spark):
    grain = spark.createDataFrame([(1, "2026-01"), (1, "2026-03"), (1, "2026-04"), (2, "2026-01")],
                                  "store_id int, period string")
    ev = spark.createDataFrame([(1, "2026-01", 5.0), (1, "2026-03", 7.0), (2, "2026-02", 1.0)],
                               "store_id int, period string, x double")
    got = {(r.store_id, r.period): r.x for r in _asof(grain, ev, ["x"]).collect()}
    assert got == {(1, "2026-01"): 5.0, (1, "2026-03"): 7.0, (1, "2026-04"): 7.0,
                   (2, "2026-01"): None}


def test_enum_presentation_order(spark):
    from tillgrid.operators.report import presentation_order
    df = spark.createDataFrame([("2026-01", "regular", 1.0), ("2026-01", "milk_powder", 3.0),
                                ("2026-01", "premium", 2.0), ("2025-12", "regular", 9.0)],
                               "period string, bucket string, amount double")
    out = [(r.period, r.bucket) for r in presentation_order(df, ["period", "bucket"]).collect()]
    assert out == [("2025-12", "regular"), ("2026-01", "premium"), ("2026-01", "regular"),
                   ("2026-01", "milk_powder")]
    df2 = spark.createDataFrame([("export", 1), ("local", 2)], "channel_group string, q int")
    assert [r.channel_group for r in presentation_order(df2, ["channel_group"]).collect()] == \
        ["local", "export"]


def test_carry_forward_over_silent_months(spark, monkeypatch):
    """Two silent months, or a month the store did not trade, lose no brand."""
    from tillgrid.operators import review as RV
    inv = spark.createDataFrame(
        [(1, "2026-01", "acme", "ACME/Acme"), (1, "2026-01", "bolt", "Bolt"), (1, "2026-02", "bolt", "Bolt"),
         (1, "2026-04", "bolt", "BOLT"), (1, "2026-05", "core", "Core")],
        "store_id int, period string, brand_key string, brand_variants string")
    monkeypatch.setattr(RV, "brand_inventory", lambda t: inv)
    monkeypatch.setattr(RV.star, "brand_categories", lambda t: spark.createDataFrame(
        [("ACME/Acme", "honey", 1), ("Bolt", "", 2)],
        "brand_variants string, confirmed_category string, line_no long"))
    got = sorted((r.period, r.brand_variants, r.confirmed_category) for r in RV.brand_carry_forward(None).collect())
    assert got == [("2026-02", "ACME/Acme", "honey"), ("2026-04", "ACME/Acme", "honey"),
                   ("2026-05", "ACME/Acme", "honey"), ("2026-05", "BOLT", "")]


def test_functional_leader_of_the_reporting_month(spark, monkeypatch):
    """A store without functional sales in the month has no leader, whatever it sold before."""
    from tillgrid.operators import report as RP
    trend = spark.createDataFrame(
        [(1, "2026-04", "fish_oil", 5), (1, "2026-04", "coq10", 9), (2, "2026-03", "calcium", 7)],
        "store_id int, period string, product_type string, qty long")
    facts = spark.createDataFrame([(1,), (2,)], "store_id int")
    monkeypatch.setattr(RP, "functional_trend", lambda t, through, variant: trend)
    monkeypatch.setattr(RP.star, "fact_sales", lambda t, through=None: facts)
    got = {r.store_id: (r.period, r.leader, r.leader_qty) for r in RP.functional_leader(None, "2026-04").collect()}
    assert got == {1: ("2026-04", "CoQ10", 9), 2: ("2026-04", None, None)}
