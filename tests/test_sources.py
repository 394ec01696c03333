"""File readers and writers: reference CSVs (S4), holiday calendar (S6),
optional known-SKU table (S8), sorted review exports (K9), report documents
written and read back (K10, S11), config row (K5)."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from tillgrid.operators import grounding as GR
from tillgrid.operators import textcheck as TX
from tillgrid.operators.classify import variant_categories
from tillgrid.sources import reference as REF
from tillgrid.sources import star, wide
from tillgrid.sources.tables import Tables


def test_reference_csv_with_bom_and_quoted_commas(spark, tmp_path):
    p = tmp_path / "brand_categories.csv"
    p.write_text("﻿brand_variants,n_sku,total_amt,sample_product,confirmed_category\n"
                 'Solwave/SOLWAVE,3,100.5,"Liver Support, 60s",supplement\n'
                 "Kiwiana Co,1,9.9,Magnet,\n"
                 "solwave,1,1.0,x,honey\n", encoding="utf-8")
    df = REF.read_reference_csv(spark, str(p), REF.BRAND_CATEGORIES)
    rows = df.orderBy("line_no").collect()
    assert rows[0].brand_variants == "Solwave/SOLWAVE"  # BOM stripped from the header
    assert rows[0].sample_product == "Liver Support, 60s"
    cats = {r.brand_key: r.category for r in variant_categories(df).collect()}
    # every spelling maps; a later row overrides an earlier one
    assert cats == {"solwave": "honey", "kiwiana co": ""}


def test_read_holidays(spark, tmp_path):
    cal = {"_note": "local dates", "2026-02": [{"date": "2026-02-15", "end": "2026-02-23",
                                                "region": "CN", "name": "New Year",
                                                "impact": "high"}], "2026-03": []}
    p = tmp_path / "holidays.json"
    p.write_text(json.dumps(cal, indent=2))
    h = REF.read_holidays(spark, str(p))
    assert sorted((r.period, r.name) for r in h.collect()) == [("2026-02", "New Year"),
                                                              ("2026-03", None)]
    on = REF.holidays_on_charts(h, spark.createDataFrame([("2026-02",)], "period string"))
    assert [r.period for r in on.collect()] == ["2026-02"]


def test_known_skus_safe(spark, tmp_path):
    df, err = REF.known_skus_safe(spark, str(tmp_path / "missing"))
    assert df.count() == 0 and "does not exist" in err
    spark.createDataFrame([("SKU1", "b", "d", "honey", "regular", "not_applicable", "x")],
                          REF.KNOWN_SKUS).write.parquet(str(tmp_path / "dim"))
    df, err = REF.known_skus_safe(spark, str(tmp_path / "dim"))
    assert err is None and df.count() == 1


def test_sorted_export_and_config(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "k string, v int")
    REF.write_sorted(df, str(tmp_path / "out"), ["k"])
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert sorted(r.k for r in back.collect()) == ["a", "b"]
    path = REF.set_report_period(spark, str(tmp_path / "cfg"), "2026-04")
    assert spark.read.parquet(path).first().rpt_period == "2026-04"


def test_documents_round_trip_and_grounding(spark, tmp_path):
    doc = {"period": "2026-02", "headline": {"total_amount": 78427.85, "total_qty": 1759},
           "top_brands": [{"brand": "Orama", "pct_of_store": 15.4}], "flag": True}
    docs = spark.createDataFrame([(1, "2026-02", json.dumps(doc))],
                                 "store_id int, period string, document string")
    REF.write_documents(docs, str(tmp_path / "docs"))
    back = REF.read_documents(spark, str(tmp_path / "docs"))
    assert back.select("period").first().period == "2026-02"
    allowed = sorted({r.a for r in GR.allowed_from_json(back, ["period"], "document").collect()})
    assert {78427.85, 78427.9, 78428.0, 1759.0, 15.4, 15.0, 2026.0, 2.0} <= set(allowed)
    schema = "struct<period:string,headline:struct<total_amount:double,total_qty:bigint>," \
             "top_brands:array<struct<brand:string,pct_of_store:double>>,flag:boolean>"
    from pyspark.sql.types import _parse_datatype_string
    typed = sorted({r.a for r in GR.allowed_from_typed_json(
        back, ["period"], "document", _parse_datatype_string(schema)).collect()})
    assert typed == allowed


def test_month_list_schema(spark):
    from tillgrid.sources.wide import month_columns, sheet_schema
    assert month_columns(["jan"]) == ["jan_order", "jan_qty", "jan_amt"]
    s = sheet_schema("product_name", ["jan", "feb"], True)
    assert len(s.fields) == 1 + 6 + 3 and all(f.dataType.simpleString() == "string" for f in s)


def test_labels(spark):
    from tillgrid.functions.text import display_label
    df = spark.createDataFrame([("milk_powder", "fish_oil", "a; b,, c")], "c string, t string, n string")
    r = df.select(display_label("c", "category").alias("c"),
                  display_label("t", "product_type").alias("t"),
                  display_label(F.lit("new_thing"), "category").alias("x")).first()
    assert (r.c, r.t, r.x) == ("Milk Powder", "Fish Oil / Omega", "New thing")


def test_cells_that_do_not_parse_are_listed(spark):
    df = spark.createDataFrame(
        [("s", "1,200", " ", "10000000000.00", "n/a"), ("t", "1.5.2", None, "", "7")],
        "sku_code string, jan_order string, jan_qty string, jan_amt string, total_amt string")
    got = {tuple(r) for r in wide.rejected_cells(df, ["sku_code"]).collect()}
    assert got == {("s", "total_amt", "n/a"), ("t", "jan_order", "1.5.2")}
    assert wide.rejected_cells(df.limit(0), ["sku_code"]).count() == 0


def test_a_quoted_holiday_range_is_sourced_and_another_is_not(spark):
    """The digits of the holidays in the charts' months count, those of others do not."""
    cal = {"_note": "77", "2026-02": [{"date": "2026-02-15", "end": "2026-03-23", "region": "CN",
                                       "name": "New Year (9-day)", "impact": "high"}], "2026-03": [],
           "2026-05": [{"date": "2026-05-28", "region": "NZ", "name": "later"}]}
    held = REF.parse_holidays(spark.createDataFrame([(json.dumps(cal),)], "c string"), "c")
    charts = spark.createDataFrame([(1, "2026-03", m) for m in ("2026-02", "2026-03")],
                                   "store_id int, period string, month string")
    allowed = TX.holiday_numbers(held, charts)
    texts = spark.createDataFrame([(1, "2026-03", f, x) for f, x in [
        ("a", "closed 15-23 Feb"), ("b", "closed 28 May"), ("c", "77 days")]],
        "store_id int, period string, field string, text string")
    found = GR.classify_tokens(GR.explode_tokens(texts, ["store_id", "period", "field"]), allowed, ["store_id", "period"])
    assert {(r.field, r.value): r.status for r in found.collect()} == {
        ("a", 15.0): "ok", ("a", 23.0): "ok", ("b", 28.0): "missing", ("c", 77.0): "missing"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_are_dealt_once(spark, tmp_path):
    """The lines move once, by the ranges that the table is stored in."""
    lines = [(o, p, 1, 2.0, 10.0, dt.datetime(1995, 1 + p % 2, 3)) for o in range(4) for p in (1, 2)] * 2
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, "
                          "l_extendedprice double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 5)], "s_suppkey long, s_nationkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(5, 3)], "n_nationkey long, n_regionkey long").write.parquet(f"{tmp_path}/nation.parquet")
    facts = star.build_fact_sales(Tables(spark, str(tmp_path)))
    plan = _plan(facts)
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
    assert {(r.partkey, r.period, r.store_id, r.order_count, r.qty, float(r.amount)) for r in facts.collect()} == {
        (1, "1995-02", 3, 4, 16, 80.0), (2, "1995-01", 3, 4, 16, 80.0)}


def test_sheet_lines_stay_where_they_are(spark):
    """Head and end of the sheets come to the lines, which are not dealt by sheet."""
    sheets = spark.createDataFrame([(1, 1995, f"[SKU{i}] [b]x", i) for i in range(9)],
                                   "store_id long, year int, product_name string, line long")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        body = wide.body_rows(sheets, ["store_id", "year"], wide.SALES_HEAD)
        last_join = next(line for line in _plan(body).splitlines() if "Join" in line)
        assert "BroadcastHashJoin" in last_join
        assert sorted(r["line"] for r in body.collect()) == [3, 4, 5, 6, 7]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_sheet_cells_are_spread_last(spark, monkeypatch):
    """The facts reach their lines as they are: no aggregate holds a column a month and measure."""
    facts = spark.createDataFrame(
        [(1, "1995-01", 7, 2, 3, Decimal("4.50")), (1, "1995-12", 7, 1, None, Decimal("1.00")),
         (2, "1995-03", 7, 1, 1, Decimal("2.00")), (2, None, 7, 9, 9, Decimal("9.00"))],
        "partkey long, period string, store_id long, order_count long, qty long, amount decimal(22,2)")
    monkeypatch.setattr(star, "fact_sales", lambda t: facts)
    monkeypatch.setattr(star, "dim_store", lambda t: spark.createDataFrame([(7, "S")], "store_id long, store_code string"))
    monkeypatch.setattr(wide, "_pname", lambda t: spark.createDataFrame([(1, "one"), (2, "two")], "partkey long, product_name string"))
    sheets = wide.build_sales_sheets(None, True)
    lines = {r.line: r for r in sheets.where("product_name IN ('one', 'two') AND year = 1995").collect()}
    one, two = lines[1 + wide.SALES_HEAD], lines[2 + wide.SALES_HEAD]
    assert (one.jan_order, one.jan_qty, one.jan_amt, one.dec_order, one.dec_qty, one.dec_amt) == ("2", "3", "4.50", "1", None, "1.00")
    assert (one.total_order, one.total_qty, one.total_amt, one.feb_amt) == ("3", "3", "5.50", None)
    assert (two.year, two.mar_amt, two.total_amt) == (1995, "2.00", "2.00")
    aggregates = [x for x in _plan(sheets.where("product_name <> 'Total'")).splitlines() if "Aggregate" in x]
    assert any("collect_list" in x for x in aggregates) and not any("max(CASE" in x for x in aggregates)


def test_totals_sum_the_cells_that_are_there(spark):
    months = ["jan", "feb", "mar"]
    schema = ", ".join(f"{c} string" for c in ["product_name", *wide.month_columns(months)])
    rows = [("a", "1", "2", "1,000.25", None, None, None, "3", "x", "0.50"), ("b", *[None] * 9)]
    df = wide.with_total_block(spark.createDataFrame(rows, schema), months)
    assert [tuple(r)[-3:] for r in df.orderBy("product_name").collect()] == [("4", "2", "1000.75"), ("0", "0", "0.00")]
    # no sum of one expression a cell, which the JIT leaves uncompiled
    assert "aggregate(" in df._jdf.queryExecution().optimizedPlan().toString()
