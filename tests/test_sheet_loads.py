"""Sheets by place, file order over blocks and files, and loads that stop on a fault."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillgrid import vocab
from tillgrid.operators import ingest as IN
from tillgrid.operators import loads as LD
from tillgrid.operators.classify import variant_categories
from tillgrid.sources import fixtures, star, wide
from tillgrid.sources import reference as REF
from tillgrid.sources.tables import Tables
from tillgrid.sources.versioned import LoadRefused, VersionedTable

BLOCKS = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in (BLOCKS, "spark.sql.files.openCostInBytes")}
    spark.conf.set(BLOCKS, "256b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def sheet(path, n, first=1):
    cells = lambda i: f"{i},{i},{i}.50"
    labels = [f"[SKU{i}] [Solwave]Thing {i}" for i in range(first, first + n)]
    labels[2], labels[4], labels[5] = "", "Total", "Column0"
    lines = ["Column0,Jan,,", ",Order,Product Quantity,Total Price", "Demo Store,9,9,9.00",
             *(f"{label},{cells(i)}" for i, label in enumerate(labels, 1)), "Total,9,9,9.00"]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_head_and_total_go_by_place_over_many_blocks(spark, tmp_path, small_blocks):
    sheet(tmp_path / "a.csv", 60)
    sheet(tmp_path / "b.csv", 30, first=100)
    df = wide.read_sheet_csv(spark, str(tmp_path), ["jan"])
    assert df.rdd.getNumPartitions() > 8
    kept, excluded = wide.parse_sales_sheet(df, ["jan"])
    assert kept.count() == 57 + 27
    assert sorted(r.product_name or "" for r in excluded.collect()) == ["", "", "Column0", "Column0", "Total", "Total"]


def test_file_order_over_blocks_and_files(spark, tmp_path, small_blocks):
    rng = random.Random(1)
    header = "brand_variants,n_sku,total_amt,sample_product,confirmed_category\n"
    want, order = {}, []
    for name in ("a.csv", "b.csv"):
        rows = [(f"brand{rng.randint(1, 20)}", rng.choice(vocab.CATEGORIES), i) for i in range(150)]
        (tmp_path / name).write_text(header + "".join(f"{b},1,1.0,sample {i},{c}\n" for b, c, i in rows))
        want.update({b: c for b, c, _ in rows})
        order += [f"sample {i}" for *_, i in rows]
    df = REF.read_reference_csv(spark, str(tmp_path), REF.BRAND_CATEGORIES, multi_line=False)
    assert df.rdd.getNumPartitions() > 8
    assert [r.sample_product for r in df.orderBy("line_no").collect()] == order
    assert {r.brand_key: r.category for r in variant_categories(df).collect()} == want


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('sku_code,override_category,reason\nSKU1,honey,"one\ntwo, three"\nSKU2,,"a ""b"""\n')
    rows = REF.read_reference_csv(spark, str(path), REF.SKU_OVERRIDES).orderBy("line_no").collect()
    assert [(r.sku_code, r.reason) for r in rows] == [("SKU1", "one\ntwo, three"), ("SKU2", 'a "b"')]


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF_SMALL)


def test_sales_sheets_load_or_stop(spark, t, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), star.fact_sales(t).select(*fixtures.FACT_COLS).schema)
    sheets, dim = IN.sales_sheets(t, True), star.dim_product(t)
    sheets = sheets.where("year = 1995")
    assert LD.load_sales_sheets(table, sheets, vocab.MONTH_PREFIXES, dim, IN.SHEET) == 1
    kept, _ = wide.parse_sales_sheet(sheets, vocab.MONTH_PREFIXES, IN.SHEET)
    facts = star.fact_sales(t).where("period like '1995%'").join(kept.select("sku_code").distinct(), "sku_code")
    got = table.read()
    assert got.exceptAll(facts.select(*got.columns)).count() == facts.select(*got.columns).exceptAll(got).count() == 0
    before = table.folders()
    first = F.col("line") == 3 + kept.agg(F.min(F.substring("sku_code", 4, 9).cast("int"))).first()[0]
    faults = {"cells of lines that do not parse": sheets.withColumn("mar_qty", F.when(first, "n/a").otherwise(F.col("mar_qty"))),
              "lines that miss their total": sheets.withColumn("total_amt", F.when(first, "1.00").otherwise(F.col("total_amt")))}
    for name, bad in faults.items():
        with pytest.raises(LoadRefused) as refused:
            LD.load_sales_sheets(table, bad, vocab.MONTH_PREFIXES, dim, IN.SHEET)
        assert name in refused.value.counts and "unregistered SKU" not in refused.value.counts
    with pytest.raises(LoadRefused, match="unregistered SKU"):
        LD.load_sales_sheets(table, sheets, vocab.MONTH_PREFIXES, dim.where("partkey > 20"), IN.SHEET)
    assert table.version() == 1 and table.folders() == before


def test_channel_sheets_load_or_stop(spark, t, tmp_path):
    stored = star.fact_channel(t)
    table = VersionedTable(spark, str(tmp_path / "t"), stored.schema)
    sheets = IN.channel_sheets(t)
    assert LD.load_channel_sheets(table, sheets, IN.SHEET) == 1
    assert table.read().exceptAll(stored).count() == stored.exceptAll(table.read()).count() == 0
    with pytest.raises(LoadRefused, match="unknown channel label"):
        LD.load_channel_sheets(table, fixtures.with_unknown_channel(sheets), IN.SHEET)
    with pytest.raises(LoadRefused, match="do not parse"):
        LD.load_channel_sheets(table, sheets.withColumn("may_amt", F.when(F.col("line") == 2, "?").otherwise(
            F.col("may_amt"))), IN.SHEET)
    assert table.version() == 1


def test_checks_find_nothing_in_clean_tables(t):
    """The checks plant nothing: what they find comes from the fixtures' faults."""
    kept, _ = IN.sheet_products(t, with_total=True)
    assert wide.rejected_cells(kept, [*IN.SHEET, "sku_code"]).count() == 0
    assert wide.unknown_channel_labels(IN.channel_sheets(t), IN.SHEET).count() == 0
    assert LD.unregistered(fixtures.second_load(t), star.dim_product(t)).count() == 0
