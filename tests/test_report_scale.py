"""Report blocks that sum the facts before they rank or collate, against their plain definitions."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillgrid.operators import document, ranking, report
from tillgrid.sources import star
from tillgrid.sources.tables import Tables

G = ["store_id", "period"]
ROWS = [
    # a brand typed in several ways; its largest rows tie in two categories, the smaller SKU decides
    (1, "2024-01", "SKU10", "Acme", "vitamins", "premium", 5, "9.00"), (1, "2024-01", "SKU2", "ACME ", "milk_powder", "regular", 7, "9.00"),
    (1, "2024-01", "SKU3", "acme", "vitamins", "regular", 7, "1.50"), (1, "2024-01", "SKU4", "Bell", "milk_powder", "premium", 7, "4.00"),
    (1, "2024-01", "SKU5", "bell", "milk_powder", "regular", None, None), (1, "2024-01", "SKU6", "Bell", "vitamins", "regular", 1, "8.00"),
    (1, "2024-01", "SKU7", None, None, None, 2, "3.00"), (None, None, "SKU8", "Acme", "vitamins", "premium", 2, "3.00"),
    (2, "2024-01", "SKU1", "Acme", "milk_powder", "premium", None, "2.00"), (2, "2024-01", "SKU2", "Acme", "vitamins", "premium", None, "5.00"),
    (2, "2024-01", "SKU3", "Acme", "vitamins", "premium", 3, "5.00")]


@pytest.fixture
def sales(spark, monkeypatch):
    s = spark.createDataFrame(ROWS, "store_id long, period string, sku_code string, brand string, category string, "
                              "tier string, qty long, amount string").select(
        "*", F.col("amount").cast("decimal(22,2)").alias("a"), F.lit("d").alias("product_desc"),
        F.lit("local").alias("shipping_channel"), F.lit("t").alias("product_type")).drop("amount")
    s = s.withColumnRenamed("a", "amount").localCheckpoint()
    monkeypatch.setattr(star, "sales", lambda t, period=None, through=None: s)
    return s


def same(a, b):
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert rows(a) == rows(b) and rows(a)


def test_largest_row_of_a_brand(sales):
    keyed = sales.withColumn("brand_key", F.collate("brand", "UNICODE_CI_AI_RTRIM"))
    want = (keyed.groupBy(*G, "brand_key").agg(
        F.sum("amount").cast("double").alias("amount"), F.min("brand").alias("brand"),
        F.min_by("category", F.struct(-F.col("amount"), F.col("sku_code"))).alias("main_category")))
    same(report.top_brands(None, main_category="largest_row").select(*G, "amount", "brand", "main_category"),
         want.select(*G, "amount", "brand", "main_category"))


def test_best_sellers(sales):
    w = Window.partitionBy(*G).orderBy(F.desc("qty"), F.asc("sku_code"))
    for k in (1, 2, 3, 10):
        want = sales.withColumn("rnk", F.row_number().over(w)).where(F.col("rnk") <= k)
        same(report.top_products(None, k=k).select(*G, "rnk", "sku_code"), want.select(*G, "rnk", "sku_code"))


@pytest.mark.parametrize("block", [report.milk_brands, lambda t: report.top_brands(t, main_category="largest_row")])
def test_brands_are_summed_by_hash_before_they_are_collated(sales, block):
    plan = block(None)._jdf.queryExecution().executedPlan().toString()
    lowest = [x for x in re.findall(r"(SortAggregate|HashAggregate)\(keys?=\[([^\]]*)\]", plan) if "brand#" in x[1]]
    assert lowest and all(kind == "HashAggregate" for kind, _ in lowest)


def test_documents_and_their_schema_rank_the_facts_once(spark, monkeypatch, tmp_path):
    calls = []
    monkeypatch.setattr(ranking, "ranged_ntile", lambda *a, f=ranking.ranged_ntile, **k: (calls.append(1), f(*a, **k))[1])
    spark.conf.set("spark.tillgrid.warehouse", str(tmp_path))
    try:
        t = Tables(spark, "/root/testdata/sf0.001")
        document.report_documents(t)
        schema = document.document_schema(t)
    finally:
        spark.conf.unset("spark.tillgrid.warehouse")
    assert len(calls) == 1 and "sku_pareto" in schema.fieldNames()
