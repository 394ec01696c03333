"""Ingest of wide monthly exports: parse, split, unpivot, reconcile.

All sheets (every store and year) are processed together; sheet identity is
carried as ``store_id, year`` columns (the file a row came from)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..sources import fixtures, wide
from ..sources.tables import Tables

SHEET = ["store_id", "year"]


def sales_sheets(t: Tables, with_total: bool) -> DataFrame:
    """The wide exports as they arrive (all cells text), stored once; the
    export without a total block is the same sheet minus those columns."""
    from ..sources import warehouse
    from ..sources.star import _inputs
    sheets = warehouse.materialized(
        t.spark, "sales_sheets",
        _inputs(t, ["lineitem", "supplier", "nation", "part", "region"]),
        lambda: wide.build_sales_sheets(t, True))
    return sheets if with_total else sheets.drop(*wide.TOTAL_COLS)


def channel_sheets(t: Tables) -> DataFrame:
    from ..sources import warehouse
    from ..sources.star import _inputs
    return warehouse.materialized(
        t.spark, "channel_sheets", _inputs(t, ["orders", "customer", "nation", "lineitem"]),
        lambda: wide.build_channel_sheets(t))


def sheet_products(t: Tables, with_total: bool = False) -> tuple[DataFrame, DataFrame]:
    """(kept product lines, excluded non-product lines) of every sales sheet."""
    sheets = sales_sheets(t, with_total)
    return wide.parse_sales_sheet(sheets, vocab.MONTH_PREFIXES, SHEET)


def products_view(t: Tables) -> DataFrame:
    kept, _ = sheet_products(t, with_total=False)
    return kept.select(*SHEET, "sku_code", "brand", "product_desc", "freight_tag",
                       F.col("total_order").cast("bigint").alias("total_order"),
                       F.col("total_qty").cast("bigint").alias("total_qty"),
                       F.col("total_amt").cast(wide.AMOUNT).cast("double").alias("total_amt"))


def excluded_view(t: Tables) -> DataFrame:
    _, ex = sheet_products(t, with_total=False)
    return ex.select(*SHEET, "product_name",
                     F.col("total_order").cast("bigint").alias("total_order"),
                     F.col("total_qty").cast("bigint").alias("total_qty"),
                     F.col("total_amt").cast(wide.AMOUNT).cast("double").alias("total_amt"))


def unpivoted(t: Tables) -> DataFrame:
    """R0 over the sheets that carry a total block."""
    kept, _ = sheet_products(t, with_total=True)
    return wide.unpivot_sales(kept, key_cols=["store_id"], year_col="year")


def rejects(t: Tables) -> DataFrame:
    """Cells that do not parse, over sheets that have some."""
    kept, _ = sheet_products(t, with_total=True)
    return wide.rejected_cells(fixtures.with_bad_cells(kept), [*SHEET, "sku_code"])


def unpivot_view(t: Tables) -> DataFrame:
    return unpivoted(t).withColumn("amount", F.col("amount").cast("double"))


def unpivot_reconcile(t: Tables) -> DataFrame:
    """Q6: per sheet, Σ unpivoted amount vs Σ source total, tolerance 0.01."""
    kept, _ = sheet_products(t, with_total=True)
    src = kept.groupBy(*SHEET).agg(
        F.sum(F.col("total_amt").try_cast(wide.AMOUNT)).alias("source_amount"))
    facts = (wide.unpivot_sales(kept, key_cols=["store_id"], year_col="year")
             .withColumn("year", F.substring("period", 1, 4).cast("int"))
             .groupBy(*SHEET).agg(F.sum("amount").alias("fact_amount")))
    j = src.join(facts, SHEET, "full")
    diff = F.coalesce("fact_amount", F.lit(0)) - F.coalesce("source_amount", F.lit(0))
    return j.select(*SHEET, F.col("fact_amount").cast("double").alias("fact_amount"),
                    F.col("source_amount").cast("double").alias("source_amount"),
                    diff.cast("double").alias("diff"),
                    (F.abs(diff) <= vocab.RECONCILE_TOLERANCE).alias("ok"))


def month_counts(t: Tables) -> DataFrame:
    """Rows and amount per (store, month) of the new facts."""
    return (unpivoted(t).groupBy("store_id", "period")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("amount").cast("double").alias("amount")))


def freight_tag_counts(t: Tables) -> DataFrame:
    """Value counts of the freight tag ('(none)' for blank)."""
    kept, _ = sheet_products(t)
    tag = F.when(F.col("freight_tag") == "", F.lit("(none)")).otherwise(F.col("freight_tag"))
    return kept.groupBy(*SHEET, tag.alias("freight_tag")).agg(F.count(F.lit(1)).alias("n"))


def brands_seen(t: Tables) -> DataFrame:
    """Distinct brands per sheet, case-folded."""
    kept, _ = sheet_products(t)
    return kept.groupBy(*SHEET).agg(
        F.count_distinct(F.lower(F.trim("brand"))).alias("n_brands"))


def channel_unpivot(t: Tables) -> DataFrame:
    """S3 + R2 + P16: channel sheets to long facts."""
    long = wide.parse_channel_sheet(channel_sheets(t), key_cols=["store_id"])
    return long.withColumn("amount", F.col("amount").cast("double"))


def unknown_channels(t: Tables) -> DataFrame:
    """Labels that map to no channel code, over sheets that have some."""
    sheets = fixtures.with_unknown_channel(channel_sheets(t))
    return wide.unknown_channel_labels(sheets, SHEET).select(*SHEET, "channel_name")
