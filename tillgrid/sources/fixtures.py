"""Incoming files derived from the tables, faults included (FIXTURES.md §3).

What a load or a check meets is planted here; the operators themselves plant nothing.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import star, wide
from .tables import Tables

#: A month that no sales have yet.
MONTH_AHEAD = "2099-01"
#: (end of the SKU, cell, value): two cells that do not parse, one amount of eleven digits, which does.
BAD_CELLS = [("89", "jan_amt", "n/a"), ("83", "mar_qty", "12345678901234567890123"),
             ("71", "feb_amt", "10000000000.00")]
FACT_COLS = ["partkey", "sku_code", "period", "store_id", "order_count", "qty", "amount"]


def next_period(p: str) -> str:
    y, m = int(p[:4]), int(p[5:7])
    return f"{y + (m == 12):04d}-{m % 12 + 1:02d}"


def second_load(t: Tables) -> DataFrame:
    """The reporting month once more: amounts x1.1 for even SKUs, odd SKUs absent, the next
    month's lines as new SKUs, each of them twice (``load_seq`` tells the later line)."""
    rpt = star.reporting_month(t)
    old = star.fact_sales(t).select(*FACT_COLS)
    cur = old.filter(F.col("period") == rpt)
    even = (cur.filter(F.col("partkey") % 2 == 0)
            .withColumn("amount", F.round(F.col("amount") * F.lit(Decimal("1.1")), 2)
                        .cast(old.schema["amount"].dataType))
            .withColumn("load_seq", F.lit(1)))
    moved = (old.filter(F.col("period") == next_period(rpt)).withColumn("period", F.lit(rpt))
             .join(cur.select("store_id", "partkey"), ["store_id", "partkey"], "left_anti"))
    again = moved.withColumn("qty", F.col("qty") + 1).withColumn("load_seq", F.lit(2))
    return (even.unionByName(moved.withColumn("load_seq", F.lit(1))).unionByName(again))


def with_stray_skus(batch: DataFrame) -> DataFrame:
    """Beside the lines of every 25th part the batch carries one of an unregistered SKU."""
    stray = (batch.filter(F.col("partkey") % 25 == 0)
             .withColumn("sku_code", F.concat("sku_code", F.lit("-U"))))
    return batch.unionByName(stray)


def with_unknown_channel(sheets: DataFrame) -> DataFrame:
    """Each channel sheet carries one line more, of a channel without a code."""
    line = (sheets.filter(F.col("line") == wide.LAST_LINE).withColumn("channel_name", F.lit("Fax"))
            .withColumn("line", F.col("line") - 1))
    return sheets.unionByName(line)


def with_bad_cells(products: DataFrame) -> DataFrame:
    for end, cell, value in BAD_CELLS:
        products = products.withColumn(cell, F.when(F.col("sku_code").endswith(end), value)
                                       .otherwise(F.col(cell)))
    return products


def with_month_ahead(rows: DataFrame, rpt: str) -> DataFrame:
    """Context rows, and each store's reporting month once more under a month without sales."""
    ahead = rows.filter(F.col("period") == rpt).withColumn("period", F.lit(MONTH_AHEAD))
    return rows.unionByName(ahead)


def holiday_calendar(t: Tables) -> DataFrame:
    """The holiday calendar as it arrives, one JSON text: every third month has a holiday from the
    15th to the 23rd, every December one that ends in the next year, the others none."""
    month = F.substring("period", 6, 2).cast("int")
    year = F.substring("period", 1, 4).cast("int")
    entry = lambda name, start, end: F.concat(
        F.lit('{"date": "'), start, F.lit('", "end": "'), end, F.lit(f'", "region": "NZ", "name": "{name}", "impact": "quiet"}}'))
    spring = entry("Harvest days", F.concat("period", F.lit("-15")), F.concat("period", F.lit("-23")))
    turn = entry("Turn of the year", F.concat("period", F.lit("-27")),
                 F.concat((year + 1).cast("string"), F.lit("-01-06")))
    days = F.concat(F.lit('"'), "period", F.lit('": ['), F.concat_ws(
        ", ", F.when(month % 3 == 0, spring), F.when(month == 12, turn)), F.lit("]"))
    months = star.fact_sales(t).select("period").distinct()
    return months.agg(F.concat(F.lit('{"_note": "local dates, 99 of them", '), F.array_join(
        F.array_sort(F.collect_list(days)), ", "), F.lit("}")).alias("calendar"))
