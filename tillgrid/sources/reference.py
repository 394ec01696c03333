"""Readers and writers for the small hand-maintained files and the report
documents (S4, S6, S8, S11, K5, K9, K10).

All readers take explicit schemas (no inference)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BRAND_CATEGORIES = T.StructType([
    T.StructField("brand_variants", T.StringType()), T.StructField("n_sku", T.LongType()),
    T.StructField("total_amt", T.DoubleType()), T.StructField("sample_product", T.StringType()),
    T.StructField("confirmed_category", T.StringType())])
SKU_OVERRIDES = T.StructType([T.StructField(c, T.StringType())
                              for c in ["sku_code", "override_category", "reason"]])
CONFLICT_REVIEWED = T.StructType([T.StructField(c, T.StringType()) for c in
                                  ["sku_code", "brand", "product_desc", "decision", "reviewed_on",
                                   "note"]])
MONTHLY_CONTEXT = T.StructType([T.StructField(c, T.StringType()) for c in
                                ["period", "foot_traffic", "miniprogram_leads",
                                 "miniprogram_completion_rate", "study_tour_flag",
                                 "study_tour_note", "activity_description"]])
HOLIDAY = "array<struct<date:string,end:string,region:string,name:string,impact:string>>"
KNOWN_SKUS = T.StructType([T.StructField(c, T.StringType()) for c in
                           ["sku_code", "brand", "product_desc", "category", "tier",
                            "shipping_channel", "product_type"]])


def file_order(file: bool = True) -> Column:
    """Where a row stands: its file, the block's start in it, its place in the block.  A block is
    read by one task from its start on, so this orders the rows of split and of several files."""
    parts = [F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")]
    return F.struct(*([F.col("_metadata.file_path").alias("file")] if file else []), *parts)


def read_reference_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Header CSV (a UTF-8 byte-order mark is stripped by the reader); quoted
    fields may hold commas and, with ``multi_line`` (files are then read whole, a task each),
    line breaks.  ``line_no`` keeps file order for 'later row wins' rules."""
    df = (spark.read.option("header", True).option("encoding", "UTF-8")
          .option("multiLine", multi_line).option("quote", '"').option("escape", '"')
          .schema(schema).csv(path))
    return df.withColumn("line_no", file_order())


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """Calendar JSON {period: [holiday...], "_note": text} -> one row per
    (period, holiday); months with an empty list keep a NULL holiday."""
    return parse_holidays(spark.read.text(path, wholetext=True), "value")


def parse_holidays(calendars: DataFrame, column: str) -> DataFrame:
    m = calendars.select(F.explode(F.from_json(column, "map<string,string>")).alias("period", "v"))
    return (m.filter(F.col("period").rlike(r"^\d{4}-\d{2}$"))
            .select("period", F.explode_outer(F.from_json("v", HOLIDAY)).alias("h"))
            .select("period", "h.*"))


def holidays_on_charts(holidays: DataFrame, periods: DataFrame) -> DataFrame:
    """holidays restricted to the months on the charts."""
    return holidays.join(periods.select("period").distinct(), "period", "left_semi")


def known_skus_safe(spark: SparkSession, path: str) -> tuple[DataFrame, str | None]:
    """The known-SKU dimension, or an empty typed frame plus the reason
    when it cannot be read (classification then starts from scratch)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return spark.createDataFrame([], KNOWN_SKUS), f"{path} does not exist"
    return spark.read.schema(KNOWN_SKUS).parquet(path), None


def set_report_period(spark: SparkSession, table_root: str, period: str) -> str:
    """K5: the single-row reporting-month config, written as a new version."""
    df = spark.createDataFrame([(1, period)], "config_id int, rpt_period string")
    path = f"{table_root.rstrip('/')}/rpt={period}"
    df.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def write_sorted(df: DataFrame, path: str, order: list[str], fmt: str = "csv") -> None:
    """Review relations written sorted for a person to read (the
    sort happens only here, at presentation)."""
    w = df.orderBy(*order).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_documents(docs: DataFrame, path: str) -> None:
    """One JSON report document per (store, period), partitioned by period."""
    (docs.select("period", F.col("document").alias("value"))
     .write.mode("overwrite").partitionBy("period").text(path))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Report documents back as text (parse with ``parse_json``/``from_json``)."""
    return spark.read.text(path).withColumnRenamed("value", "document")
