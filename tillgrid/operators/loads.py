"""Keyed loads exercised on the derived schema (slice 8).

The fact tables are versioned (``sources.versioned``): the stored facts are the first
version, taken over without a copy, and a load writes the months its batch touches.
``sources.fixtures`` derives the batches: the "second load" of the reporting month
re-imports it with amounts x1.1 for even SKUs, drops odd SKUs from the file (their old
rows survive) and adds new SKUs, some of them twice (the later line wins)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import vocab
from ..sources import fixtures, star, warehouse, wide
from ..sources.fixtures import FACT_COLS
from ..sources.tables import Tables
from ..sources.versioned import VersionedTable
from . import classify as C
from . import upsert as U
from .report import parse_monthly_context

FACT_KEYS = ["store_id", "period", "partkey"]
CHANNEL_KEYS = ["period", "store_id", "channel_code"]
CONTEXT_KEYS = ["store_id", "period"]


def _versions(t: Tables, name: str, inputs: list[str], rows: Callable[[], DataFrame], columns: list[str] | None,
              keys: list[str]) -> VersionedTable:
    """The versioned table over a stored one; its first version takes over the stored folder."""
    stored = rows()
    columns = columns or stored.columns
    own = StructType([stored.schema[c] for c in columns])
    paths = star._inputs(t, inputs)
    table = VersionedTable(t.spark, f"{warehouse.folder(t.spark, paths)}/{name}-versions", own)
    if not table.version():
        if warehouse.enabled(t.spark):
            table.adopt(f"{warehouse.folder(t.spark, paths)}/{name}")
        else:
            table.upsert(stored.select(*columns), keys)
    return table


def fact_sales_table(t: Tables) -> VersionedTable:
    return _versions(t, "fact_sales", ["lineitem", "supplier", "nation"], lambda: star.fact_sales(t), FACT_COLS,
                     FACT_KEYS)


def fact_channel_table(t: Tables) -> VersionedTable:
    return _versions(t, "fact_channel", ["orders", "customer", "nation", "lineitem"],
                     lambda: star.fact_channel(t), None, CHANNEL_KEYS)


def load_sales(table: VersionedTable, batch: DataFrame, dim: DataFrame, order: str | None = "load_seq",
               log: tuple[str, list[str]] | None = None) -> int:
    """K2 + K8 + J10: upsert fact lines; a line of an unregistered SKU stops the load."""
    known = dim.select("sku_code", F.lit(True).alias("_registered"))
    return table.upsert(batch.join(known, "sku_code", "left"), FACT_KEYS, order, {
        "unregistered SKU": F.col("_registered").isNull()}, log)


def load_sales_sheets(table: VersionedTable, sheets: DataFrame, prefixes: list[str], dim: DataFrame,
                      sheet: list[str], log: tuple[str, list[str]] | None = None) -> int:
    """S1-S2, R0, K2 with the source's stops: wide sales sheets (one per store and ``year``) go into
    the fact table, unless a cell does not parse, a line's months miss its total or a SKU is not
    registered.  The checks are observed while the batch is written; the sheets are read once."""
    kept, _ = wide.parse_sales_sheet(sheets, prefixes, sheet)
    lines = kept.withColumn("_bad", F.size(wide.bad_cells(kept)) > 0).withColumn("_off", wide.off_total(kept, prefixes)) \
        .withColumn("_stop", F.col("_bad") | F.col("_off"))
    facts = wide.unpivot_sales(lines, key_cols=["store_id", "_bad", "_off", "_stop"], year_col="year", keep="_stop")
    known = dim.select("sku_code", "partkey", F.lit(True).alias("_registered"))
    amount = table.schema["amount"].dataType
    batch = facts.join(known, "sku_code", "left").withColumn("amount", F.col("amount").cast(amount))
    return table.upsert(batch, FACT_KEYS, checks={
        "cells of lines that do not parse": F.col("_bad"), "lines that miss their total": F.col("_off"),
        "unregistered SKU": F.col("_registered").isNull()}, log=log)


def load_channel_sheets(table: VersionedTable, sheets: DataFrame, sheet: list[str],
                        log: tuple[str, list[str]] | None = None) -> int:
    """S3, R2, K3 with the source's stops: wide channel sheets go into the channel facts, unless a
    label has no channel code or a cell does not parse."""
    known = F.coalesce(F.trim("channel_name").isin(*vocab.CHANNEL_CODES), F.lit(False))
    marked = sheets.withColumn("_unknown", ~known).withColumn("_bad", F.size(wide.bad_cells(sheets)) > 0) \
        .withColumn("_stop", F.col("_unknown") | F.col("_bad"))
    flags = ["_unknown", "_bad", "_stop"]
    facts = wide.parse_channel_sheet(marked, [c for c in sheet if c != "year"] + flags, sheet=sheet, keep="_stop")
    facts = facts.withColumn("amount", F.col("amount").cast(table.schema["amount"].dataType))
    return table.upsert(facts, CHANNEL_KEYS, checks={
        "unknown channel label": F.col("_unknown"), "cells of lines that do not parse": F.col("_bad")}, log=log)


def upsert_fact_sales(t: Tables) -> DataFrame:
    """K8 + K2: the facts after the second load, read back from its version."""
    table = fact_sales_table(t)
    rpt = star.reporting_month(t)
    return table.read(load_sales(table, fixtures.second_load(t), star.dim_product(t),
                                 log=("second load", [rpt])))


def upsert_fact_sales_view(t: Tables) -> DataFrame:
    return upsert_fact_sales(t).select("store_id", "period", "sku_code", "order_count", "qty",
                                       F.col("amount").cast("double").alias("amount"))


def load_reconcile(t: Tables) -> DataFrame:
    """Q7 + F15: stored vs loaded for the loaded (store, month) groups."""
    new = U.latest_per_key(fixtures.second_load(t), FACT_KEYS)
    return U.reconcile(upsert_fact_sales(t), new, ["store_id", "period"])


def upsert_fact_channel(t: Tables) -> DataFrame:
    """K3: the reporting month's channel sheet re-imported with export volumes doubled; other
    months and channels keep their rows.  Read back from the load's version."""
    rpt = star.reporting_month(t)
    table = fact_channel_table(t)
    new = (star.fact_channel(t).filter((F.col("period") == rpt) & (F.col("channel_group") == "export"))
           .withColumn("qty", F.col("qty") * 2))
    out = table.read(table.upsert(new, CHANNEL_KEYS, log=("second load", [rpt])))
    return out.select("period", "store_id", "channel_code", "channel_group", "order_count", "qty",
                      F.col("amount").cast("double").alias("amount"))


def unregistered(batch: DataFrame, dim: DataFrame) -> DataFrame:
    """Batch lines whose SKU has no dimension row (a load stops on any)."""
    return batch.join(dim.select("sku_code"), "sku_code", "left_anti").select("store_id", "period", "sku_code")


def fact_key_check(t: Tables) -> DataFrame:
    """J10 over a batch with unregistered SKUs."""
    batch = fixtures.with_stray_skus(U.latest_per_key(fixtures.second_load(t), FACT_KEYS))
    return unregistered(batch, star.dim_product(t))


def upsert_dim_product(t: Tables) -> DataFrame:
    """K1: re-import of the even SKUs (brand spelling changed) plus new
    SKUs; product_type survives on existing rows, new rows get the default."""
    old = star.dim_product(t).drop("partkey")
    cls = star.classified(t).filter(F.col("partkey") % 2 == 0)
    changed = cls.withColumn("brand", F.lower("brand"))
    added = cls.withColumn("sku_code", F.concat("sku_code", F.lit("-N")))
    new = changed.unionByName(added).select("sku_code", "brand", "product_desc", "category",
                                            "tier", "shipping_channel")
    return U.upsert_columns(old, new, "sku_code",
                            ["brand", "product_desc", "category", "tier", "shipping_channel"],
                            {"product_type": F.lit(vocab.NOT_APPLICABLE)})


def _types(t: Tables) -> tuple[DataFrame, DataFrame]:
    dim = star.dim_product(t).drop("partkey").withColumn("product_type",
                                                         F.lit(vocab.NOT_APPLICABLE))
    cls = C.with_product_type(star.classified(t), vocab.FIXTURE_RULES) \
        .filter(F.col("category") == "supplement")
    values = cls.select("sku_code", "product_type").unionByName(
        cls.filter(F.col("partkey") % 250 == 0)
        .select(F.concat("sku_code", F.lit("-X")).alias("sku_code"), "product_type"))
    return U.update_join(dim, values, "sku_code", "product_type")


def load_product_types(t: Tables) -> DataFrame:
    """K6."""
    updated, _ = _types(t)
    return updated.select("sku_code", "category", "product_type")


def types_missing(t: Tables) -> DataFrame:
    """J13."""
    _, missing = _types(t)
    return missing.select("sku_code", "product_type")


def _dates(t: Tables) -> tuple[DataFrame, DataFrame]:
    rpt = star.reporting_month(t)
    dim = star.dim_date(t, through=rpt)
    periods = star.fact_sales(t).select("period").distinct()
    bad = periods.select(F.concat(F.substring("period", 1, 4), F.lit("-13")).alias("period"))
    return U.ensure_dim_date(dim, periods.unionByName(bad))


def ensure_dim_date(t: Tables) -> DataFrame:
    """K7."""
    dim, _ = _dates(t)
    return dim


def dim_date_skipped(t: Tables) -> DataFrame:
    _, skipped = _dates(t)
    return skipped


def context_file(t: Tables) -> DataFrame:
    rows, _ = parse_monthly_context(star.monthly_context_source(t))
    return fixtures.with_month_ahead(rows, star.reporting_month(t))


def load_context(table: VersionedTable, rows: DataFrame, dim_date: DataFrame,
                 log: tuple[str, list[str]] | None = None) -> int:
    """K4: the whole context file each run; months missing from dim_date are skipped."""
    loadable = rows.join(dim_date.select("period"), "period", "left_semi")
    return table.upsert(loadable, CONTEXT_KEYS, log=log)


def upsert_monthly_context(t: Tables) -> DataFrame:
    """K4: context rows up to 1997 were loaded before; now the whole file is loaded again.
    Read back from the load's version."""
    rows = context_file(t)
    paths = star._inputs(t, ["orders", "customer", "nation", "lineitem", "supplier"])
    table = VersionedTable(t.spark, f"{warehouse.folder(t.spark, paths)}/context-versions", rows.schema)
    dim = star.dim_date(t, through=star.reporting_month(t))
    existing = rows.filter(F.col("period") < "1998-01").withColumn("study_tour_note", F.lit("older note"))
    table.upsert(existing, CONTEXT_KEYS, log=("context file", ["up to 1997"]))
    table = table.read(load_context(table, rows, dim, ("context file", ["whole"])))
    return table.withColumn("miniprogram_completion_rate",
                            F.col("miniprogram_completion_rate").cast("double"))


def context_skipped(t: Tables) -> DataFrame:
    rows = context_file(t)
    dim = star.dim_date(t, through=star.reporting_month(t))
    return rows.join(dim.select("period"), "period", "left_anti").select("store_id", "period")


def seed_store(t: Tables) -> DataFrame:
    """Seed stores named after nations unless already present."""
    cand = t.nation.select((F.col("n_nationkey") + 100).alias("store_id"),
                           F.col("n_name").alias("store_code"),
                           F.initcap("n_name").alias("store_name"))
    cand = cand.unionByName(star.dim_store(t))
    return U.seed_if_absent(star.dim_store(t), cand, "store_code")


def integrity_checks(t: Tables) -> DataFrame:
    """Q10: unclassified SKUs (F14) and orphan fact rows (J11) after the load."""
    dim = star.dim_product(t)
    unclassified = dim.filter(F.col("category").isNull() | (F.col("category") == "")) \
        .agg(F.count(F.lit(1)).alias("n")).withColumn("check_name", F.lit("unclassified SKUs"))
    orphans = (upsert_fact_sales(t).join(dim.select("sku_code"), "sku_code", "left_anti")
               .agg(F.count(F.lit(1)).alias("n")).withColumn("check_name",
                                                              F.lit("orphan fact rows")))
    return unclassified.unionByName(orphans).select("check_name", "n")


def dimension_size(t: Tables) -> DataFrame:
    """SKUs in the dimension and distinct brands remembered."""
    return star.dim_product(t).agg(F.count(F.lit(1)).alias("n_skus"),
                                   F.count_distinct(F.lower(F.trim("brand"))).alias("n_brands"))


def dim_first_line(t: Tables) -> DataFrame:
    """The dimension keeps the first line per SKU across all sheets
    (ordered by category, tier, brand, then sheet)."""
    from .ingest import sheet_products
    kept, _ = sheet_products(t)
    cls = C.classify_products(kept.select("store_id", "year", "sku_code", "brand",
                                          "product_desc", "freight_tag"),
                              star.brand_categories(t), star.sku_overrides(t),
                              star.known_skus(t), vocab.FIXTURE_RULES, star.brand_resolutions(t))
    first = C.first_per_key(cls.select("sku_code", "category", "tier", "brand", "store_id", "year",
                                       "product_desc", "shipping_channel"),
                            ["sku_code"], ["category", "tier", "brand", "store_id", "year"])
    return first.select("sku_code", "brand", "product_desc", "category", "tier",
                        "shipping_channel", F.col("store_id").alias("first_store"),
                        F.col("year").alias("first_year"))
