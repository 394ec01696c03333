"""The report document: every block of a (store, period) report nested into
one JSON value (K10), and grounding against documents read back (S11 + G2).

Each block is collected per report grain; every list is bounded by the
block's own size (top-10, top-5, <= 10 deciles, a few buckets/categories)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import vocab
from ..functions import rules as R
from ..functions.numeric import mom_list
from ..functions.text import month_label
from ..sources import star
from ..sources.tables import Tables
from . import grounding as GR
from . import report as RP
from . import textcheck as TX

G = ["store_id", "period"]


def _nest(df: DataFrame, name: str, fields: list[str], order: str) -> DataFrame:
    return (df.groupBy(*G)
            .agg(F.array_sort(F.collect_list(F.struct(order, *[f for f in fields if f != order])))
                 .alias(name)))


def report_documents(t: Tables) -> DataFrame:
    """The stored documents (written once per input version)."""
    from ..sources import warehouse
    from ..sources.star import _inputs
    return warehouse.materialized(
        t.spark, "report_documents",
        _inputs(t, ["lineitem", "supplier", "nation", "part", "orders", "customer", "region"]),
        lambda: build_report_documents(t))


def document_schema(t: Tables):
    """The document's struct type, stored once next to the documents (a
    one-row table), so reading documents back does not re-analyse the whole
    document plan."""
    stored = _stored_schema(t, lambda: document_structs(t))
    return StructType.fromJson(json.loads(stored.first()["schema"]))


def _stored_schema(t: Tables, documents) -> DataFrame:
    from ..sources import warehouse
    from ..sources.star import _inputs
    return warehouse.materialized(
        t.spark, "report_document_schema",
        _inputs(t, ["lineitem", "supplier", "nation", "part", "orders", "customer", "region"]),
        lambda: t.spark.createDataFrame(
            [(documents().schema["doc"].dataType.json(),)], "schema string"))


def build_report_documents(t: Tables) -> DataFrame:
    """(store_id, period, document) with document = to_json of the nested report."""
    from ..sources import warehouse
    d = document_structs(t)
    if warehouse.enabled(t.spark):
        _stored_schema(t, lambda: d)  # the plan is at hand: to set it up again runs its ranking once more
    return d.select(*G, F.to_json("doc").alias("document"))


def _history(rows: DataFrame, name: str, order: list[str], fields: list[str]) -> DataFrame:
    """(store_id, name): a trend block of all months, an array per store; the calendar bounds it."""
    label = month_label("period").alias("period_label")
    return (rows.groupBy("store_id")
            .agg(F.array_sort(F.collect_list(F.struct(*order, *fields, label))).alias(name)))


def _so_far(history: str) -> Column:
    """The part of a store's history up to the document's month."""
    return F.filter(F.col(history), lambda x: x["period"] <= F.col("period"))


def _latest(rows: Column) -> Column:
    n = vocab.TREND_MONTHS
    return F.slice(rows, F.greatest(F.size(rows) - (n - 1), F.lit(1)), n)


def _series(rows: str, field: str) -> Column:
    return F.transform(F.col(rows), lambda x: x[field])


def histories(t: Tables) -> DataFrame:
    """One row per store: the trend blocks over all months.  The sales are read once, at the grain
    of all of them together, and every block is a sum over that."""
    cells = star.sales(t).groupBy(*G, "category", "tier", "shipping_channel", "product_type").agg(
        F.sum("amount").alias("amount"), F.sum("qty").alias("qty"))
    cells = cells.withColumn("bucket", R.report_bucket("category", "tier"))
    summed = [F.sum("amount").cast("double").alias("amount"), F.sum("qty").alias("qty")]
    pickup = (F.col("category") == "milk_powder") & (F.col("shipping_channel") == "local")
    typed = ~F.col("product_type").isin(vocab.NOT_APPLICABLE, vocab.CATCH_ALL_TYPE)
    # one pass of grouping sets; in each row the other sets' columns are null
    sets = cells.select(
        *G, "amount", "qty", "bucket", F.when(pickup, F.col("tier")).alias("pickup"),
        F.when(typed, F.col("product_type")).alias("type")).groupingSets(
        [[*G], [*G, "bucket"], [*G, "pickup"], [*G, "type"]], *G, "bucket", "pickup", "type").agg(
        *summed, F.grouping("bucket").alias("_b"), F.grouping("pickup").alias("_p"), F.grouping("type").alias("_t"))
    rows = lambda which, column, name: sets.where(f"{which} = 0 AND {column} IS NOT NULL").withColumnRenamed(
        column, name)
    totals = sets.where("_b = 1 AND _p = 1 AND _t = 1").withColumn("qty", F.col("qty").cast("double"))
    channels = RP.channel_trend(t)
    by_group = channels.groupBy(*G).agg(*[
        F.coalesce(F.sum(F.when(F.col("channel_group") == g, F.col("qty"))), F.lit(0)).cast("double").alias(g)
        for g in ("local", "export")])
    parts = [
        _history(totals, "_months", ["period"], ["amount", "qty"]),
        _history(rows("_b", "bucket", "part"), "_trend", ["period", "part"], ["amount", "qty"]),
        _history(rows("_t", "type", "product_type"), "_functional", ["product_type", "period"], ["qty", "amount"]),
        _history(rows("_p", "pickup", "part"), "_pickup", ["period", "part"], ["amount", "qty"]),
        _history(channels, "_channel", ["period", "channel_group"], ["qty", "amount", "qty_pct"]),
        _history(by_group, "_groups", ["period"], ["local", "export"])]
    u = parts[0]
    for part in parts[1:]:
        u = u.unionByName(part, allowMissingColumns=True)
    return u.groupBy("store_id").agg(*[F.first(c, ignorenulls=True).alias(c) for c in u.columns if c != "store_id"])


def document_structs(t: Tables) -> DataFrame:
    """(store_id, period, doc struct)."""
    head = RP.headline(t)
    hdr = RP.report_header(t).select(*G, "period_label", "store_code", "trend_months")
    tiers = _nest(RP.tier_split(t), "tiers", ["bucket", "amount", "pct_of_total"], "bucket")
    mix = ["category", "amount", "qty", "amount_pct", "qty_pct"]
    cats = _nest(RP.category_mix(t), "category_mix", mix, "category")
    premium = RP.premium_mix(t)
    premium_all = premium.groupBy(*G).agg(
        F.sum(F.col("amount").cast("decimal(22,2)")).cast("double").alias("premium_total"),
        F.sum("qty").alias("premium_qty"))
    premium = _nest(premium, "premium_mix", mix, "category")
    top = _nest(RP.top_products(t), "top_products",
                ["rnk", "sku_code", "brand", "product_desc", "category", "tier", "qty", "amount"],
                "rnk")
    brands = _nest(RP.top_brands(t, k=5, main_category="largest_row"), "top_brands",
                   ["rnk", "brand", "amount", "pct_of_store", "main_category"], "rnk")
    milk = _nest(RP.milk_brands(t), "milk_powder_brands", ["brand", "amount", "pct_of_category"], "brand")
    pareto = _nest(RP.sku_pareto(t), "sku_pareto",
                   ["decile", "sku_count", "decile_amount", "cumulative_pct"], "decile")
    si = RP.structure_intro(t)
    ctx = RP.operating_context(t)
    # one row per (store, period) in every block: union + one grouped
    # first(ignorenulls) instead of a chain of joins (one shuffle)
    u = head.withColumn("_grain", F.lit(True))
    for part in [hdr, tiers, cats, premium, premium_all, top, brands, milk, pareto, si, ctx]:
        u = u.unionByName(part, allowMissingColumns=True)
    cols = [c for c in u.columns if c not in G]
    j = (u.groupBy(*G).agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
         .filter(F.col("_grain")))
    j = j.join(histories(t), "store_id", "left")
    for c in ("_months", "_trend", "_functional", "_pickup", "_channel", "_groups"):
        j = j.withColumn(c, _so_far(c))
    j = j.withColumn("_last", _latest(F.col("_months"))).withColumn("_last_groups", _latest(F.col("_groups")))
    named = lambda c, name: F.transform(F.col(c), lambda x: F.struct(
        x["period"].alias("period"), x["part"].alias(name), x["amount"].alias("amount"), x["qty"].alias("qty"),
        x["period_label"].alias("period_label")))
    computed = {"trend_periods": _series("_last", "period"), "trend_labels": _series("_last", "period_label"),
                "amount_totals": _series("_last", "amount"), "amount_mom_pct": mom_list(_series("_last", "amount")),
                "qty_totals": _series("_last", "qty"), "qty_mom_pct": mom_list(_series("_last", "qty")),
                "channel_periods": _series("_last_groups", "period"),
                "channel_labels": _series("_last_groups", "period_label")}
    for g in ("local", "export"):
        computed |= {f"{g}_qty": _series("_last_groups", g), f"{g}_qty_mom_pct": mom_list(_series("_last_groups", g))}
    doc = F.struct(
        "period", "period_label", "store_code", "trend_months",
        F.struct(F.col("revenue").alias("total_amount"), F.col("units").alias("total_qty"),
                 F.col("orders").alias("total_orders"), "avg_order_value",
                 F.col("tiers")).alias("headline"),
        named("_trend", "bucket").alias("monthly_trend"),
        F.struct(F.col("revenue").alias("total_amount"), F.col("units").alias("total_qty"),
                 F.col("category_mix").alias("categories")).alias("category_mix"),
        "top_products", "premium_in_top10",
        F.struct(F.coalesce("premium_total", F.lit(0.0)).alias("total_amount"),
                 F.coalesce("premium_qty", F.lit(0)).alias("total_qty"),
                 F.col("premium_mix").alias("categories")).alias("premium_mix"),
        F.struct("premium_amount", "premium_pct_of_store", "leading_premium_category",
                 "leading_premium_pct", "premium_in_top10", "top_n").alias("structure_intro"),
        "top_brands", "milk_powder_brands", F.col("_functional").alias("functional_trend"),
        named("_pickup", "tier").alias("pickup_tier_trend"), F.col("_channel").alias("channel_trend"), "sku_pareto",
        F.struct("foot_traffic", "miniprogram_leads", "miniprogram_completion_rate",
                 "study_tour_flag", "study_tour_note", "activity_description")
        .alias("operating_context"),
        F.struct(*[c.alias(k) for k, c in computed.items()]).alias("computed"))
    return j.select(*G, doc.alias("doc"))


def document_leaves(t: Tables) -> DataFrame:
    """The leaves of the stored report documents, with how often each occurs."""
    return (GR.json_leaves(report_documents(t), G, "document")
            .groupBy(*G, "kind", "num", "str").agg(F.count(F.lit(1)).alias("n")))


def document_findings(t: Tables) -> DataFrame:
    """G1-G4 of the report texts against every figure of the report
    documents (numbers at 2/1/0 decimals, digits inside strings)."""
    docs = report_documents(t)  # read back from storage (S11), as the text check does
    schema = document_schema(t)
    allowed = (GR.allowed_from_typed_json(docs, G, "document", schema)
               .unionByName(GR.prose_numbers(docs, G)))
    return GR.classify_tokens(TX.number_tokens(t), allowed, G)


def nested_channel_documents(t: Tables) -> DataFrame:
    """(store_id, document): each store's channel facts nested by month, with the notes that a
    naive reader of JSON trips over (paths that end in a backslash, quotes, brackets)."""
    f = star.fact_channel(t)
    line = F.struct(F.col("channel_code").alias("code"), F.col("qty"), F.col("amount").cast("double").alias("amount"),
                    F.concat(F.lit("C:\\"), F.col("channel_group"), F.lit("\\")).alias("path"),
                    F.array(F.array(F.col("order_count"), F.lit(None).cast("bigint"))).alias("counts"),
                    (F.col("qty") > 100).alias("large"))
    months = f.groupBy(*G).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    month = F.struct("period", F.concat(F.lit('"'), "period", F.lit('": [')).alias("note"), "lines")
    stores = months.groupBy("store_id").agg(F.array_sort(F.collect_list(month)).alias("months"))
    return stores.select("store_id", F.to_json(F.struct("months")).alias("document"))


def json_leaves(t: Tables) -> DataFrame:
    """The leaves of nested documents, with how often each occurs."""
    return (GR.json_leaves(nested_channel_documents(t), ["store_id"], "document")
            .groupBy("store_id", "kind", "num", "str").agg(F.count(F.lit(1)).alias("n")))
