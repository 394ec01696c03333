"""Rule-composed report sentences (N1-N15) and the text document.

FIXED VALUES: the quoted sentence fragments below are the source's deck
wording and must stay word for word; only the numbers are computed.

One row per (store, period, field).  Every sentence is a projection over a
per-(store, period) metrics row assembled from the report blocks; nothing is
formatted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import mom_pct_zero_baseline, round_half_up
from ..functions.text import fallback_label, month_label, rose_fell, text_or_fallback
from ..sources.tables import Tables
from . import report as RP

G = ["store_id", "period"]


# ------------------------------------------------------------------ formatters
def money(x: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(round_half_up(x, 0), 0))


def units(x: Column) -> Column:
    return F.format_number(x.cast("bigint"), 0)


def fixed(x: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", round_half_up(x, digits))


def signed(x: Column) -> Column:
    """Signed percent with one decimal: +1.8%; null for null."""
    return F.when(x.isNotNull(), F.concat(
        F.when(x >= 0, F.lit("+")).otherwise(F.lit("")), fixed(x, 1), F.lit("%")))


def js_number(x: Column) -> Column:
    """How a script prints a number: integers without a decimal point."""
    return F.when(x == F.floor(x), x.cast("bigint").cast("string")).otherwise(x.cast("string"))


def short_month(period: Column) -> Column:
    return F.split(month_label(period), " ").getItem(0)


# ------------------------------------------------------------------ metrics
def _lead(df: DataFrame, pick: list[str], order: list[Column]) -> DataFrame:
    """First row per report grain in the given order (via min_by: partial agg)."""
    return (df.groupBy(*G).agg(F.min_by(F.struct(*pick), F.struct(*order)).alias("_l"))
            .select(*G, *[F.col(f"_l.{c}").alias(c) for c in pick]))


def _channel_moms(t: Tables) -> DataFrame:
    """Per store and channel period: latest export/local units MoM (0 units
    for a missing group, 0.0 on a zero baseline)."""
    c = RP.channel_trend(t)
    per = c.groupBy(*G).agg(
        F.sum(F.when(F.col("channel_group") == "export", F.col("qty")).otherwise(0)).alias("ex"),
        F.sum(F.when(F.col("channel_group") == "local", F.col("qty")).otherwise(0)).alias("lo"),
        F.max(F.when(F.col("channel_group") == "export", F.col("qty_pct"))).alias("ex_pct"))
    w = Window.partitionBy("store_id").orderBy("period")
    return (per.withColumn("pex", F.lag("ex").over(w)).withColumn("plo", F.lag("lo").over(w))
            .select(*G, F.when(F.col("pex").isNotNull(), mom_pct_zero_baseline("ex", "pex"))
                    .alias("export_mom"),
                    F.when(F.col("plo").isNotNull(), mom_pct_zero_baseline("lo", "plo"))
                    .alias("local_mom"), "ex_pct"))


def _asof(grain: DataFrame, events: DataFrame, cols: list[str]) -> DataFrame:
    """As-of attach: for each (store, period) the latest event row with
    period <= it — one window per store over its months (a union, not a
    range join)."""
    ev = events.select(*G, F.lit(0).alias("_src"), F.struct(*cols).alias("_e"))
    g = grain.select(*G, F.lit(1).alias("_src"),
                     F.lit(None).cast(ev.schema["_e"].dataType).alias("_e"))
    w = (Window.partitionBy("store_id").orderBy("period", "_src")
         .rowsBetween(Window.unboundedPreceding, 0))
    filled = ev.unionByName(g).select(*G, "_src", F.last("_e", ignorenulls=True).over(w)
                                      .alias("_e"))
    return filled.filter(F.col("_src") == 1).select(*G, *[F.col(f"_e.{c}").alias(c)
                                                          for c in cols])


ALL_INPUTS = ["lineitem", "supplier", "nation", "part", "orders", "customer", "region"]


def deck_metrics(t: Tables) -> DataFrame:
    """The per-(store, period) report figures, computed once and stored (the
    sentences, like the slides, only read the finished report data)."""
    from ..sources import warehouse
    from ..sources.star import _inputs
    return warehouse.materialized(t.spark, "report_metrics", _inputs(t, ALL_INPUTS),
                                  lambda: build_deck_metrics(t))


def build_deck_metrics(t: Tables) -> DataFrame:
    head = RP.headline(t)
    w = Window.partitionBy("store_id").orderBy("period")
    m = RP.monthly_totals(t)
    m = (m.withColumn("pa", F.lag("amount").over(w)).withColumn("pq", F.lag("qty").over(w))
         .withColumn("pp", F.lag("period").over(w))
         .select(*G, F.when(F.col("pa").isNotNull(), mom_pct_zero_baseline("amount", "pa"))
                 .alias("mom_a"),
                 F.when(F.col("pq").isNotNull(), mom_pct_zero_baseline("qty", "pq")).alias("mom_q"),
                 "pp"))
    si = RP.structure_intro(t).select(*G, "premium_pct_of_store", "premium_in_top10", "top_n")
    cat = _lead(RP.category_mix(t).withColumnRenamed("category", "cat"),
                ["cat", "amount_pct", "qty_pct"],
                [-F.col("amount_pct"), -F.col("amount"), F.col("cat")])
    prem = _lead(RP.premium_mix(t).select(*G, F.col("category").alias("pcat"),
                                          F.col("amount_pct").alias("pcat_pct"), "amount"),
                 ["pcat", "pcat_pct"], [-F.col("pcat_pct"), -F.col("amount"), F.col("pcat")])
    brand = (RP.top_brands(t, k=1, main_category="largest_row")
             .select(*G, F.col("brand").alias("lead_brand"), "pct_of_store"))
    milk = _lead(RP.milk_brands(t).select(*G, F.col("brand").alias("milk_brand"),
                                          "pct_of_category", "amount"),
                 ["milk_brand", "pct_of_category"], [-F.col("amount"), F.col("milk_brand")])
    pick = RP.pickup_share(t).select(*G, "pickup_amount", "premium_pickup_pct")
    func = _lead(RP.functional_trend(t, variant="pipeline")
                 .select(*G, F.col("product_type").alias("ftype"), F.col("qty").alias("fqty")),
                 ["ftype", "fqty"], [-F.col("fqty"), F.col("ftype")])
    conc = (RP.sku_pareto(t).filter(F.col("decile") == 2)
            .select(*G, F.col("cumulative_pct").alias("top20_pct")))
    ctx = RP.operating_context(t)
    moms = _channel_moms(t)
    chan = _asof(head.select(*G), moms, ["export_mom", "local_mom"])
    chan_now = moms.select(*G, "ex_pct")
    # Every block has at most one row per (store, period): stitch them with a
    # union and one grouped first(ignorenulls) — one shuffle instead of a
    # chain of joins — keeping the headline's grain.
    parts = [head.withColumn("_grain", F.lit(True)), m, si, cat, prem, brand, milk, pick,
             func, conc, ctx, chan, chan_now]
    u = parts[0]
    for part in parts[1:]:
        u = u.unionByName(part, allowMissingColumns=True)
    cols = [c for c in u.columns if c not in G]
    out = u.groupBy(*G).agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
    return out.filter(F.col("_grain")).drop("_grain")


def fallback_texts(t: Tables) -> DataFrame:
    """(store_id, period, field, text)."""
    d = deck_metrics(t)
    lab = month_label("period")
    a, q = F.col("mom_a"), F.col("mom_q")
    ex, lo = F.col("export_mom"), F.col("local_mom")
    fields = {
        "headline_title": F.when(a.isNull(), F.concat(lab, F.lit(": "), money(F.col("revenue")),
                                                      F.lit(" across "), units(F.col("orders")),
                                                      F.lit(" orders")))
        .otherwise(F.concat(lab, F.lit(" revenue "), money(F.col("revenue")), F.lit(", "),
                            rose_fell(a), F.lit(" "), fixed(F.abs(a), 1), F.lit("% on "),
                            short_month(F.col("pp")))),
        "headline_subtitle": F.concat(F.lit("Average order value "),
                                      money(F.col("avg_order_value"))),
        "trend_title": F.when(a.isNull(), F.lit("Revenue by month"))
        .otherwise(F.concat(F.lit("Revenue "), rose_fell(a), F.lit(" "), fixed(F.abs(a), 1),
                            F.lit("% month on month"))),
        "trend_qty_title": F.when(q.isNull(), F.lit("Units sold by month"))
        .otherwise(F.concat(F.lit("Units "), rose_fell(q), F.lit(" "), fixed(F.abs(q), 1),
                            F.lit("% — "),
                            F.when(F.signum(q) == F.signum(a), F.lit("moving with revenue"))
                            .otherwise(F.lit("moving against revenue")))),
        "structure_intro_title": F.concat(
            F.lit("Premium is "), js_number(F.col("premium_pct_of_store")),
            F.lit("% of revenue and holds "), F.col("premium_in_top10").cast("string"),
            F.lit(" of the top "), F.col("top_n").cast("string"), F.lit(" seller slots")),
        "category_mix_title": F.when(F.col("cat").isNull(), F.lit("Category mix"))
        .otherwise(F.concat(fallback_label("cat"), F.lit(" is "), js_number(F.col("amount_pct")),
                            F.lit("% of revenue on "), js_number(F.col("qty_pct")),
                            F.lit("% of units"))),
        "premium_mix_title": F.when(F.col("pcat").isNull(), F.lit("Premium range by category"))
        .otherwise(F.concat(fallback_label("pcat"), F.lit(" is "), js_number(F.col("pcat_pct")),
                            F.lit("% of the premium range"))),
        "top_products_title": F.concat(F.col("premium_in_top10").cast("string"),
                                       F.lit(" of the top "), F.col("top_n").cast("string"),
                                       F.lit(" sellers are premium lines")),
        "brand_title": F.when(F.col("lead_brand").isNull(), F.lit("Brands by revenue"))
        .otherwise(F.concat(F.col("lead_brand"), F.lit(" leads on revenue at "),
                            fixed(F.col("pct_of_store"), 1), F.lit("% of the store"))),
        "milk_brand_title": F.when(F.col("milk_brand").isNull(), F.lit("Milk powder brands"))
        .otherwise(F.concat(F.col("milk_brand"), F.lit(" leads milk powder with "),
                            fixed(F.col("pct_of_category"), 1), F.lit("% of the category"))),
        "milk_brand_note": F.when(F.col("milk_brand").isNull(),
                                  F.lit("No milk powder sales recorded this month."))
        .otherwise(F.concat(F.col("milk_brand"), F.lit(" accounts for "),
                            fixed(F.col("pct_of_category"), 1),
                            F.lit("% of milk powder revenue this month. Shares here are within "
                                  "the category — the store-wide slide uses a different "
                                  "denominator."))),
        "pickup_title": F.when(F.coalesce(F.col("pickup_amount"), F.lit(0.0)) == 0,
                               F.lit("In-store milk powder pickups"))
        .otherwise(F.concat(F.lit("Premium is "), fixed(F.col("premium_pickup_pct"), 1),
                            F.lit("% of in-store milk powder pickups"))),
        "pickup_comment": F.when(F.coalesce(F.col("pickup_amount"), F.lit(0.0)) == 0,
                                 F.lit("No in-store milk powder pickups were recorded this month."))
        .otherwise(F.concat(F.lit("Premium lines made up "), fixed(F.col("premium_pickup_pct"), 1),
                            F.lit("% of in-store milk powder pickups in "), lab,
                            F.lit(". Staff can mention the premium range when handing over a "
                                  "pickup order."))),
        "functional_title": F.lit("Functional supplement types by month"),
        "functional_note": F.when(F.col("ftype").isNull(),
                                  F.lit("No functional supplement sales recorded this month."))
        .otherwise(F.concat(fallback_label("ftype"), F.lit(" leads on units this month at "),
                            units(F.col("fqty")), F.lit("."))),
        "channel_title": F.when(ex.isNull(), F.lit("Local and export volume by month"))
        .otherwise(F.concat(F.lit("Export "), rose_fell(ex), F.lit(" "), fixed(F.abs(ex), 1),
                            F.lit("%, local "), rose_fell(lo), F.lit(" "), fixed(F.abs(lo), 1),
                            F.lit("%"))),
        "channel_comment": F.when(ex.isNull(),
                                  F.lit("First month on record — no comparison available yet."))
        .otherwise(F.concat(F.lit("Export volume "), rose_fell(ex), F.lit(" "), fixed(F.abs(ex), 1),
                            F.lit("% and local "), rose_fell(lo), F.lit(" "), fixed(F.abs(lo), 1),
                            F.lit("% month on month"),
                            F.when(F.col("ex_pct").isNotNull(),
                                   F.concat(F.lit("; export is "), js_number(F.col("ex_pct")),
                                            F.lit("% of units this month.")))
                            .otherwise(F.lit(".")))),
        "local_card": F.coalesce(signed(F.col("local_mom")), F.lit("n/a")),
        "export_card": F.coalesce(signed(F.col("export_mom")), F.lit("n/a")),
        "concentration_title": F.when(F.col("top20_pct").isNull(),
                                      F.lit("Revenue concentration by SKU"))
        .otherwise(F.concat(F.lit("The top 20% of SKUs account for "),
                            fixed(F.col("top20_pct"), 0), F.lit("% of revenue"))),
        "operations_title": F.concat(lab, F.lit(" operating context")),
        "foot_traffic_card": F.when(F.coalesce(F.col("foot_traffic"), F.lit(0)) == 0, F.lit("—"))
        .otherwise(units(F.col("foot_traffic"))),
        "app_enquiries_card": F.when(F.coalesce(F.col("miniprogram_leads"), F.lit(0)) == 0, F.lit("—"))
        .otherwise(units(F.col("miniprogram_leads"))),
        "completion_card": F.when(F.coalesce(F.col("miniprogram_completion_rate"), F.lit(0.0)) == 0,
                                  F.lit("—"))
        .otherwise(F.concat(js_number(F.col("miniprogram_completion_rate")), F.lit("%"))),
        "tour_text": F.when(F.col("study_tour_flag") == "yes",
                            F.coalesce(F.nullif(F.col("study_tour_note"), F.lit("")),
                                       F.lit("A tour group visited this month.")))
        .otherwise(F.lit("No tour groups this month.")),
        "campaign_title": F.lit("Campaigns running this month"),
        "campaign_bullets": _bullets(F.col("activity_description")),
    }
    arr = F.array(*[F.struct(F.lit(k).alias("field"), v.alias("text")) for k, v in fields.items()])
    return d.select(*G, F.explode(arr).alias("x")).select(*G, "x.field", "x.text")


def _bullets(desc: Column) -> Column:
    """P26 with the script's semantics: no note -> default; otherwise the
    cleaned lines (which may be empty)."""
    parts = F.filter(F.transform(F.split(desc, "[;,]"), lambda x: F.trim(x)), lambda x: x != "")
    joined = F.array_join(F.transform(parts, lambda x: F.concat(F.lit("· "), x)), "\n")
    return F.when(F.coalesce(desc, F.lit("")) == "", F.lit("No campaigns recorded for this month."))\
        .otherwise(joined)


def deck_texts(t: Tables, replies: DataFrame) -> DataFrame:
    """Model text where present and non-blank, else the fallback."""
    fb = fallback_texts(t)
    r = replies.select(*G, "field", F.col("text").alias("reply_text"))
    return (fb.join(r, [*G, "field"], "left")
            .select(*G, "field", text_or_fallback("reply_text", "text").alias("text"),
                    F.col("reply_text").isNotNull().alias("from_model")))
