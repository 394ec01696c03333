"""Grounding jobs over report text and documents (slice 9).

Texts to check are derived from the report figures (one headline and one
units sentence per store-month: every 5th quotes a wrong revenue figure,
every 3rd writes a fall without the minus sign, every 4th mentions a
'15-23 Feb' date range), plus the free ``documents`` corpus checked against
all headline figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions.numeric import round_half_up
from ..functions.text import month_label, rose_fell
from ..sources import fixtures, star
from ..sources import reference as REF
from ..sources.tables import Tables
from . import grounding as GR
from . import report as RP

G = ["store_id", "period"]
NUM_COLS = ["revenue", "units", "orders", "avg_order_value", "prev_amount", "amount_mom_pct",
            "qty_mom_pct"]


def report_numbers(t: Tables) -> DataFrame:
    """Headline and month-on-month figures per (store, period), stored once:
    texts, allow-lists and document checks all read this small table instead
    of re-aggregating the facts in every branch of their plans."""
    from ..sources import warehouse
    from ..sources.star import _inputs

    def build() -> DataFrame:
        h = RP.headline(t)
        m = RP.mom_sql(t).select(*G, "prev_amount", "amount_mom_pct", "qty_mom_pct")
        return h.join(m, G, "left")
    return warehouse.materialized(t.spark, "report_numbers",
                                  _inputs(t, ["lineitem", "supplier", "nation"]), build)


def _ordinal():
    return (F.col("store_id") * 100000 + F.substring("period", 1, 4).cast("int") * 12
            + F.substring("period", 6, 2).cast("int"))


def report_texts(t: Tables) -> DataFrame:
    """(store_id, period, field, text)."""
    r = report_numbers(t).withColumn("i", _ordinal())
    rev = F.when(F.col("i") % 5 == 0, F.col("revenue") + F.lit(6000.0)).otherwise(F.col("revenue"))
    money = F.concat(F.lit("$"), F.format_number(rev, 2))
    label = month_label("period")
    mom = F.col("amount_mom_pct")
    orders = F.col("orders").cast("string")
    normal = F.concat(F.lit("Revenue "), money, F.lit(" in "), label, F.lit(" ("),
                      F.format_string("%+.2f", mom), F.lit("% on the month, "), orders,
                      F.lit(" orders)."))
    third = F.concat(F.lit("Revenue "), rose_fell(mom), F.lit(" "),
                     F.format_string("%.2f", F.abs(mom)), F.lit("% to "), money, F.lit(" in "),
                     label, F.lit(", "), orders, F.lit(" orders."))
    first = F.concat(F.lit("Revenue "), money, F.lit(" in "), label, F.lit(", "), orders,
                     F.lit(" orders."))
    head = (F.when(mom.isNull(), first).when(F.col("i") % 3 == 0, third).otherwise(normal))
    head = F.concat(head, F.when(F.col("i") % 4 == 0, F.lit(" Promotion ran 15-23 Feb."))
                    .otherwise(F.lit("")))
    q = F.col("qty_mom_pct")
    units = F.when(q.isNull(), F.concat(F.lit("Units: "), F.col("units").cast("string"),
                                        F.lit(" sold.")))\
        .otherwise(F.concat(F.lit("Units "), F.format_string("%+.1f", round_half_up(q, 1)),
                            F.lit("% month on month, "), F.col("units").cast("string"),
                            F.lit(" units sold.")))
    return r.select(*G, F.explode(F.array(
        F.struct(F.lit("headline_title").alias("field"), head.alias("text")),
        F.struct(F.lit("trend_qty_title").alias("field"), units.alias("text")))).alias("x")) \
        .select(*G, "x.field", "x.text")


def report_allowed(t: Tables) -> DataFrame:
    """G2 + G3 per report: figures at 2/1/0 decimals, digits of the period
    string, prose numbers."""
    r = report_numbers(t)
    return (GR.allowed_from_numbers(r, G, NUM_COLS)
            .unionByName(GR.allowed_from_strings(r, G, ["period"]))
            .unionByName(GR.prose_numbers(r, G)))


def holiday_numbers(holidays: DataFrame, charts: DataFrame) -> DataFrame:
    """G2 for the holiday calendar: the digits of dates, ends, names and remarks of the holidays
    in the months on a report's charts (``charts``: report keys and ``month``)."""
    on = REF.holidays_on_charts(holidays, charts.select(F.col("month").alias("period")))
    fields = ["date", "end", "region", "name", "impact"]
    return GR.allowed_from_strings(charts.join(on.withColumnRenamed("period", "month"), "month"), G, fields)


def holiday_findings(t: Tables) -> DataFrame:
    """The report texts against the figures and the holidays of the charts' months,
    which are a store's months up to the report's."""
    months = star.fact_sales(t).select("store_id", F.col("period").alias("month")).distinct()
    charts = months.withColumnRenamed("month", "period").join(months, "store_id").where("month <= period")
    holidays = REF.parse_holidays(fixtures.holiday_calendar(t), "calendar")
    allowed = report_allowed(t).unionByName(holiday_numbers(holidays, charts).select(*G, "a"))
    return GR.classify_tokens(number_tokens(t), allowed, G)


def number_tokens(t: Tables) -> DataFrame:
    """G1 over the report texts."""
    return GR.explode_tokens(report_texts(t), [*G, "field"])


def findings(t: Tables) -> DataFrame:
    """One row per number token with its status."""
    return GR.classify_tokens(number_tokens(t), report_allowed(t), G)


def report_verdict(t: Tables) -> DataFrame:
    """G5."""
    return GR.verdict(findings(t), G)


def document_grounding(t: Tables) -> DataFrame:
    """G1-G5 over every document: numbers checked against all headline
    figures of all stores and months (one shared allow-list: the bucketed
    join spreads it over value buckets)."""
    # one shared scope; derived from the row (not a bare literal) so the
    # planner keeps an equi-join on it instead of folding it into a
    # nested-loop join
    docs = t.documents.select("doc_id", "text").withColumn(
        "scope", F.when(F.col("doc_id").isNotNull(), F.lit("all")))
    toks = GR.explode_tokens(docs, ["scope", "doc_id"])
    r = report_numbers(t).withColumn(
        "scope", F.when(F.col("store_id").isNotNull(), F.lit("all")))
    allowed = (GR.allowed_from_numbers(r, ["scope"], NUM_COLS)
               .unionByName(GR.prose_numbers(r, ["scope"])))
    found = GR.classify_tokens(toks, allowed, ["scope"])
    return GR.verdict(found, ["doc_id"])


def model_replies(t: Tables) -> DataFrame:
    """Replies as a text model returns them: JSON maps of the sentences, some
    fenced, some with trailing commas, some with fields outside the allow-list,
    one in ten truncated (unparseable)."""
    texts = report_texts(t)
    pairs = texts.groupBy(*G).agg(F.array_sort(F.collect_list(F.struct("field", "text")))
                                  .alias("kv"))
    i = _ordinal()
    body = F.array_join(F.transform("kv", lambda x: F.concat(
        F.lit('"'), x["field"], F.lit('": "'), x["text"], F.lit('"'))), ", ")
    extra = F.when(i % 2 == 0, F.lit(', "mood": "upbeat"')).otherwise(F.lit(""))
    trail = F.when(i % 3 == 0, F.lit(",")).otherwise(F.lit(""))
    js = F.concat(F.lit("{"), body, extra, trail, F.lit("}"))
    js = F.when(i % 10 == 7, F.substring(js, 1, 20)).otherwise(js)
    fenced = F.when(i % 4 == 1, F.concat(F.lit("```json\n"), js, F.lit("\n```"))).otherwise(js)
    return pairs.select(*G, fenced.alias("reply"))


def parsed_replies(t: Tables) -> DataFrame:
    """P25 + F12: (store_id, period, field, text) for allowed fields of the
    replies that parse; unparseable replies are listed by ``rejected_replies``."""
    p = model_replies(t).withColumn("m", GR.parse_lenient("reply"))
    return (p.filter(F.col("m").isNotNull())
            .select(*G, F.explode("m").alias("field", "text"))
            .filter(F.col("field").isin(*vocab.NARRATIVE_FIELDS)))


def rejected_replies(t: Tables) -> DataFrame:
    p = model_replies(t).withColumn("m", GR.parse_lenient("reply"))
    return p.filter(F.col("m").isNull()).select(*G, "reply")
