"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the input tables (or DataFrames Spark derives from them)
in full; the reporting month used by as-of trend queries is itself derived
from the data (latest order month, S9)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import document as DOC
from ..operators import fuzzy as FZ
from ..operators import ingest as IN
from ..operators import narrative as NR
from ..operators import loads as LD
from ..operators import report as RP
from ..operators import review as RV
from ..operators import textcheck as TX
from ..sources import star
from ..sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def _asof(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = _t(spark, sf_dir)
        return fn(t, through=star.reporting_month(t))
    return run


def _month(fn) -> Query:
    """one reporting month (a partition filter on the stored facts)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = _t(spark, sf_dir)
        return fn(t, period=star.reporting_month(t))
    return run


def _all(fn, **kw) -> Query:
    return lambda spark, sf_dir: fn(_t(spark, sf_dir), **kw)


def report_queries() -> dict[str, Query]:
    return {
        "headline": _all(RP.headline),
        "mom_sql": _asof(RP.mom_sql),
        "mom_pipeline": _asof(RP.mom_pipeline),
        "tier_split": _all(RP.tier_split),
        "bucket_trend": _asof(RP.bucket_trend),
        "category_mix": _all(RP.category_mix),
        "premium_mix": _all(RP.premium_mix),
        "top_products": _all(RP.top_products),
        "structure_intro": _all(RP.structure_intro),
        "top_brands": _all(RP.top_brands),
        "top_brands_rowmax": _all(RP.top_brands, k=5, main_category="largest_row"),
        "milk_brands": _all(RP.milk_brands),
        "pickup_tier_trend": _asof(RP.pickup_tier_trend),
        "functional_trend_sql": _asof(lambda t, through: RP.functional_trend(t, through, "sql")),
        "functional_trend_pipeline": _asof(
            lambda t, through: RP.functional_trend(t, through, "pipeline")),
        "channel_trend": _asof(RP.channel_trend),
        "channel_totals": _asof(RP.channel_totals),
        "pickup_share": _asof(RP.pickup_share),
        "sku_pareto": _all(RP.sku_pareto),
        "bucket_matrix": _asof(RP.bucket_matrix),
        "trend_series": _asof(RP.trend_series_rows),
        "channel_series": _asof(RP.channel_series),
        "functional_top": _asof(RP.functional_top),
        "functional_leader": _asof(RP.functional_leader),
        "operating_context": _asof(RP.operating_context),
        "context_gaps": _asof(RP.context_gaps),
        "report_header": _asof(RP.report_header),
        "category_labels": _all(RP.category_labels),
        "headline_rpt": _month(RP.headline),
        "top_products_rpt": _month(RP.top_products),
        "context_malformed": _all(lambda t: RP.parse_monthly_context(
            star.monthly_context_source(t))[1].select("store_id", "period", "line_no")),
    }


def ingest_queries() -> dict[str, Query]:
    return {
        "sheet_products": _all(IN.products_view),
        "sheet_excluded": _all(IN.excluded_view),
        "sheet_unpivot": _all(IN.unpivot_view),
        "sheet_rejects": _all(IN.rejects),
        "unpivot_reconcile": _all(IN.unpivot_reconcile),
        "unpivot_month_counts": _all(IN.month_counts),
        "freight_tag_counts": _all(IN.freight_tag_counts),
        "brands_seen": _all(IN.brands_seen),
        "channel_unpivot": _all(IN.channel_unpivot),
        "unknown_channels": _all(IN.unknown_channels),
    }


def review_queries() -> dict[str, Query]:
    return {
        "classified_products": _all(RV.classified_view),
        "dim_product": _all(RV.dim_product_view),
        "keyword_conflicts": _all(RV.keyword_conflicts),
        "new_conflicts": _all(RV.new_conflicts),
        "unclassified_brand_skus": _all(RV.unclassified_brand_skus),
        "brand_inventory": _all(RV.brand_inventory_view),
        "new_brands": _all(RV.new_brands),
        "brand_carry_forward": _all(RV.brand_carry_forward),
        "category_spread": _all(RV.category_spread),
        "summary_by_category": _all(RV.summary_by_category),
        "summary_by_bucket": _all(RV.summary_by_bucket),
        "summary_by_shipping": _all(RV.summary_by_shipping),
        "invalid_categories": _all(RV.invalid_categories),
        "odd_shipping": _all(RV.odd_shipping),
        "unknown_tags": _all(RV.unknown_tags),
        "type_counts": _all(RV.type_counts),
        "reviewed_seed": _all(RV.reviewed_seed),
        "settled_skus": _all(RV.settled_skus),
    }


def _brands(t: Tables):
    return star.products(t).select("brand")


def _new_and_known_keys(t: Tables):
    from ..operators.classify import variant_categories
    cats = variant_categories(star.brand_categories(t))
    return cats.filter("category = ''"), variant_categories(star.brand_categories(t),
                                                            skip_blank=True)


def fuzzy_queries() -> dict[str, Query]:
    return {
        "brand_resolution": _all(lambda t: FZ.resolution(_brands(t))),
        "fuzzy_merges": _all(lambda t: FZ.fuzzy_merges(_brands(t))),
        "close_names": _all(lambda t: FZ.close_names(*_new_and_known_keys(t))),
        "classified_fuzzy": _all(lambda t: star.classified(t).select(
            "sku_code", "brand", "resolved_brand", "resolve_how", "tier", "tier_reason")),
        "brand_headroom": _all(lambda t: FZ.headroom(star.brand_categories(t).select(
            F.substring_index("brand_variants", "/", 1).alias("brand")))),
    }


def load_queries() -> dict[str, Query]:
    return {
        "upsert_fact_sales": _all(LD.upsert_fact_sales_view),
        "load_reconcile": _all(LD.load_reconcile),
        "fact_key_check": _all(LD.fact_key_check),
        "upsert_fact_channel": _all(LD.upsert_fact_channel),
        "upsert_dim_product": _all(LD.upsert_dim_product),
        "load_product_types": _all(LD.load_product_types),
        "types_missing": _all(LD.types_missing),
        "ensure_dim_date": _all(LD.ensure_dim_date),
        "dim_date_skipped": _all(LD.dim_date_skipped),
        "upsert_monthly_context": _all(LD.upsert_monthly_context),
        "context_skipped": _all(LD.context_skipped),
        "seed_store": _all(LD.seed_store),
        "integrity_checks": _all(LD.integrity_checks),
        "dimension_size": _all(LD.dimension_size),
        "dim_first_line": _all(LD.dim_first_line),
    }


def text_queries() -> dict[str, Query]:
    return {
        "report_texts": _all(TX.report_texts),
        "number_tokens": _all(TX.number_tokens),
        "grounding_findings": _all(TX.findings),
        "holiday_findings": _all(TX.holiday_findings),
        "grounding_verdict": _all(TX.report_verdict),
        "document_grounding": _all(TX.document_grounding),
        "parsed_replies": _all(TX.parsed_replies),
        "rejected_replies": _all(TX.rejected_replies),
        "fallback_texts": _all(NR.fallback_texts),
        "deck_texts": _all(lambda t: NR.deck_texts(t, TX.parsed_replies(t))),
        "report_documents": _all(DOC.report_documents),
        "document_findings": _all(DOC.document_findings),
        "document_leaves": _all(DOC.document_leaves),
        "json_leaves": _all(DOC.json_leaves),
    }


def sql_queries() -> dict[str, Query]:
    """The ad-hoc analysis SQL (spark.sql with named parameters)."""
    from . import analysis

    def q(name: str) -> Query:
        return lambda spark, sf_dir: analysis.run(spark, sf_dir, name)
    return {f"sql_{n}": q(n) for n in analysis.SQL}


def build_star(spark: SparkSession, sf_dir: str) -> None:
    """The import step: write every stored table for these inputs (no-op when
    they exist for this input and code version)."""
    from ..operators import document, ingest, narrative, textcheck
    t = _t(spark, sf_dir)
    # each stored table is written when it is first referenced
    for table in (star.fact_sales, star.dim_product, star.sales, star.fact_channel,
                  lambda t: ingest.sales_sheets(t, True), ingest.channel_sheets,
                  textcheck.report_numbers, narrative.deck_metrics, document.report_documents,
                  document.document_schema):
        table(t)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q.update(report_queries())
    q.update(ingest_queries())
    q.update(review_queries())
    q.update(fuzzy_queries())
    q.update(load_queries())
    q.update(text_queries())
    q.update(sql_queries())
    return q


def oracle_sql() -> dict[str, str]:
    from .oracle_report import sql as report_sql
    s: dict[str, str] = {}
    from .oracle_ingest import sql as ingest_sql
    s.update(report_sql())
    s.update(ingest_sql())
    from .oracle_review import sql as review_sql
    s.update(review_sql())
    from .oracle_fuzzy import sql as fuzzy_sql
    s.update(fuzzy_sql())
    from .oracle_loads import sql as loads_sql
    s.update(loads_sql())
    from .oracle_text import sql as text_sql
    s.update(text_sql())
    from .oracle_document import sql as document_sql
    s.update(document_sql())
    from .oracle_narrative import sql as narrative_sql
    s.update(narrative_sql())
    from .oracle_analysis import sql as analysis_sql
    s.update(analysis_sql())
    return s
