"""Ad-hoc analysis SQL over the star schema (the SQL-API entry point).

The star schema is registered as temporary views (facts read from the stored
tables, so a month filter prunes partitions), and each question is a Spark
SQL text with named parameters (``:period``), run with
``spark.sql(text, args=...)``.  Every query answers for every store at once;
windows are partitioned by the report grain.  The decile question is served
by the DataFrame operator (``ranking.ranged_ntile``) instead of a window, so
no store-month ever sits in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import report as RP
from ..sources import star
from ..sources.tables import Tables

SQL = {
    "headline": """
        SELECT f.store_id, d.period,
               CAST(SUM(f.amount) AS DOUBLE) AS revenue, SUM(f.qty) AS units,
               SUM(f.order_count) AS orders,
               CAST(round(CAST(try_divide(CAST(SUM(f.amount) AS DOUBLE),
                                          CAST(SUM(f.order_count) AS DOUBLE))
                               AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_order_value
        FROM fact_sales f JOIN dim_date d ON f.period = d.period
        WHERE d.period = :period
        GROUP BY f.store_id, d.period""",
    "tier_split": """
        SELECT store_id, period, bucket, CAST(amount AS DOUBLE) AS amount,
               CAST(round(CAST(try_divide(100.0D * CAST(amount AS DOUBLE),
                    CAST(SUM(amount) OVER (PARTITION BY store_id, period) AS DOUBLE))
                    AS DECIMAL(38,10)), 2) AS DOUBLE) AS pct_of_total
        FROM (SELECT f.store_id, f.period,
                     CASE WHEN p.category = 'milk_powder' THEN 'milk_powder' ELSE p.tier END
                         AS bucket,
                     SUM(f.amount) AS amount
              FROM fact_sales f JOIN dim_product p ON f.partkey = p.partkey
              WHERE f.period = :period
              GROUP BY 1, 2, 3)""",
    "mom": """
        WITH monthly AS (
            SELECT store_id, period, SUM(amount) AS amount, SUM(qty) AS qty
            FROM fact_sales WHERE period <= :period GROUP BY store_id, period)
        SELECT store_id, period, CAST(amount AS DOUBLE) AS amount,
               CAST(LAG(amount) OVER w AS DOUBLE) AS prev_amount,
               CAST(round(CAST(try_divide((CAST(amount AS DOUBLE)
                    - CAST(LAG(amount) OVER w AS DOUBLE)) * 100.0D,
                    CAST(LAG(amount) OVER w AS DOUBLE)) AS DECIMAL(38,10)), 2) AS DOUBLE)
                   AS amount_mom_pct
        FROM monthly
        WINDOW w AS (PARTITION BY store_id ORDER BY period)""",
    "channel_trend": """
        SELECT store_id, period, channel_group, SUM(qty) AS qty,
               CAST(round(CAST(try_divide(100.0D * CAST(SUM(qty) AS DOUBLE),
                    CAST(SUM(SUM(qty)) OVER (PARTITION BY store_id, period) AS DOUBLE))
                    AS DECIMAL(38,10)), 1) AS DOUBLE) AS qty_pct
        FROM fact_channel WHERE period <= :period
        GROUP BY store_id, period, channel_group""",
    "checks": """
        SELECT 'unclassified SKUs' AS check_name, COUNT(*) AS n FROM dim_product
        WHERE category IS NULL OR category = ''
        UNION ALL
        SELECT 'orphan fact rows', COUNT(*) FROM fact_sales f
        LEFT ANTI JOIN dim_product p ON f.partkey = p.partkey""",
}


def register_views(t: Tables) -> str:
    """Register the star schema as temp views; return the reporting month."""
    star.fact_sales(t).createOrReplaceTempView("fact_sales")
    star.dim_product(t).createOrReplaceTempView("dim_product")
    star.dim_date(t).createOrReplaceTempView("dim_date")
    star.dim_store(t).createOrReplaceTempView("dim_store")
    star.fact_channel(t).createOrReplaceTempView("fact_channel")
    rows, _ = RP.parse_monthly_context(star.monthly_context_source(t))
    rows.createOrReplaceTempView("monthly_context")
    rpt = star.reporting_month(t)
    t.spark.sql("SELECT 1 AS config_id, :p AS rpt_period", args={"p": rpt}) \
        .createOrReplaceTempView("report_config")
    return rpt


def run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    rpt = register_views(t)
    text = SQL[name]
    args = {"period": rpt} if ":period" in text else {}
    return spark.sql(text, args=args)
