"""DuckDB twins of the ad-hoc analysis SQL."""

from __future__ import annotations

from .sqlgen import RPT, mom, pct, ratio, report_bucket, with_star


def sql() -> dict[str, str]:
    W = "PARTITION BY store_id, period"
    return {
        "sql_headline": with_star(f"""
SELECT store_id, period, CAST(SUM(amount) AS DOUBLE) AS revenue, CAST(SUM(qty) AS BIGINT) AS units,
       CAST(SUM(order_count) AS BIGINT) AS orders,
       {ratio('SUM(amount)', 'SUM(order_count)', 2)} AS avg_order_value
FROM fact_sales WHERE period = {RPT} GROUP BY store_id, period"""),
        "sql_tier_split": with_star(f"""
SELECT store_id, period, bucket, CAST(amount AS DOUBLE) AS amount,
       {pct('amount', f'SUM(amount) OVER ({W})', 2)} AS pct_of_total
FROM (SELECT store_id, period, {report_bucket('category', 'tier')} AS bucket, SUM(amount) AS amount
      FROM sales WHERE period = {RPT} GROUP BY 1, 2, 3)"""),
        "sql_mom": with_star(f"""
, monthly AS (SELECT store_id, period, SUM(amount) AS amount FROM fact_sales GROUP BY 1, 2),
l AS (SELECT *, LAG(amount) OVER (PARTITION BY store_id ORDER BY period) AS prev FROM monthly)
SELECT store_id, period, CAST(amount AS DOUBLE) AS amount, CAST(prev AS DOUBLE) AS prev_amount,
       {mom('amount', 'prev')} AS amount_mom_pct FROM l""", through_rpt=True),
        "sql_channel_trend": with_star(f"""
SELECT store_id, period, channel_group, qty, {pct('qty', f'SUM(qty) OVER ({W})', 1)} AS qty_pct
FROM (SELECT store_id, period, channel_group, CAST(SUM(qty) AS BIGINT) AS qty FROM fact_channel
      GROUP BY 1, 2, 3)""", through_rpt=True),
        "sql_checks": with_star("""
SELECT 'unclassified SKUs' AS check_name, COUNT(*) AS n FROM dim_product
WHERE category IS NULL OR category = ''
UNION ALL
SELECT 'orphan fact rows', COUNT(*) FROM fact_sales f
WHERE NOT EXISTS (SELECT 1 FROM dim_product p WHERE p.partkey = f.partkey)"""),
    }
