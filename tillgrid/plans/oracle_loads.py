"""DuckDB oracle SQL for keyed loads and the fuzzy-free integrity checks (slice 8)."""

from __future__ import annotations

from ..sources.fixtures import MONTH_AHEAD
from .oracle_ingest import parsed_cte, sales_sheets_cte
from .sqlgen import RPT, with_star

BATCH = f"""
, rp AS (SELECT {RPT} AS p),
nx AS (SELECT strftime(CAST((SELECT p FROM rp) || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m') AS p),
old AS (SELECT partkey, sku_code, period, store_id, order_count, qty, amount FROM fact_sales),
cur AS (SELECT * FROM old WHERE period = (SELECT p FROM rp)),
even AS (SELECT partkey, sku_code, period, store_id, order_count, qty,
                CAST(round(amount * 1.1, 2) AS DECIMAL(38,2)) AS amount, 1 AS load_seq
         FROM cur WHERE partkey % 2 = 0),
moved AS (SELECT o.partkey, o.sku_code, (SELECT p FROM rp) AS period, o.store_id, o.order_count,
                 o.qty, o.amount FROM old o
          WHERE o.period = (SELECT p FROM nx)
            AND NOT EXISTS (SELECT 1 FROM cur c WHERE c.store_id = o.store_id
                            AND c.partkey = o.partkey)),
batch AS (SELECT * FROM even
          UNION ALL SELECT *, 1 AS load_seq FROM moved
          UNION ALL SELECT partkey, sku_code, period, store_id, order_count, qty + 1, amount, 2
                    FROM moved),
new AS (SELECT partkey, sku_code, period, store_id, order_count, qty, amount, load_seq FROM
        (SELECT *, row_number() OVER (PARTITION BY store_id, period, partkey ORDER BY load_seq DESC)
                AS rn FROM batch) WHERE rn = 1),
res AS (SELECT partkey, sku_code, period, store_id, order_count, qty, amount FROM old
        WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.store_id = old.store_id
                          AND n.period = old.period AND n.partkey = old.partkey)
        UNION ALL SELECT partkey, sku_code, period, store_id, order_count, qty, amount FROM new)
"""

TYPES = """
, vals AS (SELECT sku_code, product_type FROM dim_product WHERE category = 'supplement'
           UNION ALL SELECT sku_code || '-X', product_type FROM dim_product
           WHERE category = 'supplement' AND partkey % 250 = 0)
"""

DATES = f"""
, dd AS (SELECT DISTINCT period, CAST(substr(period, 1, 4) AS INTEGER) AS year,
                CAST(substr(period, 6, 2) AS INTEGER) AS month,
                CAST((CAST(substr(period, 6, 2) AS INTEGER) - 1) // 3 + 1 AS INTEGER) AS quarter
         FROM fact_sales WHERE period <= {RPT}),
allp AS (SELECT DISTINCT period FROM fact_sales),
cand0 AS (SELECT period FROM allp UNION ALL SELECT substr(period, 1, 4) || '-13' FROM allp),
cand AS (SELECT DISTINCT trim(period) AS period FROM cand0
         WHERE trim(period) NOT IN (SELECT period FROM dd)),
okc AS (SELECT period, coalesce(regexp_matches(period, '^\\d{{4}}-\\d{{2}}$')
                  AND TRY_CAST(substr(period, 1, 4) AS INTEGER) IS NOT NULL
                  AND TRY_CAST(substr(period, 6, 2) AS INTEGER) BETWEEN 1 AND 12, false) AS ok
        FROM cand)
"""


def sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["upsert_fact_sales"] = with_star(BATCH + """
SELECT store_id, period, sku_code, order_count, qty, CAST(amount AS DOUBLE) AS amount FROM res""")
    s["load_reconcile"] = with_star(BATCH + """
, lo AS (SELECT store_id, period, SUM(amount) AS loaded FROM new GROUP BY 1, 2),
st AS (SELECT r.store_id, r.period, SUM(r.amount) AS stored FROM res r
       WHERE (r.store_id, r.period) IN (SELECT store_id, period FROM lo) GROUP BY 1, 2)
SELECT lo.store_id, lo.period, CAST(loaded AS DOUBLE) AS loaded, CAST(stored AS DOUBLE) AS stored,
       abs(coalesce(stored, 0) - loaded) <= 0.01 AS ok
FROM lo LEFT JOIN st USING (store_id, period)""")
    s["upsert_fact_channel"] = with_star(f"""
, newc AS (SELECT period, store_id, channel_code, order_count, qty * 2 AS qty, amount, channel_group
           FROM fact_channel WHERE period = {RPT} AND channel_group = 'export')
SELECT period, store_id, channel_code, channel_group, order_count, qty, CAST(amount AS DOUBLE) AS amount
FROM fact_channel o WHERE NOT EXISTS (SELECT 1 FROM newc n WHERE n.period = o.period
      AND n.store_id = o.store_id AND n.channel_code = o.channel_code)
UNION ALL
SELECT period, store_id, channel_code, channel_group, order_count, qty, CAST(amount AS DOUBLE) FROM newc""")
    s["fact_key_check"] = with_star(BATCH + """
SELECT store_id, period, sku_code FROM (
  SELECT store_id, period, sku_code FROM new
  UNION ALL SELECT store_id, period, sku_code || '-U' FROM new WHERE partkey % 25 = 0)
WHERE sku_code NOT IN (SELECT sku_code FROM dim_product)""")
    s["upsert_dim_product"] = with_star("""
, newb AS (SELECT sku_code, lower(brand) AS brand, product_desc, category, tier, shipping_channel
           FROM classified WHERE partkey % 2 = 0
           UNION ALL SELECT sku_code || '-N', brand, product_desc, category, tier, shipping_channel
           FROM classified WHERE partkey % 2 = 0)
SELECT coalesce(o.sku_code, n.sku_code) AS sku_code,
       CASE WHEN n.sku_code IS NOT NULL THEN n.brand ELSE o.brand END AS brand,
       CASE WHEN n.sku_code IS NOT NULL THEN n.product_desc ELSE o.product_desc END AS product_desc,
       CASE WHEN n.sku_code IS NOT NULL THEN n.category ELSE o.category END AS category,
       CASE WHEN n.sku_code IS NOT NULL THEN n.tier ELSE o.tier END AS tier,
       CASE WHEN n.sku_code IS NOT NULL THEN n.shipping_channel ELSE o.shipping_channel END
           AS shipping_channel,
       CASE WHEN o.sku_code IS NULL THEN 'not_applicable' ELSE o.product_type END AS product_type
FROM dim_product o FULL JOIN newb n ON o.sku_code = n.sku_code""")
    s["load_product_types"] = with_star(TYPES + """
SELECT d.sku_code, d.category, coalesce(v.product_type, 'not_applicable') AS product_type
FROM dim_product d LEFT JOIN vals v ON d.sku_code = v.sku_code""")
    s["types_missing"] = with_star(TYPES + """
SELECT sku_code, product_type FROM vals WHERE sku_code NOT IN (SELECT sku_code FROM dim_product)""")
    s["ensure_dim_date"] = with_star(DATES + """
SELECT period, year, month, quarter FROM dd
UNION ALL
SELECT period, CAST(substr(period, 1, 4) AS INTEGER), CAST(substr(period, 6, 2) AS INTEGER),
       CAST((CAST(substr(period, 6, 2) AS INTEGER) - 1) // 3 + 1 AS INTEGER)
FROM okc WHERE ok""")
    s["dim_date_skipped"] = with_star(DATES + "SELECT period FROM okc WHERE NOT ok")
    s["upsert_monthly_context"] = with_star(f"""
, existing AS (SELECT store_id, period, foot_traffic, miniprogram_leads, miniprogram_completion_rate,
                      study_tour_flag, 'older note' AS study_tour_note, activity_description
               FROM context_rows WHERE period < '1998-01'),
dd AS (SELECT DISTINCT period FROM fact_sales WHERE period <= {RPT}),
loadable AS (SELECT * FROM context_rows WHERE period IN (SELECT period FROM dd))
SELECT store_id, period, foot_traffic, miniprogram_leads,
       CAST(miniprogram_completion_rate AS DOUBLE) AS miniprogram_completion_rate,
       study_tour_flag, study_tour_note, activity_description FROM existing e
WHERE NOT EXISTS (SELECT 1 FROM loadable l WHERE l.store_id = e.store_id AND l.period = e.period)
UNION ALL
SELECT store_id, period, foot_traffic, miniprogram_leads,
       CAST(miniprogram_completion_rate AS DOUBLE), study_tour_flag, study_tour_note,
       activity_description FROM loadable""")
    s["context_skipped"] = with_star(f"""
SELECT store_id, period FROM (
  SELECT store_id, period FROM context_rows
  UNION ALL SELECT store_id, '{MONTH_AHEAD}' FROM context_rows WHERE period = {RPT})
WHERE period NOT IN (SELECT DISTINCT period FROM fact_sales WHERE period <= {RPT})""")
    s["seed_store"] = with_star("""
SELECT r_regionkey AS store_id, r_name AS store_code, array_to_string(list_transform(string_split(lower(r_name), ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ') AS store_name FROM region
UNION ALL
SELECT n_nationkey + 100, n_name, array_to_string(list_transform(string_split(lower(n_name), ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ') FROM nation
WHERE n_name NOT IN (SELECT r_name FROM region)""")
    s["integrity_checks"] = with_star(BATCH + """
SELECT 'unclassified SKUs' AS check_name, COUNT(*) AS n FROM dim_product
WHERE category IS NULL OR category = ''
UNION ALL
SELECT 'orphan fact rows', COUNT(*) FROM res WHERE sku_code NOT IN (SELECT sku_code FROM dim_product)""")
    s["dimension_size"] = with_star("""
SELECT COUNT(*) AS n_skus, COUNT(DISTINCT lower(trim(brand))) AS n_brands FROM dim_product""")
    s["dim_first_line"] = with_star(sales_sheets_cte(False) + parsed_cte(False) + """
, kl AS (SELECT k.store_id, k.year, k.sku_code, k.brand, k.product_desc, k.freight_tag,
                coalesce(nullif(kn.category, ''), nullif(o.override_category, ''),
                         nullif(b.category, ''), '') AS category,
                nullif(kn.tier, '') AS k_tier, nullif(kn.shipping_channel, '') AS k_ship
         FROM kept k LEFT JOIN brand_cat b ON lower(trim(k.brand)) = b.brand_key
         LEFT JOIN overrides o ON k.sku_code = o.sku_code
         LEFT JOIN known kn ON k.sku_code = kn.sku_code),
kc AS (SELECT kl.*, c.tier AS c_tier, c.shipping_channel AS c_ship FROM kl
       JOIN classified c ON kl.sku_code = c.sku_code),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sku_code ORDER BY category, c_tier, brand,
                                        store_id, year) AS rn FROM kc)
SELECT sku_code, brand, product_desc, category, c_tier AS tier, c_ship AS shipping_channel,
       store_id AS first_store, year AS first_year FROM ranked WHERE rn = 1""")
    return s
