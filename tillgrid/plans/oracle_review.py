"""DuckDB oracle SQL for classification and review queues (slice 6)."""

from __future__ import annotations

from .. import vocab
from .oracle_fuzzy import close_pairs
from .sqlgen import keyword_guess, q, verdict, with_star

R = vocab.FIXTURE_RULES
G = "store_id, period"


def _conflicts(src: str) -> str:
    return (f"SELECT x.*, coalesce(b.category, '') AS brand_category, "
            f"{keyword_guess('x.product_desc', R)} AS keyword_guess FROM {src} x "
            f"LEFT JOIN brand_cat b ON lower(trim(x.brand)) = b.brand_key")


MONTH_PRODUCTS = (", mp AS (SELECT f.store_id, f.period, p.sku_code, p.brand, p.product_desc, "
                  "f.amount AS total_amt FROM fact_sales f JOIN products p ON f.partkey = p.partkey),\n"
                  "inv AS (SELECT store_id, period, lower(trim(brand)) AS brand_key, "
                  "array_to_string(list_sort(list_distinct(list(brand))), '/') AS brand_variants, "
                  "COUNT(sku_code) AS n_sku, SUM(total_amt) AS total_amt, "
                  "first(product_desc ORDER BY brand, sku_code) AS sample_product "
                  "FROM mp GROUP BY 1, 2, 3)\n")

SKU_TOTALS = (", tot AS (SELECT partkey, SUM(amount) AS total_amt FROM fact_sales GROUP BY 1),\n"
              "kept AS (SELECT c.*, t.total_amt FROM classified c JOIN tot t ON c.partkey = t.partkey "
              "WHERE coalesce(c.category, '') <> 'excluded')\n")


def sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["classified_products"] = with_star("""
SELECT sku_code, brand, brand_key, category, is_known, was_overridden, resolved_brand, resolve_how,
       tier, tier_reason, shipping_channel FROM classified""")
    s["dim_product"] = with_star("SELECT * FROM dim_product")
    conf = f", conf AS (SELECT *, {verdict('brand_category', 'keyword_guess')} AS verdict FROM ({_conflicts('products')}))\n"
    s["keyword_conflicts"] = with_star(conf + """
SELECT sku_code, brand, product_desc, brand_category, keyword_guess, verdict FROM conf""")
    s["new_conflicts"] = with_star(conf + """
SELECT sku_code, brand, product_desc, brand_category, keyword_guess, verdict FROM conf
WHERE starts_with(verdict, 'CONFLICT')
  AND sku_code NOT IN (SELECT sku_code FROM reviewed UNION ALL SELECT sku_code FROM known
                       UNION ALL SELECT sku_code FROM overrides)""")
    s["unclassified_brand_skus"] = with_star(conf + """
SELECT sku_code, brand, product_desc FROM conf WHERE verdict = 'brand_not_classified'""")
    s["brand_inventory"] = with_star(MONTH_PRODUCTS + """
SELECT store_id, period, brand_key, brand_variants, n_sku, CAST(total_amt AS DOUBLE) AS total_amt,
       sample_product FROM inv""")
    s["new_brands"] = with_star(MONTH_PRODUCTS + close_pairs() + """
, named AS (SELECT new_key, string_agg(known_key, '/' ORDER BY rank) AS close_names FROM close GROUP BY 1)
SELECT store_id, period,
       CAST(row_number() OVER (PARTITION BY store_id, period ORDER BY total_amt DESC, brand_key) AS INTEGER) AS place,
       brand_key, brand_variants, n_sku, CAST(total_amt AS DOUBLE) AS total_amt, sample_product,
       coalesce(close_names, '') AS close_names
FROM inv LEFT JOIN named ON brand_key = new_key
WHERE brand_key NOT IN (SELECT known_key FROM keys)""")
    s["brand_carry_forward"] = with_star(MONTH_PRODUCTS + """
, months AS (SELECT DISTINCT store_id, period FROM inv)
SELECT m.store_id, m.period,
       (SELECT arg_max(i.brand_variants, i.period) FROM inv i WHERE i.store_id = m.store_id
          AND i.brand_key = k.brand_key AND i.period < m.period) AS brand_variants,
       CAST(0 AS BIGINT) AS n_sku, CAST(0.0 AS DOUBLE) AS total_amt,
       coalesce(b.category, '') AS confirmed_category
FROM months m JOIN (SELECT DISTINCT store_id, brand_key FROM inv) k ON k.store_id = m.store_id
LEFT JOIN brand_cat b ON k.brand_key = b.brand_key
WHERE EXISTS (SELECT 1 FROM inv i WHERE i.store_id = m.store_id AND i.brand_key = k.brand_key AND i.period < m.period)
  AND NOT EXISTS (SELECT 1 FROM inv i WHERE i.store_id = m.store_id AND i.brand_key = k.brand_key
                  AND i.period = m.period)""")
    s["category_spread"] = with_star("""
, per AS (SELECT brand, category, COUNT(*) AS n FROM dim_product GROUP BY 1, 2),
multi AS (SELECT brand, COUNT(*) AS n_categories FROM per GROUP BY 1 HAVING COUNT(*) > 1)
SELECT per.brand, per.category, per.n, multi.n_categories FROM per JOIN multi USING (brand)""")
    s["summary_by_category"] = with_star(SKU_TOTALS + """
SELECT category, CAST(SUM(total_amt) AS DOUBLE) AS amount, CAST(GROUPING(category) AS INTEGER) AS is_total
FROM kept GROUP BY ROLLUP (category)""")
    s["summary_by_bucket"] = with_star(SKU_TOTALS + """
SELECT CASE WHEN category = 'milk_powder' AND NOT was_overridden THEN 'milk_powder' ELSE tier END
           AS bucket, CAST(SUM(total_amt) AS DOUBLE) AS amount FROM kept GROUP BY 1""")
    s["summary_by_shipping"] = with_star(SKU_TOTALS + """
SELECT shipping_channel, CAST(SUM(total_amt) AS DOUBLE) AS amount FROM kept GROUP BY 1""")
    s["invalid_categories"] = with_star(f"""
SELECT sku_code, brand, product_desc, category FROM classified
WHERE coalesce(category, '') <> 'excluded'
  AND NOT coalesce(category IN ({", ".join(q(c) for c in vocab.CATEGORIES)}), false)""")
    s["odd_shipping"] = with_star("""
SELECT sku_code, brand, shipping_channel FROM classified
WHERE coalesce(category, '') <> 'excluded' AND starts_with(shipping_channel, 'other:')""")
    tags = ", ".join(q(x) for x in vocab.EXPORT_TAGS)
    s["unknown_tags"] = with_star(f"""
SELECT trim(freight_tag) AS freight_tag, COUNT(*) AS n_skus FROM products
WHERE trim(freight_tag) IS NOT NULL AND trim(freight_tag) NOT IN ('', 'nan', 'None', 'NaN')
  AND trim(freight_tag) NOT IN ({tags}) GROUP BY 1""")
    s["type_counts"] = with_star(SKU_TOTALS + f"""
, sup AS (SELECT k.*, d.product_type FROM kept k JOIN dim_product d ON k.partkey = d.partkey
          WHERE k.category = 'supplement'),
per AS (SELECT product_type, COUNT(*) AS n_skus, SUM(total_amt) AS revenue FROM sup GROUP BY 1),
sh AS (SELECT *, CAST(SUM(CASE WHEN product_type = {q(vocab.CATCH_ALL_TYPE)} THEN n_skus ELSE 0 END)
                      OVER () AS DOUBLE) / CAST(SUM(n_skus) OVER () AS DOUBLE) AS catch_all_share
       FROM per)
SELECT product_type, n_skus, CAST(revenue AS DOUBLE) AS revenue, catch_all_share,
       catch_all_share > {vocab.CATCH_ALL_WARN_SHARE} AS warn FROM sh""")
    s["reviewed_seed"] = with_star(f"""
, mp AS (SELECT DISTINCT f.period, p.sku_code, p.brand, p.product_desc
         FROM fact_sales f JOIN products p ON f.partkey = p.partkey),
conf AS (SELECT *, {verdict('brand_category', 'keyword_guess')} AS verdict FROM ({_conflicts('mp')})),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sku_code ORDER BY period) AS rn
                         FROM conf WHERE starts_with(verdict, 'CONFLICT')) WHERE rn = 1)
SELECT sku_code, brand, product_desc, period AS first_seen, 'pending' AS decision, verdict AS note
FROM first WHERE sku_code NOT IN (SELECT sku_code FROM overrides)""")
    s["settled_skus"] = with_star("""
SELECT sku_code FROM reviewed UNION SELECT sku_code FROM known UNION SELECT sku_code FROM overrides""")
    return s
