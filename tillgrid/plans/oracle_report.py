"""DuckDB oracle SQL for the report query set (slices 1-4)."""

from __future__ import annotations

from .. import vocab
from .sqlgen import RPT, mom, mom0, pct, pct0, q, ratio, report_bucket, with_star

W = "PARTITION BY store_id, period"
LABELS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"


def month_label(p: str) -> str:
    return f"({LABELS}[CAST(substr({p}, 6, 2) AS INTEGER)] || ' ' || substr({p}, 1, 4))"


def _win(src: str) -> str:
    return (f"SELECT store_id, period FROM (SELECT store_id, period, dense_rank() OVER "
            f"(PARTITION BY store_id ORDER BY period DESC) AS r FROM (SELECT DISTINCT store_id, "
            f"period FROM {src})) WHERE r <= 4")


def sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["headline"] = with_star(f"""
SELECT store_id, period, CAST(SUM(amount) AS DOUBLE) AS revenue, CAST(SUM(qty) AS BIGINT) AS units,
       CAST(SUM(order_count) AS BIGINT) AS orders,
       {ratio('SUM(amount)', 'SUM(order_count)', 2)} AS avg_order_value
FROM fact_sales GROUP BY store_id, period""")

    monthly = (", monthly AS (SELECT store_id, period, SUM(amount) AS amount, SUM(qty) AS qty "
               "FROM fact_sales GROUP BY store_id, period),\n"
               "lagged AS (SELECT *, LAG(amount) OVER (PARTITION BY store_id ORDER BY period) "
               "AS prev_amount, LAG(qty) OVER (PARTITION BY store_id ORDER BY period) AS prev_qty "
               "FROM monthly)\n")
    s["mom_sql"] = with_star(monthly + f"""
SELECT store_id, period, CAST(amount AS DOUBLE) AS amount, CAST(prev_amount AS DOUBLE) AS prev_amount,
       {mom('amount', 'prev_amount')} AS amount_mom_pct, {mom('qty', 'prev_qty')} AS qty_mom_pct
FROM lagged""", through_rpt=True)
    s["mom_pipeline"] = with_star(monthly + f"""
SELECT store_id, period, {mom0('amount', 'prev_amount')} AS amount_mom_pct,
       {mom0('qty', 'prev_qty')} AS qty_mom_pct
FROM lagged WHERE prev_amount IS NOT NULL""", through_rpt=True)

    s["tier_split"] = with_star(f"""
SELECT store_id, period, bucket, CAST(amount AS DOUBLE) AS amount,
       {pct('amount', f'SUM(amount) OVER ({W})', 2)} AS pct_of_total
FROM (SELECT store_id, period, {report_bucket('category', 'tier')} AS bucket, SUM(amount) AS amount
      FROM sales GROUP BY 1, 2, 3)""")
    s["bucket_trend"] = with_star(f"""
SELECT store_id, period, bucket, CAST(SUM(amount) AS DOUBLE) AS amount, CAST(SUM(qty) AS BIGINT) AS qty
FROM (SELECT *, {report_bucket('category', 'tier')} AS bucket FROM sales)
GROUP BY store_id, period, bucket""", through_rpt=True)

    def mix(where: str) -> str:
        return with_star(f"""
SELECT store_id, period, category, CAST(amount AS DOUBLE) AS amount, qty,
       {pct0('amount', f'SUM(amount) OVER ({W})', 1)} AS amount_pct,
       {pct0('qty', f'SUM(qty) OVER ({W})', 1)} AS qty_pct
FROM (SELECT store_id, period, category, SUM(amount) AS amount, CAST(SUM(qty) AS BIGINT) AS qty
      FROM sales {where} GROUP BY 1, 2, 3)""")
    s["category_mix"] = mix("")
    s["premium_mix"] = mix("WHERE tier = 'premium'")

    top10 = (f"SELECT *, row_number() OVER ({W} ORDER BY qty DESC, sku_code) AS rnk FROM sales")
    s["top_products"] = with_star(f"""
SELECT store_id, period, CAST(rnk AS INTEGER) AS rnk, sku_code, brand, product_desc, category, tier,
       qty, CAST(amount AS DOUBLE) AS amount
FROM ({top10}) WHERE rnk <= 10""")

    s["structure_intro"] = with_star(f"""
, tot AS (SELECT store_id, period, SUM(amount) AS store_amount FROM sales GROUP BY 1, 2),
prem AS (SELECT store_id, period, category, SUM(amount) AS amount FROM sales
         WHERE tier = 'premium' GROUP BY 1, 2, 3),
prem_tot AS (SELECT store_id, period, SUM(amount) AS premium_amount FROM prem GROUP BY 1, 2),
prem_lead AS (SELECT store_id, period, category AS lead_cat, amount AS lead_amount FROM
              (SELECT *, row_number() OVER ({W} ORDER BY amount DESC, category) AS rn FROM prem)
              WHERE rn = 1),
top AS (SELECT store_id, period, count_if(tier = 'premium') AS premium_in_top10, COUNT(*) AS top_n
        FROM ({top10}) WHERE rnk <= 10 GROUP BY 1, 2)
SELECT t.store_id, t.period, CAST(coalesce(p.premium_amount, 0) AS DOUBLE) AS premium_amount,
       {pct0('coalesce(p.premium_amount, 0)', 't.store_amount', 1)} AS premium_pct_of_store,
       l.lead_cat AS leading_premium_category,
       {pct0('l.lead_amount', 'p.premium_amount', 1)} AS leading_premium_pct,
       CAST(coalesce(tp.premium_in_top10, 0) AS BIGINT) AS premium_in_top10,
       CAST(coalesce(tp.top_n, 0) AS BIGINT) AS top_n
FROM tot t LEFT JOIN prem_tot p USING (store_id, period) LEFT JOIN prem_lead l USING (store_id, period)
LEFT JOIN top tp USING (store_id, period)""")

    def brands(k: int, rowmax: bool) -> str:
        if rowmax:
            bm = (f"bm AS (SELECT store_id, period, bk, category AS main_category FROM "
                  f"(SELECT store_id, period, lower(trim(brand)) AS bk, category, row_number() OVER "
                  f"(PARTITION BY store_id, period, lower(trim(brand)) ORDER BY amount DESC, sku_code)"
                  f" AS rn FROM sales) WHERE rn = 1),")
        else:
            bm = (f"bc AS (SELECT store_id, period, lower(trim(brand)) AS bk, category, "
                  f"SUM(amount) AS ca FROM sales GROUP BY 1, 2, 3, 4),\n"
                  f"bm AS (SELECT store_id, period, bk, category AS main_category FROM "
                  f"(SELECT *, row_number() OVER (PARTITION BY store_id, period, bk ORDER BY ca DESC, "
                  f"category) AS rn FROM bc) WHERE rn = 1),")
        return with_star(f"""
, {bm}
bt AS (SELECT store_id, period, lower(trim(brand)) AS bk, SUM(amount) AS amount, min(brand) AS brand
       FROM sales GROUP BY 1, 2, 3),
j AS (SELECT bt.*, bm.main_category, SUM(bt.amount) OVER (PARTITION BY bt.store_id, bt.period)
             AS store_total FROM bt JOIN bm USING (store_id, period, bk))
SELECT store_id, period, CAST(rnk AS INTEGER) AS rnk, brand, CAST(amount AS DOUBLE) AS amount,
       {pct('amount', 'store_total', 1)} AS pct_of_store, main_category
FROM (SELECT *, row_number() OVER ({W} ORDER BY amount DESC, brand) AS rnk FROM j)
WHERE rnk <= {k}""")
    s["top_brands"] = brands(10, False)
    s["top_brands_rowmax"] = brands(5, True)

    s["milk_brands"] = with_star(f"""
SELECT store_id, period, brand, CAST(amount AS DOUBLE) AS amount,
       {pct('amount', f'SUM(amount) OVER ({W})', 1)} AS pct_of_category
FROM (SELECT store_id, period, lower(trim(brand)) AS bk, min(brand) AS brand, SUM(amount) AS amount
      FROM sales WHERE category = 'milk_powder' GROUP BY 1, 2, 3)""")

    s["pickup_tier_trend"] = with_star("""
SELECT store_id, period, tier, CAST(SUM(amount) AS DOUBLE) AS amount, CAST(SUM(qty) AS BIGINT) AS qty
FROM sales WHERE category = 'milk_powder' AND shipping_channel = 'local'
GROUP BY store_id, period, tier""", through_rpt=True)

    def functional(where: str) -> str:
        return with_star(f"""
SELECT store_id, period, product_type, CAST(SUM(qty) AS BIGINT) AS qty,
       CAST(SUM(amount) AS DOUBLE) AS amount
FROM sales WHERE {where} GROUP BY store_id, period, product_type""", through_rpt=True)
    s["functional_trend_sql"] = functional(
        "category = 'supplement' AND product_type IS NOT NULL AND product_type <> 'not_applicable'")
    s["functional_trend_pipeline"] = functional(
        "product_type NOT IN ('not_applicable', 'other_supplement')")

    s["channel_trend"] = with_star(f"""
SELECT store_id, period, channel_group, qty, CAST(amount AS DOUBLE) AS amount,
       {pct('qty', f'SUM(qty) OVER ({W})', 1)} AS qty_pct
FROM (SELECT store_id, period, channel_group, CAST(SUM(qty) AS BIGINT) AS qty, SUM(amount) AS amount
      FROM fact_channel GROUP BY 1, 2, 3)""", through_rpt=True)
    s["channel_totals"] = with_star("""
SELECT store_id, channel_group, CAST(SUM(order_count) AS BIGINT) AS order_count,
       CAST(SUM(qty) AS BIGINT) AS qty, CAST(SUM(amount) AS DOUBLE) AS amount
FROM fact_channel GROUP BY store_id, channel_group""", through_rpt=True)

    s["pickup_share"] = with_star(f"""
SELECT store_id, period, CAST(SUM(amount) AS DOUBLE) AS pickup_amount,
       {pct0("coalesce(SUM(CASE WHEN tier = 'premium' THEN amount END), 0)", 'SUM(amount)', 1)}
           AS premium_pickup_pct
FROM sales WHERE category = 'milk_powder' AND shipping_channel = 'local'
GROUP BY store_id, period""", through_rpt=True)

    run = (f"SUM(decile_amount) OVER ({W} ORDER BY decile ROWS BETWEEN UNBOUNDED PRECEDING "
           f"AND CURRENT ROW)")
    s["sku_pareto"] = with_star(f"""
, ranked AS (SELECT store_id, period, sku_code, amount,
                    ntile(10) OVER ({W} ORDER BY amount DESC, sku_code) AS decile FROM fact_sales),
d AS (SELECT store_id, period, decile, COUNT(*) AS sku_count, SUM(amount) AS decile_amount
      FROM ranked GROUP BY 1, 2, 3)
SELECT store_id, period, CAST(decile AS INTEGER) AS decile, sku_count,
       CAST(decile_amount AS DOUBLE) AS decile_amount,
       {pct(run, f'SUM(decile_amount) OVER ({W})', 1)} AS cumulative_pct
FROM d""")

    s["bucket_matrix"] = with_star(f"""
, bt AS (SELECT store_id, period, bucket, CAST(SUM(amount) AS DOUBLE) AS amount,
                CAST(SUM(qty) AS BIGINT) AS qty
         FROM (SELECT *, {report_bucket('category', 'tier')} AS bucket FROM sales) GROUP BY 1, 2, 3),
win AS ({_win('bt')}),
grid AS (SELECT store_id, period, unnest(['premium', 'regular', 'milk_powder']) AS bucket FROM win)
SELECT g.store_id, g.period, g.bucket, coalesce(bt.amount, 0.0) AS amount,
       CAST(coalesce(bt.qty, 0) AS BIGINT) AS qty
FROM grid g LEFT JOIN bt USING (store_id, period, bucket)""", through_rpt=True)

    s["trend_series"] = with_star(f"""
, m AS (SELECT store_id, period, SUM(amount) AS amount, SUM(qty) AS qty FROM fact_sales GROUP BY 1, 2),
w AS (SELECT m.* FROM m JOIN ({_win('m')}) x USING (store_id, period)),
x AS (SELECT store_id, period, CAST(amount AS DOUBLE) AS amount_total, CAST(qty AS DOUBLE) AS qty_total,
             row_number() OVER (PARTITION BY store_id ORDER BY period) AS idx,
             LAG(CAST(amount AS DOUBLE)) OVER (PARTITION BY store_id ORDER BY period) AS prev_a,
             LAG(CAST(qty AS DOUBLE)) OVER (PARTITION BY store_id ORDER BY period) AS prev_q
      FROM w)
SELECT store_id, CAST(idx AS INTEGER) AS idx, period, {month_label('period')} AS period_label,
       amount_total, qty_total,
       CASE WHEN idx > 1 THEN {mom0('amount_total', 'prev_a')} END AS amount_mom_pct,
       CASE WHEN idx > 1 THEN {mom0('qty_total', 'prev_q')} END AS qty_mom_pct
FROM x""", through_rpt=True)

    def before(c: str) -> str:
        return f"CASE WHEN idx > 1 THEN {mom0(c, f'LAG({c}) OVER w')} END AS {c}_mom_pct"
    s["channel_series"] = with_star(f"""
, m AS (SELECT store_id, period, CAST(coalesce(SUM(qty) FILTER (channel_group = 'local'), 0) AS DOUBLE) AS local_qty,
               CAST(coalesce(SUM(qty) FILTER (channel_group = 'export'), 0) AS DOUBLE) AS export_qty
        FROM fact_channel GROUP BY 1, 2),
x AS (SELECT m.*, CAST(row_number() OVER (PARTITION BY store_id ORDER BY period) AS INTEGER) AS idx
      FROM m JOIN ({_win('m')}) USING (store_id, period))
SELECT store_id, idx, period, {month_label('period')} AS period_label, local_qty, {before('local_qty')},
       export_qty, {before('export_qty')}
FROM x WINDOW w AS (PARTITION BY store_id ORDER BY period)""", through_rpt=True)

    fpipe = ("SELECT store_id, period, product_type, SUM(qty) AS qty FROM sales WHERE product_type "
             "NOT IN ('not_applicable', 'other_supplement') GROUP BY 1, 2, 3")
    label = "CASE product_type " + " ".join(
        f"WHEN {q(k)} THEN {q(v)}" for k, v in vocab.PRODUCT_TYPE_LABELS.items()) + " END"
    s["functional_top"] = with_star(f"""
, f AS ({fpipe}),
win AS (SELECT DISTINCT store_id, period FROM f),
tot AS (SELECT store_id, product_type, SUM(qty) AS tq FROM f GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY tq DESC, product_type) AS r FROM tot),
lab AS (SELECT store_id, product_type,
               CASE WHEN r <= 6 THEN {label} ELSE 'Other (' ||
                    CAST(count_if(r > 6) OVER (PARTITION BY store_id) AS VARCHAR) || ' types)' END
                   AS label FROM rk),
labelled AS (SELECT f.store_id, f.period, lab.label, SUM(f.qty) AS qty
             FROM f JOIN lab USING (store_id, product_type) GROUP BY 1, 2, 3),
grid AS (SELECT DISTINCT win.store_id, win.period, lab.label FROM win JOIN lab USING (store_id))
SELECT g.store_id, g.period, g.label, CAST(coalesce(l.qty, 0) AS BIGINT) AS qty
FROM grid g LEFT JOIN labelled l USING (store_id, period, label)""", through_rpt=True)

    s["functional_leader"] = with_star(f"""
, f AS ({fpipe}),
best AS (SELECT store_id, {label} AS leader, qty
         FROM (SELECT f.*, row_number() OVER (PARTITION BY store_id ORDER BY qty DESC, product_type) AS rn
               FROM f WHERE period = {RPT}) WHERE rn = 1)
SELECT s.store_id, {RPT} AS period, best.leader, CAST(best.qty AS BIGINT) AS leader_qty
FROM (SELECT DISTINCT store_id FROM fact_sales) s LEFT JOIN best USING (store_id)""", through_rpt=True)

    s["operating_context"] = with_star("""
SELECT g.store_id, g.period, c.foot_traffic, c.miniprogram_leads,
       CAST(c.miniprogram_completion_rate AS DOUBLE) AS miniprogram_completion_rate,
       c.study_tour_flag, c.study_tour_note, c.activity_description
FROM (SELECT DISTINCT store_id, period FROM fact_sales) g
LEFT JOIN context_rows c USING (store_id, period)""", through_rpt=True)
    s["context_gaps"] = with_star("""
, g AS (SELECT DISTINCT store_id, period FROM fact_sales)
SELECT store_id, period, 'missing' AS issue FROM g
WHERE NOT EXISTS (SELECT 1 FROM context_rows c WHERE c.store_id = g.store_id AND c.period = g.period)
UNION ALL
SELECT store_id, period, 'incomplete' AS issue FROM g
WHERE EXISTS (SELECT 1 FROM context_rows c WHERE c.store_id = g.store_id AND c.period = g.period
              AND c.foot_traffic IS NULL)""", through_rpt=True)
    s["report_header"] = with_star(f"""
SELECT g.store_id, g.period, {month_label('g.period')} AS period_label, r.r_name AS store_code,
       CAST(4 AS INTEGER) AS trend_months, 'Reporting month: ' || g.period AS context_line
FROM (SELECT DISTINCT store_id, period FROM fact_sales) g JOIN region r ON g.store_id = r.r_regionkey
""", through_rpt=True)
    s["headline_rpt"] = with_star(f"""
SELECT store_id, period, CAST(SUM(amount) AS DOUBLE) AS revenue, CAST(SUM(qty) AS BIGINT) AS units,
       CAST(SUM(order_count) AS BIGINT) AS orders,
       {ratio('SUM(amount)', 'SUM(order_count)', 2)} AS avg_order_value
FROM fact_sales WHERE period = {RPT} GROUP BY store_id, period""")
    s["top_products_rpt"] = with_star(f"""
SELECT store_id, period, CAST(rnk AS INTEGER) AS rnk, sku_code, brand, product_desc, category, tier,
       qty, CAST(amount AS DOUBLE) AS amount
FROM ({top10} WHERE period = {RPT}) WHERE rnk <= 10""".replace("FROM sales WHERE", "FROM sales WHERE", 1))
    s["context_malformed"] = with_star("""
SELECT store_id, trim(period) AS period, line_no FROM context_src
WHERE nullif(trim(period), '') IS NOT NULL AND NOT regexp_matches(trim(period), '^\\d{4}-\\d{2}$')""")

    def lab(col: str, mapping: dict) -> str:
        whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
        r = f"replace({col}, '_', ' ')"
        return f"(CASE {col} {whens} ELSE upper(substr({r}, 1, 1)) || substr({r}, 2) END)"
    s["category_labels"] = with_star(f"""
SELECT store_id, period, category, bucket, {lab('category', vocab.CATEGORY_LABELS)} AS category_label,
       {lab('bucket', vocab.TIER_LABELS)} AS bucket_label, CAST(amount AS DOUBLE) AS amount
FROM (SELECT store_id, period, category, {report_bucket('category', 'tier')} AS bucket,
             SUM(amount) AS amount FROM sales GROUP BY 1, 2, 3, 4)""")
    return s
