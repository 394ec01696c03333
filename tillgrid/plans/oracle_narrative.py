"""DuckDB oracle SQL for the report sentences."""

from __future__ import annotations

from .oracle_report import LABELS, month_label
from .sqlgen import mom0, pct, pct0, q, ratio, rnd, with_star

W = "PARTITION BY store_id, period"


def money(x: str) -> str:
    return f"('$' || format('{{:,}}', CAST({rnd(x, 0)} AS BIGINT)))"


def units(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def fixed(x: str, n: int) -> str:
    return f"printf('%.{n}f', {rnd(x, n)})"


def js(x: str) -> str:
    return (f"(CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({x} AS VARCHAR) END)")


def label(k: str) -> str:
    r = f"replace({k}, '_', ' ')"
    return f"(upper(substr({r}, 1, 1)) || substr({r}, 2))"


def rose(x: str) -> str:
    return f"(CASE WHEN {x} >= 0 THEN 'rose' ELSE 'fell' END)"


METRICS = f"""
, head AS (SELECT store_id, period, CAST(SUM(amount) AS DOUBLE) AS revenue,
                  CAST(SUM(order_count) AS BIGINT) AS orders,
                  {ratio('SUM(amount)', 'SUM(order_count)', 2)} AS avg_order_value
           FROM fact_sales GROUP BY 1, 2),
mo AS (SELECT store_id, period, SUM(amount) AS amount, SUM(qty) AS qty FROM fact_sales GROUP BY 1, 2),
ml AS (SELECT *, LAG(amount) OVER (PARTITION BY store_id ORDER BY period) AS pa,
              LAG(qty) OVER (PARTITION BY store_id ORDER BY period) AS pq,
              LAG(period) OVER (PARTITION BY store_id ORDER BY period) AS pp FROM mo),
m AS (SELECT store_id, period, CASE WHEN pa IS NOT NULL THEN {mom0('amount', 'pa')} END AS mom_a,
             CASE WHEN pq IS NOT NULL THEN {mom0('qty', 'pq')} END AS mom_q, pp FROM ml),
tot AS (SELECT store_id, period, SUM(amount) AS store_amount FROM sales GROUP BY 1, 2),
prem AS (SELECT store_id, period, category, SUM(amount) AS amount FROM sales
         WHERE tier = 'premium' GROUP BY 1, 2, 3),
prem_tot AS (SELECT store_id, period, SUM(amount) AS premium_amount FROM prem GROUP BY 1, 2),
top10 AS (SELECT store_id, period, count_if(tier = 'premium') AS premium_in_top10, COUNT(*) AS top_n
          FROM (SELECT *, row_number() OVER ({W} ORDER BY qty DESC, sku_code) AS rnk FROM sales)
          WHERE rnk <= 10 GROUP BY 1, 2),
si AS (SELECT t.store_id, t.period,
              {pct0('coalesce(p.premium_amount, 0)', 't.store_amount', 1)} AS premium_pct_of_store,
              CAST(coalesce(tp.premium_in_top10, 0) AS BIGINT) AS premium_in_top10,
              CAST(coalesce(tp.top_n, 0) AS BIGINT) AS top_n
       FROM tot t LEFT JOIN prem_tot p USING (store_id, period) LEFT JOIN top10 tp USING (store_id, period)),
mixa AS (SELECT store_id, period, category, SUM(amount) AS amount, SUM(qty) AS qty FROM sales GROUP BY 1, 2, 3),
mix AS (SELECT store_id, period, category, amount,
               {pct0('amount', f'SUM(amount) OVER ({W})', 1)} AS amount_pct,
               {pct0('qty', f'SUM(qty) OVER ({W})', 1)} AS qty_pct FROM mixa),
cat AS (SELECT store_id, period, category AS cat, amount_pct, qty_pct FROM
        (SELECT *, row_number() OVER ({W} ORDER BY amount_pct DESC, amount DESC, category) AS rn
         FROM mix) WHERE rn = 1),
pmix AS (SELECT store_id, period, category, amount,
                {pct0('amount', f'SUM(amount) OVER ({W})', 1)} AS amount_pct FROM prem),
pcat AS (SELECT store_id, period, category AS pcat, amount_pct AS pcat_pct FROM
         (SELECT *, row_number() OVER ({W} ORDER BY amount_pct DESC, amount DESC, category) AS rn
          FROM pmix) WHERE rn = 1),
bt AS (SELECT store_id, period, lower(trim(brand)) AS bk, SUM(amount) AS amount, min(brand) AS brand
       FROM sales GROUP BY 1, 2, 3),
br AS (SELECT store_id, period, brand AS lead_brand,
              {pct('amount', 'store_total', 1)} AS pct_of_store FROM
       (SELECT *, SUM(amount) OVER ({W}) AS store_total,
               row_number() OVER ({W} ORDER BY amount DESC, brand) AS rn FROM bt) WHERE rn = 1),
mb AS (SELECT store_id, period, lower(trim(brand)) AS bk, min(brand) AS brand, SUM(amount) AS amount
       FROM sales WHERE category = 'milk_powder' GROUP BY 1, 2, 3),
mk AS (SELECT store_id, period, brand AS milk_brand,
              {pct('amount', 'mtot', 1)} AS pct_of_category FROM
       (SELECT *, SUM(amount) OVER ({W}) AS mtot,
               row_number() OVER ({W} ORDER BY amount DESC, brand) AS rn FROM mb) WHERE rn = 1),
pk AS (SELECT store_id, period, CAST(SUM(amount) AS DOUBLE) AS pickup_amount,
              {pct0("coalesce(SUM(CASE WHEN tier = 'premium' THEN amount END), 0)", 'SUM(amount)', 1)}
                  AS premium_pickup_pct
       FROM sales WHERE category = 'milk_powder' AND shipping_channel = 'local' GROUP BY 1, 2),
fa AS (SELECT store_id, period, product_type, SUM(qty) AS qty FROM sales
       WHERE product_type NOT IN ('not_applicable', 'other_supplement') GROUP BY 1, 2, 3),
fn AS (SELECT store_id, period, product_type AS ftype, qty AS fqty FROM
       (SELECT *, row_number() OVER ({W} ORDER BY qty DESC, product_type) AS rn FROM fa) WHERE rn = 1),
rk AS (SELECT store_id, period, amount,
              ntile(10) OVER ({W} ORDER BY amount DESC, sku_code) AS decile FROM fact_sales),
dc AS (SELECT store_id, period, decile, SUM(amount) AS da FROM rk GROUP BY 1, 2, 3),
pr AS (SELECT store_id, period,
              {pct(f'SUM(da) OVER ({W} ORDER BY decile ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', f'SUM(da) OVER ({W})', 1)}
                  AS top20_pct, decile FROM dc),
conc AS (SELECT store_id, period, top20_pct FROM pr WHERE decile = 2),
cx AS (SELECT g.store_id, g.period, c.foot_traffic, c.miniprogram_leads,
              CAST(c.miniprogram_completion_rate AS DOUBLE) AS miniprogram_completion_rate,
              c.study_tour_flag, c.study_tour_note, c.activity_description
       FROM head g LEFT JOIN context_rows c USING (store_id, period)),
cg AS (SELECT store_id, period, channel_group, CAST(SUM(qty) AS BIGINT) AS qty FROM fact_channel
       GROUP BY 1, 2, 3),
cgp AS (SELECT *, {pct('qty', f'SUM(qty) OVER ({W})', 1)} AS qty_pct FROM cg),
chp AS (SELECT store_id, period,
               SUM(CASE WHEN channel_group = 'export' THEN qty ELSE 0 END) AS ex,
               SUM(CASE WHEN channel_group = 'local' THEN qty ELSE 0 END) AS lo,
               max(CASE WHEN channel_group = 'export' THEN qty_pct END) AS ex_pct
        FROM cgp GROUP BY 1, 2),
chl AS (SELECT *, LAG(ex) OVER (PARTITION BY store_id ORDER BY period) AS pex,
               LAG(lo) OVER (PARTITION BY store_id ORDER BY period) AS plo FROM chp),
ch AS (SELECT store_id, period, CASE WHEN pex IS NOT NULL THEN {mom0('ex', 'pex')} END AS export_mom,
              CASE WHEN plo IS NOT NULL THEN {mom0('lo', 'plo')} END AS local_mom, ex_pct FROM chl),
chj AS (SELECT g.store_id, g.period, c.export_mom, c.local_mom FROM head g
        ASOF LEFT JOIN ch c ON g.store_id = c.store_id AND g.period >= c.period),
d AS (SELECT * FROM head
      LEFT JOIN m USING (store_id, period) LEFT JOIN si USING (store_id, period)
      LEFT JOIN cat USING (store_id, period) LEFT JOIN pcat USING (store_id, period)
      LEFT JOIN br USING (store_id, period) LEFT JOIN mk USING (store_id, period)
      LEFT JOIN pk USING (store_id, period) LEFT JOIN fn USING (store_id, period)
      LEFT JOIN conc USING (store_id, period) LEFT JOIN cx USING (store_id, period)
      LEFT JOIN chj USING (store_id, period)
      LEFT JOIN (SELECT store_id, period, ex_pct FROM ch) chn USING (store_id, period))
"""


def fields() -> dict[str, str]:
    lab = month_label("period")
    short = f"{LABELS}[CAST(substr(pp, 6, 2) AS INTEGER)]"
    bullets = ("array_to_string(list_transform(list_filter(list_transform("
               "regexp_split_to_array(activity_description, '[;,]'), lambda x: trim(x)), "
               "lambda x: x <> ''), lambda x: '· ' || x), chr(10))")
    return {
        "headline_title": f"CASE WHEN mom_a IS NULL THEN {lab} || ': ' || {money('revenue')} || ' across ' "
                          f"|| {units('orders')} || ' orders' ELSE {lab} || ' revenue ' || {money('revenue')}"
                          f" || ', ' || {rose('mom_a')} || ' ' || {fixed('abs(mom_a)', 1)} || '% on ' "
                          f"|| {short} END",
        "headline_subtitle": f"'Average order value ' || {money('avg_order_value')}",
        "trend_title": f"CASE WHEN mom_a IS NULL THEN 'Revenue by month' ELSE 'Revenue ' || "
                       f"{rose('mom_a')} || ' ' || {fixed('abs(mom_a)', 1)} || '% month on month' END",
        "trend_qty_title": f"CASE WHEN mom_q IS NULL THEN 'Units sold by month' ELSE 'Units ' || "
                           f"{rose('mom_q')} || ' ' || {fixed('abs(mom_q)', 1)} || '% — ' || CASE WHEN "
                           f"sign(mom_q) = sign(mom_a) THEN 'moving with revenue' ELSE "
                           f"'moving against revenue' END END",
        "structure_intro_title": f"'Premium is ' || {js('premium_pct_of_store')} || '% of revenue and "
                                 f"holds ' || CAST(premium_in_top10 AS VARCHAR) || ' of the top ' || "
                                 f"CAST(top_n AS VARCHAR) || ' seller slots'",
        "category_mix_title": f"CASE WHEN cat IS NULL THEN 'Category mix' ELSE {label('cat')} || ' is ' "
                              f"|| {js('amount_pct')} || '% of revenue on ' || {js('qty_pct')} || "
                              f"'% of units' END",
        "premium_mix_title": f"CASE WHEN pcat IS NULL THEN 'Premium range by category' ELSE "
                             f"{label('pcat')} || ' is ' || {js('pcat_pct')} || '% of the premium range' END",
        "top_products_title": "CAST(premium_in_top10 AS VARCHAR) || ' of the top ' || "
                              "CAST(top_n AS VARCHAR) || ' sellers are premium lines'",
        "brand_title": f"CASE WHEN lead_brand IS NULL THEN 'Brands by revenue' ELSE lead_brand || "
                       f"' leads on revenue at ' || {fixed('pct_of_store', 1)} || '% of the store' END",
        "milk_brand_title": f"CASE WHEN milk_brand IS NULL THEN 'Milk powder brands' ELSE milk_brand || "
                            f"' leads milk powder with ' || {fixed('pct_of_category', 1)} || "
                            f"'% of the category' END",
        "milk_brand_note": f"CASE WHEN milk_brand IS NULL THEN 'No milk powder sales recorded this month.' "
                           f"ELSE milk_brand || ' accounts for ' || {fixed('pct_of_category', 1)} || "
                           f"{q('% of milk powder revenue this month. Shares here are within the category — the store-wide slide uses a different denominator.')} END",
        "pickup_title": f"CASE WHEN coalesce(pickup_amount, 0.0) = 0 THEN 'In-store milk powder pickups' "
                        f"ELSE 'Premium is ' || {fixed('premium_pickup_pct', 1)} || "
                        f"'% of in-store milk powder pickups' END",
        "pickup_comment": f"CASE WHEN coalesce(pickup_amount, 0.0) = 0 THEN "
                          f"'No in-store milk powder pickups were recorded this month.' ELSE "
                          f"'Premium lines made up ' || {fixed('premium_pickup_pct', 1)} || "
                          f"'% of in-store milk powder pickups in ' || {lab} || "
                          f"'. Staff can mention the premium range when handing over a pickup order.' END",
        "functional_title": "'Functional supplement types by month'",
        "functional_note": f"CASE WHEN ftype IS NULL THEN 'No functional supplement sales recorded this "
                           f"month.' ELSE {label('ftype')} || ' leads on units this month at ' || "
                           f"{units('fqty')} || '.' END",
        "channel_title": f"CASE WHEN export_mom IS NULL THEN 'Local and export volume by month' ELSE "
                         f"'Export ' || {rose('export_mom')} || ' ' || {fixed('abs(export_mom)', 1)} || "
                         f"'%, local ' || {rose('local_mom')} || ' ' || {fixed('abs(local_mom)', 1)} || '%' END",
        "channel_comment": f"CASE WHEN export_mom IS NULL THEN {q('First month on record — no comparison available yet.')} "
                           f"ELSE 'Export volume ' || {rose('export_mom')} || ' ' || "
                           f"{fixed('abs(export_mom)', 1)} || '% and local ' || {rose('local_mom')} || ' ' "
                           f"|| {fixed('abs(local_mom)', 1)} || '% month on month' || CASE WHEN ex_pct IS "
                           f"NOT NULL THEN '; export is ' || {js('ex_pct')} || '% of units this month.' "
                           f"ELSE '.' END END",
        "concentration_title": f"CASE WHEN top20_pct IS NULL THEN 'Revenue concentration by SKU' ELSE "
                               f"'The top 20% of SKUs account for ' || {fixed('top20_pct', 0)} || "
                               f"'% of revenue' END",
        "operations_title": f"{lab} || ' operating context'",
        "foot_traffic_card": f"CASE WHEN coalesce(foot_traffic, 0) = 0 THEN '—' ELSE "
                             f"{units('foot_traffic')} END",
        "app_enquiries_card": f"CASE WHEN coalesce(miniprogram_leads, 0) = 0 THEN '—' ELSE "
                              f"{units('miniprogram_leads')} END",
        "local_card": f"coalesce(CASE WHEN local_mom >= 0 THEN '+' ELSE '' END || {fixed('local_mom', 1)} || '%', 'n/a')",
        "export_card": f"coalesce(CASE WHEN export_mom >= 0 THEN '+' ELSE '' END || {fixed('export_mom', 1)} || '%', 'n/a')",
        "completion_card": f"CASE WHEN coalesce(miniprogram_completion_rate, 0.0) = 0 THEN '—' ELSE "
                           f"{js('miniprogram_completion_rate')} || '%' END",
        "tour_text": "CASE WHEN study_tour_flag = 'yes' THEN coalesce(nullif(study_tour_note, ''), "
                     "'A tour group visited this month.') ELSE 'No tour groups this month.' END",
        "campaign_title": "'Campaigns running this month'",
        "campaign_bullets": f"CASE WHEN coalesce(activity_description, '') = '' THEN "
                            f"'No campaigns recorded for this month.' ELSE {bullets} END",
    }


def sql() -> dict[str, str]:
    structs = ", ".join(f"struct_pack(field := {q(k)}, text := ({v}))" for k, v in fields().items())
    body = METRICS + f"""
, ex AS (SELECT store_id, period, unnest([{structs}]) AS x FROM d)
SELECT store_id, period, x.field AS field, x.text AS text FROM ex"""
    from .oracle_text import NUMBERS, REPLIES, TEXTS
    deck = METRICS + f"""
, ex AS (SELECT store_id, period, unnest([{structs}]) AS x FROM d),
fb AS (SELECT store_id, period, x.field AS field, x.text AS text FROM ex)
""" + NUMBERS + TEXTS + REPLIES + """
SELECT fb.store_id, fb.period, fb.field, coalesce(nullif(trim(p.text), ''), fb.text) AS text,
       p.text IS NOT NULL AS from_model
FROM fb LEFT JOIN parsed p ON fb.store_id = p.store_id AND fb.period = p.period AND fb.field = p.field"""
    return {"fallback_texts": with_star(body), "deck_texts": with_star(deck)}
