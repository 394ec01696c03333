"""DuckDB oracle SQL for the report documents: their leaves as rows, block by block, and the
grounding of the report texts against them."""

from __future__ import annotations

from .oracle_report import month_label
from .oracle_report import sql as report_sql
from .oracle_text import NUMBERS, PROSE, STATUS, TEXTS, _classify, tokens_cte
from .sqlgen import mom0, pct, report_bucket, rnd, with_star

MONTHS = f"""
, docs AS (SELECT DISTINCT store_id, period FROM fact_sales),
trend AS (SELECT store_id, period, {report_bucket('category', 'tier')} AS bucket, SUM(amount) AS amount, SUM(qty) AS qty
          FROM sales GROUP BY 1, 2, 3),
functional AS (SELECT store_id, period, product_type, SUM(amount) AS amount, SUM(qty) AS qty FROM sales
               WHERE product_type NOT IN ('not_applicable', 'other_supplement') GROUP BY 1, 2, 3),
pickup AS (SELECT store_id, period, tier, SUM(amount) AS amount, SUM(qty) AS qty FROM sales
           WHERE category = 'milk_powder' AND shipping_channel = 'local' GROUP BY 1, 2, 3),
channel AS (SELECT *, {pct('qty', 'SUM(qty) OVER (PARTITION BY store_id, period)', 1)} AS qty_pct FROM (
            SELECT store_id, period, channel_group, SUM(qty) AS qty, SUM(amount) AS amount FROM fact_channel
            GROUP BY 1, 2, 3)),
months AS (SELECT store_id, period AS month, SUM(amount) AS a, SUM(qty) AS b FROM fact_sales GROUP BY 1, 2),
groups AS (SELECT store_id, period AS month, coalesce(SUM(qty) FILTER (channel_group = 'local'), 0) AS a,
                  coalesce(SUM(qty) FILTER (channel_group = 'export'), 0) AS b FROM fact_channel GROUP BY 1, 2)
"""


def _window(name: str, src: str) -> str:
    """The last four months of ``src`` up to each document's month, with the month before."""
    return f"""
, {name}0 AS (SELECT d.store_id, d.period, m.month, m.a, m.b,
                     row_number() OVER (PARTITION BY d.store_id, d.period ORDER BY m.month DESC) AS r
              FROM docs d JOIN {src} m ON m.store_id = d.store_id AND m.month <= d.period QUALIFY r <= 4),
{name} AS (SELECT *, LAG(a) OVER w AS pa, LAG(b) OVER w AS pb FROM {name}0
           WINDOW w AS (PARTITION BY store_id, period ORDER BY month))"""


def _leaf(src: str, numbers: list[str], strings: list[str]) -> list[str]:
    out = []
    if numbers:
        cells = ", ".join(f"CAST({c} AS DOUBLE)" for c in numbers)
        out.append(f"SELECT store_id, period, unnest([{cells}]) AS num, CAST(NULL AS VARCHAR) AS str FROM {src}")
    if strings:
        cells = ", ".join(f"CAST({c} AS VARCHAR)" for c in strings)
        out.append(f"SELECT store_id, period, CAST(NULL AS DOUBLE), unnest([{cells}]) FROM {src}")
    return out


def leaves_cte() -> str:
    """CTEs that end in ``leaf`` (store_id, period, num, str): every leaf of every document."""
    r = report_sql()
    block = lambda name: f"({r[name]})"
    so_far = lambda src: (f"(SELECT d.store_id, d.period, x.* EXCLUDE (store_id, period), x.period AS month, "  # noqa: E731
                          f"{month_label('x.period')} AS label FROM docs d JOIN {src} x "
                          "ON x.store_id = d.store_id AND x.period <= d.period)")
    header = (f"(SELECT d.store_id, d.period, {month_label('d.period')} AS label, r_name, 4 AS months FROM docs d "
              "JOIN region ON d.store_id = r_regionkey)")
    context = "(SELECT d.*, c.* EXCLUDE (store_id, period) FROM docs d JOIN context_rows c USING (store_id, period))"
    premium = (f"(SELECT d.store_id, d.period, coalesce(SUM(CAST(amount AS DECIMAL(22,2))), 0) AS amount, "
               f"coalesce(SUM(qty), 0) AS qty FROM docs d LEFT JOIN {block('premium_mix')} p USING (store_id, period) "
               "GROUP BY 1, 2)")
    mix = (["amount", "qty", "amount_pct", "qty_pct"], ["category"])
    moms = [f"CASE WHEN p{c} IS NOT NULL THEN {mom0(f'CAST({c} AS DOUBLE)', f'CAST(p{c} AS DOUBLE)')} END" for c in "ab"]
    parts = [
        _leaf(header, ["months"], ["period", "label", "r_name"]),
        _leaf(block("headline"), ["revenue", "units", "orders", "avg_order_value", "revenue", "units"], []),
        _leaf(block("tier_split"), ["amount", "pct_of_total"], ["bucket"]),
        _leaf(so_far("trend"), ["amount", "qty"], ["month", "bucket", "label"]),
        _leaf(block("category_mix"), *mix), _leaf(block("premium_mix"), *mix), _leaf(premium, ["amount", "qty"], []),
        _leaf(block("top_products"), ["rnk", "qty", "amount"], ["sku_code", "brand", "product_desc", "category", "tier"]),
        _leaf(block("structure_intro"), ["premium_amount", "premium_pct_of_store", "leading_premium_pct",
                                         "premium_in_top10", "premium_in_top10", "top_n"], ["leading_premium_category"]),
        _leaf(block("top_brands_rowmax"), ["rnk", "amount", "pct_of_store"], ["brand", "main_category"]),
        _leaf(block("milk_brands"), ["amount", "pct_of_category"], ["brand"]),
        _leaf(so_far("functional"), ["amount", "qty"], ["month", "product_type", "label"]),
        _leaf(so_far("pickup"), ["amount", "qty"], ["month", "tier", "label"]),
        _leaf(so_far("channel"), ["amount", "qty", "qty_pct"], ["month", "channel_group", "label"]),
        _leaf(block("sku_pareto"), ["decile", "sku_count", "decile_amount", "cumulative_pct"], []),
        _leaf(context, ["foot_traffic", "miniprogram_leads", "miniprogram_completion_rate"],
              ["study_tour_flag", "study_tour_note", "activity_description"]),
        _leaf("recent", ["a", "b", *moms], ["month", month_label("month")]),
        _leaf("recent_groups", ["a", "b", *moms], ["month", month_label("month")])]
    every = " UNION ALL ".join(x for p in parts for x in p)
    return (MONTHS + _window("recent", "months") + _window("recent_groups", "groups")
            + f", leaf AS (SELECT * FROM ({every}) WHERE num IS NOT NULL OR str IS NOT NULL)\n")


def sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["document_leaves"] = with_star(leaves_cte() + """
SELECT store_id, period, CASE WHEN str IS NULL THEN 'number' ELSE 'string' END AS kind, num, str, COUNT(*) AS n
FROM leaf GROUP BY ALL""")
    keys = "store_id, period, field"
    rounded = " UNION ALL ".join(
        f"SELECT store_id, period, {rnd('num', d) if d else 'round_even(num, 0)'} AS a FROM leaf WHERE num IS NOT NULL"
        for d in (2, 1, 0))
    allowed = f"""
, allowed AS (SELECT DISTINCT * FROM ({rounded}
  UNION ALL SELECT store_id, period, CAST(unnest(regexp_extract_all(str, '[0-9]+')) AS DOUBLE) FROM leaf
  WHERE str IS NOT NULL
  UNION ALL SELECT store_id, period, unnest([{PROSE}]) FROM docs))
"""
    s["document_findings"] = with_star(
        leaves_cte() + allowed + NUMBERS + TEXTS + tokens_cte("tx", keys)
        + _classify("a.store_id = t.store_id AND a.period = t.period")
        + f"SELECT {keys}, pos, value, {STATUS} FROM fnd")
    return s
