"""DuckDB oracle SQL for the grounding slice (brute-force tolerance EXISTS)."""

from __future__ import annotations

from .. import vocab
from .oracle_report import month_label
from .sqlgen import mom, q, ratio, rnd, with_star

DATE_ALT = "|".join(vocab.DATE_WORDS)
TOKEN_RE = q(f"(-?[0-9][0-9,]*\\.?[0-9]*)([ \\t\\n\\r\\f\\x0B]*(?i:{DATE_ALT}))?")
NUM_COLS = ["revenue", "units", "orders", "avg_order_value", "prev_amount", "amount_mom_pct",
            "qty_mom_pct"]
PROSE = ", ".join(f"{float(x)}" for x in vocab.NARRATIVE_NUMBERS)
OK_MSG = vocab.GROUNDING_SIGN_ONLY
MISS_MSG = vocab.GROUNDING_MISSING

NUMBERS = f"""
, h AS (SELECT store_id, period, CAST(SUM(amount) AS DOUBLE) AS revenue, CAST(SUM(qty) AS BIGINT) AS units,
               CAST(SUM(order_count) AS BIGINT) AS orders,
               {ratio('SUM(amount)', 'SUM(order_count)', 2)} AS avg_order_value
        FROM fact_sales GROUP BY store_id, period),
tmo AS (SELECT store_id, period, SUM(amount) AS amount, SUM(qty) AS qty FROM fact_sales GROUP BY 1, 2),
tml AS (SELECT *, LAG(amount) OVER (PARTITION BY store_id ORDER BY period) AS pa,
              LAG(qty) OVER (PARTITION BY store_id ORDER BY period) AS pq FROM tmo),
tm AS (SELECT store_id, period, CAST(pa AS DOUBLE) AS prev_amount, {mom('amount', 'pa')} AS amount_mom_pct,
             {mom('qty', 'pq')} AS qty_mom_pct FROM tml),
r AS (SELECT h.*, tm.prev_amount, tm.amount_mom_pct, tm.qty_mom_pct,
             store_id * 100000 + CAST(substr(period, 1, 4) AS INTEGER) * 12
               + CAST(substr(period, 6, 2) AS INTEGER) AS i
      FROM h LEFT JOIN tm USING (store_id, period))
"""

TEXTS = f"""
, r2 AS (SELECT *, '$' || format('{{:,.2f}}', CASE WHEN i % 5 = 0 THEN revenue + 6000.0 ELSE revenue END)
                   AS money, {month_label('period')} AS label FROM r),
tx AS (
  SELECT store_id, period, 'headline_title' AS field,
         (CASE WHEN amount_mom_pct IS NULL
               THEN 'Revenue ' || money || ' in ' || label || ', ' || CAST(orders AS VARCHAR) || ' orders.'
               WHEN i % 3 = 0
               THEN 'Revenue ' || CASE WHEN amount_mom_pct >= 0 THEN 'rose' ELSE 'fell' END || ' '
                    || printf('%.2f', abs(amount_mom_pct)) || '% to ' || money || ' in ' || label
                    || ', ' || CAST(orders AS VARCHAR) || ' orders.'
               ELSE 'Revenue ' || money || ' in ' || label || ' (' || printf('%+.2f', amount_mom_pct)
                    || '% on the month, ' || CAST(orders AS VARCHAR) || ' orders).' END)
         || CASE WHEN i % 4 = 0 THEN ' Promotion ran 15-23 Feb.' ELSE '' END AS text
  FROM r2
  UNION ALL
  SELECT store_id, period, 'trend_qty_title',
         CASE WHEN qty_mom_pct IS NULL THEN 'Units: ' || CAST(units AS VARCHAR) || ' sold.'
              ELSE 'Units ' || printf('%+.1f', {rnd('qty_mom_pct', 1)}) || '% month on month, '
                   || CAST(units AS VARCHAR) || ' units sold.' END
  FROM r)
"""


def tokens_cte(src: str, keys: str) -> str:
    return f"""
, tk0 AS (SELECT {keys}, regexp_extract_all(text, {TOKEN_RE}, 1) AS t1,
                 regexp_extract_all(text, {TOKEN_RE}, 2) AS t2 FROM {src} WHERE text IS NOT NULL),
tk1 AS (SELECT {keys}, t1, t2, unnest(generate_series(1, len(t1))) AS j FROM tk0),
tk2 AS (SELECT {keys}, j, TRY_CAST(replace(CASE WHEN starts_with(t1[j], '-') AND t2[j] <> ''
                                              THEN substr(t1[j], 2) ELSE t1[j] END, ',', '')
                                   AS DOUBLE) AS value FROM tk1),
toks AS (SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY j) - 1 AS INTEGER) AS pos,
                value FROM tk2 WHERE value IS NOT NULL)
"""


def _allowed(keys: str, with_strings: bool) -> str:
    nums = " UNION ALL ".join(
        f"SELECT {keys}, {rnd(c, d) if d else f'round_even(CAST({c} AS DOUBLE), 0)'} AS a FROM rs WHERE {c} IS NOT NULL"
        for c in NUM_COLS for d in (2, 1, 0))
    strings = (f" UNION ALL SELECT {keys}, CAST(unnest(regexp_extract_all(period, '[0-9]+')) AS DOUBLE)"
               f" FROM rs") if with_strings else ""
    prose = f" UNION ALL SELECT DISTINCT {keys}, unnest([{PROSE}]) FROM rs"
    return f", allowed AS ({nums}{strings}{prose})\n"


def _classify(keys_join: str) -> str:
    return f"""
, fnd AS (SELECT t.*,
            EXISTS (SELECT 1 FROM allowed a WHERE {keys_join} AND abs(t.value - a.a) <= 0.1) AS okk,
            EXISTS (SELECT 1 FROM allowed a WHERE {keys_join}
                    AND abs(abs(t.value) - abs(a.a)) <= 0.1) AS sg
          FROM toks t)
"""


STATUS = (f"CASE WHEN okk THEN 'ok' WHEN sg THEN 'sign_only' ELSE 'missing' END AS status, "
          f"CASE WHEN okk THEN NULL WHEN sg THEN {q(OK_MSG)} ELSE {q(MISS_MSG)} END AS message")


def sql() -> dict[str, str]:
    s: dict[str, str] = {}
    keys = "store_id, period, field"
    base = NUMBERS + TEXTS + tokens_cte("tx", keys)
    s["report_texts"] = with_star(NUMBERS + TEXTS + "SELECT store_id, period, field, text FROM tx")
    s["number_tokens"] = with_star(base + f"SELECT {keys}, pos, value FROM toks")
    status = STATUS
    rs = ", rs AS (SELECT * FROM r)\n"
    cls = rs + _allowed("store_id, period", True) + _classify(
        "a.store_id = t.store_id AND a.period = t.period")
    s["grounding_findings"] = with_star(base + cls + f"SELECT {keys}, pos, value, {status} FROM fnd")
    holiday = """
, hmonths AS (SELECT DISTINCT store_id, period FROM fact_sales),
hdays AS (SELECT period, unnest(list_concat(
            CASE WHEN CAST(substr(period, 6, 2) AS INTEGER) % 3 = 0 THEN [period || '-15', period || '-23'] ELSE [] END,
            CASE WHEN substr(period, 6, 2) = '12' THEN [period || '-27',
              CAST(CAST(substr(period, 1, 4) AS INTEGER) + 1 AS VARCHAR) || '-01-06'] ELSE [] END)) AS day
          FROM (SELECT DISTINCT period FROM hmonths)),
allowed AS (SELECT * FROM figures UNION ALL
            SELECT r.store_id, r.period, CAST(unnest(regexp_extract_all(h.day, '[0-9]+')) AS DOUBLE)
            FROM hmonths r JOIN hmonths c ON c.store_id = r.store_id AND c.period <= r.period
            JOIN hdays h ON h.period = c.period)
"""
    figures = rs + _allowed("store_id, period", True).replace(", allowed AS", ", figures AS")
    s["holiday_findings"] = with_star(
        base + figures + holiday + _classify("a.store_id = t.store_id AND a.period = t.period")
        + f"SELECT {keys}, pos, value, {status} FROM fnd")
    s["grounding_verdict"] = with_star(base + cls + """
SELECT store_id, period, COUNT(*) AS n_numbers, CAST(count_if(NOT okk AND NOT sg) AS BIGINT) AS n_missing,
       CAST(count_if(NOT okk AND sg) AS BIGINT) AS n_sign_only, count_if(NOT okk AND NOT sg) > 0 AS needs_review
FROM fnd GROUP BY store_id, period""")
    docs = (", dsrc AS (SELECT 'all' AS scope, doc_id, text FROM documents)\n"
            + tokens_cte("dsrc", "scope, doc_id").replace(", tk0", ", tk0", 1))
    drs = ", rs AS (SELECT *, 'all' AS scope FROM r)\n"
    s["document_grounding"] = with_star(NUMBERS + docs + drs + _allowed("scope", False)
                                        + _classify("a.scope = t.scope") + """
SELECT doc_id, COUNT(*) AS n_numbers, CAST(count_if(NOT okk AND NOT sg) AS BIGINT) AS n_missing,
       CAST(count_if(NOT okk AND sg) AS BIGINT) AS n_sign_only, count_if(NOT okk AND NOT sg) > 0 AS needs_review
FROM fnd GROUP BY doc_id""")
    s["json_leaves"] = with_star("""
, months AS (SELECT store_id, period, list(struct_pack(code := channel_code, qty := qty, amount := CAST(amount AS DOUBLE),
               path := 'C:\\' || channel_group || '\\', counts := [[order_count, NULL]], large := qty > 100)) AS lines
             FROM fact_channel GROUP BY 1, 2),
docs AS (SELECT store_id, to_json(struct_pack(months := list(struct_pack(
               period := period, note := '"' || period || '": [', lines := lines)))) AS j FROM months GROUP BY 1),
leaves AS (SELECT store_id, x.type AS t, x.atom AS a FROM docs, json_tree(docs.j) x
           WHERE x.type IN ('VARCHAR', 'BIGINT', 'UBIGINT', 'DOUBLE'))
SELECT store_id, CASE WHEN t = 'VARCHAR' THEN 'string' ELSE 'number' END AS kind,
       CASE WHEN t <> 'VARCHAR' THEN CAST(a AS DOUBLE) END AS num, CASE WHEN t = 'VARCHAR' THEN a ->> '$' END AS str,
       COUNT(*) AS n
FROM leaves GROUP BY ALL""")
    s["parsed_replies"] = with_star(NUMBERS + TEXTS + REPLIES + """
SELECT store_id, period, field, text FROM parsed""")
    s["rejected_replies"] = with_star(NUMBERS + TEXTS + REPLIES + """
SELECT store_id, period, reply FROM rep WHERE NOT coalesce(json_valid(cleaned), false)""")
    return s


FIELDS = ", ".join(q(f) for f in vocab.NARRATIVE_FIELDS)
REPLIES = f"""
, kv AS (SELECT store_id, period,
                string_agg('"' || field || '": "' || text || '"', ', ' ORDER BY field, text) AS body
         FROM tx GROUP BY store_id, period),
js0 AS (SELECT kv.store_id, kv.period, r.i,
               '{{' || body || CASE WHEN r.i % 2 = 0 THEN ', "mood": "upbeat"' ELSE '' END
                    || CASE WHEN r.i % 3 = 0 THEN ',' ELSE '' END || '}}' AS js
        FROM kv JOIN r USING (store_id, period)),
js1 AS (SELECT store_id, period, i, CASE WHEN i % 10 = 7 THEN substr(js, 1, 20) ELSE js END AS js
        FROM js0),
rep AS (SELECT store_id, period,
               CASE WHEN i % 4 = 1 THEN '```json' || chr(10) || js || chr(10) || '```' ELSE js END
                   AS reply,
               regexp_replace(regexp_replace(regexp_replace(
                   CASE WHEN i % 4 = 1 THEN '```json' || chr(10) || js || chr(10) || '```' ELSE js END,
                   '^\\s*```[a-zA-Z]*\\s*', ''), '\\s*```\\s*$', ''),
                   ',(\\s*[}}\\]])', '\\1', 'g') AS cleaned
        FROM js1),
keys AS (SELECT store_id, period, cleaned, unnest(json_keys(cleaned)) AS field FROM rep
         WHERE coalesce(json_valid(cleaned), false)),
parsed AS (SELECT store_id, period, field, json_extract_string(cleaned, '$."' || field || '"') AS text
           FROM keys WHERE field IN ({FIELDS}))
"""
