"""DuckDB oracle SQL for the ingest slice (wide sheets, parse, unpivot)."""

from __future__ import annotations

from .. import vocab
from ..sources.fixtures import BAD_CELLS
from .sqlgen import q, with_star

P = vocab.PRODUCT_PATTERN
TAG = vocab.FREIGHT_TAG_PATTERN
MONTHS = vocab.MONTH_PREFIXES


def _month_aggs(src_m: str = "m") -> str:
    out = []
    for i, p in enumerate(MONTHS, start=1):
        out += [f"CAST(max(CASE WHEN {src_m} = {i} THEN order_count END) AS VARCHAR) AS {p}_order",
                f"CAST(max(CASE WHEN {src_m} = {i} THEN qty END) AS VARCHAR) AS {p}_qty",
                f"CAST(max(CASE WHEN {src_m} = {i} THEN amount END) AS VARCHAR) AS {p}_amt"]
    return ",\n       ".join(out)


def _cols(with_total: bool) -> list[str]:
    cols = [f"{p}_{s}" for p in MONTHS for s in ("order", "qty", "amt")]
    return cols + (["total_order", "total_qty", "total_amt"] if with_total else [])


def sales_sheets_cte(with_total: bool) -> str:
    cols = _cols(with_total)
    tot = (",\n       CAST(SUM(order_count) AS VARCHAR) AS total_order, CAST(SUM(qty) AS VARCHAR)"
           " AS total_qty, CAST(SUM(amount) AS VARCHAR) AS total_amt") if with_total else ""
    pname = ("CASE WHEN p.partkey % 89 = 5 THEN NULL WHEN p.partkey % 89 = 6 THEN 'Total' "
             "WHEN p.partkey % 89 = 7 THEN 'Order' WHEN p.partkey % 97 = 0 THEN '[DIS' || CAST(p.partkey AS VARCHAR) || '] $5 off' "
             "ELSE '[' || p.sku_code || ']' || CASE WHEN p.partkey % 11 = 0 THEN '  ' ELSE ' ' END || "
             "'[' || p.brand || ']' || p.product_desc || CASE WHEN p.freight_tag <> '' THEN '{' || "
             "p.freight_tag || '}' ELSE '' END END")
    clist = ", ".join(cols)
    return f"""
, fsm AS (SELECT *, CAST(substr(period, 1, 4) AS INTEGER) AS year,
                 CAST(substr(period, 6, 2) AS INTEGER) AS m FROM fact_sales),
lines AS (SELECT store_id, year, partkey,
       {_month_aggs()}{tot}
  FROM fsm GROUP BY store_id, year, partkey),
named AS (SELECT l.store_id, l.year, {pname} AS product_name, {", ".join('l.' + c for c in cols)}
          FROM lines l JOIN products p ON l.partkey = p.partkey),
sheets AS (SELECT store_id, year, product_name, {clist} FROM named)"""


def _num(c: str, typ: str) -> str:
    return f"TRY_CAST(replace({c}, ',', '') AS {typ})"


def parsed_cte(with_total: bool) -> str:
    if with_total:
        totals = "total_order, total_qty, total_amt"
    else:
        def tsum(s: str, typ: str) -> str:
            terms = " + ".join(f"coalesce({_num(f'{p}_{s}', typ)}, 0)" for p in MONTHS)
            return f"CAST(CAST({terms} AS {typ}) AS VARCHAR) AS total_{s}"
        totals = ", ".join([tsum("order", "BIGINT"), tsum("qty", "BIGINT"),
                            tsum("amt", "DECIMAL(38,2)")])
    mcols = ", ".join(_cols(False))
    non_product = " OR ".join([f"starts_with(sku_code, {q(p)})" for p in vocab.NON_PRODUCT_PREFIXES])
    return f"""
, body AS (SELECT store_id, year, trim(regexp_replace(product_name, '\\s+', ' ', 'g')) AS product_name,
                  {mcols}, {totals}
           FROM sheets),
parsed AS (SELECT *,
             CASE WHEN regexp_matches(product_name, {q(P)}) THEN regexp_extract(product_name, {q(P)}, 1) END
                 AS sku_code,
             CASE WHEN regexp_matches(product_name, {q(P)}) THEN regexp_extract(product_name, {q(P)}, 2) END
                 AS brand_raw,
             CASE WHEN regexp_matches(product_name, {q(P)}) THEN regexp_extract(product_name, {q(P)}, 3)
                  ELSE product_name END AS desc0
           FROM body),
excluded AS (SELECT * FROM parsed WHERE sku_code IS NULL OR {non_product}),
kept AS (SELECT store_id, year, sku_code, trim(brand_raw) AS brand,
                regexp_extract(coalesce(desc0, ''), {q(TAG)}, 1) AS freight_tag,
                trim(regexp_replace(desc0, {q(TAG)}, '', 'g')) AS product_desc,
                {mcols}, total_order, total_qty, total_amt
         FROM parsed WHERE NOT (sku_code IS NULL OR {non_product}))"""


def unpivot_cte(src: str, key: str = "sku_code") -> str:
    structs = ", ".join(
        f"struct_pack(mm := '{i:02d}', o := {p}_order, q := {p}_qty, a := {p}_amt)"
        for i, p in enumerate(MONTHS, start=1))
    return f"""
, stacked AS (SELECT store_id, year, {key} AS sku_code, unnest([{structs}]) AS x FROM {src}),
long AS (SELECT store_id, sku_code, CAST(year AS VARCHAR) || '-' || x.mm AS period,
                {_num('x.o', 'BIGINT')} AS order_count, {_num('x.q', 'BIGINT')} AS qty,
                {_num('x.a', 'DECIMAL(28,2)')} AS amount FROM stacked),
unpiv AS (SELECT * FROM long
          WHERE NOT (order_count IS NULL AND qty IS NULL AND amount IS NULL))"""


def channel_sheets_cte() -> str:
    labels = " ".join(f"WHEN {q(v)} THEN {q(k)}" for k, v in vocab.CHANNEL_CODES.items())
    cols = _cols(False)
    clist = ", ".join(cols)
    return f"""
, fcm AS (SELECT *, CAST(substr(period, 1, 4) AS INTEGER) AS year,
                 CAST(substr(period, 6, 2) AS INTEGER) AS m,
                 CASE channel_code {labels} END AS channel_name FROM fact_channel),
crow AS (SELECT store_id, year, channel_name, {_month_aggs()} FROM fcm
         GROUP BY store_id, year, channel_name),
cbody AS (SELECT store_id, year, channel_name, {clist} FROM crow),
ccoded AS (SELECT *, CASE trim(channel_name) {" ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in vocab.CHANNEL_CODES.items())} END
                  AS code FROM cbody)"""


def sql() -> dict[str, str]:
    s: dict[str, str] = {}
    narrow = sales_sheets_cte(False) + parsed_cte(False)
    wide_ = sales_sheets_cte(True) + parsed_cte(True)
    s["sheet_products"] = with_star(narrow + """
SELECT store_id, year, sku_code, brand, product_desc, freight_tag,
       CAST(total_order AS BIGINT) AS total_order, CAST(total_qty AS BIGINT) AS total_qty,
       CAST(CAST(total_amt AS DECIMAL(28,2)) AS DOUBLE) AS total_amt FROM kept""")
    s["sheet_excluded"] = with_star(narrow + """
SELECT store_id, year, product_name, CAST(total_order AS BIGINT) AS total_order,
       CAST(total_qty AS BIGINT) AS total_qty,
       CAST(CAST(total_amt AS DECIMAL(28,2)) AS DOUBLE) AS total_amt FROM excluded""")
    s["sheet_unpivot"] = with_star(wide_ + unpivot_cte("kept") + """
SELECT store_id, sku_code, period, order_count, qty, CAST(amount AS DOUBLE) AS amount FROM unpiv""")
    s["unpivot_reconcile"] = with_star(wide_ + unpivot_cte("kept") + """
, src AS (SELECT store_id, year, SUM(TRY_CAST(total_amt AS DECIMAL(28,2))) AS source_amount
          FROM kept GROUP BY 1, 2),
facts AS (SELECT store_id, CAST(substr(period, 1, 4) AS INTEGER) AS year, SUM(amount) AS fact_amount
          FROM unpiv GROUP BY 1, 2)
SELECT coalesce(src.store_id, facts.store_id) AS store_id, coalesce(src.year, facts.year) AS year,
       CAST(fact_amount AS DOUBLE) AS fact_amount, CAST(source_amount AS DOUBLE) AS source_amount,
       CAST(coalesce(fact_amount, 0) - coalesce(source_amount, 0) AS DOUBLE) AS diff,
       abs(coalesce(fact_amount, 0) - coalesce(source_amount, 0)) <= 0.01 AS ok
FROM src FULL JOIN facts ON src.store_id = facts.store_id AND src.year = facts.year""")
    s["unpivot_month_counts"] = with_star(wide_ + unpivot_cte("kept") + """
SELECT store_id, period, COUNT(*) AS n_rows, CAST(SUM(amount) AS DOUBLE) AS amount
FROM unpiv GROUP BY store_id, period""")
    s["freight_tag_counts"] = with_star(narrow + """
SELECT store_id, year, CASE WHEN freight_tag = '' THEN '(none)' ELSE freight_tag END AS freight_tag,
       COUNT(*) AS n FROM kept GROUP BY 1, 2, 3""")
    s["brands_seen"] = with_star(narrow + """
SELECT store_id, year, COUNT(DISTINCT lower(trim(brand))) AS n_brands FROM kept GROUP BY 1, 2""")
    groups = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in vocab.CHANNEL_GROUP.items())
    s["channel_unpivot"] = with_star(channel_sheets_cte() + unpivot_cte("ccoded", key="code") + f"""
SELECT store_id, sku_code AS channel_code, period, order_count, qty, CAST(amount AS DOUBLE) AS amount,
       CASE sku_code {groups} END AS channel_group FROM unpiv""")
    s["unknown_channels"] = with_star(channel_sheets_cte() + """
SELECT store_id, year, channel_name FROM ccoded WHERE code IS NULL
UNION ALL SELECT DISTINCT store_id, year, 'Fax' FROM crow""")
    bad = {cell: f"CASE WHEN ends_with(sku_code, {q(end)}) THEN {q(value)} ELSE {cell} END"
           for end, cell, value in BAD_CELLS}
    cells = ", ".join(
        f"struct_pack(cell := {q(c)}, value := {c}, bad := "
        f"{_num(c, 'DECIMAL(28,2)' if c.endswith('amt') else 'BIGINT')} IS NULL)" for c in _cols(True))
    s["sheet_rejects"] = with_star(wide_ + f"""
, marked AS (SELECT * REPLACE ({", ".join(f"{e} AS {c}" for c, e in bad.items())}) FROM kept),
cells AS (SELECT store_id, year, sku_code, unnest([{cells}]) AS x FROM marked)
SELECT store_id, year, sku_code, x.cell AS cell, x.value AS value FROM cells
WHERE x.bad AND trim(x.value) <> ''""")
    return s
