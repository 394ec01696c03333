"""DuckDB oracle SQL for name matching.  SQL has no Ratcliff-Obershelp ratio, so the pairs of
fixture spellings and their ratios are listed as values, computed by plain difflib."""

from __future__ import annotations

import difflib

from .. import vocab
from .sqlgen import fuzzy_pairs, q, resolve_how, resolved_brand, spellings, tight_brand, with_star

R = vocab.FIXTURE_RULES
KEYS = sorted({s.lower() for b in vocab.FIXTURE_BRANDS for s in spellings(b).values()})


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(q(x) if isinstance(x, str) else repr(x) for x in r) + ")" for r in rows)


def close_pairs() -> str:
    """CTEs: ``near`` (new_key, known_key, ratio) over all spellings; ``keys`` the decided ones;
    ``close`` the best two decided names of each key."""
    rows = [(new, known, r) for new in KEYS for known in KEYS
            if (r := difflib.SequenceMatcher(None, known, new).ratio()) >= vocab.CLOSE_NAME_CUTOFF]
    return f"""
, near(new_key, known_key, ratio) AS (VALUES {_values(rows)}),
keys AS (SELECT DISTINCT lower(trim(unnest(string_split(brand_variants, '/')))) AS known_key FROM brand_categories
         WHERE coalesce(trim(confirmed_category), '') <> ''),
close AS (SELECT new_key, known_key, CAST(ratio AS DOUBLE) AS ratio,
                 row_number() OVER (PARTITION BY new_key ORDER BY ratio DESC, known_key DESC) AS rank
          FROM near JOIN keys USING (known_key) QUALIFY rank <= {vocab.CLOSE_NAME_COUNT})
"""


def sql() -> dict[str, str]:
    s: dict[str, str] = {}
    ratios = " ".join(f"WHEN {q(k)} THEN {round(r, 3)!r}" for k, (_, r) in fuzzy_pairs(R).items())
    resolution = f"""
, res AS (SELECT brand, {resolved_brand('brand', R)} AS resolved_brand, {resolve_how('brand', R)} AS how
          FROM (SELECT DISTINCT brand FROM products)),
rated AS (SELECT *, CASE WHEN how = 'fuzzy' THEN CAST(CASE {tight_brand('brand')} {ratios} END AS DOUBLE) END
          AS ratio FROM res)
"""
    s["brand_resolution"] = with_star(resolution + "SELECT brand, resolved_brand, how, ratio FROM rated")
    s["fuzzy_merges"] = with_star(resolution + """
SELECT brand AS raw, resolved_brand AS matched, ratio FROM rated WHERE how = 'fuzzy'""")
    s["classified_fuzzy"] = with_star("""
SELECT sku_code, brand, resolved_brand, resolve_how, tier, tier_reason FROM classified""")
    s["close_names"] = with_star(close_pairs() + """
SELECT new_key AS brand_key, CAST(rank AS INTEGER) AS rank, known_key AS close_name, round(ratio, 3) AS ratio
FROM close JOIN brand_cat ON new_key = brand_key WHERE category = ''""")
    names = sorted(b.lower() for b in vocab.FIXTURE_BRANDS)
    rows = [(a, b, round(r, 3), r >= vocab.FUZZY_THRESHOLD) for a in names for b in names
            if a < b and (r := difflib.SequenceMatcher(None, a, b).ratio()) >= 0.3]
    s["brand_headroom"] = with_star(f"""
, pairs(brand_a, brand_b, ratio, merged) AS (VALUES {_values(rows)}),
own AS (SELECT lower(split_part(brand_variants, '/', 1)) AS b FROM brand_categories)
SELECT brand_a, brand_b, CAST(ratio AS DOUBLE) AS ratio, merged FROM pairs
WHERE brand_a IN (SELECT b FROM own) AND brand_b IN (SELECT b FROM own)""")
    return s
