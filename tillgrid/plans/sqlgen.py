"""SQL text for the DuckDB oracle: the star-schema derivation and the rule
sets rendered as ANSI SQL.  Mirrors ``sources.star`` and ``functions.rules``
so every registered query can be checked against an independent engine."""

from __future__ import annotations

import difflib

from .. import vocab


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(xs) -> str:
    return ", ".join(q(x) for x in xs)


def rnd(x: str, n: int) -> str:
    """HALF_UP rounding of a DOUBLE through DECIMAL(38,10), as DOUBLE."""
    return f"CAST(round(CAST(({x}) AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def pct(part: str, total: str, n: int) -> str:
    return rnd(f"100.0 * CAST({part} AS DOUBLE) / NULLIF(CAST({total} AS DOUBLE), 0)", n)


def pct0(part: str, total: str, n: int) -> str:
    return f"COALESCE({pct(part, total, n)}, 0.0)"


def ratio(a: str, b: str, n: int) -> str:
    return rnd(f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)", n)


def mom(cur: str, prev: str, n: int = 2) -> str:
    return rnd(f"(CAST({cur} AS DOUBLE) - CAST({prev} AS DOUBLE)) * 100.0 "
               f"/ NULLIF(CAST({prev} AS DOUBLE), 0)", n)


def mom0(cur: str, prev: str, n: int = 2) -> str:
    return f"CASE WHEN CAST({prev} AS DOUBLE) = 0 THEN 0.0 ELSE {mom(cur, prev, n)} END"


def any_pattern(pats) -> str:
    return q("(?i)(?:" + "|".join(pats) + ")")


def keyword_guess(desc: str, rules: vocab.RuleSet) -> str:
    items = ", ".join(
        f"CASE WHEN regexp_matches(coalesce({desc}, ''), {any_pattern(p)}) THEN {q(c)} END"
        for c, p in rules.keyword_rules.items())
    hits = f"list_sort(list_filter([{items}], lambda x: x IS NOT NULL))"
    return (f"(CASE WHEN len({hits}) = 0 THEN '' WHEN len({hits}) = 1 THEN {hits}[1] "
            f"ELSE 'ambiguous:' || array_to_string({hits}, '+') END)")


def verdict(bc: str, guess: str) -> str:
    g = f"coalesce({guess}, '')"
    return (f"(CASE WHEN {bc} = 'excluded' THEN 'excluded' "
            f"WHEN {bc} IS NULL OR {bc} = '' THEN 'brand_not_classified' "
            f"WHEN {g} = '' THEN 'no_keyword_match' "
            f"WHEN starts_with({g}, 'ambiguous') THEN 'CONFLICT - name matches several categories (' "
            f"|| {g} || ') vs brand=' || {bc} "
            f"WHEN {g} = {bc} THEN 'match' "
            f"ELSE 'CONFLICT - name suggests ' || {g} || ', brand default is ' || {bc} END)")


def pickup(tag: str, export_tags=vocab.EXPORT_TAGS) -> str:
    t = f"trim({tag})"
    return f"({t} IS NULL OR {t} IN ('', 'nan', 'None', 'NaN') OR {t} NOT IN ({lst(export_tags)}))"


def shipping_for(cat: str, tag: str, export_tags=vocab.EXPORT_TAGS) -> str:
    t = f"trim(coalesce({tag}, ''))"
    return (f"(CASE WHEN {cat} IS NULL OR {cat} <> 'milk_powder' THEN 'not_applicable' "
            f"WHEN {t} = '' THEN 'local' WHEN {t} IN ({lst(export_tags)}) THEN 'export' "
            f"ELSE 'other:' || {t} END)")


def norm_brand(b: str) -> str:
    return f"regexp_replace(lower(trim({b})), '\\s+', ' ', 'g')"


def tight_brand(b: str) -> str:
    return f"replace({norm_brand(b)}, ' ', '')"


def spellings(name: str) -> dict[str, str]:
    """``sources.star.brand_spellings`` of a fixture brand."""
    return {"plain": name, "capitals": name.upper(), "dropped": name[:2] + name[3:],
            "joined": name.replace(" ", ""), "swapped": name[:3] + name[4:5] + name[3:4] + name[5:]}


def fuzzy_pairs(rules: vocab.RuleSet) -> dict[str, tuple[str, float]]:
    """Space-free spelling -> (known brand, ratio) of the fixture spellings that need the
    fuzzy stage, by plain difflib."""
    tight = {k.replace(" ", ""): k for k in rules.known_brands}
    found = {}
    for name in vocab.FIXTURE_BRANDS:
        for typed in spellings(name).values():
            t = typed.lower().replace(" ", "")
            if t in tight:
                continue
            ratios = [(difflib.SequenceMatcher(None, t, k).ratio(), -i, b) for i, (k, b) in enumerate(tight.items())]
            ratio, _, best = max(ratios)
            if ratio >= vocab.FUZZY_THRESHOLD:
                found[t] = (best, ratio)
    return found


def resolved_exact_tight(b: str, rules: vocab.RuleSet) -> str:
    n, t = norm_brand(b), tight_brand(b)
    tight_map = {}
    for k in rules.known_brands:
        tight_map[k.replace(" ", "")] = k
    whens = " ".join(f"WHEN {t} = {q(k)} THEN {q(v)}" for k, v in tight_map.items())
    return f"(CASE WHEN {n} IN ({lst(rules.known_brands)}) THEN {n} {whens} ELSE NULL END)"


def resolved_brand(b: str, rules: vocab.RuleSet) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, (v, _) in fuzzy_pairs(rules).items())
    return f"coalesce({resolved_exact_tight(b, rules)}, CASE {tight_brand(b)} {whens} END)"


def resolve_how(b: str, rules: vocab.RuleSet) -> str:
    n = norm_brand(b)
    return (f"(CASE WHEN {n} IN ({lst(rules.known_brands)}) THEN 'exact' "
            f"WHEN {resolved_exact_tight(b, rules)} IS NOT NULL THEN 'tight' "
            f"WHEN {resolved_brand(b, rules)} IS NOT NULL THEN 'fuzzy' ELSE 'none' END)")


def tier_parts(rb: str, desc: str, tag: str, rules: vocab.RuleSet) -> tuple[str, str]:
    d = f"lower(coalesce({desc}, ''))"
    pk = pickup(tag, rules.export_tags)
    tier = [f"CASE WHEN {rb} IS NULL THEN 'regular'",
            f"WHEN {rb} IN ({lst(rules.premium_brands)}) THEN 'premium'"]
    reason = [f"CASE WHEN {rb} IS NULL THEN 'brand has no tier rule'",
              f"WHEN {rb} IN ({lst(rules.premium_brands)}) THEN {rb} || ': whole brand is premium'"]
    for r in rules.sku_rules:
        if r.keywords is None:
            t_body, r_body = "'premium'", q(r.note)
        else:
            hits = f"list_filter([{lst(r.keywords)}], lambda k: contains({d}, k))"
            t_body = f"CASE WHEN len({hits}) > 0 THEN 'premium' ELSE 'regular' END"
            r_body = (f"CASE WHEN len({hits}) > 0 THEN {q(r.note + ' (matched ')} || "
                      f"array_to_string({hits}, '/') || ')' "
                      f"ELSE {q(f'{r.brand}: no keyword match ({chr(47).join(r.keywords)})')} END")
        if r.local_pickup_only:
            t_body = f"CASE WHEN NOT {pk} THEN 'regular' ELSE {t_body} END"
            r_body = (f"CASE WHEN NOT {pk} THEN {q(r.brand + ': ships out, rule is pickup-only')} "
                      f"ELSE {r_body} END")
        tier.append(f"WHEN {rb} = {q(r.brand)} THEN ({t_body})")
        reason.append(f"WHEN {rb} = {q(r.brand)} THEN ({r_body})")
    return " ".join(tier) + " ELSE 'regular' END", " ".join(reason) + " ELSE 'default' END"


def product_type(cat: str, desc: str, rules: vocab.RuleSet) -> str:
    whens = " ".join(f"WHEN regexp_matches(coalesce({desc}, ''), {any_pattern(p)}) THEN {q(n)}"
                     for n, p in rules.type_rules)
    return (f"(CASE WHEN {cat} IS NULL OR {cat} <> 'supplement' THEN 'not_applicable' {whens} "
            f"ELSE {q(vocab.CATCH_ALL_TYPE)} END)")


def report_bucket(cat: str, tier: str) -> str:
    return f"(CASE WHEN {cat} = 'milk_powder' THEN 'milk_powder' ELSE {tier} END)"


RPT = "(SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders)"
CATS = "[" + lst(vocab.CATEGORIES) + "]"
BRANDS = "[" + lst(vocab.FIXTURE_BRANDS) + "]"
DROPPED = "substr(name, 1, 2) || substr(name, 4)"
JOINED = "replace(name, ' ', '')"
SWAPPED = "substr(name, 1, 3) || substr(name, 5, 1) || substr(name, 4, 1) || substr(name, 6)"


def star_ctes(rules: vocab.RuleSet = vocab.FIXTURE_RULES, through_rpt: bool = False) -> str:
    """WITH-list defining fact_sales, products, brand_categories, overrides,
    known, classified, dim_product, sales, fact_channel, context_src."""
    through = f"WHERE strftime(l.l_shipdate, '%Y-%m') <= {RPT}" if through_rpt else ""
    through_o = f"WHERE strftime(o.o_orderdate, '%Y-%m') <= {RPT}" if through_rpt else ""
    tier_sql, reason_sql = tier_parts("rb", "product_desc", "freight_tag", rules)
    return f"""
supplier_store AS (
  SELECT s.s_suppkey, n.n_regionkey AS store_id
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
sales_lines AS (
  SELECT l.l_orderkey, l.l_partkey AS partkey, strftime(l.l_shipdate, '%Y-%m') AS period,
         ss.store_id, CAST(l.l_quantity AS BIGINT) AS qty,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS amount
  FROM lineitem l JOIN supplier_store ss ON l.l_suppkey = ss.s_suppkey {through}),
fact_sales AS (
  SELECT partkey, period, store_id, COUNT(DISTINCT l_orderkey) AS order_count,
         CAST(SUM(qty) AS BIGINT) AS qty, SUM(amount) AS amount,
         'SKU' || CAST(partkey AS VARCHAR) AS sku_code
  FROM sales_lines GROUP BY partkey, period, store_id),
products AS (
  SELECT p_partkey AS partkey, 'SKU' || CAST(p_partkey AS VARCHAR) AS sku_code,
         CASE WHEN p_partkey % 7 = 0 THEN upper(name) WHEN p_partkey % 19 = 3 THEN {DROPPED}
              WHEN p_partkey % 19 = 7 THEN {JOINED} WHEN p_partkey % 19 = 11 THEN {SWAPPED}
              ELSE name END AS brand, bn,
         p_name || ' ' || lower(p_type) AS product_desc,
         CASE WHEN p_size = 50 THEN 'Drone Courier' WHEN p_size % 4 = 1 THEN 'Express Freight'
              WHEN p_size % 4 = 2 THEN 'Standard Freight' WHEN p_size % 4 = 3 THEN '15-Day Express'
              ELSE '' END AS freight_tag
  FROM (SELECT *, {BRANDS}[bn] AS name FROM (
        SELECT *, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS bn FROM part))),
brand_categories AS (
  SELECT name || '/' || upper(name) || '/' || {DROPPED} || '/' || {JOINED} AS brand_variants,
         CASE WHEN bn = 25 THEN '' ELSE {CATS}[bn % 6 + 1] END AS confirmed_category,
         CAST(bn AS BIGINT) AS line_no
  FROM (SELECT *, {BRANDS}[bn] AS name FROM (
        SELECT DISTINCT p_brand, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS bn FROM part))),
brand_cat AS (
  SELECT lower(trim(v)) AS brand_key, max_by(category, line_no) AS category
  FROM (SELECT unnest(string_split(brand_variants, '/')) AS v,
               coalesce(trim(confirmed_category), '') AS category, line_no
        FROM brand_categories)
  GROUP BY 1),
overrides AS (
  SELECT 'SKU' || CAST(p_partkey AS VARCHAR) AS sku_code, 'supplement' AS override_category
  FROM part WHERE p_partkey % 50 = 0),
reviewed AS (
  SELECT 'SKU' || CAST(p_partkey AS VARCHAR) AS sku_code FROM part WHERE p_partkey % 13 = 0),
known AS (
  SELECT sku_code, brand, product_desc, cat AS category,
         CASE WHEN bn <= 4 THEN 'premium' ELSE 'regular' END AS tier,
         {shipping_for('cat', 'freight_tag')} AS shipping_channel
  FROM (SELECT *, {CATS}[(bn + 1) % 6 + 1] AS cat FROM products WHERE partkey % 3 = 0)),
classified0 AS (
  SELECT p.*, lower(trim(p.brand)) AS brand_key,
         coalesce(nullif(k.category, ''), nullif(o.override_category, ''),
                  nullif(b.category, ''), '') AS category,
         (nullif(k.category, '') IS NOT NULL OR nullif(k.tier, '') IS NOT NULL) AS is_known,
         nullif(o.override_category, '') IS NOT NULL AS was_overridden,
         nullif(k.tier, '') AS k_tier, nullif(k.shipping_channel, '') AS k_shipping,
         {resolved_brand('p.brand', rules)} AS rb,
         {resolve_how('p.brand', rules)} AS resolve_how
  FROM products p
  LEFT JOIN brand_cat b ON lower(trim(p.brand)) = b.brand_key
  LEFT JOIN overrides o ON p.sku_code = o.sku_code
  LEFT JOIN known k ON p.sku_code = k.sku_code),
classified AS (
  SELECT partkey, sku_code, brand, bn, product_desc, freight_tag, brand_key, category, is_known,
         was_overridden, rb AS resolved_brand, resolve_how,
         coalesce(k_tier, {tier_sql}) AS tier,
         CASE WHEN k_tier IS NOT NULL THEN 'known SKU' ELSE {reason_sql} END AS tier_reason,
         coalesce(k_shipping, {shipping_for('category', 'freight_tag', rules.export_tags)})
             AS shipping_channel
  FROM classified0),
dim_product AS (
  SELECT partkey, sku_code, brand, product_desc, category, tier, shipping_channel,
         {product_type('category', 'product_desc', rules)} AS product_type
  FROM classified),
sales AS (
  SELECT f.partkey, f.period, f.store_id, f.order_count, f.qty, f.amount, f.sku_code,
         d.brand, d.product_desc, d.category, d.tier, d.shipping_channel, d.product_type
  FROM fact_sales f JOIN dim_product d ON f.partkey = d.partkey),
cust_store AS (
  SELECT c.c_custkey, n.n_regionkey AS store_id
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
fact_channel AS (
  SELECT period, store_id, channel_code, COUNT(DISTINCT o_orderkey) AS order_count,
         CAST(SUM(qty) AS BIGINT) AS qty, SUM(amount) AS amount,
         CASE WHEN channel_code IN ('member_price', 'wholesale') THEN 'local' ELSE 'export' END
             AS channel_group
  FROM (SELECT strftime(o.o_orderdate, '%Y-%m') AS period, cs.store_id,
               CASE o.o_orderpriority WHEN '1-URGENT' THEN 'member_price'
                    WHEN '2-HIGH' THEN 'wholesale' WHEN '3-MEDIUM' THEN 'export_gst_free'
                    WHEN '4-NOT SPECIFIED' THEN 'wechat_pay' WHEN '5-LOW' THEN 'courier_export'
               END AS channel_code,
               o.o_orderkey, CAST(l.l_quantity AS BIGINT) AS qty,
               CAST(l.l_extendedprice AS DECIMAL(12,2)) AS amount
        FROM orders o JOIN cust_store cs ON o.o_custkey = cs.c_custkey
        JOIN lineitem l ON o.o_orderkey = l.l_orderkey {through_o})
  GROUP BY period, store_id, channel_code),
context_src AS (
  SELECT CAST(store_id * 100000 + mnum AS BIGINT) AS line_no, store_id,
         CASE WHEN store_id = 4 AND period = '1995-01' THEN '1995-1' ELSE period END AS period,
         CASE WHEN (mnum + store_id) % 10 = 0 THEN ' ' ELSE CAST(ft AS VARCHAR) END AS foot_traffic,
         CAST(leads AS VARCHAR) AS miniprogram_leads,
         CAST(round(CAST(100.0 * n_f / n AS DECIMAL(38,10)), 2) AS VARCHAR)
             AS miniprogram_completion_rate,
         CASE WHEN leads % 3 = 0 THEN 'Yes' END AS study_tour_flag,
         CASE WHEN leads % 3 = 0 THEN 'group of ' || CAST(leads AS VARCHAR) END AS study_tour_note,
         CASE WHEN n % 2 = 0 THEN 'Member night; tasting, ;window display' END
             AS activity_description
  FROM (SELECT cs.store_id, strftime(o.o_orderdate, '%Y-%m') AS period,
               COUNT(DISTINCT o.o_custkey) AS ft,
               count_if(o.o_orderstatus = 'P') AS leads,
               count_if(o.o_orderstatus = 'F') AS n_f, COUNT(*) AS n,
               CAST(strftime(o.o_orderdate, '%Y') AS INTEGER) * 12
                 + CAST(strftime(o.o_orderdate, '%m') AS INTEGER) AS mnum
        FROM orders o JOIN cust_store cs ON o.o_custkey = cs.c_custkey
        GROUP BY cs.store_id, strftime(o.o_orderdate, '%Y-%m'), mnum)),
context_rows AS (
  SELECT store_id, period,
         TRY_CAST(foot_traffic AS INTEGER) AS foot_traffic,
         TRY_CAST(miniprogram_leads AS INTEGER) AS miniprogram_leads,
         TRY_CAST(miniprogram_completion_rate AS DECIMAL(5,2)) AS miniprogram_completion_rate,
         lower(coalesce(study_tour_flag, 'no')) AS study_tour_flag,
         study_tour_note, activity_description
  FROM (SELECT store_id, nullif(trim(period), '') AS period,
               nullif(trim(foot_traffic), '') AS foot_traffic,
               nullif(trim(miniprogram_leads), '') AS miniprogram_leads,
               nullif(trim(miniprogram_completion_rate), '') AS miniprogram_completion_rate,
               nullif(trim(study_tour_flag), '') AS study_tour_flag,
               nullif(trim(study_tour_note), '') AS study_tour_note,
               nullif(trim(activity_description), '') AS activity_description,
               row_number() OVER (PARTITION BY store_id, nullif(trim(period), '')
                                  ORDER BY line_no DESC) AS rn
        FROM context_src
        WHERE nullif(trim(period), '') IS NOT NULL
          AND regexp_matches(trim(period), '^\\d{{4}}-\\d{{2}}$'))
  WHERE rn = 1)"""


def with_star(body: str, rules: vocab.RuleSet = vocab.FIXTURE_RULES,
              through_rpt: bool = False) -> str:
    return "WITH " + star_ctes(rules, through_rpt).strip() + "\n" + body
