"""Classification rules as native Spark expressions.

Rule sets are small, bounded lists (``vocab.RuleSet``); each one is compiled
into a ``when`` chain / ``rlike`` test here, so classification runs inside
whole-stage codegen with no Python in the row path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from .numeric import col
from .text import normalise_brand, tight_brand


def _any_pattern(patterns: list[str]) -> str:
    return "(?i)(?:" + "|".join(patterns) + ")"


def keyword_guess(desc: str | Column, rules: vocab.RuleSet) -> Column:
    """One category hit -> that category; several -> 'ambiguous:a+b'
    (sorted); none -> ''."""
    d = F.coalesce(col(desc), F.lit(""))
    hits = F.filter(
        F.array(*[F.when(d.rlike(_any_pattern(pats)), F.lit(cat))
                  for cat, pats in rules.keyword_rules.items()]),
        lambda x: x.isNotNull())
    hits = F.array_sort(hits)
    return (F.when(F.size(hits) == 0, F.lit(""))
            .when(F.size(hits) == 1, F.element_at(hits, 1))
            .otherwise(F.concat(F.lit("ambiguous:"), F.array_join(hits, "+"))))


def verdict(brand_category: str | Column, guess: str | Column) -> Column:
    """P10: excluded -> brand_not_classified -> no_keyword_match ->
    CONFLICT(ambiguous) -> match -> CONFLICT(different)."""
    bc = col(brand_category)
    g = F.coalesce(col(guess), F.lit(""))
    return (F.when(bc == vocab.EXCLUDED_CATEGORY, F.lit(vocab.VERDICT_EXCLUDED))
            .when(bc.isNull() | (bc == ""), F.lit(vocab.VERDICT_NO_BRAND))
            .when(g == "", F.lit(vocab.VERDICT_NO_KEYWORD))
            .when(g.startswith("ambiguous"), fill(vocab.VERDICT_AMBIGUOUS, guess=g, brand=bc))
            .when(g == bc, F.lit(vocab.VERDICT_MATCH))
            .otherwise(fill(vocab.VERDICT_DIFFERENT, guess=g, brand=bc)))


def fill(template: str, **parts: Column) -> Column:
    """A fixed message template with column values in its {placeholders}."""
    import re
    pieces = []
    for i, tok in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            pieces.append(parts[tok])
        elif tok:
            pieces.append(F.lit(tok))
    return F.concat(*pieces)


def is_local_pickup(tag: str | Column, export_tags: list[str] = vocab.EXPORT_TAGS) -> Column:
    """No tag (or a blank / 'nan' / 'None') -> pickup; unknown tag -> pickup."""
    t = F.trim(col(tag))
    return (t.isNull() | t.isin("", "nan", "None", "NaN") | ~t.isin(*export_tags))


def is_unknown_tag(tag: str | Column, export_tags: list[str] = vocab.EXPORT_TAGS) -> Column:
    """Q5 predicate: a non-blank tag that is not a known export tag."""
    t = F.trim(col(tag))
    return t.isNotNull() & ~t.isin("", "nan", "None", "NaN") & ~t.isin(*export_tags)


def shipping_for(category: str | Column, tag: str | Column,
                 export_tags: list[str] = vocab.EXPORT_TAGS) -> Column:
    """Non-milk-powder -> not_applicable; no tag -> local; known tag ->
    export; otherwise 'other:<tag>'."""
    t = F.trim(F.coalesce(col(tag), F.lit("")))
    c = col(category)
    return (F.when(c.isNull() | (c != "milk_powder"), F.lit(vocab.NOT_APPLICABLE))
            .when(t == "", F.lit("local"))
            .when(t.isin(*export_tags), F.lit("export"))
            .otherwise(F.concat(F.lit("other:"), t)))


def resolve_brand_exact_tight(raw_brand: str | Column, rules: vocab.RuleSet) -> Column:
    """J14 stages 1-2: struct(brand, how) with how in exact / tight; NULL
    brand when neither stage matches (the fuzzy stage is a separate join,
    see operators.fuzzy)."""
    n = normalise_brand(raw_brand)
    t = tight_brand(raw_brand)
    known = rules.known_brands
    tight_map = {}
    for b in known:  # later entries win, as in a dict built from the list
        tight_map[b.replace(" ", "")] = b
    tight_expr = F.element_at(F.create_map(*[F.lit(x) for kv in tight_map.items() for x in kv]), t)
    brand = F.when(n.isin(*known), n).otherwise(tight_expr)
    how = (F.when(n.isin(*known), F.lit("exact"))
           .when(tight_expr.isNotNull(), F.lit("tight"))
           .otherwise(F.lit("none")))
    return F.struct(brand.alias("brand"), how.alias("how"))


def tier_for(resolved: str | Column, desc: str | Column, tag: str | Column,
             rules: vocab.RuleSet) -> Column:
    """struct(tier, reason) from the resolved brand."""
    b = col(resolved)
    d = F.lower(F.coalesce(col(desc), F.lit("")))
    pickup = is_local_pickup(tag, rules.export_tags)
    prem = F.struct(F.lit("premium").alias("tier"),
                    fill(vocab.TIER_WHOLE_BRAND, brand=b).alias("reason"))
    out = (F.when(b.isNull(), F.struct(F.lit("regular").alias("tier"),
                                       F.lit(vocab.TIER_NO_RULE).alias("reason")))
           .when(b.isin(*rules.premium_brands), prem))
    for rule in rules.sku_rules:
        if rule.keywords is None:
            body = F.struct(F.lit("premium").alias("tier"), F.lit(rule.note).alias("reason"))
        else:
            hit = F.filter(F.array(*[F.lit(k) for k in rule.keywords]), lambda k: d.contains(k))
            body = F.when(F.size(hit) > 0, F.struct(
                F.lit("premium").alias("tier"),
                fill(vocab.TIER_MATCHED, note=F.lit(rule.note), hits=F.array_join(hit, "/"))
                .alias("reason"))).otherwise(F.struct(
                    F.lit("regular").alias("tier"),
                    F.lit(vocab.TIER_NO_KEYWORD.format(brand=rule.brand,
                                                       keywords="/".join(rule.keywords)))
                    .alias("reason")))
        if rule.local_pickup_only:
            body = F.when(~pickup, F.struct(
                F.lit("regular").alias("tier"),
                F.lit(vocab.TIER_SHIPS_OUT.format(brand=rule.brand)).alias("reason"))
            ).otherwise(body)
        out = out.when(b == rule.brand, body)
    return out.otherwise(F.struct(F.lit("regular").alias("tier"),
                                  F.lit(vocab.TIER_DEFAULT).alias("reason")))


def product_type_for(category: str | Column, desc: str | Column, rules: vocab.RuleSet) -> Column:
    """First matching type rule for supplements; catch-all otherwise."""
    d = F.coalesce(col(desc), F.lit(""))
    c = col(category)
    out = F.when(c.isNull() | (c != "supplement"), F.lit(vocab.NOT_APPLICABLE))
    for name, pats in rules.type_rules:
        out = out.when(d.rlike(_any_pattern(pats)), F.lit(name))
    return out.otherwise(F.lit(vocab.CATCH_ALL_TYPE))


def report_bucket(category: str | Column, tier: str | Column) -> Column:
    """Milk powder is its own bucket, otherwise the tier."""
    return F.when(col(category) == "milk_powder", F.lit("milk_powder")).otherwise(col(tier))


def variant_bucket(category: str | Column, tier: str | Column, overridden: str | Column) -> Column:
    """Import-summary bucket — milk powder unless overridden."""
    return F.when((col(category) == "milk_powder") & ~col(overridden),
                  F.lit("milk_powder")).otherwise(col(tier))


def is_non_product(sku_code: str | Column) -> Column:
    """no SKU code, or a code with a non-product prefix."""
    # the code is named once: a filter that is pushed down to the label parses it once
    return F.coalesce(col(sku_code).rlike("^(?:" + "|".join(vocab.NON_PRODUCT_PREFIXES) + ")"), F.lit(True))
