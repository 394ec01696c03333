"""String functions over product names, brands, labels and report text.

All of them build native Spark expressions (no Python UDFs).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from .numeric import col


def collapse_ws(c: str | Column) -> Column:
    """Runs of whitespace -> one space, trimmed."""
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


def parse_product_name(c: str | Column) -> Column:
    """P3: '[code] [brand]rest' -> struct(sku_code, brand_raw, product_desc).

    A line that does not match keeps the whole text as the description and
    NULL code/brand."""
    s = col(c)
    matched = s.rlike(vocab.PRODUCT_PATTERN)
    return F.struct(
        F.when(matched, F.regexp_extract(s, vocab.PRODUCT_PATTERN, 1)).alias("sku_code"),
        F.when(matched, F.regexp_extract(s, vocab.PRODUCT_PATTERN, 2)).alias("brand_raw"),
        F.when(matched, F.regexp_extract(s, vocab.PRODUCT_PATTERN, 3)).otherwise(s)
        .alias("product_desc"),
    )


def freight_tag(desc: str | Column) -> Column:
    """First {tag}; '' when there is none."""
    return F.regexp_extract(F.coalesce(col(desc), F.lit("")), vocab.FREIGHT_TAG_PATTERN, 1)


def strip_tags(desc: str | Column) -> Column:
    """P5: remove every {tag}, trim."""
    return F.trim(F.regexp_replace(col(desc), vocab.FREIGHT_TAG_PATTERN, ""))


def brand_key(brand: str | Column) -> Column:
    """Category lookup key — lower + trim only."""
    return F.lower(F.trim(col(brand)))


def normalise_brand(brand: str | Column) -> Column:
    """Lower, trim, collapse whitespace."""
    return F.regexp_replace(F.lower(F.trim(col(brand))), r"\s+", " ")


def tight_brand(brand: str | Column) -> Column:
    """Normalised brand without any spaces."""
    return F.replace(normalise_brand(brand), F.lit(" "), F.lit(""))


def month_label(period: str | Column) -> Column:
    """P19: '2026-04' -> 'Apr 2026'."""
    months = F.array(*[F.lit(m) for m in vocab.MONTH_SHORT])
    p = col(period)
    return F.concat(F.element_at(months, F.substring(p, 6, 2).cast("int")), F.lit(" "),
                    F.substring(p, 1, 4))


def _label_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def fallback_label(key: str | Column) -> Column:
    """P20 fallback: '_' -> ' ', first letter upper-cased."""
    k = F.replace(col(key), F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(k, 1, 1)), F.substring(k, 2, 1 << 30))


def display_label(key: str | Column, kind: str) -> Column:
    """P20: display label for a category / tier / product type."""
    mapping = {"category": vocab.CATEGORY_LABELS, "tier": vocab.TIER_LABELS,
               "product_type": vocab.PRODUCT_TYPE_LABELS}[kind]
    return F.coalesce(F.element_at(_label_map(mapping), col(key)), fallback_label(key))


def rose_fell(x: str | Column) -> Column:
    """P24: 'rose' for >= 0, 'fell' otherwise."""
    return F.when(col(x) >= 0, F.lit("rose")).otherwise(F.lit("fell"))


def text_or_fallback(text: str | Column, fallback: str | Column) -> Column:
    """A blank text counts as absent."""
    return F.coalesce(F.nullif(F.trim(col(text)), F.lit("")), col(fallback))


def context_line(period: str | Column) -> Column:
    """P28."""
    return F.concat(F.lit("Reporting month: "), col(period))
