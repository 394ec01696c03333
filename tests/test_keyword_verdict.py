"""Keyword guess and conflict verdict (P9, P10) with the fixed keyword rules."""

import pytest
from pyspark.sql import functions as F

from tillgrid import vocab
from tillgrid.functions.rules import keyword_guess, verdict


def guess(spark, desc):
    df = spark.createDataFrame([(desc,)], "d string")
    return df.select(keyword_guess("d", vocab.REFERENCE_RULES).alias("g")).first()["g"]


def verdict_of(spark, cat, g):
    df = spark.createDataFrame([(cat, g)], "c string, g string")
    return df.select(verdict("c", "g").alias("v")).first()["v"]


@pytest.mark.parametrize("desc,expected", [
    ("Whole Milk Powder (800g)", "milk_powder"),
    ("Fish Oil 1000mg 400 Capsules", "supplement"),
    ("Manuka Honey UMF 10+ 500g", "honey"),
    ("Lanolin Cream 100g", "skincare"),
    ("Sheepskin Slippers", "souvenir"),
    ("Dark Chocolate Bar", "chocolate"),
])
def test_single_category(spark, desc, expected):
    assert guess(spark, desc) == expected


def test_case_insensitive(spark):
    assert guess(spark, "WHOLE MILK POWDER") == "milk_powder"


def test_several_categories_are_ambiguous_and_sorted(spark):
    assert guess(spark, "Honey Gift Set (250g x4)") == "ambiguous:honey+souvenir"


def test_no_keyword(spark):
    assert guess(spark, "Stainless Steel Water Bottle") == ""


def test_word_boundary_honey(spark):
    # "honeycomb" is not the word honey
    assert guess(spark, "Honeycomb Toffee") == ""


def test_blanket_is_a_souvenir_keyword(spark):
    assert guess(spark, "Wool Throw Blanket") == "souvenir"


@pytest.mark.parametrize("cat,g,expected", [
    ("excluded", "honey", "excluded"),
    ("", "honey", "brand_not_classified"),
    (None, "honey", "brand_not_classified"),
    ("honey", "honey", "match"),
    ("honey", None, "no_keyword_match"),
    ("honey", "", "no_keyword_match"),
])
def test_verdict_simple(spark, cat, g, expected):
    assert verdict_of(spark, cat, g) == expected


def test_verdict_conflicts(spark):
    assert verdict_of(spark, "supplement", "honey") == \
        "CONFLICT - name suggests honey, brand default is supplement"
    assert verdict_of(spark, "honey", "ambiguous:honey+souvenir").startswith(
        "CONFLICT - name matches several categories (ambiguous:honey+souvenir)")


def test_verdict_over_many_rows_is_native(spark):
    df = spark.range(1000).select(F.lit("honey").alias("c"),
                                  F.when(F.col("id") % 2 == 0, F.lit("honey")).alias("g"))
    out = df.select(verdict("c", "g").alias("v")).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in out} == {"match": 500, "no_keyword_match": 500}
