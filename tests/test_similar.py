"""The inverted index of character pairs against the plain ratio of all pairs."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from tillgrid import vocab
from tillgrid.operators import fuzzy, similar
from tillgrid.plans import sqlgen


def names(n, seed, letters="abcdefgh", longest=14):
    rng = random.Random(seed)
    out = {"", "a", "ab", "ba", "aa", "aaa", "öl", "öl & ölö", "😀x", "aaaaaaaa", "abababab"}
    while len(out) < n:
        s = "".join(rng.choice(letters) for _ in range(rng.randint(1, longest)))
        out.add(s)
        i = rng.randrange(len(s))
        out.add(rng.choice([s[:i] + s[i + 1:], s[:i] + rng.choice(letters) + s[i:], s[:i] + s[i:][::-1]]))
    return sorted(out)


@pytest.mark.parametrize("threshold", [0.4, 0.6, 0.7, 0.8, 0.85, 1.0])
def test_no_pair_within_the_ratio_is_lost(spark, threshold):
    a, b = names(70, 1), names(70, 2)
    left = spark.createDataFrame([(x,) for x in a] + [(None,), (a[3],)], "a string")
    right = spark.createDataFrame([(x,) for x in b] + [(None,)], "b string")
    got = {(r.a, r.b): r.ratio for r in similar.similar(left, right, threshold).collect()}
    want = {(x, y): difflib.SequenceMatcher(None, x, y).ratio() for x in a for y in b}
    assert got == {k: r for k, r in want.items() if r >= threshold}


def test_candidates_come_once_and_are_few(spark):
    words = names(1500, 3, "abcdefghijklmnopqrstuvwxyz", 24)
    df = spark.createDataFrame([(w,) for w in words], "a string")
    pairs = similar.candidates(df, df.withColumnRenamed("a", "b"), 0.85)
    assert pairs.count() == pairs.distinct().count() < len(words) * 12


def test_candidates_grow_with_the_names(spark):
    """Ten times the names, with their misspellings, give about ten times the candidates."""
    rng = random.Random(8)
    syllables = ["".join(rng.choice(x) for x in ("bcdfghjklmnprstvwz", "aeiou", "bdgklmnrst")) for _ in range(600)]

    def counted(n):
        whole = [" ".join("".join(rng.choice(syllables) for _ in range(3)) for _ in range(2)) for _ in range(n)]
        left = spark.createDataFrame([(w,) for w in whole], "a string")
        right = spark.createDataFrame([(w[:4] + w[5:],) for w in whole], "b string")
        found = similar.candidates(left, right, 0.85)
        return found.count(), found.where(F.col("b") == F.concat(F.substring("a", 1, 4), F.expr("substr(a, 6)"))).count()

    few, hits = counted(300)
    many, more_hits = counted(3000)
    assert hits == 300 and more_hits == 3000
    assert many <= 15 * few


def test_a_bad_threshold_is_refused(spark):
    df = spark.createDataFrame([("x",)], "a string")
    for t in (0, 1.5):
        with pytest.raises(ValueError):
            similar.candidates(df, df.withColumnRenamed("a", "b"), t)


def test_stored_resolutions_score_a_spelling_once(spark, tmp_path):
    table = fuzzy.resolution_table(spark, str(tmp_path / "t"))
    first = spark.createDataFrame([("Amber Holow",), ("AMBER  HOLOW ",), ("Amber Hollow",), ("stranger",)], "brand string")
    assert fuzzy.keep_resolutions(table, first) == 1
    held = {r.norm_brand: (r.fuzzy_brand, r.ratio is None) for r in table.read().collect()}
    assert held == {"amber holow": ("amber hollow", False), "stranger": (None, True)}
    before = table.folders()
    assert fuzzy.keep_resolutions(table, first) == 1 and table.folders() == before
    assert fuzzy.keep_resolutions(table, first.union(spark.createDataFrame([("Copper Ketle",)], "brand string"))) == 2
    assert {r.norm_brand for r in table.read().collect()} == {"amber holow", "stranger", "copper ketle"}


def test_fixture_brands_have_headroom_and_need_every_stage(spark):
    df = spark.createDataFrame([(b,) for b in vocab.FIXTURE_BRANDS], "brand string")
    assert fuzzy.headroom(df).where("merged").count() == 0
    known = vocab.FIXTURE_RULES.known_brands
    spelled = [(s,) for b in vocab.FIXTURE_BRANDS for s in sqlgen.spellings(b).values()]
    hows = {r.how for r in fuzzy.resolution(spark.createDataFrame(spelled, "brand string")).collect()}
    assert hows == {"exact", "tight", "fuzzy", "none"} and len(set(known)) == len(known)


def test_what_is_asked_of_a_spelling_is_not_asked_of_every_line(spark):
    """Filters on normalised names stay above the distinct spellings."""
    typed = F.when(F.col("id") % 3 == 0, "Amber Hollow").when(F.col("id") % 3 == 1, "Amer Hollow")
    lines = spark.range(300).select(typed.alias("brand"))
    assert fuzzy.spellings(lines).count() == 3
    left = fuzzy.unresolved(lines, vocab.FIXTURE_RULES)
    assert {r["norm_brand"] for r in left.collect()} == {"amer hollow"}
    per_line = left._jdf.queryExecution().optimizedPlan().toString().split("Aggregate [")[-1]
    assert "Range (0, 300" in per_line and "regexp_replace" not in per_line
