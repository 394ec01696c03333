"""Number grounding (G1-G6) against a nested-loop definition over generated sentences and allow-lists."""

import json
import math
import random
import re

import pytest
from helpers import extract

from tillgrid import vocab
from tillgrid.operators import grounding as GR

TOL = vocab.GROUNDING_TOLERANCE

#: text, the numbers it holds
SENTENCES = [
    ("", []),
    ("no figures at all", []),
    ("Turnover 91,204.50 over 37 tills", [91204.5, 37.0]),
    ("margin slid -4.25 to 12", [-4.25, 12.0]),
    ("closed 3-9 June and 11-14 oct", [3.0, 9.0, 11.0, 14.0]),
    ("scores of 8-2 all season", [8.0, -2.0]),
    ("open 20-22 decimals", [20.0, 22.0]),
    ("7.", [7.0]),
    ("1,2,3", [123.0]),
]


@pytest.mark.parametrize("text,numbers", SENTENCES)
def test_tokens(spark, text, numbers):
    assert extract(spark, text) == numbers


def test_a_token_too_long_for_a_double_is_reported(spark):
    texts = spark.createDataFrame([("k", f"about {'8' * 400} units, or 5")], "k string, text string")
    allowed = spark.createDataFrame([("k", 5.0), ("k", 8.0)], "k string, a double")
    found = GR.classify_tokens(GR.explode_tokens(texts, ["k"]), allowed, ["k"]).orderBy("pos").collect()
    assert [(math.isinf(r["value"]), r["status"]) for r in found] == [(True, "missing"), (False, "ok")]


def plain_status(v, allowed):
    if any(abs(v - a) <= TOL for a in allowed):
        return "ok"
    return "sign_only" if any(abs(abs(v) - abs(a)) <= TOL for a in allowed) else "missing"


@pytest.mark.parametrize("seed,scale", [(1, 1.0), (2, 50.0), (3, 1e6), (4, 1e15), (5, 1e18)])
def test_statuses_equal_the_nested_loop(spark, seed, scale):
    rng = random.Random(seed)
    keys = ["p", "q"]
    allowed = [(rng.choice(keys), round(rng.uniform(-scale, scale), rng.choice([0, 1, 2]))) for _ in range(250)]
    tokens = [(rng.choice(keys), rng.uniform(-1.2 * scale, 1.2 * scale)) for _ in range(250)]
    for k, a in allowed[:60]:
        tokens += [(k, a + d) for d in (0.0, TOL, -TOL, 0.05, 0.11, -0.0999999)] + [(k, -a)]
    rows = [(k, i, float(v)) for i, (k, v) in enumerate(tokens)]
    got = GR.classify_tokens(spark.createDataFrame(rows, "k string, pos int, value double"),
                             spark.createDataFrame([(k, float(a)) for k, a in allowed], "k string, a double"), ["k"])
    for r in got.collect():
        assert r["status"] == plain_status(r["value"], [a for k, a in allowed if k == r["k"]]), r


def test_equal_tokens_keep_their_rows(spark):
    tokens = spark.createDataFrame([("k", 1.0)] * 3 + [("k", 9.0)] * 2, "k string, value double")
    allowed = spark.createDataFrame([("k", 1.0)] * 4, "k string, a double")
    found = GR.classify_tokens(tokens, allowed, ["k"])
    counts = GR.verdict(found, ["k"]).first()
    assert (counts["n_numbers"], counts["n_missing"], counts["needs_review"]) == (5, 2, True)


def test_no_list_of_allowed_values_is_gathered(spark):
    tokens = spark.createDataFrame([("k", 1.0)], "k string, value double")
    allowed = spark.createDataFrame([("k", 1.0)], "k string, a double")
    plan = GR.classify_tokens(tokens, allowed, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("collect_list|collect_set|map_from|Cartesian", plan)


@pytest.mark.parametrize("value,whole", [(178.5, 178.0), (179.5, 180.0), (-0.5, 0.0), (2.5, 2.0)])
def test_allowed_values_round_half_to_even(spark, value, whole):
    df = spark.createDataFrame([("k", value)], "k string, v double")
    got = {r["a"] for r in GR.allowed_from_numbers(df, ["k"], ["v"]).collect()}
    assert got == {round(value, 2), round(value, 1), whole}


@pytest.mark.parametrize("depth", [1, 3, 12, 30])
def test_leaves_at_any_depth(spark, depth):
    doc = {"n": 4, "s": "in 1999, [not {an} array", "none": None, "flag": True}
    for i in range(depth):
        doc = {"inner": doc, "list": [i + 0.5, [f"t{i}"]]} if i % 2 else [doc, i + 0.5, f'quote " {{[ {i}']
    df = spark.createDataFrame([("k", json.dumps(doc)), ("k", "not json"), ("k", None)], "k string, j string")

    def plain(x):
        if isinstance(x, dict):
            return [y for v in x.values() for y in plain(v)]
        if isinstance(x, list):
            return [y for v in x for y in plain(v)]
        return [] if x is None or isinstance(x, bool) else [x]
    got = [r["str"] if r["kind"] == "string" else r["num"] for r in GR.json_leaves(df, ["k"], "j").collect()]
    assert sorted(map(repr, got)) == sorted(repr(x if isinstance(x, str) else float(x)) for x in plain(doc))


REPLIES = [
    ('{"a": "x, } y"}', {"a": "x, } y"}),
    ('{"a": "x", "b": "y",}', {"a": "x", "b": "y"}),
    ('```json\n{"a": "x"}\n```', {"a": "x"}),
    ('{"a": 7, "b": {"c": "d"}, "e": "f", "g": null, "h": ["i"]}', {"e": "f"}),
    ('{"a": "cut', None),
    ("plain words", None),
    (None, None),
]


def test_replies_are_repaired_only_if_they_fail_and_keep_strings_only(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(REPLIES)], "i int, t string")
    got = {r["i"]: r["m"] for r in df.select("i", GR.parse_lenient("t").alias("m")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(REPLIES)}


def test_twenty_fields_may_be_filled_in():
    assert len(vocab.NARRATIVE_FIELDS) == len(set(vocab.NARRATIVE_FIELDS)) == 20


def _leaves_of(value):
    if isinstance(value, dict):
        return [x for v in value.values() for x in _leaves_of(v)]
    if isinstance(value, list):
        return [x for v in value for x in _leaves_of(v)]
    if value is None or isinstance(value, bool):
        return []
    return [value if isinstance(value, str) else float(value)]


def test_leaves_of_any_depth_and_escape(spark):
    rng = random.Random(2)
    signs = ["a", '"', "\\", "\n", "é", "{", "[", ":", ",", " ", "😀", "/", "u0022", "true"]

    def make(depth):
        kind = rng.random()
        if depth and kind < 0.3:
            return [make(depth - 1) for _ in range(rng.randint(0, 3))]
        if depth and kind < 0.6:
            return {"".join(rng.choices(signs, k=3)) + str(i): make(depth - 1) for i in range(rng.randint(0, 3))}
        return rng.choice([True, None, rng.randint(-999, 10**12), rng.random() * 1e-7, -1.5e300,
                           "".join(rng.choices(signs, k=rng.randint(0, 8)))])

    texts = [json.dumps(make(6), ensure_ascii=i % 2 == 0) for i in range(200)]
    texts += [r'{"p": "C:\\", "x": [[[[12345]]]], "y": "z"}', "[" * 200 + "12345" + "]" * 200,
              json.dumps("\n" * 20_000), '{"a": "1', "nope", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, j string")
    got = {}
    for r in GR.json_leaves(df, ["k"], "j").collect():
        got.setdefault(r.k, []).append(r.str if r.kind == "string" else r.num)
    for i, text in enumerate(texts[:-3]):
        assert sorted(got.get(i, []), key=repr) == sorted(_leaves_of(json.loads(text)), key=repr), text[:100]
    assert not set(got) & set(range(len(texts) - 3, len(texts)))
