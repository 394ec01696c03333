"""Licence scan against Dice coefficients of all units and all templates."""

import random
import re

import pytest

from tillgrid.llm import licenses as L

SF = "/root/testdata/sf0.001"


def grams(text):
    w = [x for x in re.split("[^0-9a-z\x80-\U0010ffff]+", text.lower()) if x]
    return {f"{a} {b}" for a, b in zip(w, w[1:])}


def brute(rows, templates=L.TEMPLATES, t=0.8):
    out = {}
    for doc, text in rows:
        if text is None:
            continue
        units = {*text.split("\n"), *re.split("\n[ \t\r]*\n", text), text}
        for unit in units:
            a = grams(unit)
            for name, body in templates:
                b = grams(body)
                dice = 2 * len(a & b) / (len(a) + len(b)) if a else 0
                if dice >= t:
                    out[doc, name] = max(dice, out.get((doc, name), 0))
    return out


def got(df):
    return {(r["doc_id"], r["license"]): r["dice"] for r in df.collect()}


def damaged(text, rng, share):
    return " ".join(w if rng.random() > share else "xyz" for w in text.split())


def test_damaged_templates_in_texts(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        name, body = rng.choice(L.TEMPLATES)
        lines = ["Some opening words here.", damaged(body, rng, rng.choice([0, 0.02, 0.05, 0.1, 0.2])), "And the software ends."]
        rows.append((i, rng.choice(["\n", "\n\n", "\n \t\n"]).join(lines)))
    want = brute(rows)
    assert len(want) > 40
    assert got(L.scan(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_paragraphs_of_several_lines(spark):
    body = dict(reversed(L.TEMPLATES))["MIT"]
    long_ = max((t for n, t in L.TEMPLATES if n == "MIT"), key=len)
    wrapped = "\n".join(x.strip().upper() for x in long_.split("\n"))
    rows = [(1, f"intro\n\n{wrapped}\n\nmore"), (2, wrapped), (3, f"first line\n{body}\nlast line")]
    want = brute(rows)
    assert {d for d, n in want if n == "MIT"} == {1, 2, 3}
    assert got(L.scan(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_documents_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(L.scan(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("t", [0.3, 0.5, 0.8, 1.0])
def test_bounds_lose_nothing(t):
    for _, body in L.TEMPLATES:
        b = L.template_bigrams(body)
        for n in range(1, 4 * len(b)):
            best = 2 * min(n, len(b)) / (n + len(b))
            assert (n in L.sizes(len(b), t)) == (best >= t - 1e-12)
        words = set(L.anchors(body, t))
        untouched = [g for g in b if not words & set(g.split())]
        n = len(untouched)  # the best unit of untouched bigrams alone
        assert n == 0 or 2 * n / (n + len(b)) < t


def test_edge_cases(spark):
    text = "Released under the MIT License."
    rows = [(1, None, "a", 1.0), (2, "", "b", 1.0), (3, "license", "c", 1.0), (None, text, "d", 1.0), (None, text, "e", 1.0),
            (4, f"{text}\n{text}", "f", 1.0), (4, text.upper(), "g", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string, dice double")
    found = L.scan(docs)
    assert got(found) == {(None, "MIT"): 1.0, (4, "MIT"): 1.0} and found.count() == 2
    assert L.scan(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = L.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
