"""Wu-Manber decontamination against a plain search of every window at every place."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tillgrid.llm import decontaminate as D

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, items, window):
    """(words, hit words, items) by comparing every window everywhere."""
    split = lambda t: WORD.findall((t or "").encode().lower())
    w, hit, found = split(text), set(), set()
    for item, body in items:
        b = split(body)
        n = min(window, len(b))
        for s in range(len(b) - n + 1 if n else 0):
            for at in range(len(w) - n + 1):
                if w[at:at + n] == b[s:s + n]:
                    hit.update(range(at, at + n))
                    found.add(item)
    return len(w), len(hit), sorted(x for x in found if x is not None)


def as_rows(df):
    return {r["doc_id"]: (r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), list(r["items"]))
            for r in df.collect()}


def test_random_texts_equal_a_plain_search(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("ab c-d É7 zz Zz".split()) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 3, 4, 6, 9]))) for i in range(12)]
    docs = [(i, text(rng.choice([0, 1, 2, 5, 30, 80]))) for i in range(60)]
    got = as_rows(D.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                  spark.createDataFrame(items, "item_id long, text string"), window=4))
    assert got == {i: brute(t, items, 4) for i, t in docs}


def test_blocks_of_the_benchmark_give_the_same_rows(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    items = [(i % 7, " ".join(rng.choices(words, k=12))) for i in range(20)]
    docs = [(i, " ".join(rng.choices(words, k=10)) + " " + items[i % 20][1]) for i in range(40)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    whole = as_rows(D.contamination(d, b, window=5))
    assert as_rows(D.contamination(d, b, window=5, block_bytes=300)) == whole
    assert any(n for _, n, _ in whole.values())
    extra = d.withColumn("row", F.lit("x")).withColumn("found", F.col("doc_id"))
    kept = D.clean(extra, b, window=5, block_bytes=300)
    assert kept.columns == extra.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(
        r["doc_id"] for r in D.clean(extra, b, window=5).collect())


def test_one_block_of_a_large_benchmark_is_held_at_a_time(spark, monkeypatch):
    alive, most, context = [], [], spark.sparkContext
    send = context.broadcast

    def watched(value):
        sent = send(value)
        alive.append(sent)
        most.append(len(alive))
        end = sent.destroy
        monkeypatch.setattr(sent, "destroy", lambda *a: (alive.remove(sent), end(*a)))
        return sent

    monkeypatch.setattr(context, "broadcast", watched)
    items = spark.createDataFrame([(i, f"alpha{i} beta{i} gamma{i} " * 4) for i in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"alpha{i} beta{i} gamma{i} " * 5) for i in range(0, 80, 4)], "doc_id long, text string")
    found = D.contamination(docs, items, window=5, block_bytes=1000)
    assert len(most) >= 10 and max(most) == 1 and not alive
    assert {r["doc_id"]: r["items"] for r in found.collect()} == {i: [i] if i < 60 else [] for i in range(0, 80, 4)}


@pytest.mark.parametrize("stride", [1, 7, 40])
def test_long_texts_are_searched_across_strides(monkeypatch, stride):
    monkeypatch.setattr(D, "STRIDE", stride)
    rng = random.Random(stride)
    items = [(1, "a b c d e"), (2, "c"), (3, "e a")]
    text = " ".join(rng.choices("abcde", k=300))
    n, spans, found = D.scan(text.encode(), D.searches([(i, t.encode()) for i, t in items], 4))
    assert (n, sum(e - s for s, e in spans), sorted(found)) == brute(text, items, 4)


def test_nulls_empty_texts_repeated_rows_and_extra_columns(spark):
    docs = spark.createDataFrame(
        [(1, None, 5, "x"), (1, None, 5, "x"), (2, "", 6, None), (None, "the one two", 7, "y"), (3, "one TWO!", 8, "z")],
        "doc_id long, text string, n_words long, spans string")
    bench = spark.createDataFrame([(9, "one two"), (9, "one two"), (None, "the"), (4, None), (5, "")],
                                  "item_id long, text string")
    rows = sorted(D.digest(D.contamination(docs, bench)).collect(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in rows] == [
        (None, 3, 3, 1, True), (1, 0, 0, 0, False), (1, 0, 0, 0, False), (2, 0, 0, 0, False), (3, 2, 2, 1, True)]
    assert rows[-1]["items_sha256"] == D.sha256_of([9]) and rows[1]["items_sha256"] == D.sha256_of([])
    kept = D.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 2]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert D.contamination(docs.limit(0), bench).count() == 0
    row = D.digest(D.contamination(docs, bench.limit(0))).first()
    assert (row["n_words"], row["n_hit"], row["contaminated"]) == (2, 0, False)


def test_shift_skips_blocks_that_stand_in_no_pattern():
    table = D.WuManber({tuple(b"a b c d e f".split()): frozenset([1])})
    assert table.far == 5 and table.shift[b"e", b"f"] == 0 and table.shift[b"a", b"b"] == 4
