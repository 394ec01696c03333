"""SimHash fingerprints and components against all-pairs brute force."""

import random

import numpy as np
import pytest
import xxhash

from tillgrid.llm import simhash as S
from tillgrid.llm._components import components

SF = "/root/testdata/sf0.01"


def brute_fingerprint(text, size=3):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in w).split(" ") if x]
    grams = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if hs and 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(values, distance=3):
    """Smallest index reachable, by flood over all pairs."""
    v = np.array(values, np.uint64)
    out = [None] * len(v)
    for i in range(len(v)):
        if out[i] is None:
            todo = [i]
            out[i] = i
            while todo:
                near = np.flatnonzero(np.bitwise_count(v ^ v[todo.pop()]) <= distance)
                for j in near.tolist():
                    if out[j] is None:
                        out[j] = i
                        todo.append(j)
    return out


TEXTS = [None, "", "  \t\n", "One", "one two", "One TWO three", "É é É", "a b c d", "x\x0by\x0cz\rw q\x1cr", "rep rep rep rep rep",
         " ".join(f"w{i % 50}" for i in range(5000))]


def test_fingerprints(monkeypatch):
    for stride in (1, 3, 1000, 1 << 16):
        monkeypatch.setattr(S, "STRIDE", stride)
        for t in TEXTS:
            assert int.from_bytes(S.text_fingerprint(t.encode() if t is not None else None), "big") == brute_fingerprint(t)


def test_fingerprint_hash_is_spark_xxhash64(spark):
    (h,) = spark.sql("SELECT xxhash64('one two three')").first()
    assert h % (1 << 64) == xxhash.xxh64_intdigest(b"one two three", 42)


@pytest.mark.parametrize("distance", range(8))
def test_every_close_pair_shares_a_key_whose_chain_holds(distance):
    rng = random.Random(distance)
    keys = S.choices(distance)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, distance)):
            y ^= 1 << b
        assert any(x & m == y & m and S.linked(np.array([x, y, x], np.uint64), first, distance)
                   for first, m in keys)


def test_budgets_of_three_bits():
    assert S.budgets(3) == [0, 0, 1, 1, 1, 2, 2, 3]
    keys = S.choices(3)
    assert len(keys) == 24 and {m.bit_count() for _, m in keys} == {32}


def clusters(n, rng):
    """Chains of fingerprints a few bits apart, and strangers."""
    out = []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            out.append(x)
            for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4])):
                x ^= 1 << b
    return out[:n]


@pytest.mark.parametrize("block", [4, 1024])
def test_components_equal_brute_force(spark, block, monkeypatch):
    rng = random.Random(block)
    near = clusters(300, rng)
    base = rng.getrandbits(64)  # one hot group: one or two bits from a centre
    near += [base ^ (1 << i) ^ (1 << j) for i in range(8) for j in range(8)]
    rng.shuffle(near)
    signed = np.array(near, np.uint64).view(np.int64).tolist()
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "doc_id long, fp long")
    links = S.links(rows.select("fp").distinct(), 3, block)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    label = {}
    got = [label.setdefault(roots.get(f, f), i) for i, f in enumerate(signed)]
    assert got == brute_components(near)
    assert [r["component"] for r in S.clustered(rows, "doc_id", 3).orderBy("doc_id").collect()] == got


def test_a_group_gives_a_forest_not_all_pairs():
    values = np.array([1 << i for i in range(40)], np.uint64)
    found = [S.linked(values, first, 3) for first in range(8)]
    assert all(len(f) < len(values) for f in found) and any(found)


def test_documents_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    prints = [brute_fingerprint(t) for _, t in rows]
    want = {rows[i][0]: (prints[i], rows[c][0]) for i, c in enumerate(brute_components(prints))}
    got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component"]) for r in S.groups(docs).collect()}
    assert got == want


def test_edge_cases(spark):
    text = "some words that make a fingerprint here"
    rows = [(None, text, 1, "a"), (4, text, 2, "b"), (4, text, 3, "c"), (9, None, 4, "d"), (8, "", 5, "e"),
            (None, "other words altogether in this one", 6, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long, row string")
    got = sorted(((r["doc_id"], r["component"]) for r in S.groups(docs).collect()), key=repr)
    assert got == sorted([(None, 4), (4, 4), (4, 4), (9, 8), (8, 8), (None, None)], key=repr)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [4, 8, None]
    assert S.groups(docs.limit(0)).count() == 0 and S.keep_one(docs.limit(0)).count() == 0


def test_keep_one_keeps_the_smallest_of_each_group(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    firsts = {r["component"] for r in S.groups(docs).collect()}
    kept = S.keep_one(docs)
    assert kept.schema == docs.schema and sorted(r["doc_id"] for r in kept.collect()) == sorted(firsts)


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    rows = spark.createDataFrame(path + star + [(5000, 5000)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(rows).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}}
