"""The Merkle manifest against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tillgrid.llm import merkle as M

SCHEMA = "extra string, doc_id long, source string, lang string, n_chars int, text string, leaf string, size int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    fields = [row[1], row[2], row[3], row[4], text]
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def tree(nodes):
    """(root, path per node): a path is a list of (left siblings, right siblings)."""
    paths, where, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, at in enumerate(where):
            run = level[at // 3 * 3:at // 3 * 3 + 3]
            paths[i].append(("".join(run[:at % 3]), "".join(run[at % 3 + 1:])))
        level = [h(*level[i:i + 3]) for i in range(0, len(level), 3)]
        where = [w // 3 for w in where]
    return level[0], paths


def brute(rows, tamper=lambda r: None):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[2], []).append(r)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    low = lambda x: (x is not None, x or 0)
    done = []
    for s in sources:
        own = sorted(by_source[s], key=lambda r: (low(r[1]), leaf_of(r, r[5])))
        leaves = [leaf_of(r, r[5]) for r in own]
        done.append((own, leaves, *tree(leaves)))
    if not done:
        return []
    root, above = tree([x[2] for x in done])
    out = []
    for (own, leaves, subroot, paths), up in zip(done, above):
        for r, leaf, path in zip(own, leaves, paths):
            path = path + up
            changed = tamper(r)
            now = leaf if changed is None else leaf_of(r, changed)
            for a, b in path:
                now = h(a, now, b)
            out.append((r[1], leaf, subroot, root, h(*(a + b for a, b in path)), now, now == root))
    return out


def got(df):
    return sorted(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                       "verified").collect()), key=repr)


def rows_of(n, sources):
    return [("x", i, sources[i * i % len(sources)], "en" if i % 4 else None, i if i % 3 else None,
             None if i % 7 == 0 else f"line {i}\nmore é {i}" if i % 2 else f"plain {i}", "clash", 3) for i in range(n)]


def tampered(row):
    hit = row[1] is not None and row[5] is not None and zlib.crc32(str(row[1]).encode()) % 2 == 0
    return row[5].replace("\n", "") if hit else None


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_equals_a_plain_tree(spark, levels):
    rows = rows_of(170, ["b", "a", None, "é", "", "a", "a"])
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = got(M.manifest(df, M.without_newlines(), levels=levels))
    assert out == sorted(brute(rows, tampered), key=repr)
    assert {r[-1] for r in out} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_small_trees(spark, n):
    rows = rows_of(n, ["only"])
    assert got(M.manifest(spark.createDataFrame(rows, SCHEMA), levels=2)) == sorted(brute(rows), key=repr)


def test_repeated_and_null_ids_equal_rows_and_empty_texts(spark):
    rows = [("x", i, s, "en", 1, t, "c", 1) for i, s, t in
            [(None, None, ""), (None, None, ""), (None, None, "b"), (5, None, None), (5, None, "a\nb"), (5, "s", ""),
             (5, "s", ""), (5, "s", ""), (-3, "s", "x" * 100_000)]]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(M.manifest(df, M.without_newlines(), levels=1)) == sorted(brute(rows, tampered), key=repr)


def test_a_source_with_equal_rows_only_is_dealt_over_ranges(spark):
    rows = [("x", 1, "hot", "en", 1, "same", "c", 1)] * 200
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert got(M.manifest(df, levels=2)) == sorted(brute(rows), key=repr)
    held = M.ranked(df.select(F.col("source").alias("tree"), "doc_id"), "tree", ["doc_id"])
    assert sorted(r["rank"] for r in held.collect()) == list(range(200))


def test_an_empty_table(spark):
    assert got(M.manifest(spark.createDataFrame([], SCHEMA))) == []
