"""The block matrix join against all inner products."""

import math

import numpy as np
import pytest

from tillgrid.llm import neighbours as N

SF = "/root/testdata/sf0.001"


def brute(rows, k, asks):
    good = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = min(good.get(i, v), v)
    out = {}
    for q in filter(asks, good):
        scores = []
        for c, v in good.items():
            if c != q and len(v) == len(good[q]):
                s = 0.0
                for a, b in zip(good[q], v):
                    s += a * b
                scores.append((-s, c))
        out[q] = [(c, -s) for s, c in sorted(scores)[:k]]
    return out


def got(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def search(spark, rows, k, asks, kind="float"):
    v = N.usable(spark.createDataFrame([(*r, 1) for r in rows], f"vec_id long, embedding array<{kind}>, rank int"))
    return got(N.nearest(v.where(asks), v, k))


def floats(x):
    return [float(np.float32(v)) for v in x]


def test_embeddings_table(spark, monkeypatch):
    for name, size in (("QUERY_BAND", 7), ("CANDIDATE_BAND", 90), ("TILE", 32)):
        monkeypatch.setattr(N, name, size)
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in vectors.collect()]
    v = N.usable(vectors)
    assert got(N.nearest(v.where("id % 20 = 0"), v, 20)) == brute(rows, 20, lambda i: i % 20 == 0)


@pytest.mark.parametrize("scale", [1e-30, 1.0, 1e15])
def test_near_ties_and_copies(spark, scale):
    rng = np.random.default_rng(2)
    base = rng.normal(size=6)
    rows = [(i, floats(scale * base)) for i in range(60)]  # one vector many times
    rows += [(100 + i, floats(scale * (base + 1e-6 * rng.normal(size=6)))) for i in range(60)]
    rows += [(200 + i, floats(scale * rng.normal(size=6))) for i in range(60)]
    want = brute(rows, 5, lambda i: i % 10 == 0)
    assert search(spark, rows, 5, "id % 10 = 0") == want


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, []), (8, [1.0, 2.0, 3.0]), (9, [3.0, 2.0, 1.0]), (None, [1.0, 1.0]), (1, [0.5, 0.25]), (1, [0.5, 0.5]),
            (-2, [-1.0, -0.0])]
    want = brute(rows, 3, lambda i: i % 2 == 0)
    assert search(spark, rows, 3, "id % 2 = 0") == {q: w for q, w in want.items() if w}
    empty = N.usable(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert N.nearest(empty, empty, 3).count() == 0


def test_doubles_and_long_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=1100).tolist()) for i in range(40)]
    assert search(spark, rows, 4, "id < 5", "double") == brute(rows, 4, lambda i: i < 5)


def test_bounds_hold_for_every_pair():
    rng = np.random.default_rng(6)
    for scale in (1e-200, 1.0, 1e100):
        x = rng.normal(size=(50, 16)) * scale * rng.choice([1e-3, 1, 50], size=(50, 16))
        q = N._Quantised(x)
        near = (q.codes.astype(float) @ q.codes.astype(float).T) * q.scale[:, None] * q.scale[None, :]
        bound = q.error[:, None] * q.norm[None, :] + q.near[:, None] * q.error[None, :]
        true = np.array([[N.exact(x[i:i + 1], x[j:j + 1])[0] for j in range(50)] for i in range(50)])
        assert (np.abs(true - near) <= bound).all()
