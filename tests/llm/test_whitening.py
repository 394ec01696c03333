"""Whitening against numpy on all distinct vectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tillgrid.llm import whitening as W


def brute(rows, k=16, weights="one"):
    good = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    x = [tuple(math.floor(64 * np.float32(c).astype(float)) + 1_000_000 for c in v) for _, v in good]
    fit = list(dict.fromkeys(x)) if weights == "one" else x
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    mean = [Fraction(t, n) for t in s]
    c = np.array([[float(a - m) for a, m in zip(v, mean)] for v in fit])
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for (i, _), v in zip(good, x):
        d = np.array([float(a - m) for a, m in zip(v, mean)])
        dev = sum((n * a - t) ** 2 for a, t in zip(v, s))
        for j in range(min(k, (e > 1e-9 * e[0]).sum())):
            out[i, j + 1] = (n, dev, d @ u[:, j] / math.sqrt(e[j]), e[j] / e.sum())
    return out


def same(spark, rows, k=16, weights="one"):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                               "vec_id long, embedding array<float>, h string, n int").repartition(4)
    got = W.whiten(df, k, weights).collect()
    want = brute(rows, k, weights)
    assert sorted((r["vec_id"], r["component"]) for r in got) == sorted(want)
    sign = {}
    for r in got:
        n, dev, w, share = want[r["vec_id"], r["component"]]
        if abs(w) > 1e-3:
            sign.setdefault(r["component"], r["whitened"] * w > 0)
            assert sign[r["component"]] == (r["whitened"] * w > 0)
        assert (r["n"], r["deviation"]) == (n, dev)
        assert abs(abs(r["whitened"]) - abs(w)) < 1e-8 and abs(r["explained"] - share) < 1e-10
        assert r["identity_error"] < 1e-9
    return got


def vectors(n, dims, seed=3):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dims, dims))
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(n, dims)) @ mix)]


@pytest.mark.parametrize("weights", ["one", "counts"])
def test_repeated_vectors_and_rows_without_a_vector(spark, weights):
    rows = vectors(150, 20)
    rows += [(1000 + i, rows[3][1]) for i in range(70)]
    rows += [(2000, None), (2001, []), (2002, [None] * 20), (2003, [math.nan] * 20), (2004, [math.inf] + [0.0] * 19)]
    same(spark, rows, weights=weights)


def test_components_end_at_the_rank(spark):
    rows = [(i, [float(i % 5), float(i % 5) * 2, 1.0, float(i % 3)]) for i in range(30)]
    assert max(r["component"] for r in same(spark, rows)) == 2


def test_one_vector_null_ids_and_empty_table(spark):
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<float>")).count() == 0
    assert W.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    rows = [(None, [0.0, 1.0]), (1, [1.0, 5.0]), (1, [4.0, 0.0])]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert sorted((r["vec_id"] is None, r["component"]) for r in got.collect()) == [
        (False, 1), (False, 1), (False, 2), (False, 2), (True, 1), (True, 2)]


def test_lengths_have_fits_of_their_own(spark):
    short, long = vectors(20, 3), [(100 + i, v) for i, v in vectors(30, 5)]
    df = spark.createDataFrame(short + long, "vec_id long, embedding array<float>")
    got = {(r["vec_id"], r["component"]): r for r in W.whiten(df).collect()}
    want = brute(short) | brute(long)
    assert set(got) == set(want)
    assert all((got[k]["n"], got[k]["deviation"]) == want[k][:2] for k in want)


def test_exact_beyond_64_bits():
    fit = W.Fit(3, [6 * 10**18, 3])
    x = np.array([[2 * 10**18, 1], [2 * 10**18 + 1, 5]], np.int64)
    assert fit.deviations(x) == [0, 9 + 144]
    big = W.Fit(10**7, [0, 0])
    assert big.deviations(np.array([[1000, 1]], np.int64)) == [10**20 + 10**14]
