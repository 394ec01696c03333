"""Exact nearest neighbours by inner product, as a block matrix join.

Queries and candidates are dealt into bands; a cell is a query band against a
candidate band, and Spark shuffles each band to its cells.  In a cell, vectors
are quantised to int8 with a scale each; products of int8 tiles give every inner
product up to a bound from the quantisation errors:
``|<x, y> - <x', y'>| <= |x - x'| |y| + |x'| |y - y'|``.  Pairs whose upper bound
reaches the k-th best so far survive, are recomputed in double precision from
the original vectors, and enter the query's heap.  The heaps of a query's cells
are merged by rank.

Copies of a vector: no query can need more than the first k + 1 of them by id,
so only these are dealt out.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do null ids; of rows that repeat a vec_id the
smallest vector counts; vectors of different length never meet; fewer than k
candidates give fewer rows; columns beside the two named ones are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries and candidates of a cell; candidates of a tile.
QUERY_BAND, CANDIDATE_BAND, TILE = 2048, 8192, 1024
#: Pairs recomputed at a time.
PAIRS = 1 << 16


def usable(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of the vectors that take part, one row per id."""
    v = F.col("v")
    whole = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(ident).cast("long").alias("id"),
                          F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & whole
                      & F.exists(v, lambda x: x != 0))
    most = rows.groupBy("id").count().agg(F.max("count")).first()[0]
    if (most or 1) > 1:
        rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    return rows


class _Quantised:
    def __init__(self, v: np.ndarray) -> None:
        peak = np.abs(v).max(axis=1)
        self.scale = peak / 127.0
        with np.errstate(over="ignore"):
            codes = np.rint(v / peak[:, None] * 127.0)
            back = codes * self.scale[:, None]
        self.codes = codes.astype(np.int8)
        # norms are taken of vectors scaled to a peak of 1, which cannot overflow;
        # the factor covers the rounding of the norms and of the bound itself
        slack = 1 + 1e-9
        self.norm = np.sqrt(((v / peak[:, None]) ** 2).sum(1)) * peak * slack
        self.near = np.sqrt(((back / peak[:, None]) ** 2).sum(1)) * peak * slack
        self.error = np.sqrt((((v - back) / peak[:, None]) ** 2).sum(1)) * peak * slack + peak * 1e-12


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, summed in order of dimension."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * y[:, d]
    return total


class Search:
    """The k nearest of each query among the candidates shown so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.q = _Quantised(vectors)
        # entries (score, -id): the root is the worst kept
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]

    def show(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        c, q = _Quantised(vectors), self.q
        kind = np.float32 if vectors.shape[1] * 127 * 127 < 1 << 24 else np.float64
        product = (q.codes.astype(kind) @ c.codes.astype(kind).T).astype(np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            product *= q.scale[:, None]
            product *= c.scale[None, :]
            bound = q.error[:, None] * c.norm[None, :]
            bound += q.near[:, None] * c.error[None, :]
            need = np.full(len(self.ids), -np.inf)
            if len(ids) > self.k:  # one more than k: a query may be among the candidates
                low = np.partition(product - bound, len(ids) - self.k - 1, axis=1)
                need = low[:, len(ids) - self.k - 1]
            for i, h in enumerate(self.heaps):
                if len(h) == self.k:
                    need[i] = max(need[i], h[0][0])
            product += bound
            alive = ~(product < need[:, None])
        at, of = np.nonzero(alive)
        other = self.ids[at] != ids[of]
        at, of = at[other], of[other]
        for lo in range(0, len(at), PAIRS):
            a, o = at[lo:lo + PAIRS], of[lo:lo + PAIRS]
            scores = exact(self.vectors[a], vectors[o])
            for i, score, ident in zip(a.tolist(), scores.tolist(), ids[o].tolist()):
                h = self.heaps[i]
                if len(h) < self.k:
                    heapq.heappush(h, (score, -ident))
                elif (score, -ident) > h[0]:
                    heapq.heapreplace(h, (score, -ident))


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _cell(k: int):
    def search(cell: pa.Table) -> pa.Table:
        ids = cell["id"].to_numpy()
        asks = cell["asks"].to_numpy(zero_copy_only=False)
        held = cell["v"].combine_chunks()
        lengths = held.value_lengths().to_numpy()
        flat = held.flatten().to_numpy()
        starts = np.concatenate([[0], np.cumsum(lengths)])
        rows: list[tuple] = []
        for d in np.unique(lengths[asks]).tolist():
            pick = lambda mask: np.flatnonzero(mask & (lengths == d))  # noqa: B023, E731
            matrix = lambda at: flat[starts[at][:, None] + np.arange(d)[None, :]]  # noqa: B023, E731
            asking, given = pick(asks), pick(~asks)
            s = Search(ids[asking], matrix(asking), k)
            for lo in range(0, len(given), TILE):
                tile = given[lo:lo + TILE]
                s.show(ids[tile], matrix(tile))
            rows += [(q, -neg, score) for q, h in zip(s.ids.tolist(), s.heaps) for score, neg in h]
        columns = zip(*rows) if rows else ((), (), ())
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)
    return search


def nearest(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k largest inner
    products; both inputs as ``usable`` gives them.  A candidate with a
    query's id is the query itself."""
    n_queries, n_candidates = queries.count(), candidates.count()
    bands = lambda n, size: max(1, -(-n // size))
    nq, nc = bands(n_queries, QUERY_BAND), bands(n_candidates, CANDIDATE_BAND)
    copies = Window.partitionBy("v").orderBy("id")
    needed = (candidates.withColumn("copy", F.row_number().over(copies))
              .where(F.col("copy") <= k + 1).drop("copy"))
    band = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    asking = queries.select("id", "v", F.lit(True).alias("asks"), band(nq).alias("q"),
                            F.explode(F.sequence(F.lit(0), F.lit(nc - 1))).alias("c"))
    given = needed.select("id", "v", F.lit(False).alias("asks"), band(nc).alias("c"),
                          F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("q"))
    cells = asking.unionByName(given).groupBy("q", "c").applyInArrow(
        _cell(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (cells.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
