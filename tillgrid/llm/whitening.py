"""Embedding whitening with a weighted multiplicity covariance.

Vectors become integers x = floor(64 c) + 1 000 000.  Equal x-vectors are grouped
once, with their number of rows; a vector's weight in the fit is one or that
number.  Tasks multiply blocks of centred distinct vectors by their weighted
transposes, and Spark adds the products up by matrix cell.  The eigenvectors of the
covariance, a matrix of dimension by dimension, are found on the driver.  Each
distinct vector is whitened once, and the rows are joined to the results.

Centring is exact: n*x - S is an integer, and only its quotient by n is rounded.

Defined results: rows whose vector is null, empty or holds null or non-finite
entries are left out; vectors of each length are whitened by a fit of their own; entries
beyond +-2**52 / 64 count as these; null and repeated ids stay, a row each; components whose
eigenvalue is not above the rounding of the largest do not exist and are left out,
so a single distinct vector has no rows; an empty table gives an empty one; columns
beside the two named ones are not read.  Components are numbered from 1 by falling
eigenvalue and turned so that the entry of greatest magnitude is positive.
``deviation`` is null where it does not fit into 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import settle

SCALE, SHIFT = 64, 1_000_000
#: Numbers of a block of vectors that is multiplied at a time.
BLOCK = 1 << 20
_EDGE = float(1 << 52)

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


class Fit:
    """The whitening of one vector length: n vectors (by weight) with sums ``total``."""

    def __init__(self, n: int, total: list[int]) -> None:
        self.n, self.total = n, total
        self.axes = np.zeros((0, len(total)))
        self.values = np.zeros(0)
        self.trace = 0.0

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exact: 64-bit integers where these do, else Python's."""
        most = max(map(abs, self.total), default=0) + self.n * int(np.abs(x).max(initial=0))
        if most < 1 << 62:
            return x * self.n - np.array(self.total, np.int64)
        return x.astype(object) * self.n - np.array(self.total, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        d = self.differences(x)
        if d.dtype == object:
            return np.array([[v / self.n for v in row] for row in d.tolist()], float).reshape(d.shape)
        return d / float(self.n)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n*x - S)**2, exact."""
        d = self.differences(x)
        if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * max(1, d.shape[1]) >= 1 << 63:
            d = d.astype(object)
        return [int(v) for v in (d * d).sum(axis=1)]

    def solve(self, covariance: np.ndarray, most: int) -> None:
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        values, vectors = values[::-1], vectors[:, ::-1].T
        self.trace = float(np.trace(covariance))
        real = values > max(values[0], 0.0) * len(values) * np.finfo(float).eps * 8
        self.values, self.axes = values[real][:most], vectors[real][:most]
        turn = np.take_along_axis(self.axes, np.abs(self.axes).argmax(axis=1)[:, None], axis=1)
        self.axes = self.axes * np.where(turn < 0, -1.0, 1.0)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes.T / np.sqrt(self.values)


def _vectors(lists: pa.ListArray, dtype: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the lists, in blocks of equal length."""
    length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    begin = np.cumsum(length) - length
    for dims in np.unique(length).tolist():
        rows = np.flatnonzero(length == dims)
        step = max(1, BLOCK // max(1, dims))
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            yield some, flat[begin[some][:, None] + np.arange(dims)].astype(dtype, copy=False)


def _products(centres: dict[int, Callable[[np.ndarray], np.ndarray]], dtype: type) -> Batches:
    """The task's sums of weighted outer products, a row per matrix row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            weight = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            for rows, x in _vectors(batch.column(0), dtype):
                dims = x.shape[1]
                c = centres[dims](x)
                part = (c * weight[rows][:, None]).T @ c
                sums[dims] = sums[dims] + part if dims in sums else part
        for dims, total in sums.items():
            yield pa.RecordBatch.from_pydict({
                "dims": pa.array([dims] * len(total), pa.int32()), "i": pa.array(range(len(total)), pa.int32()),
                "products": pa.array(list(total), pa.list_(pa.float64()))})
    return run


def _covariances(vectors: DataFrame, centres: dict[int, Callable[[np.ndarray], np.ndarray]], n: dict[int, int],
                 dtype: type = float) -> dict[int, np.ndarray]:
    """By length: the covariance of (v, weight), divisor ``n``."""
    parts = vectors.select("v", "weight").mapInArrow(
        _products(centres, dtype), "dims int, i int, products array<double>")
    cells = (parts.select("dims", "i", F.posexplode("products").alias("j", "p"))
             .groupBy("dims", "i", "j").agg(F.sum("p").alias("p")))
    found = {d: np.zeros((d, d)) for d in n}
    for r in cells.toLocalIterator():  # dimension times dimension numbers
        found[r["dims"]][r["i"], r["j"]] = r["p"] / n[r["dims"]]
    return found


def _applied(fits: dict[int, Fit]) -> Batches:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            white: list = [None] * batch.num_rows
            apart: list = [None] * batch.num_rows
            for rows, x in _vectors(batch.column(1), np.int64):
                fit = fits[x.shape[1]]
                for i, w, d in zip(rows.tolist(), fit.whitened(x), fit.deviations(x)):
                    white[i], apart[i] = w, d if d < 1 << 63 else None
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(white, pa.list_(pa.float64())), pa.array(apart, pa.int64())],
                ["h", "v", "weight", "whitened", "deviation"])
    return run


def integers(rows: DataFrame, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, h, v) of the rows that take part: ``v`` holds x - SHIFT, ``h`` its hash."""
    v = F.col("c")
    own = rows.select(F.col(ident).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = own.where(v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(False)))
    edge = F.lit(_EDGE)
    x = F.transform(v, lambda c: F.floor(F.greatest(F.least(c * SCALE, edge), -edge)))
    return whole.select("vec_id", x.alias("v")).select("vec_id", F.xxhash64("v").alias("h"), "v")


def fitted(distinct: DataFrame, components: int) -> dict[int, Fit]:
    """The fits over (v, weight), by vector length."""
    dims = F.size("v").alias("dims")
    numbers = {r["dims"]: int(r["n"]) for r in
               distinct.groupBy(dims).agg(F.sum(F.col("weight").cast("decimal(38,0)")).alias("n")).collect()}
    sums = (distinct.select(dims, "weight", F.posexplode("v").alias("j", "x")).groupBy("dims", "j")
            .agg(F.sum(F.col("x").cast("decimal(19,0)") * F.col("weight").cast("decimal(18,0)")).alias("s")))
    totals: dict[int, list[int]] = {d: [0] * d for d in numbers}
    for r in sums.toLocalIterator():
        totals[r["dims"]][r["j"]] = int(r["s"])
    fits = {d: Fit(n, totals[d]) for d, n in numbers.items()}
    if fits:
        covariances = _covariances(distinct, {d: f.centred for d, f in fits.items()}, numbers, np.int64)
        for d, fit in fits.items():
            fit.solve(covariances[d], components)
    return fits


def _error(white: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """By length of the vectors: the largest absolute entry of whitened's covariance minus the identity."""
    errors = {}
    for d, fit in fits.items():
        k = len(fit.values)
        if not k:
            continue
        own = white.where(F.size("v") == d).select(F.col("whitened").alias("v"), "weight")
        sums = (own.select("weight", F.posexplode("v").alias("j", "w")).groupBy("j")
                .agg(F.sum(F.col("w") * F.col("weight")).alias("s")).collect())
        mean = np.zeros(k)
        for r in sums:
            mean[r["j"]] = r["s"] / fit.n
        found = _covariances(own, {k: lambda w, mean=mean: w - mean}, {k: fit.n})[k]
        errors[d] = float(np.abs(found - np.eye(k)).max())
    return errors


def whiten(rows: DataFrame, components: int = 16, weights: str = "one") -> DataFrame:
    """One row per row that takes part and component: vec_id, component, n, deviation,
    whitened, explained, identity_error.  ``weights`` is ``one`` or ``counts``."""
    if weights not in ("one", "counts"):
        raise ValueError("weights are 'one' or 'counts'")
    own = integers(rows)
    weight = F.count(F.lit(1)) if weights == "counts" else F.lit(1).cast("long")
    distinct = settle(own.groupBy("h", "v").agg(weight.alias("weight")), "distinct")
    fits = fitted(distinct, components)
    white = settle(distinct.mapInArrow(
        _applied(fits), "h long, v array<long>, weight long, whitened array<double>, deviation long"), "whitened")
    errors = _error(white, fits)
    known = [(d, f.n, float(errors.get(d, 0.0)), [float(x) / f.trace for x in f.values]) for d, f in fits.items()]
    facts = rows.sparkSession.createDataFrame(
        known, "dims int, n long, identity_error double, shares array<double>")
    each = white.withColumn("dims", F.size("v")).join(F.broadcast(facts), "dims").select(
        "h", "v", "n", "deviation", "identity_error",
        F.arrays_zip("whitened", F.col("shares").alias("explained")).alias("parts"))
    joined = own.join(each, ["h", "v"])
    return joined.select("vec_id", "n", "deviation", "identity_error", F.posexplode("parts").alias("at", "part")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("part.whitened").alias("whitened"),
        F.col("part.explained").alias("explained"), "identity_error")
