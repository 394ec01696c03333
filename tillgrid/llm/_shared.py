"""Small helpers shared by the operators: scratch tables, unique row keys, byte-level words.

Scratch tables and files go below the shared folder of the session
(``spark.checkpoint.dir``), never to a folder of one machine.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tables import Tables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return Tables(spark, sf_dir).read(name)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.  Cuts the lineage:
    a lost executor costs a re-read, not a recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def keyed(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with a unique, never-null long ``key`` that ascends with doc_id.

    Usually that is doc_id itself.  Where ids are null or repeat, the rows are
    numbered in id order (null ids last) and written to the shared folder, so
    that every later read sees the same numbers."""
    ids = docs.groupBy("doc_id").count().agg(
        F.max("count").alias("most"), F.max(F.col("doc_id").isNull()).alias("null")).first()
    if ids["most"] in (None, 1) and not ids["null"]:
        return docs.withColumn(key, F.col("doc_id").cast("long"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    numbered = (docs.repartitionByRange(*order).sortWithinPartitions(*order, "text")
                .withColumn(key, F.monotonically_increasing_id()))
    return settle(numbered, "keyed")


# --- words as byte runs -------------------------------------------------------------

SLICE = 1 << 20
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over uint64 values (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants made by the finaliser from a counter."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                   + np.uint64(seed)) | np.uint64(1)


_BYTE = constants(256, 11)
_RADIX = int(constants(1, 23)[0])
_UNRADIX = pow(_RADIX, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(radix: int, n: int) -> np.ndarray:
    """radix**0 .. radix**(n-1) mod 2**64, by doubling; kept up to SLICE."""
    have = _POWERS.get(radix)
    if have is None or len(have) < n:
        have = np.ones(1, np.uint64)
        with np.errstate(over="ignore"):
            while len(have) < n:
                have = np.concatenate([have, have * np.uint64(pow(radix, len(have), 1 << 64))])
        if n <= 2 * SLICE:
            _POWERS[radix] = have
    return have[:n]


def powers(n: int) -> np.ndarray:
    return _powers(_RADIX, n)


def unpowers(n: int) -> np.ndarray:
    """The inverses of ``powers``."""
    return _powers(_UNRADIX, n)


def lower_words() -> np.ndarray:
    """Byte classes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z is lowered: 1 in a word, else 0."""
    classes = np.zeros(256, np.uint8)
    classes[ord("0"):ord("9") + 1] = 1
    classes[ord("a"):ord("z") + 1] = 1
    classes[0x80:] = 1
    return classes


def slices(data: bytes, gap: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Cut points so that no run of bytes outside ``gap`` is cut."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + size)
        while end < n and not gap[data[end]]:
            end += 1
        yield at, end
        at = end


def runs(data: bytes, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of equal non-zero class: byte starts, byte ends, 64-bit hashes.

    A hash is a polynomial over the run's bytes; all hashes of a slice come
    from one running sum.  Works in slices, so memory beside the result is
    bounded whatever the length."""
    parts = []
    gap = classes == 0
    for lo, hi in slices(data, gap):
        buf = np.frombuffer(data, np.uint8, hi - lo, lo)
        kind = classes[buf]
        cut = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        cut = np.concatenate([[0], cut, [len(buf)]])
        start, end = cut[:-1], cut[1:]
        real = kind[start] != 0
        start, end = start[real], end[real]
        with np.errstate(over="ignore"):
            total = np.zeros(len(buf) + 1, np.uint64)
            np.cumsum(_BYTE[buf] * _powers(_RADIX, len(buf)), out=total[1:])
            hashed = mix((total[end] - total[start]) * _powers(_UNRADIX, len(buf))[start]
                         + (end - start).astype(np.uint64))
        parts.append((start + lo, end + lo, hashed))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def batches_of_text(texts: list, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` (bytes or None) of about ``size`` bytes together."""
    at, total = 0, 0
    for i, x in enumerate(texts):
        total += len(x or b"") + 1
        if total >= size:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def blocks(texts: list, alone: int) -> Iterator[tuple[int, int]]:
    """As ``batches_of_text``, but a text of more than ``alone`` bytes is a range of its own."""
    at, total = 0, 0
    for i, x in enumerate(texts):
        n = len(x or b"")
        if n > alone:
            if at < i:
                yield at, i
            yield i, i + 1
            at, total = i + 1, 0
            continue
        total += n + 1
        if total >= SLICE:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def cuts(size: int, *columns: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of the rows of ``columns`` with about ``size`` bytes of text together."""
    length = sum(pc.fill_null(pc.binary_length(x), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                 for x in columns)
    go = np.cumsum(length + 1) // size
    cut = np.concatenate([[0], np.flatnonzero(np.diff(go)) + 1, [len(length)]])
    return ((lo, hi) for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()) if hi > lo)


def parts_of(frame: pa.RecordBatch, column: int, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Slices of a record batch with about ``size`` bytes of text each."""
    for lo, hi in cuts(size, frame.column(column)):
        yield frame.slice(lo, hi - lo)


def text_lists(texts: pa.Array, size: int = 1 << 22) -> Iterator[list]:
    """The texts as bytes (or None), in lists of about ``size`` bytes each."""
    for lo, hi in cuts(size, texts):
        yield texts.slice(lo, hi - lo).cast(pa.binary()).to_pylist()


def tidy() -> None:
    """At a task's end: give what it no longer needs back to the system, so that
    the worker, which Spark keeps for later tasks, does not hold the task's peak."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def joined(texts: list) -> tuple[bytes, np.ndarray]:
    """Texts with a line feed behind each, and where each begins (with the end as last)."""
    lengths = np.fromiter((len(x or b"") + 1 for x in texts), np.int64, len(texts))
    return b"".join([(x or b"") + b"\n" for x in texts]), np.concatenate([[0], np.cumsum(lengths)])
