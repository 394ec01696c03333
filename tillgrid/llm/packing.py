"""Packing by power-of-two decomposition.

A document of n ids is cut into n // longest pieces of the longest length and
one piece for each binary digit of the rest, longest first.  Every piece is a
sequence by itself: no sequence crosses documents and none is padded, as every
length is a power of two.  Sequences are numbered bucket by bucket (equal
lengths together, longest first), so a training job reads equal-length batches
from consecutive numbers.

Defined results: a null or empty text is the end id alone; repeated rows and
null ids are documents of their own; an empty table gives no rows; columns
beside ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import parts_of, settle, tidy
from ._tokens import check_id, encoder

#: Bytes of text cut and encoded together: the arrays over their words take some 30 times that.
BLOCK = 1 << 19

SCHEMA = ("doc_id long, start long, length long, input_ids array<int>, ids_crc32 long, "
          "doc_tokens long, task int, place long")


def decompose(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids: full ones, then the binary digits of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1)
                                         if rest >> b & 1]


class _Rows:
    """Output rows gathered into record batches of bounded size."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.columns: list[list] = [[] for _ in range(7)]
        self.ids: list[np.ndarray] = []
        self.n_ids = 0

    def add(self, ids: np.ndarray, *values) -> None:
        for c, v in zip(self.columns, values):
            c.append(v)
        self.ids.append(ids)
        self.n_ids += len(ids)

    def batch(self) -> pa.RecordBatch:
        doc, start, crc, total, task, place, _ = self.columns
        lengths = np.fromiter(map(len, self.ids), np.int64, len(self.ids))
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        flat = np.concatenate(self.ids).astype(np.int32) if self.ids else np.zeros(0, np.int32)
        out = pa.RecordBatch.from_arrays([
            pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(lengths),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            pa.array(crc, pa.int64()), pa.array(total, pa.int64()),
            pa.array(task, pa.int32()), pa.array(place, pa.int64())],
            ["doc_id", "start", "length", "input_ids", "ids_crc32", "doc_tokens", "task", "place"])
        self.clear()
        return out


def _cutter(path: str, end: int, longest: int):
    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        places: dict[int, int] = {}
        rows = _Rows()
        coder = encoder(path)
        for frame in frames:
            for part in parts_of(frame, 1, BLOCK):
                texts = part.column(1).to_pylist()
                for doc, ids in zip(part.column(0).to_pylist(), coder.encode(texts, end, BLOCK)):
                    at = 0
                    for n in decompose(len(ids), longest):
                        piece = ids[at:at + n]
                        place = places.get(n, 0)
                        places[n] = place + 1
                        rows.add(piece, doc, at, zlib.crc32(piece.astype("<u4").tobytes()),
                                 len(ids), task, place)
                        at += n
                        if rows.n_ids >= 1 << 18:
                            yield rows.batch()
        yield rows.batch()
        tidy()
    return cut


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, longest: int = 4096) -> DataFrame:
    """One row per piece: doc_id, start, length, input_ids, ids_crc32,
    doc_tokens, sequence_id, offset.

    Texts are tokenised once and the pieces written to the shared folder;
    numbering then needs only the counts per (length, task)."""
    if longest < 1 or longest & longest - 1:
        raise ValueError("the longest length must be a power of two")
    check_id(tokenizer, end_id)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
    pieces = settle(source.mapInArrow(_cutter(tokenizer, end_id, longest), SCHEMA), "pieces")
    counts = pieces.groupBy("length", "task").count()
    in_bucket = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    longer = Window.orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.groupBy("length").agg(F.sum("count").alias("n")).select(
        "length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("first"))
    bases = (counts.withColumn("before", F.coalesce(F.sum("count").over(in_bucket), F.lit(0)))
             .join(buckets, "length")
             .select("length", "task", (F.col("first") + F.col("before")).alias("base")))
    return (pieces.join(bases, ["length", "task"])
            .select("doc_id", "start", "length", "input_ids", "ids_crc32", "doc_tokens",
                    (F.col("base") + F.col("place")).alias("sequence_id"),
                    F.lit(0).cast("long").alias("offset")))
