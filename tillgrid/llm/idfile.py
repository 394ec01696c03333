"""Token-id files with Elias-Fano document boundaries.

A file holds the concatenated ids of consecutive documents and two monotone
sequences in Elias-Fano form: where each document ends, and the document ids.
With u the largest value and n values, the low ``floor(log2(u / n))`` bits of
each value stand in a packed array, the rest in unary in a bit array of at most
3n + 1 bits; a sample of every 64th set bit lets ``select`` start near its goal.
That is about 2 + log2(u / n) bits a document, with no table of 64-bit offsets.

Layout, little-endian: magic ``TGEF`` and a uint32 header length, the header as
JSON, then the sections that the header lists with their lengths: ids, ends_low,
ends_high, ends_sample, docs_low, docs_high, docs_sample.

Documents are written in ascending id order (null ids last, equal ids by
text); the files are bounded and their order is the order of their names.
Defined results: a null or empty text is the end id alone; repeated rows are
documents of their own; an empty table writes no file and gives no rows;
columns beside ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import parts_of, scratch, settle, tidy
from ._tokens import check_id, encoder

MAGIC = b"TGEF"
EVERY = 64
SECTIONS = ("ids", "ends_low", "ends_high", "ends_sample", "docs_low", "docs_high", "docs_sample")


class EliasFano:
    """A non-decreasing sequence of non-negative integers."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray,
                 sample: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high, self.sample = n, low_bits, low, high, sample

    @classmethod
    def build(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        if low_bits:
            shifts = np.arange(low_bits, dtype=np.uint64)
            bits = (values[:, None] >> shifts & np.uint64(1)).astype(np.uint8)
            low = np.packbits(bits.ravel(), bitorder="little")
        else:
            low = np.zeros(0, np.uint8)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros((top >> low_bits) + n + 1, np.uint8)
        unary[ones] = 1
        return cls(n, low_bits, low, np.packbits(unary, bitorder="little"),
                   ones[::EVERY].astype("<u4"))

    def _low(self, i: int) -> int:
        at = i * self.low_bits
        raw = int.from_bytes(self.low[at >> 3:(at + self.low_bits + 7) >> 3].tobytes(), "little")
        return raw >> (at & 7) & (1 << self.low_bits) - 1

    def select(self, i: int) -> int:
        """Value ``i``: the position of the i-th set bit, found from the nearest
        sample, gives the high part."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.sample[i // EVERY]), i % EVERY
        byte = at >> 3
        word = int(self.high[byte]) >> (at & 7) << (at & 7)
        while (count := word.bit_count()) <= left:
            left -= count
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        position = byte * 8 + (word & -word).bit_length() - 1
        return (position - i) << self.low_bits | (self._low(i) if self.low_bits else 0)

    def values(self) -> np.ndarray:
        """All values, in blocks, as int64."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        out = (ones - np.arange(self.n)) << self.low_bits
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits]
            weights = np.int64(1) << np.arange(self.low_bits, dtype=np.int64)
            out |= bits.reshape(self.n, self.low_bits) @ weights
        return out


def dump(ids: list[np.ndarray], doc_ids: list[int | None]) -> Iterator[bytes]:
    """The file of some documents: ``ids`` of each, and their document ids
    (ascending, nulls last)."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    first = int(known[0]) if len(known) else 0
    gaps = (known - first).astype(np.uint64) if len(known) else np.zeros(0, np.uint64)
    ends = EliasFano.build(np.cumsum([len(x) for x in ids]).astype(np.uint64))
    docs = EliasFano.build(gaps)
    dtype = ids[0].dtype if ids else np.dtype("<u2")
    body = {"ids": None, "ends_low": ends.low, "ends_high": ends.high,
            "ends_sample": ends.sample, "docs_low": docs.low, "docs_high": docs.high,
            "docs_sample": docs.sample}
    sizes = {k: (sum(len(x) for x in ids) * dtype.itemsize if v is None else v.nbytes)
             for k, v in body.items()}
    header = json.dumps({"n": len(ids), "known": len(known), "first": first,
                         "id_bytes": dtype.itemsize, "ends_bits": ends.low_bits,
                         "docs_bits": docs.low_bits, "sizes": sizes}).encode()
    yield MAGIC + struct.pack("<I", len(header)) + header
    for x in ids:
        yield x.tobytes()
    for k in SECTIONS[1:]:
        yield body[k].tobytes()


class IdFile:
    """An id file opened for reading."""

    def __init__(self, stream) -> None:
        if stream.read(4) != MAGIC:
            raise ValueError("not an id file")
        (size,) = struct.unpack("<I", stream.read(4))
        h = json.loads(stream.read(size))
        raw = {k: stream.read(h["sizes"][k]) for k in SECTIONS}
        if any(len(raw[k]) != h["sizes"][k] for k in SECTIONS):
            raise ValueError("the id file is cut short")
        part = {k: np.frombuffer(raw[k], "<u4" if k.endswith("sample") else np.uint8)
                for k in SECTIONS[1:]}
        self.n = h["n"]
        self.ids = np.frombuffer(raw["ids"], f"<u{h['id_bytes']}")
        self.ends = EliasFano(h["n"], h["ends_bits"], part["ends_low"], part["ends_high"],
                              part["ends_sample"])
        self._docs = EliasFano(h["known"], h["docs_bits"], part["docs_low"], part["docs_high"],
                               part["docs_sample"])
        self.first = h["first"]

    def doc_id(self, i: int) -> int | None:
        """The id of document ``i``, by a select; the last of a file may have none."""
        return self._docs.select(i) + self.first if i < self._docs.n else None

    def document(self, i: int) -> np.ndarray:
        """The ids of document ``i`` of the file, by two selects."""
        return self.ids[self.ends.select(i - 1) if i else 0:self.ends.select(i)]


def _writer(folder: str, path: str, end: int, file_ids: int):
    def write(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        made, held, docs, size = [], [], [], 0

        def flush() -> None:
            nonlocal held, docs, size
            name = f"part-{task.partitionId():07d}-{len(made):05d}.ids"
            trial = f"{root}/.{name}.{task.taskAttemptId()}"
            with fs.open_output_stream(trial) as out:
                for block in dump(held, docs):
                    out.write(block)
            fs.move(trial, f"{root}/{name}")
            made.append((name, len(held), size))
            held, docs, size = [], [], 0

        fs.create_dir(root, recursive=True)
        coder = encoder(path)
        for frame in frames:
            for part in parts_of(frame, 1):
                texts = part.column(1).to_pylist()
                for doc, ids in zip(part.column(0).to_pylist(), coder.encode(texts, end)):
                    held.append(ids)
                    docs.append(doc)
                    size += len(ids)
                    if size >= file_ids:
                        flush()
        if held:
            flush()
        names, n_docs, n_ids = zip(*made) if made else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(n_docs, pa.int64()), pa.array(n_ids, pa.int64())],
            ["file", "n_docs", "n_ids"])
        tidy()
    return write


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, folder: str,
              file_ids: int = 1 << 23) -> DataFrame:
    """Write the id files below ``folder`` (a URI that every executor reaches)
    and return their manifest: file, n_docs, n_ids, start.

    A file is closed once it holds ``file_ids`` ids.  It is written under a
    name of the attempt and moved into place, so that a retried task replaces
    its own files and a reader never sees part of one."""
    check_id(tokenizer, end_id)
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("text").cast("string").alias("text"))
               .repartitionByRange(*order).sortWithinPartitions(*order, "text"))
    made = settle(ordered.mapInArrow(_writer(folder, tokenizer, end_id, file_ids),
                                     "file string, n_docs long, n_ids long"), "id-files")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _reader(folder: str):
    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for frame in frames:
            for name, base in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist()):
                with fs.open_input_stream(f"{root}/{name}") as stream:
                    opened = IdFile(stream)
                end = 0
                for at in range(0, opened.n, 4096):
                    rows = []
                    for i in range(at, min(opened.n, at + 4096)):
                        start, end = end, opened.ends.select(i)
                        crc = zlib.crc32(opened.ids[start:end].astype("<u4").tobytes())
                        rows.append((opened.doc_id(i), start + base, end - start, crc))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                     ["doc_id", "start", "n_tokens", "ids_crc32"])
    return read


def read_ids(files: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files in a manifest: doc_id, start (over all
    files), n_tokens, ids_crc32."""
    spread = files.select("file", "start").repartition("file")
    return spread.mapInArrow(_reader(folder),
                             "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write ``docs`` to a new folder of the shared space and read them back."""
    folder = scratch(docs.sparkSession, "ids")
    if "://" not in folder:
        folder = f"file://{folder.removeprefix('file:')}"
    return read_ids(write_ids(docs, tokenizer, end_id, folder), folder)
