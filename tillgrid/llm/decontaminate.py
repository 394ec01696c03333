"""Benchmark decontamination by Wu-Manber search over words.

Words are the byte runs ``[0-9a-z\\x80-\\xff]+`` after A-Z is lowered.  Every
window of ``window`` consecutive words of a benchmark item is a pattern; an
item of fewer words, but not none, is one pattern.  Patterns of one length form
one search:

* the shift table holds, for every block of two words in a pattern, how far
  the search may move on when a text position ends with that block; blocks in
  no pattern move it by the length less one,
* a block that ends a pattern has a bucket, keyed by the pattern's first two
  words (the prefix check), of the patterns themselves,
* direct comparison of all words confirms an occurrence.

The benchmark is the side that is sent to every task.  Its size is checked
first: one of at most ``block_bytes`` is sent as it is.  A larger one is dealt into
blocks of about that size, and the documents are read once per block: a block is sent,
its hits are written, and it is destroyed before the next is fetched.  So the driver
and a task hold one block at a time (an item larger than a block is one by itself),
and the hits of a document are put together at the end.

Defined results: null and empty texts have no words and are not contaminated;
benchmark rows with a null text have no windows; a null item_id still hits but
is not listed; rows that repeat an item_id are one item; an empty benchmark hits
nothing; other columns are kept out of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import free_name, lower_words, settle, text_lists, tidy

STRIDE = 1 << 22

#: Byte map: A-Z lowered, word bytes kept, all others a space.
_FOLD = bytes(b if c else (b + 32 if 65 <= b <= 90 else 32)
              for b, c in enumerate(lower_words()))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


class WuManber:
    """Search for word patterns of one length; ``patterns`` maps each to its items."""

    def __init__(self, patterns: dict[tuple[bytes, ...], frozenset]) -> None:
        self.length = m = len(next(iter(patterns)))
        self.block = b = min(2, m)
        self.far = m - b + 1
        self.shift: dict = {}
        self.bucket: dict = {}
        for p, items in patterns.items():
            for end in range(b, m + 1):
                key = p[end - b:end]
                self.shift[key] = min(self.shift.get(key, self.far), m - end)
            by_prefix = self.bucket.setdefault(p[m - b:], {})
            by_prefix.setdefault(p[:b], []).append((p, items))

    def occurrences(self, text: list[bytes]) -> Iterator[tuple[int, frozenset]]:
        """(first word, items) of each occurrence, in order."""
        m, b, far, shift, bucket = self.length, self.block, self.far, self.shift, self.bucket
        at, n = m, len(text)
        while at <= n:
            key = (text[at - 2], text[at - 1]) if b == 2 else (text[at - 1],)
            step = shift.get(key, far)
            if step:
                at += step
                continue
            start = at - m
            for p, items in bucket[key].get(tuple(text[start:start + b]), ()):
                if tuple(text[start:at]) == p:
                    yield start, items
            at += 1


def searches(items: list[tuple[int | None, bytes | None]], window: int) -> list[WuManber]:
    """One search per pattern length."""
    found: dict[int, dict[tuple[bytes, ...], set]] = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            p = tuple(w[i:i + window])
            found.setdefault(len(p), {}).setdefault(p, set()).add(item)
    return [WuManber({p: frozenset(x) for p, x in found[m].items()}) for m in sorted(found)]


def scan(text: bytes | None, tables: list[WuManber]) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, hit word spans (merged, ascending) and items of a text.

    Long texts are taken in strides that overlap by the longest pattern less
    one word."""
    text = text or b""
    most = max((t.length for t in tables), default=1)
    n_words, carry, at, spans, items = 0, [], 0, [], set()
    while at < len(text) or at == 0:
        end = len(text)
        if end - at > STRIDE:
            end = at + STRIDE
            while end < len(text) and _FOLD[text[end]] != 32:
                end += 1
        fresh = words(text[at:end])
        held = carry + fresh
        first = n_words - len(carry)
        for t in tables:
            for start, which in t.occurrences(held):
                if start + t.length > len(carry):
                    spans.append((first + start, first + start + t.length))
                    items |= which
        n_words += len(fresh)
        carry = held[len(held) - most + 1:] if len(held) >= most else held
        if most == 1:
            carry = []
        if end >= len(text):
            break
        at = end
    merged: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    return n_words, merged, items


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
FOUND = "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<bigint>>"


def _finder(tables):
    @F.arrow_udf(FOUND)
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ready = searches(*tables.value)
        for column in texts:
            rows = [scan(x, ready) for part in text_lists(column) for x in part]
            yield pa.StructArray.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([[{"start": s, "end": e} for s, e in r[1]] for r in rows], _SPANS),
                 pa.array([sorted(x for x in r[2] if x is not None) for r in rows],
                          pa.list_(pa.int64()))],
                ["n_words", "spans", "items"])
        tidy()
    return find


def blocks(benchmark: DataFrame, block_bytes: int) -> int:
    """Number of blocks that keep each at about ``block_bytes`` at most."""
    size = benchmark.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    return -(-size // block_bytes)


def _items(rows: DataFrame) -> list[tuple[int | None, bytes]]:
    return [(r[0], r[1].encode()) for r in rows.collect() if r[1]]


def searched(docs: DataFrame, benchmark: DataFrame, out: str, window: int = 10, block_bytes: int = 1 << 23) -> DataFrame:
    """``docs`` with a further column ``out``: n_words, spans (hit word ranges, merged) and
    items (ascending ids of the items with occurring windows) of their ``text``."""
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.col("text").cast("string").alias("text"))
    n = blocks(bench, block_bytes)
    send = docs.sparkSession.sparkContext.broadcast
    text = F.col("text").cast("string")
    if n <= 1:
        return docs.withColumn(out, _finder(send((_items(bench), window)))(text))
    bench = settle(bench.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "benchmark")
    # rows are known by their place in a table written once
    row = free_name(docs, "row")
    held = settle(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    hits = []
    for k in range(n):
        block = send((_items(bench.where(F.col("block") == k)), window))
        got = held.select(row, _finder(block)(text).alias("f")).select(row, "f.*")
        hits.append(settle(got if k == 0 else got.where(F.size("spans") > 0), "hits"))
        block.destroy()
    every = hits[0]
    for more in hits[1:]:
        every = every.unionByName(more)
    # one row a document and block at most
    each = every.groupBy(row).agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    each = each.select(row, F.struct("n_words", _merged("spans").alias("spans"), "items").alias(out))
    return held.join(each, row).drop(row)


def _merged(spans: str) -> Column:
    """Ascending spans, those that touch as one."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= x["start"]),
                      F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))
                      ).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(spans, none, add)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  block_bytes: int = 1 << 23) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, spans (hit word ranges, merged) and
    items (ascending ids of the items with occurring windows)."""
    return searched(docs.select("doc_id", "text"), benchmark, "found", window, block_bytes).select("doc_id", "found.*")


def digest(found_rows: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found_rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10,
          block_bytes: int = 1 << 23) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    found = free_name(docs, "found")
    kept = searched(docs, benchmark, found, window, block_bytes).where(F.size(F.col(found)["spans"]) == 0)
    return kept.select(*docs.columns)


def sha256_of(items: list[int]) -> str:
    """The digest of a list of item ids, as the query gives it."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
