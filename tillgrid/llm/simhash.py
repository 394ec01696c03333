"""SimHash near-duplicates with pigeonring filtering.

A fingerprint has 64 bits; a bit is set if over half of the text's shingle
hashes have it.  Two fingerprints link at ``distance`` or fewer differing bits.

The bits are cut into ``SEGMENTS`` segments on a ring.  If two fingerprints
differ in at most d bits, then from some segment on, every chain of c
consecutive segments differs in at most c * d / SEGMENTS bits.  For 3 bits and 8
segments the budgets are 0, 0, 1, 1, 1, 2, 2, 3: two whole segments agree, and
of the next three all but one.  Such choices are the join keys (24 of 32 bits
each for these numbers), so a candidate shares half of its bits exactly.  The
whole chain of budgets is tested next, the Hamming distance last.

Copies collapse first: candidates are distinct fingerprints.  A key that many
fingerprints share is split into blocks, and each pair of blocks is a group of
bounded size.  A group gives a spanning forest of its links, not all pairs, and
components come from a distributed star algorithm.

Defined results: a text without words (null and empty too) has fingerprint
zero and links like any other; repeated rows each get a row; a null doc_id gets
the component of its fingerprint, whose id is null where all its ids are; an
empty table gives no rows; columns beside ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._components import components
from ._shared import free_name, keyed, settle, text_lists, tidy

SEGMENTS = 8
WIDTH = 64 // SEGMENTS
#: Fingerprints of a key that are compared in one group.
BLOCK = 1024
#: Words hashed at a time.
STRIDE = 1 << 16


def text_fingerprint(text: bytes | None, shingle: int = 3) -> bytes:
    """Eight bytes, the highest bit first."""
    words = (text or b"").lower().split()
    n = max(1, len(words) - shingle + 1) if words else 0
    ones = np.zeros(64, np.int64)
    for at in range(0, n, STRIDE):
        part = words[at:at + STRIDE + shingle - 1]
        line = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        last = min(shingle, len(part)) - 1
        hashes = b"".join([xxhash.xxh64_digest(line[a:b], 42)
                           for a, b in zip(starts[:len(part) - last].tolist(), ends[last:].tolist())])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(
            axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes() if n else bytes(8)


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint of a text as a (signed) long."""
    @F.arrow_udf("long")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array([int.from_bytes(text_fingerprint(x, shingle), "big", signed=True)
                            for texts_ in text_lists(column) for x in texts_], pa.int64())
        tidy()
    return of(text.cast("string"))


# --- the ring ----------------------------------------------------------------------

def budgets(distance: int) -> list[int]:
    """Differing bits allowed in a chain of 1, 2, ... SEGMENTS segments."""
    return [c * distance // SEGMENTS for c in range(1, SEGMENTS + 1)]


def _mask(segments) -> int:
    return sum(((1 << WIDTH) - 1) << WIDTH * (SEGMENTS - 1 - s % SEGMENTS) for s in segments)


def choices(distance: int) -> list[tuple[int, int]]:
    """(first segment, mask of the bits that must agree) of every join key.

    A chain of c segments with budget b has at most b segments that differ, so
    c - b agree.  The chain is the shortest of which half of all segments
    agree or, where none reaches that, the one with the most that agree."""
    allowed = budgets(distance)
    if distance >= SEGMENTS:
        raise ValueError("the distance must be below the number of segments")
    agree = lambda c: min(c - allowed[c - 1], SEGMENTS // 2)
    length = max(range(1, SEGMENTS + 1), key=lambda c: (agree(c), -c))
    exact = sum(b == 0 for b in allowed[:length])
    found = {}
    for first in range(SEGMENTS):
        tail = range(first + exact, first + length)
        for off in combinations(tail, allowed[length - 1]):
            mask = _mask([first + s for s in range(exact)] + [s for s in tail if s not in off])
            found[first, mask] = None
    return list(found)


def _chain_masks(first: int) -> list[int]:
    return [_mask(range(first, first + c)) for c in range(1, SEGMENTS + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def linked(values: np.ndarray, first: int, distance: int) -> list[tuple[int, int]]:
    """A spanning forest, as index pairs, of the links in one group whose chain from ``first`` holds."""
    n = len(values)
    masks, allowed = _chain_masks(first), budgets(distance)
    if n == 2:
        diff = int(values[0] ^ values[1])
        ok = diff.bit_count() <= distance and all(
            (diff & m).bit_count() <= b for m, b in zip(masks, allowed))
        return [(0, 1)] if ok else []
    rows, columns = [], []
    for at in range(0, n, 256):
        diff = values[at:at + 256, None] ^ values[None, :]
        ok = np.ones(diff.shape, bool)
        for m, b in zip(masks, allowed):
            ok &= np.bitwise_count(diff & np.uint64(m)) <= b
        ok &= np.bitwise_count(diff) <= distance
        r, c = np.nonzero(ok)
        keep = r + at < c
        rows.append(r[keep] + at)
        columns.append(c[keep])
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest = []
    for a, b in zip(np.concatenate(rows).tolist(), np.concatenate(columns).tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            forest.append((a, b))
    return forest


_PAIR = pa.struct([("u", pa.int64()), ("v", pa.int64())])


def _forest(distance: int, firsts: list[int]):
    @F.arrow_udf("array<struct<u:bigint,v:bigint>>")
    def forest(groups: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for choice, members in groups:
            out = []
            for k, held in zip(choice.to_pylist(), members):
                values = held.values.to_numpy().view(np.uint64)
                out.append([{"u": int(values[a].view(np.int64)), "v": int(values[b].view(np.int64))}
                            for a, b in linked(values, firsts[k], distance)])
            yield pa.array(out, pa.list_(_PAIR))
        tidy()
    return forest


def links(fingerprints: DataFrame, distance: int = 3, block: int = BLOCK) -> DataFrame:
    """Links (u, v) that connect all of the distinct longs in column ``fp``
    that lie within ``distance`` bits, by any path."""
    keys = choices(distance)
    shared = fingerprints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
        for k, (_, m) in enumerate(keys)])).alias("key")).select("fp", "key.*")
    met = (shared.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    rows = shared.join(met, ["choice", "bits"])
    parts = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    rows = rows.withColumn("parts", parts).withColumn("own", own).select(
        "choice", "bits", "fp", F.explode(F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda other: F.struct(F.least("own", other).alias("a"),
                                   F.greatest("own", other).alias("b")))).alias("pair"))
    groups = rows.groupBy("choice", "bits", "pair").agg(F.collect_list("fp").alias("members"))
    forest = _forest(distance, [f for f, _ in keys])
    return groups.where(F.size("members") > 1).select(
        F.explode(forest("choice", "members")).alias("l")).select("l.*")


def clustered(rows: DataFrame, ident: str, distance: int = 3) -> DataFrame:
    """``rows`` (columns ``ident`` and ``fp``) with ``component``: the smallest
    non-null ``ident`` reachable by links."""
    each = settle(rows.groupBy("fp").agg(F.min(ident).alias("least")), "distinct-fingerprints")
    roots = components(links(each, distance))
    named = each.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    by_root = named.groupBy("root").agg(F.min("least").alias("component"))
    return rows.join(named.join(by_root, "root").select("fp", "component"), "fp")


def groups(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """Per row of ``docs``: doc_id, fp and component (the smallest doc_id of its group)."""
    rows = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              fingerprint(F.col("text"), shingle).alias("fp")), "fingerprints")
    return clustered(rows, "doc_id", distance)


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of each group: that with the smallest doc_id (of repeated ids,
    the first by text; of groups without ids, the first by text)."""
    key = free_name(docs, "row")
    numbered = keyed(docs, key)
    rows = settle(numbered.select(F.col(key).alias("id"),
                                  fingerprint(F.col("text"), shingle).alias("fp")), "fingerprints")
    kept = clustered(rows, "id", distance).where("id = component").select(F.col("id").alias(key))
    return numbered.join(kept, key, "left_semi").select(*docs.columns)
