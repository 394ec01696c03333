"""Near-duplicate passages by compact windows.

Tokens are the word shingles of a document.  For each of ``hashes`` min-hash
functions, the Cartesian tree over the tokens' hashes gives compact windows
(l, c, r): every subsequence of l..r that holds c has its min-hash at c.  Only
windows as long as the shortest passage matter.  Their centres are the minima
of all runs of that length, and the nearest smaller hash to either side of such
a centre is such a centre too, so the tree is built over the centres alone:
about 2n / length windows per function, whatever the text.

Windows of two documents with the same function and the same min-hash share a
signature.  The first document with a signature leads it, and the others are
held against the leader, never against one another: one candidate per window.
For each pair of documents the candidates are intervals; those that overlap are
joined, and a stretch covered by at least ``agree`` functions is verified on the
shingles themselves: the longest stretches in which the shared shingles can
reach the similarity, then their Jaccard coefficient.

A leader that merely shares a signature (a common short line) may hide a passage.
Windows that no verified passage covers are therefore met twice more, the leader's
own included.  First with the first of those that agree in signature and in a second
key: the min-hash of a half passage to the left or right of the centre, that whole
half, or both min-hashes; and with every earlier one of the signature that no passage
covers either, first to last until one holds it: shingles around the centres that no other
document of the signature has are of no use to a passage, windows left with too few in any
stretch cannot have one, and of the others two must share one of their rarest shingles.
That passes over no pair that the verification would accept.  At last those that agree in
a whole half passage (every exact repeat does, to one side) give all runs
of the least length around the centre, and equal runs are exact repeats.  So exact
repeats are always found, and a near repeat of the least length with probability
1 - (1 - J) ** hashes, whatever documents lead its signatures; a longer one holds several.

A passage counts as repeated if an earlier document (by doc_id) holds it and
keeps it; the first occurrence stays.  Repeats within a document are left alone.

Defined results: null, empty and short texts have no passages; rows that repeat
a doc_id are documents of their own, in id order, then by text hash, null ids
last; an empty table gives no rows; columns beside ``doc_id`` and ``text`` are
not read, and ``cut`` returns them unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import (batches_of_text, constants, cuts, free_name, joined, keyed, lower_words, mix, parts_of,
                      powers, runs, settle, tidy, unpowers)

SHINGLE = 5
_CLASSES = lower_words()
#: Window lengths to either side of the centre are kept up to this, for long windows
#: are cut to what both sides share and the neighbouring centres cover the rest.
REACH = (1 << 15) - 1
#: Functions that the low bits of a signature can tell apart.
MOST = 8
#: Slices of one document that are cut in one go.
WANTS = 256
#: Of the half passage to either side of a centre: the hash of the whole and the min-hash.
HALVES = ["before", "behind", "least_before", "least_behind"]


def shingles(data: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of joined texts and the place where each text's begin (and the end)."""
    starts, _, h = runs(data.lower(), _CLASSES)
    first = np.searchsorted(starts, at)
    n = np.maximum(np.diff(first) - SHINGLE + 1, 0)
    if len(h) < SHINGLE:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    bounds = np.concatenate([[0], np.cumsum(n)])
    take = np.repeat(first[:-1] - bounds[:-1], n) + np.arange(bounds[-1])
    return mix(_shingled(h)[take]), bounds


def _shingled(words: np.ndarray) -> np.ndarray:
    """A hash of every ``SHINGLE`` consecutive word hashes."""
    n = max(len(words) - SHINGLE + 1, 0)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k, c in enumerate(constants(SHINGLE, 71)):
            total += mix(words[k:n + k] * c)
    return total


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, from block-wise running minima."""
    n = len(x)
    pad = -n % width
    top = np.iinfo(x.dtype).max
    blocks = np.concatenate([x, np.full(pad, top, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def windows(order: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Compact windows (text, l, c, r) of at least ``width`` tokens; places count
    over all texts.  Of equal hashes the left is smaller."""
    n = len(order)
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, none, none
    # the place in the low bits makes all values differ and ties go left
    bits = max(1, int(n).bit_length())
    value = order >> np.uint64(bits) << np.uint64(bits) | np.arange(n, dtype=np.uint64)
    low = sliding_minimum(value, width)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = text[:n - width + 1] == text[width - 1:]
    centre = np.unique((low[inside] & np.uint64((1 << bits) - 1)).astype(np.int64))
    of = text[centre]
    key, begin, end = value[centre].tolist(), bounds[of].tolist(), (bounds[of + 1] - 1).tolist()
    place = centre.tolist()
    left, right, stack, doc = begin, end, [], -1
    for i, (p, k, t) in enumerate(zip(place, key, of.tolist())):
        if t != doc:
            stack, doc = [], t
        while stack and key[stack[-1]] > k:
            right[stack.pop()] = p - 1
        if stack:
            left[i] = place[stack[-1]] + 1
        stack.append(i)
    # typed, for without a centre (short texts alone) an array of nothing would be of floats
    return of, np.array(left, np.int64), centre, np.array(right, np.int64)


def run_hashes(h: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the runs of ``length`` shingles from ``begin`` on."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers(len(h)))])
        return mix((total[begin + length] - total[begin]) * unpowers(len(h))[begin])


def _halves(h: np.ndarray, bounds: np.ndarray, of: np.ndarray, centre: np.ndarray,
            length: int) -> list[np.ndarray]:
    """32-bit hashes of the ``length`` shingles before and behind each centre; 0 where the text has fewer."""
    out = []
    for begin in (centre - length, centre + 1):
        ok = (begin >= bounds[of]) & (begin + length <= bounds[of + 1])
        half = np.zeros(len(centre), np.int32)
        if ok.any():
            half[ok] = (run_hashes(h, begin[ok], length) >> np.uint64(33)).astype(np.int32) | 1
        out.append(half)
    return out


def _half_minima(order: np.ndarray, bounds: np.ndarray, of: np.ndarray, centre: np.ndarray,
                 length: int) -> list[np.ndarray]:
    """32 bits of the least of the ``length`` values before and behind each centre; 0 where the text has fewer."""
    low = sliding_minimum(order, length) if len(order) >= length else order[:0]
    out = []
    for begin in (centre - length, centre + 1):
        ok = (begin >= bounds[of]) & (begin + length <= bounds[of + 1])
        half = np.zeros(len(centre), np.int32)
        half[ok] = (mix(low[begin[ok]]) >> np.uint64(33)).astype(np.int32) | 1
        out.append(half)
    return out


def _signer(width: int, hashes: int):
    multiply, add = constants(hashes, 101), constants(hashes, 103)
    multiply_half, add_half = constants(hashes, 107), constants(hashes, 109)

    def sign(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in (part for whole in frames for part in parts_of(whole, 1)):
            ids = frame.column(0).to_numpy()
            texts = frame.column(1).cast(pa.binary()).to_pylist()
            for lo, hi in batches_of_text(texts):
                h, bounds = shingles(*joined(texts[lo:hi]))
                for j in range(hashes):
                    with np.errstate(over="ignore"):
                        order = mix(h * multiply[j] + add[j])
                        beside = mix(h * multiply_half[j] + add_half[j])
                    of, left, centre, right = windows(order, bounds, width)
                    name = order[centre] & ~np.uint64(MOST - 1) | np.uint64(j)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(name.view(np.int64)), pa.array(ids[lo + of]),
                         pa.array((centre - bounds[of]).astype(np.int32)),
                         pa.array((np.minimum(centre - left, REACH) << 16
                                   | np.minimum(right - centre, REACH)).astype(np.int32)),
                         *map(pa.array, _halves(h, bounds, of, centre, width // 2)),
                         *map(pa.array, _half_minima(beside, bounds, of, centre, width // 2))],
                        ["signature", "doc", "centre", "reach", *HALVES])
        tidy()
    return sign


def signatures(rows: DataFrame, least_words: int, hashes: int) -> DataFrame:
    """One row per compact window of ``rows`` (doc, text): signature (the function
    in its low bits), doc, centre, reach, and hashes and min-hashes of half a passage
    before and behind the centre."""
    if hashes > MOST:
        raise ValueError(f"at most {MOST} functions")
    return rows.mapInArrow(_signer(least_words - SHINGLE + 1, hashes),
                           "signature long, doc long, centre int, reach int, "
                           + ", ".join(f"{c} int" for c in HALVES))


# --- candidates: intervals that two documents share ----------------------------------

_STRETCH = pa.struct([("b0", pa.int32()), ("b1", pa.int32()), ("a0", pa.int32()), ("a1", pa.int32())])


def stretches(hits: list[tuple], width: int, agree: int) -> list[dict]:
    """Join the shared windows of a pair of documents.  Each of ``hits`` is
    (centre in b, left, right, centre in a, function), with left and right what
    both windows have beside their centres.  Joined stretches overlap in both
    documents and some place of b lies in windows of ``agree`` functions."""
    out = []
    now = None
    spans: list[tuple[int, int, int]] = []

    def close() -> None:
        if agree <= 1:
            out.append(dict(zip(("b0", "b1", "a0", "a1"), now)))
            return
        events = sorted([(s, 1, f) for s, _, f in spans] + [(e + 1, 0, f) for _, e, f in spans])
        open_, most = {}, 0
        for _, starts, f in events:
            open_[f] = open_.get(f, 0) + (1 if starts else -1)
            if starts:
                most = max(most, sum(v > 0 for v in open_.values()))
            if most >= agree:
                break
        if most >= agree:
            out.append(dict(zip(("b0", "b1", "a0", "a1"), now)))

    for b, left, right, a, f in sorted((h[0] - h[1], h[1], h[2], h[3] - h[1], h[4]) for h in hits):
        b1, a1 = b + left + right, a + left + right
        if now and b <= now[1] and a <= now[3] + width and a1 >= now[2] - width:
            now = [now[0], max(now[1], b1), min(now[2], a), max(now[3], a1)]
            spans.append((b, b1, f))
        else:
            if now:
                close()
            now, spans = [b, b1, a, a1], [(b, b1, f)]
    if now:
        close()
    return out


def _stretcher(width: int, agree: int):
    @F.arrow_udf("array<struct<b0:int,b1:int,a0:int,a1:int>>")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for held in columns:
            flat = held.flatten()
            hits = list(zip(*(flat.field(i).to_pylist() for i in range(flat.type.num_fields))))
            ends = np.cumsum(held.value_lengths().to_numpy(zero_copy_only=False)).tolist()
            yield pa.array([stretches(hits[lo:hi], width, agree) for lo, hi in zip([0, *ends], ends)],
                           pa.list_(_STRETCH))
        tidy()
    return of


# --- verification --------------------------------------------------------------------

def longest_dense(match: np.ndarray, share: float) -> tuple[int, int] | None:
    """The longest stretch, first of equals, that begins and ends with a match
    and of which at least ``share`` match."""
    at = np.flatnonzero(match)
    if not len(at):
        return None
    total = np.concatenate([[0.0], np.cumsum(match - share)])
    # a stretch is dense enough if the prefix sum does not fall over it; the earliest
    # begin for an end is a match where the prefix sum is lower than at all matches before
    begin = total[at]
    lows = np.flatnonzero(begin < np.concatenate([[np.inf], np.minimum.accumulate(begin)[:-1]]))
    first = at[lows[np.searchsorted(-begin[lows], -(total[at + 1] + 1e-9))]]
    best = int((at + 1 - first).argmax())
    return int(first[best]), int(at[best]) + 1


def _dense_parts(match: np.ndarray, share: float, width: int) -> list[tuple[int, int]]:
    """Joined, the stretches of at least ``width`` that begin and end with a match
    and of which at least ``share`` match."""
    at = np.flatnonzero(match)
    if len(at) < share * width - 1e-9:
        return []
    total = np.concatenate([[0.0], np.cumsum(match - share)])
    begin = total[at]
    lows = np.flatnonzero(begin < np.concatenate([[np.inf], np.minimum.accumulate(begin)[:-1]]))
    first = at[lows[np.searchsorted(-begin[lows], -(total[at + 1] + 1e-9))]]
    wide = at + 1 - first >= width
    begins, ends = first[wide], at[wide] + 1
    if not len(begins):
        return []
    # joined are those that the next begin lies in, the least of all behind
    low = np.minimum.accumulate(begins[::-1])[::-1]
    last = np.append(np.flatnonzero(low[1:] >= ends[:-1]), len(ends) - 1)
    return list(zip(low[np.concatenate([[0], last[:-1] + 1])].tolist(), ends[last].tolist()))


def _among(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of ``x`` stand in ``y`` (not empty)."""
    ordered = np.sort(y)
    at = np.searchsorted(ordered, x)
    at[at == len(ordered)] = 0
    return ordered[at] == x


def _places(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where each of b stands in a, or -1; of several places one that continues its neighbour's."""
    if not len(a):
        return np.full(len(b), -1)
    order = np.argsort(a, kind="stable")
    ordered = a[order]
    low = np.minimum(np.searchsorted(ordered, b), len(a) - 1)
    place = np.where(ordered[low] == b, order[low], -1)
    several = np.flatnonzero((place >= 0) & (ordered[np.minimum(low + 1, len(a) - 1)] == b) & (low + 1 < len(a)))
    for way, ends in ((1, several), (-1, several[::-1])):
        for p in ends.tolist():
            q = p - way
            if 0 <= q < len(b) and place[q] >= 0 and 0 <= place[q] + way < len(a) and a[place[q] + way] == b[p]:
                place[p] = place[q] + way
    return place


def _previous(x: np.ndarray) -> np.ndarray:
    """For each value the place of the equal value before it, or -1."""
    order = np.argsort(x, kind="stable")
    out = np.full(len(x), -1)
    same = x[order[1:]] == x[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


def _best_pair(a: np.ndarray, b: np.ndarray, width: int, similarity: float) -> tuple | None:
    """The longest passage of b whose places in a span one of Jaccard coefficient
    ``similarity``: (begin, end, begin in a, end in a, jaccard).  To lengthen both by
    a shared shingle never lowers the coefficient, so only the ends of runs are tried."""
    place = _places(a, b)
    hits = np.flatnonzero(place >= 0)
    if not len(hits):
        return None
    new = np.flatnonzero((np.diff(hits) != 1) | (np.diff(place[hits]) != 1)) + 1
    begins = hits[np.concatenate([[0], new])]
    ends = hits[np.concatenate([new - 1, [len(hits) - 1]])] + 1
    low, high = place[begins], place[ends - 1] + 1
    match = place >= 0
    before_b, before_a = _previous(b), _previous(a)
    best = None
    for i, lo in enumerate(begins.tolist()):
        if len(b) - lo < max(width, best[1] - best[0] + 1 if best else 0):
            break
        fresh = before_b[lo:] < lo
        own = np.cumsum(fresh)[ends[i:] - lo - 1]
        common = np.cumsum(fresh & match[lo:])[ends[i:] - lo - 1]
        u, v = np.minimum.accumulate(low[i:]), np.maximum.accumulate(high[i:])
        other = np.empty(len(u), np.int64)
        for x in np.unique(u).tolist():
            at = u == x
            other[at] = np.cumsum(before_a[x:] < x)[v[at] - x - 1]
        jaccard = common / (own + other - common)
        good = np.flatnonzero((jaccard >= similarity) & (ends[i:] - lo >= width) & (v - u >= width))
        if len(good):
            j = int(good[-1])
            if best is None or ends[i + j] - lo > best[1] - best[0]:
                best = (lo, int(ends[i + j]), int(u[j]), int(v[j]), float(jaccard[j]))
    return best


def verified(a: np.ndarray, b: np.ndarray, width: int, similarity: float) -> list[tuple]:
    """Passages of b (begin, end in shingles) with their place in a and their
    Jaccard coefficient.  A coefficient of ``similarity`` needs that share of matches
    on each side, on the longer side no more: what no such stretch covers, in b or in
    a, goes.  In what is left the longest passage counts, then the longest left and
    right of it.  Equal stretches are one passage."""
    if len(a) >= width and np.array_equal(a, b):
        return [(0, len(b), 0, len(a), 1.0)]
    out = []
    todo = [(0, len(b), 0, len(a))]
    while todo:
        lo, hi, u, v = todo.pop()
        if hi - lo < width or v - u < width:
            continue
        parts = _dense_parts(_among(b[lo:hi], a[u:v]), similarity, width)
        if parts != [(0, hi - lo)]:
            todo += [(lo + s, lo + e, u, v) for s, e in parts]
            continue
        sources = _dense_parts(_among(a[u:v], b[lo:hi]), similarity, width)
        if sources != [(0, v - u)]:
            todo += [(lo, hi, u + s, u + e) for s, e in sources]
            continue
        found = _best_pair(a[u:v], b[lo:hi], width, similarity)
        if found is not None:
            s, e, x, y, jaccard = found
            out.append((lo + s, lo + e, u + x, u + y, jaccard))
            todo += [(lo, lo + s, u, v), (lo + e, hi, u, v)]
            continue
        # no span of a holds a passage in order: two parts, cut at the longest gap or jump
        place = _places(a[u:v], b[lo:hi])
        hits = np.flatnonzero(place >= 0)
        gap, jump = np.diff(hits), np.abs(np.diff(place[hits]) - 1)
        if not len(gap):
            continue
        at = int(gap.argmax()) if gap.max() > 1 else int(jump.argmax())
        todo += [(lo, lo + int(hits[at]) + 1, u, v), (lo + int(hits[at + 1]), hi, u, v)]
    return sorted(out)


def _slicer():
    """Cuts what is wanted of the texts, as 32 bits a word: half of what its shingles' hashes would
    take.  Shingles of different words count as equal only where all words that differ collide."""
    schema = pa.schema([("pair", pa.int64()), ("side", pa.bool_()), ("begin", pa.int32()),
                        ("words", pa.binary())])

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ready(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        rows, size = [], 0
        for frame in (part for whole in frames for part in parts_of(whole, 0)):
            texts = frame.column(0).cast(pa.binary()).to_pylist()
            wants = frame.column(1)
            for lo, hi in batches_of_text(texts):
                data, at = joined(texts[lo:hi])
                starts, _, h = runs(data.lower(), _CLASSES)
                words, first = (h >> np.uint64(32)).astype(np.uint32), np.searchsorted(starts, at)
                for i in range(lo, hi):
                    own = words[first[i - lo]:first[i - lo + 1]]
                    for w in wants[i].as_py():
                        piece = own[max(0, w["begin"]):w["end"] + SHINGLE]
                        rows.append((w["pair"], w["side"], max(0, w["begin"]), piece.tobytes()))
                        size += piece.nbytes + 64
                        if size >= 1 << 22:
                            yield ready(rows)
                            rows, size = [], 0
        yield ready(rows)
        tidy()
    return cut


def _of_words(pieces: pa.Array) -> list[np.ndarray]:
    """The shingle hashes of every piece that ``_slicer`` cut."""
    end = np.cumsum(pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64) // 4)
    every = _shingled(np.frombuffer(b"".join(pieces.to_pylist()), np.uint32).astype(np.uint64))
    return [every[lo:max(lo, hi - SHINGLE + 1)] for lo, hi in zip([0, *end[:-1].tolist()], end.tolist())]


def _verifier(width: int, similarity: float):
    kind = pa.struct([("b0", pa.int32()), ("b1", pa.int32()), ("a0", pa.int32()),
                      ("a1", pa.int32()), ("jaccard", pa.float64())])

    @F.arrow_udf("array<struct<b0:int,b1:int,a0:int,a1:int,jaccard:double>>")
    def of(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for a, a_at, b, b_at in columns:
            out = []
            for lo, hi in cuts(1 << 21, a, b):
                own = (x.slice(lo, hi - lo) for x in (a, a_at, b, b_at))
                x_all, xa_all, y_all, ya_all = (f(x) for f, x in zip((_of_words, pa.Array.to_pylist) * 2, own))
                for x, xa, y, ya in zip(x_all, xa_all, y_all, ya_all):
                    got = verified(x, y, width, similarity)
                    out.append([{"b0": s + ya, "b1": e + ya, "a0": u + xa, "a1": v + xa, "jaccard": j}
                                for s, e, u, v, j in got])
            yield pa.array(out, pa.list_(kind))
        tidy()
    return of


def passages(rows: DataFrame, least_words: int = 50, similarity: float = 0.8, hashes: int = 2,
             agree: int = 1) -> DataFrame:
    """Repeated passages of ``rows`` (a unique long ``doc``, text): doc, begin
    and end (words, end exclusive), source, source_begin, source_end, jaccard.
    ``source`` precedes ``doc``."""
    width = least_words - SHINGLE + 1
    every = settle(signatures(rows, least_words, hashes), "signatures")
    # one row a signature, as a table of its own: Spark can then split the windows of a hot one
    leaders = settle(every.groupBy("signature").agg(
        F.min(F.struct("doc", "centre", "reach")).alias("lead"), F.max("doc").alias("last")).where("lead.doc < last")
        .select("signature", F.col("lead.doc").alias("source"), F.col("lead.centre").alias("source_centre"),
                F.col("lead.reach").alias("source_reach")), "leaders")
    held = settle(every.join(leaders, "signature"), "windows")
    met = held.where("doc > source")
    found = settle(_verify(rows, met, width, similarity, agree), "passages")
    # the leader's own windows too: only the first of them was held against the others
    behind = held.where("doc > source or centre > source_centre")
    left = settle(_uncovered(behind, found), "uncovered")
    # both verified in one go, for each go deals out the texts
    again = settle(_next_leaders(left).unionByName(_every_leader(rows, left, width, similarity)).distinct(), "again")
    if not again.isEmpty():
        found = settle(found.unionByName(_verify(rows, again, width, similarity, agree)), "passages")
    rest = settle(_with_partner(_uncovered(held, found)), "rest")
    if not rest.isEmpty():
        found = found.unionByName(_exact(rows, rest, width))
    return found


def _verify(rows: DataFrame, met: DataFrame, width: int, similarity: float, agree: int) -> DataFrame:
    left = F.least(F.shiftright("reach", 16), F.shiftright("source_reach", 16))
    right = F.least(F.col("reach").bitwiseAND(0xFFFF), F.col("source_reach").bitwiseAND(0xFFFF))
    hits = met.groupBy("doc", "source").agg(F.collect_list(F.struct(
        "centre", left.alias("left"), right.alias("right"), "source_centre",
        F.col("signature").bitwiseAND(MOST - 1).alias("function"))).alias("hits"))
    pairs = hits.select("doc", "source", F.explode(_stretcher(width, agree)("hits")).alias("s"))
    pairs = settle(pairs.withColumn("pair", F.monotonically_increasing_id()), "stretches")
    want = (pairs.select(F.col("doc").alias("owner"), "pair", F.lit(True).alias("side"),
                         F.col("s.b0").alias("begin"), F.col("s.b1").alias("end"))
            .unionByName(pairs.select(F.col("source").alias("owner"), "pair", F.lit(False).alias("side"),
                                      F.col("s.a0").alias("begin"), F.col("s.a1").alias("end"))))
    # a document that leads many others is cut in several goes, each of a bounded list
    many = want.groupBy("owner").agg(F.ceil(F.count(F.lit(1)) / WANTS).alias("goes"))
    lists = (want.join(many, "owner").groupBy("owner", F.pmod(F.xxhash64("pair"), "goes").alias("go"))
             .agg(F.collect_list(F.struct("pair", "side", "begin", "end")).alias("want")))
    # what is asked of the texts grows with them: a merge join at every size, never a broadcast
    pieces = (lists.hint("merge").join(rows.withColumnRenamed("doc", "owner"), "owner").select("text", "want")
              .mapInArrow(_slicer(), "pair long, side boolean, begin int, words binary"))
    one = lambda s, c: F.max(F.when(F.col("side") == s, F.col(c)))
    both = pieces.groupBy("pair").agg(
        one(False, "words").alias("a"), one(False, "begin").alias("a_at"),
        one(True, "words").alias("b"), one(True, "begin").alias("b_at"))
    ok = both.select("pair", F.explode(_verifier(width, similarity)("a", "a_at", "b", "b_at")).alias("p"))
    words = SHINGLE - 1
    return ok.join(pairs.drop("s"), "pair").select(
        "doc", F.col("p.b0").alias("begin"), (F.col("p.b1") + words).alias("end"),
        "source", F.col("p.a0").alias("source_begin"), (F.col("p.a1") + words).alias("source_end"),
        F.col("p.jaccard").alias("jaccard"))


def _uncovered(held: DataFrame, found: DataFrame) -> DataFrame:
    """The windows of ``held`` whose centre lies in no passage of their document."""
    spans = found.groupBy("doc").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    inside = F.exists("spans", lambda s: (s["begin"] <= F.col("centre"))
                      & (F.col("centre") <= s["end"] - SHINGLE))
    return (held.join(spans, "doc", "left").where(~F.coalesce(inside, F.lit(False)))
            .select("signature", "doc", "centre", "reach", *HALVES))


def _next_leaders(windows_: DataFrame) -> DataFrame:
    """The windows with the first of those that agree in signature and in a second key: the
    min-hash of a half passage to one side, the whole of such a half, or both min-hashes."""
    both = F.when((F.col("least_before") != 0) & (F.col("least_behind") != 0),
                  F.xxhash64("least_before", "least_behind")).otherwise(0)
    keys = [F.col("least_before").cast("long"), F.col("least_behind").cast("long"),
            F.col("before").cast("long"), F.col("behind").cast("long"), both]
    half = windows_.select("signature", "doc", "centre", "reach", F.explode(F.array(
        *(F.struct(F.lit(i).alias("kind"), key.alias("half")) for i, key in enumerate(keys)))).alias("h"))
    half = half.where("h.half <> 0")
    leads = (half.groupBy("signature", "h")
             .agg(F.min(F.struct("doc", "centre", "reach")).alias("lead"), F.max("doc").alias("last"))
             .where("lead.doc < last").drop("last"))
    return (half.join(leads, ["signature", "h"]).where(F.col("doc") > F.col("lead.doc"))
            .select("signature", "doc", "centre", "reach", F.col("lead.doc").alias("source"),
                    F.col("lead.centre").alias("source_centre"), F.col("lead.reach").alias("source_reach"))
            .distinct())


# --- windows of one signature that no passage covers, each against all before it ------

def _side(width: int, similarity: float) -> int:
    """Shingles to either side of a centre that a passage of the least length, or what it
    repeats (longer by insertions), can reach."""
    return int(np.ceil(width / similarity - 1e-9)) - 1


def _surrounder(side: int):
    """The shingles around the centres of a document's windows, as 32 bits each."""
    schema = pa.schema([("signature", pa.int64()), ("doc", pa.int64()), ("centre", pa.int32()),
                        ("reach", pa.int32()), ("around", pa.binary())])

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in (part for whole in frames for part in parts_of(whole, 1)):
            texts = frame.column(1).cast(pa.binary()).to_pylist()
            ids, own = frame.column(0).to_pylist(), frame.column(2)
            for lo, hi in batches_of_text(texts):
                h, bounds = shingles(*joined(texts[lo:hi]))
                h = (h >> np.uint64(32)).astype(np.uint32)
                rows = []
                for i in range(lo, hi):
                    begin = bounds[i - lo]
                    for w in own[i].as_py():
                        c, reach = w["centre"], w["reach"]
                        left, right = min(reach >> 16, side), min(reach & 0xFFFF, side)
                        rows.append((w["signature"], ids[i], c, reach,
                                     h[begin + c - left:begin + c + right + 1].tobytes()))
                    if len(rows) >= 1 << 13:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
        tidy()
    return cut


def _elsewhere(group: np.ndarray, doc: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of the shingles ``x`` another document of their group has.  Ordered by group, then document."""
    # the place in the low bits makes a plain sort enough; what collides above them counts as shared
    bits = np.uint64(len(x).bit_length())
    with np.errstate(over="ignore"):
        key = mix(mix(group.astype(np.int64).view(np.uint64)) + x)
    key = key >> bits << bits | np.arange(len(x), dtype=np.uint64)
    key.sort()
    order = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    key >>= bits
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    last = np.append(first[1:], len(x)) - 1
    out = np.empty(len(x), bool)
    out[order] = np.repeat(doc[order[first]] != doc[order[last]], last - first + 1)
    return out


def _least_distinct(x: np.ndarray, width: int) -> int:
    """The least count of different shingles in a run of ``width``."""
    if len(np.unique(x)) == len(x):
        return width
    before = np.lib.stride_tricks.sliding_window_view(_previous(x), width)
    return int((before < np.arange(len(before))[:, None]).sum(axis=1).min())


def crowd(group: np.ndarray, doc: np.ndarray, around: list[np.ndarray], width: int,
          similarity: float) -> list[tuple[int, int]]:
    """(window, earlier window) of one group where the shingles around both hold a passage: for each
    window the first that does and that is itself without one.  Ordered by group, then document."""
    size = np.array([len(x) for x in around], np.int64)
    alive = np.flatnonzero(size >= width)
    inside: dict[int, np.ndarray] = {}
    while len(alive):
        n = size[alive]
        x = np.concatenate([around[i] for i in alive])
        of = np.repeat(np.arange(len(alive)), n)
        shared = _elsewhere(group[alive][of], doc[alive][of], x)
        ends = np.cumsum(n)
        enough = np.bincount(of, shared, len(alive)) >= similarity * width - 1e-9
        inside = {}
        for k in np.flatnonzero(enough).tolist():
            own = shared[ends[k] - n[k]:ends[k]]
            parts = _dense_parts(own, similarity, width)
            if parts:
                # what lies outside of the dense parts counts for no passage
                use = np.zeros(n[k], bool)
                for s, e in parts:
                    use[s:e] = own[s:e]
                inside[int(alive[k])] = around[alive[k]][use]
        left = np.array(sorted(inside), np.int64)
        settled = len(left) > 0.95 * len(alive)
        alive = left
        if settled:
            break
    found = []
    at = 0
    while at < len(alive):
        end = int(np.searchsorted(group[alive], group[alive[at]], side="right"))
        own, at = alive[at:end].tolist(), end
        if doc[own[0]] == doc[own[-1]]:
            continue
        sets = {i: np.unique(inside[i]) for i in own}
        values, times = np.unique(np.concatenate(list(sets.values())), return_counts=True)
        rank = np.empty(len(values), np.int64)
        rank[np.lexsort((values, times))] = np.arange(len(values))
        # a coefficient of ``similarity`` takes this many different shingles in common with any other
        distinct = {i: _least_distinct(around[i], width) for i in own}
        low = min(distinct.values())
        leads: dict[int, list[int]] = {}
        kept: dict[int, set] = {}
        for i in own:
            least = int(np.ceil(similarity / (1 + similarity)
                                * (distinct[i] + max(low, similarity * distinct[i])) - 1e-9))
            ranks = np.sort(rank[np.searchsorted(values, sets[i])])
            if len(ranks) < least:
                continue
            prefix, mine = ranks[:len(ranks) - least + 1].tolist(), set(ranks.tolist())
            for j in sorted({j for r in prefix for j in leads.get(r, ())}):
                if (doc[j] != doc[i] and len(mine & kept[j]) >= least
                        and verified(around[j], around[i], width, similarity)):
                    found.append((i, j))
                    break
            else:
                kept[i] = mine
                for r in prefix:
                    leads.setdefault(r, []).append(i)
    return found


def _crowder(width: int, similarity: float):
    names = ["signature", "doc", "centre", "reach", "source", "source_centre", "source_reach"]

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        group, doc = rows["signature"].to_numpy(), rows["doc"].to_numpy()
        around = [np.frombuffer(x, np.uint32) for x in rows["around"].to_pylist()]
        found = np.array(crowd(group, doc, around, width, similarity), np.int64).reshape(-1, 2)
        centre, reach = rows["centre"].to_numpy(), rows["reach"].to_numpy()
        i, j = found[:, 0], found[:, 1]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (group[i], doc[i], centre[i], reach[i], doc[j], centre[j], reach[j])], names)

    def of(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # ends with windows of a signature of which more may come
        for frame in (part for whole in frames for part in parts_of(whole, 4, 1 << 21)):
            signature = frame.column(0).to_numpy()
            cut = int(np.flatnonzero(signature == signature[-1])[0])
            if cut or held and held[-1].column(0)[0].as_py() != signature[0]:
                yield pairs(pa.Table.from_batches([*held, frame.slice(0, cut)]))
                held = []
            held.append(frame.slice(cut))
        if held:
            yield pairs(pa.Table.from_batches(held))
        tidy()
    return of


def _every_leader(rows: DataFrame, windows_: DataFrame, width: int, similarity: float) -> DataFrame:
    """The windows with the first of their signature that holds a passage around the centre."""
    shared = windows_.groupBy("signature").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    own = (windows_.join(shared.where("low < high"), "signature")
           .groupBy("doc").agg(F.collect_list(F.struct("signature", "centre", "reach")).alias("own")))
    around = (rows.join(own.hint("merge"), "doc").select("doc", "text", "own")
              .mapInArrow(_surrounder(_side(width, similarity)),
                          "signature long, doc long, centre int, reach int, around binary"))
    return (around.repartition("signature").sortWithinPartitions("signature", "doc", "centre")
            .mapInArrow(_crowder(width, similarity),
                        "signature long, doc long, centre int, reach int, source long, source_centre int, source_reach int"))


def _with_partner(windows_: DataFrame) -> DataFrame:
    """(doc, centre, reach) of the windows that share a half passage with one of another document."""
    half = windows_.select("signature", "doc", "centre", "reach", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("before").alias("half")),
        F.struct(F.lit(1).alias("side"), F.col("behind").alias("half")))).alias("h"))
    half = half.where("h.half <> 0")
    shared = half.groupBy("signature", "h").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    return (half.join(shared.where("low < high"), ["signature", "h"])
            .select("doc", "centre", "reach").distinct())


def _runner(width: int):
    def runs_of(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in (part for whole in frames for part in parts_of(whole, 1)):
            ids = frame.column(0).to_pylist()
            texts = frame.column(1).cast(pa.binary()).to_pylist()
            for lo, hi in batches_of_text(texts):
                h, bounds = shingles(*joined(texts[lo:hi]))
                found = []
                for i in range(lo, hi):
                    begins = set()
                    for c, reach in ((x["centre"], x["reach"]) for x in frame.column(2)[i].as_py()):
                        least = max(c - (reach >> 16), c - width + 1)
                        most = min(c, c + (reach & 0xFFFF) - width + 1)
                        begins.update(range(least, most + 1))
                    at = np.array(sorted(begins), np.int64)
                    found.append((run_hashes(h[bounds[i - lo]:bounds[i - lo + 1]], at, width).view(np.int64),
                                  np.full(len(at), ids[i], np.int64), at.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)],
                                                 ["run", "doc", "begin"])
        tidy()
    return runs_of


def _exact(rows: DataFrame, rest: DataFrame, width: int) -> DataFrame:
    """Exact repeats of the least length around the centres of ``rest``."""
    own = rest.groupBy("doc").agg(F.collect_list(F.struct("centre", "reach")).alias("own"))
    every = (rows.join(own.hint("merge"), "doc").select("doc", "text", "own")
             .mapInArrow(_runner(width), "run long, doc long, begin int"))
    every = settle(every, "runs")
    first = every.groupBy("run").agg(F.min(F.struct("doc", "begin")).alias("lead"))
    words = width + SHINGLE - 1
    return (every.join(first, "run").where(F.col("doc") > F.col("lead.doc"))
            .select("doc", "begin", (F.col("begin") + words).alias("end"),
                    F.col("lead.doc").alias("source"), F.col("lead.begin").alias("source_begin"),
                    (F.col("lead.begin") + words).alias("source_end"), F.lit(1.0).alias("jaccard")))


# --- what a pipeline does with it ------------------------------------------------------

def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the words of ``spans`` (ascending or not, may overlap)
    and what stands between them."""
    starts, ends, _ = runs(text.lower(), _CLASSES)
    out, at = [], 0
    for s, e in sorted(spans):
        s = max(s, 0)
        b0, b1 = int(starts[s]), int(ends[e - 1])
        if b1 <= at:
            continue
        out.append(text[at:max(at, b0)])
        at = b1
    out.append(text[at:])
    return b"".join(out)


def _remover():
    @F.arrow_udf("string")
    def of(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in columns:
            out = []
            for text, own in zip(texts.to_pylist(), spans.to_pylist()):
                if own and text:
                    text = without(text.encode(), [(s["begin"], s["end"]) for s in own]).decode()
                out.append(text)
            yield pa.array(out, pa.string())
    return of


def _keyed_texts(docs: DataFrame) -> tuple[DataFrame, str, DataFrame]:
    key = free_name(docs, "row")
    numbered = keyed(docs, key)
    return numbered, key, numbered.select(F.col(key).alias("doc"), F.col("text").cast("string").alias("text"))


def repeats(docs: DataFrame, **options) -> DataFrame:
    """The repeated passages by doc_id: doc_id, begin, end, source_id,
    source_begin, source_end, jaccard."""
    numbered, key, rows = _keyed_texts(docs)
    names = numbered.select(F.col(key).alias("k"), F.col("doc_id").cast("long").alias("named"))
    found = (passages(rows, **options)
             .join(names.withColumnsRenamed({"k": "doc", "named": "doc_id"}), "doc")
             .join(names.withColumnsRenamed({"k": "source", "named": "source_id"}), "source"))
    return found.select("doc_id", "begin", "end", "source_id", "source_begin", "source_end", "jaccard")


def cut(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` (and ``n_chars``, if
    there, made to fit); a document of which no word is left goes."""
    numbered, key, rows = _keyed_texts(docs)
    spans = free_name(numbered, "spans")
    found = passages(rows, **options).groupBy(F.col("doc").alias(key)).agg(
        F.collect_set(F.struct("begin", "end")).alias(spans))
    text = F.col("text").cast("string")
    new: Column = F.when(F.col(spans).isNotNull(), _remover()(text, F.col(spans))).otherwise(text)
    out = numbered.join(found, key, "left").withColumn("text", new)
    out = out.where(F.col(spans).isNull() | F.col("text").rlike("[0-9A-Za-z\\x{80}-\\x{10FFFF}]"))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(length))
    return out.select(*docs.columns)
