"""SentencePiece encoding and decoding by vectorised merge rounds.

The library merges, again and again, the best-scored adjacent pair of a text (the
leftmost of equals).  No piece holds a space behind another character, so no merge
crosses the place before a space; nor does one cross two characters that stand
side by side in no piece.  A block of texts is therefore cut into words, its
distinct words into segments, and all segments are merged together on flat arrays:
each round takes every segment's least pair rank, merges that pair wherever it
occurs, from the left, and drops merged symbols and finished segments, until no
pair remains.  Where a merge can make a pair that ranks before itself, only the
leftmost occurrence is merged in a round, so the order is the library's always.
Segments of more than ``LONG`` symbols, for which rounds would be many, take the
same merges from a heap.  Characters in no piece become their bytes.

Defined results: a null text counts as empty; an empty text has the end id alone;
texts are encoded whole, whatever their length; U+2581 in a text is a space to the
model and comes back as one; null and repeated doc_ids stay as they are, a row
each; an empty table gives an empty one; columns but the named ones are not read.
A null id array decodes to null, null ids in it are passed over.  Models that are
not BPE with byte fallback and the identity normaliser are refused.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import constants, mix, parts_of, powers, tidy, unpowers

#: Bytes of text cut and merged together, and ids decoded together.
BLOCK = 1 << 21
#: Symbols of a segment from which on the heap is used.
LONG = 256

_SPACE = "▁"
_NEVER = np.int32(2**31 - 1)
_BYTE = constants(256, 31)
_LOADED: dict[str, "Model"] = {}


class Model:
    """The tables of a SentencePiece BPE model file."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb2
        proto = pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        kind = pb2.ModelProto.SentencePiece
        form, trainer = proto.normalizer_spec, proto.trainer_spec
        types = [p.type for p in proto.pieces]
        if (trainer.model_type != pb2.TrainerSpec.BPE or not trainer.byte_fallback
                or kind.USER_DEFINED in types or form.precompiled_charsmap
                or form.remove_extra_whitespaces or not form.escape_whitespaces
                or trainer.treat_whitespace_as_suffix or proto.denormalizer_spec.precompiled_charsmap):
            raise ValueError(f"{path}: not a BPE model with byte fallback and the identity normaliser")
        self.prefix = b" " if form.add_dummy_prefix else b""
        self.size = len(types)
        names = [p.piece for p in proto.pieces]
        self.end = next((i for i, p in enumerate(names) if p == trainer.eos_piece), -1)
        normal = {p: i for i, (p, t) in enumerate(zip(names, types)) if t in (kind.NORMAL, kind.UNUSED)}
        if any(_SPACE in p.lstrip(_SPACE) for p in normal):
            raise ValueError(f"{path}: pieces run over spaces")
        scores = np.array([p.score for p in proto.pieces], np.float32)
        _, dense = np.unique(-scores, return_inverse=True)
        self._merges(normal, dense)
        self._bytes = np.full(256, -1, np.int64)
        surface: list[bytes] = []
        for i, (p, t) in enumerate(zip(names, types)):
            if t == kind.BYTE:
                self._bytes[int(p[3:5], 16)] = i
                surface.append(bytes([int(p[3:5], 16)]))
            elif t == kind.CONTROL:
                surface.append(b"")
            elif t == kind.UNKNOWN:
                surface.append((trainer.unk_surface or " ⁇ ").encode())
            else:
                surface.append(p.replace(_SPACE, " ").encode())
        self.is_byte = np.array([t == kind.BYTE for t in types])
        self.is_control = np.array([t == kind.CONTROL for t in types])
        self.leads = np.array([t in (kind.NORMAL, kind.UNUSED) and p.startswith(_SPACE)
                               for p, t in zip(names, types)])
        self._blob = np.frombuffer(b"".join(surface), np.uint8)
        self._length = np.fromiter(map(len, surface), np.int64, self.size)
        self._begin = np.cumsum(self._length) - self._length

    def _merges(self, normal: dict[str, int], dense: np.ndarray) -> None:
        """Symbols are piece ids, or ``size`` + code point for characters that are no piece."""
        self._symbol = np.arange(0x110000, dtype=np.int64) + self.size
        chars = set("".join(normal))
        for c in chars:
            if c in normal:
                self._symbol[ord(c)] = normal[c]
        self.wide = self.size + 0x110000

        def symbol(s: str) -> int | None:
            return normal.get(s, self.size + ord(s) if len(s) == 1 and s in chars else None)

        keys, made, inside = [], [], set()
        risky = np.zeros(self.size, bool)
        for piece, i in normal.items():
            for k in range(1, len(piece)):
                inside.add(ord(piece[k - 1]) << 21 | ord(piece[k]))
                left, right = symbol(piece[:k]), symbol(piece[k:])
                if left is not None and right is not None:
                    keys.append(left * self.wide + right)
                    made.append(i)
                    for part in (left, right):
                        if part < self.size and dense[i] <= dense[part]:
                            risky[part] = True
        order = np.argsort(keys)
        self._keys = np.append(np.array(keys, np.int64)[order], np.int64(2**62))
        self._made = np.append(np.array(made, np.int64)[order], -1)
        self._rank = np.append(dense[self._made[:-1]].astype(np.int32), _NEVER)
        self._risky = np.append(risky, False)
        self._inside = np.append(np.sort(np.fromiter(inside, np.int64)), np.int64(2**62))

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair and what it makes; ``_NEVER`` and -1 where it is no merge."""
        key = left * self.wide + right
        at = np.searchsorted(self._keys, key)
        at[self._keys[at] != key] = len(self._keys) - 1
        return self._rank[at], self._made[at]

    # --- merging -------------------------------------------------------------------

    def _by_heap(self, symbols: list[int]) -> list[int]:
        """The merges of one long segment in the library's order."""
        n = len(symbols)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def ranked(at: np.ndarray, to: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
            s = np.asarray(symbols, np.int64) if len(at) > 2 else None
            left = s[at] if s is not None else np.array([symbols[i] for i in at], np.int64)
            right = s[to] if s is not None else np.array([symbols[i] for i in to], np.int64)
            rank, made = self._pairs(left, right)
            for r, i, m, a, b in zip(rank.tolist(), at, made.tolist(), left.tolist(), right.tolist()):
                if r != _NEVER:
                    yield r, int(i), m, a, b

        agenda = list(ranked(np.arange(n - 1), np.arange(1, n)))
        heapq.heapify(agenda)
        while agenda:
            _, i, m, a, b = heapq.heappop(agenda)
            j = after[i]
            if not alive[i] or j >= n or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], alive[j], after[i] = m, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            new = [(before[i], i)] * (before[i] >= 0) + [(i, after[i])] * (after[i] < n)
            if new:
                for x in ranked(*map(list, zip(*new))):
                    heapq.heappush(agenda, x)
        return [s for s, ok in zip(symbols, alive) if ok]

    def _rounds(self, sym: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All segments merged together; symbols and the segment of each, in order."""
        done_sym, done_seg = [], []
        rank, made = np.full(len(sym), _NEVER, np.int32), np.full(len(sym), -1, np.int64)
        inner = np.flatnonzero(seg[1:] == seg[:-1])
        rank[inner], made[inner] = self._pairs(sym[inner], sym[inner + 1])
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
            size = np.diff(np.append(first, len(sym)))
            least = np.minimum.reduceat(rank, first)
            over = least == _NEVER
            if over.any():
                out = np.repeat(over, size)
                done_sym.append(sym[out])
                done_seg.append(seg[out])
                stay = ~out
                sym, seg, rank, made = sym[stay], seg[stay], rank[stay], made[stay]
                size, least = size[~over], least[~over]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, size))
            # of pairs that overlap in a row, every other one, from the left
            place = np.arange(len(hit))
            new_run = np.concatenate([[True], np.diff(hit) != 1])
            hit = hit[(place - np.maximum.accumulate(np.where(new_run, place, 0))) % 2 == 0]
            again = np.concatenate([[False], seg[hit[1:]] == seg[hit[:-1]]])
            hit = hit[~(again & self._risky[made[hit]])]
            sym[hit] = made[hit]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            at = hit - np.arange(len(hit))  # places after the merged ones are gone
            sym, seg, rank, made = sym[stay], seg[stay], rank[stay], made[stay]
            look = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[look], made[look] = _NEVER, -1
            look = look[look + 1 < len(sym)]
            look = look[seg[look] == seg[look + 1]]
            rank[look], made[look] = self._pairs(sym[look], sym[look + 1])
        if not done_sym:
            return sym, seg
        sym, seg = np.concatenate(done_sym), np.concatenate(done_seg)
        order = np.argsort(seg, kind="stable")
        return sym[order], seg[order]

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words (bytes that begin with their spaces), flat, and their number by word."""
        data = b"".join(words)
        points = np.frombuffer(data.decode("utf-8").replace(" ", _SPACE).encode("utf-32-le"), np.uint32)
        points = points.astype(np.int64)
        raw = np.frombuffer(data, np.uint8)
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        ends = np.cumsum([len(w) for w in words])
        word = np.repeat(np.arange(len(words)), np.diff(np.concatenate([[0], chars[ends]])))
        pair = points[:-1] << 21 | points[1:]
        held = self._inside[np.searchsorted(self._inside, pair)] == pair
        begins = np.concatenate([[True], ~held | (word[1:] != word[:-1])])[:len(points)]
        seg = np.cumsum(begins) - 1
        sym = self._symbol[points]
        length = np.bincount(seg, minlength=0)
        long = np.flatnonzero(length > LONG)
        if len(long):
            out = np.isin(seg, long)
            parts = [self._rounds(sym[~out], seg[~out])]
            for s in long.tolist():
                lo, hi = np.searchsorted(seg, [s, s + 1])
                own = self._by_heap(sym[lo:hi].tolist())
                parts.append((np.array(own, np.int64), np.full(len(own), s)))
            all_sym, all_seg = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(all_seg, kind="stable")
            done, seg_of = all_sym[order], all_seg[order]
        else:
            done, seg_of = self._rounds(sym, seg)
        word_of = word[np.flatnonzero(begins)][seg_of]
        return self._as_bytes(done, word_of, len(words))

    def _as_bytes(self, sym: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become the ids of their bytes."""
        odd = np.flatnonzero(sym >= self.size)
        if len(odd):
            points, which = np.unique(sym[odd] - self.size, return_inverse=True)
            raw = [chr(p).encode() for p in points.tolist()]
            width = np.fromiter(map(len, raw), np.int64, len(raw))
            begin = np.cumsum(width) - width
            flat = self._bytes[np.frombuffer(b"".join(raw), np.uint8)]
            count = np.ones(len(sym), np.int64)
            count[odd] = width[which]
            sym, word = np.repeat(sym, count), np.repeat(word, count)
            after = np.cumsum(count)
            spread = np.repeat(after[odd] - count[odd], count[odd])
            step = np.arange(len(spread)) - np.repeat(np.cumsum(count[odd]) - count[odd], count[odd])
            sym[spread + step] = flat[np.repeat(begin[which], count[odd]) + step]
        return sym.astype(np.int32), np.bincount(word, minlength=n)

    # --- texts ---------------------------------------------------------------------

    def _block(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of texts; prefixes are in, U+2581 is out."""
        data = b"".join(texts)
        if not data:
            return [np.zeros(0, np.int32) for _ in texts]
        buf = np.frombuffer(data, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        head = np.cumsum(lengths) - lengths
        space = buf == 0x20
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[head[lengths > 0]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(buf))
        with np.errstate(over="ignore"):
            total = np.zeros(len(buf) + 1, np.uint64)
            np.cumsum(_BYTE[buf] * powers(len(buf)), out=total[1:])
            h = mix((total[end] - total[start]) * unpowers(len(buf))[start] + (end - start).astype(np.uint64))
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        # equal hashes must be equal words
        size = end - start
        same = np.array_equal(size[first][which], size)
        if same:
            twin = np.repeat(start[first][which] - start, size) + np.arange(len(buf))
            same = np.array_equal(buf[twin], buf)
        if not same:
            first = which = np.arange(len(start))
        ids, count = self.merged([data[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())])
        begin = np.cumsum(count) - count
        n = count[which]
        after = np.cumsum(n)
        flat = ids[np.repeat(begin[which] - after + n, n) + np.arange(int(after[-1]))]
        cut = np.concatenate([[0], after])[np.searchsorted(start, head + lengths)]
        return np.split(flat, cut[:-1])

    def _pieces(self, text: bytes) -> Iterator[bytes]:
        """A text in parts of about BLOCK bytes, cut before a space behind another character."""
        at = 0
        while len(text) - at > BLOCK:
            cut = text.find(b" ", at + BLOCK)
            while cut > 0 and text[cut - 1] == 0x20:
                cut = text.find(b" ", cut + 1)
            if cut < 0:
                break
            yield text[at:cut]
            at = cut
        yield text[at:]

    def encode(self, texts: list[bytes | None], end: bool = True) -> Iterator[np.ndarray]:
        """The ids of each text (UTF-8 bytes; null: empty), with the end id behind."""
        tail = np.array([self.end] if end else [], np.int32)
        held: list[bytes] = []
        size = 0

        def flush() -> Iterator[np.ndarray]:
            for x in self._block(held):
                yield np.concatenate([x, tail])
            held.clear()

        for text in texts:
            raw = (text or b"").replace(_SPACE.encode(), b" ")
            raw = self.prefix + raw if raw else raw
            if len(raw) > BLOCK:
                yield from flush()
                size = 0
                yield np.concatenate([*(self._block([p])[0] for p in self._pieces(raw)), tail])
                continue
            held.append(raw)
            size += len(raw)
            if size > BLOCK:
                yield from flush()
                size = 0
        yield from flush()

    # --- decoding ------------------------------------------------------------------

    def _loose(self, ids: np.ndarray) -> bytes:
        """The surface of ids whose byte pieces are not whole characters: a replacement for each stray byte."""
        out: list[bytes] = []
        kind = self.is_byte[ids] + 2 * self.is_control[ids]
        for part in np.split(ids, np.flatnonzero(np.diff(kind)) + 1):
            raw = self._surface(part)
            if not self.is_byte[part[0]]:
                out.append(raw)
                continue
            at = 0
            while at < len(raw):
                lead = raw[at]
                n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                try:
                    raw[at:at + n].decode("utf-8")
                    out.append(raw[at:at + n])
                except UnicodeDecodeError:
                    out.append("�".encode())
                    n = 1
                at += n
        return b"".join(out)

    def _surface(self, ids: np.ndarray) -> bytes:
        n = self._length[ids]
        after = np.cumsum(n)
        total = int(after[-1]) if len(after) else 0
        return self._blob[np.repeat(self._begin[ids] - after + n, n) + np.arange(total)].tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of one document's ids in UTF-8, as the library's ``decode``."""
        if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < self.size:
            raise ValueError("an id is out of the model's range")
        text = np.flatnonzero(~self.is_control[ids])
        ids = ids[text[0]:text[-1] + 1] if len(text) else ids[:0]
        # parts end anywhere: bytes are only joined
        raw = b"".join([self._surface(ids[at:at + BLOCK]) for at in range(0, len(ids), BLOCK)])
        try:
            if len(ids) > len(text):  # control ids between others end a run of byte pieces
                raw = self._loose(ids)
            raw.decode("utf-8")
        except UnicodeDecodeError:
            raw = self._loose(ids)
        return raw[1:] if self.prefix and len(ids) and self.leads[ids[0]] else raw


def model(path: str) -> Model:
    """The worker's tables for a model file."""
    if path not in _LOADED:
        _LOADED[path] = Model(path)
    return _LOADED[path]


def _encoder(path: str, end: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            for part in parts_of(batch, 1):
                ids = list(own.encode(part.column(1).cast(pa.binary()).to_pylist(), end))
                ends = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "input_ids"])
        tidy()
    return run


def encode(docs: DataFrame, path: str, end: bool = True) -> DataFrame:
    """doc_id, input_ids of every row's ``text``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encoder(path, end), "doc_id long, input_ids array<int>")


def _decoder(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            texts = []
            for ids in batch.column(1):
                texts.append(own.decode(ids.values.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
                             .decode() if ids.is_valid else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             ["doc_id", "input_ids", "text"])
        tidy()
    return run


def decode(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, input_ids and the decoded ``text`` of every row's ``input_ids``."""
    return rows.select("doc_id", "input_ids").mapInArrow(
        _decoder(path), "doc_id long, input_ids array<int>, text string")


def digest(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ids = F.array_join(F.col("input_ids").cast("array<string>"), " ")
    return decoded.select("doc_id", F.size("input_ids").cast("long").alias("n_tokens"),
                          F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
