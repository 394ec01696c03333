"""Token ids by the ``tokenizers`` library, remembered per piece of text.

The vocabulary's pre-tokenizer drops white space and encodes runs of letters,
digits and other signs by themselves, so a text's ids are the ids of its runs in
turn.  Texts in ASCII and Latin letters are cut into such runs as bytes, a block
of texts at a time; the block's distinct runs are encoded by the library, unless
the worker remembers them, and all ids are gathered by array operations.  Texts
for which that cut is not surely the pre-tokenizer's (apostrophes, other scripts
and signs) go by white-space chunks, and those with the rare white space on
which Python and the tokenizer disagree are encoded whole.

All this holds for vocabularies with the normaliser and pre-tokenizer named below; with
any other, every text is encoded whole by the library.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np

import public_tokenizers

from ._shared import runs

#: The vocabulary of the registered queries.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: Pieces in a worker's store (some 200 bytes each); there are two stores at most.
REMEMBERED = 300_000
#: Characters of a text handled at a time.
STRIDE = 1 << 21

_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: What a text cut into byte runs must not hold: apostrophes (contractions), the separators
#: above, and beyond ASCII all but the Latin letters whose lower case is one letter.
_NOT_PLAIN = re.compile("['\x1c-\x1f\x80-\xbf\xd7\xf7\u0130\u0250-\U0010ffff]")
#: The normaliser and pre-tokenizer (fixed values of the vocabulary's format) that the cuts are made for.
_NORMALISER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_SPACE = re.compile(r"[ \t\r\n]")
_LOADED: dict[str, "Encoder"] = {}


def _run_classes() -> np.ndarray:
    """Byte classes: 0 white space, 1 letters, 2 digits, 3 other signs."""
    c = np.full(256, 3, np.uint8)
    for b in b" \t\n\x0b\x0c\r":
        c[b] = 0
    c[ord("0"):ord("9") + 1] = 2
    c[ord("a"):ord("z") + 1] = 1
    c[0x80:] = 1
    return c


_CLASSES = _run_classes()


class Encoder:
    """Ids of texts as little-endian integers of two or four bytes."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        top = max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0)
        self.dtype = np.dtype("<u2") if top < 1 << 16 else np.dtype("<u4")
        self.special = [x.encode() for x in self._special()]
        self.cuts = self._as_expected()
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _as_expected(self) -> bool:
        """Whether texts may be cut; else they are encoded whole."""
        own = [x and json.loads(x.__getstate__()) for x in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        added = self.tokenizer.get_added_tokens_decoder().values()
        return (own == [_NORMALISER, _PRE_TOKENIZER] and self.tokenizer.truncation is None
                and self.tokenizer.padding is None
                and not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added))

    def _special(self) -> list[str]:
        """Strings that the library cuts out of a text before all else."""
        return [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        code = "H" if self.dtype.itemsize == 2 else "I"
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = array(code, e.ids)
            if sys.byteorder == "big":
                ids.byteswap()
            yield ids.tobytes()

    def pieces(self, texts: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces of text, from the store or the library.  A full store
        becomes the old one, from which pieces that come again are taken back."""
        ids = list(map(self.known.get, texts))
        if None not in ids:
            return ids
        new = [t for t, x in zip(texts, ids) if x is None]
        if len(self.known) + len(new) > REMEMBERED:
            self.old, self.known = self.known, {}
        held = list(map(self.old.get, new))
        missing = [t for t, x in zip(new, held) if x is None]
        got = dict(zip(missing, self._encode([t.decode() for t in missing])))
        got.update((t, x) for t, x in zip(new, held) if x is not None)
        self.known.update(got)
        return [got[t] if x is None else x for t, x in zip(texts, ids)]

    def _strides(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > STRIDE:
            cut = _SPACE.search(text, at + STRIDE)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _whole(self, text: str) -> np.ndarray:
        """The ids of one text, by white-space chunks where that is sure."""
        if not self.cuts or _ODD_SPACE.search(text):
            return np.frombuffer(next(self._encode([text])), self.dtype)
        out = []
        for part in self._strides(text):
            words = part.encode().split()
            own = list(set(words))
            ids = dict(zip(own, self.pieces(own)))
            out.append(b"".join(map(ids.__getitem__, words)))
        return np.frombuffer(b"".join(out), self.dtype)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts that byte runs cut as the pre-tokenizer does."""
        raw = [(t.lower() + "\n").encode() for t in texts]
        data = b"".join(raw)
        starts, ends, h = runs(data, _CLASSES)
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        ids = self.pieces([data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
        flat = np.frombuffer(b"".join(ids), self.dtype)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        begin = np.cumsum(size) - size
        n = size[which]
        after = np.cumsum(n)
        total = int(after[-1]) if len(after) else 0
        out = flat[np.repeat(begin[which] - after + n, n) + np.arange(total)]
        # where the ids of each text end
        text_end = np.cumsum([len(r) for r in raw])
        last = np.searchsorted(starts, text_end)
        cut = np.concatenate([[0], after])[last]
        return np.split(out, cut[:-1])

    def _is_plain(self, text: str) -> bool:
        return self.cuts and len(text) <= STRIDE and not _NOT_PLAIN.search(text) and not any(
            s.decode() in text for s in self.special)

    def encode(self, texts: list[str | None], end: int | None = None,
               block: int = 1 << 21) -> Iterator[np.ndarray]:
        """The ids of each text (null: empty), with ``end`` behind if given.
        Texts of about ``block`` characters are cut together."""
        tail = np.array([] if end is None else [end], self.dtype)
        at = 0
        while at < len(texts):
            size, held = 0, []
            while at < len(texts) and size < block:
                held.append(texts[at] or "")
                size += len(held[-1])
                at += 1
            plain = [self._is_plain(t) for t in held]
            easy = iter(self._plain([t for t, p in zip(held, plain) if p]))
            for text, p in zip(held, plain):
                yield np.concatenate([next(easy) if p else self._whole(text), tail])


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def check_id(path: str, end: int) -> None:
    """Fail where the end id does not fit the ids' width.  The file is only searched for its
    ids: the driver has no need of the vocabulary itself."""
    with open(path, "rb") as f:
        top = max((int(x) for x in re.findall(rb'"\s*:\s*(\d+)', f.read())), default=0)
    if not 0 <= end < (1 << 16 if top < 1 << 16 else 1 << 32):
        raise ValueError(f"id {end} does not fit the ids of {path}")
