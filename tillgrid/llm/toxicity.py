"""Toxicity score: gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learnt from labelled texts: words and word beginnings (4 to 6
bytes) that far more toxic than clean texts hold, each with its log-odds.  A
text's features are densities, sums and peaks of those, how near they stand to
second-person words, and the rates of capitals, punctuation, exclamation marks,
digits and obfuscated words.  Obfuscated words (marks or digits within letters)
are also looked up with the marks taken out and the digits read as letters.

Fitting reads a bounded sample of the labelled rows: the ``sample_rows`` with
the smallest hash of their id.  The sample is dealt into folds by that hash.
Features of a sampled text come from the lexicon of the other folds, so that the
trees see lexicon hits as they occur in texts not learnt from.  One fold in
``FOLDS`` is kept from the trees and calibrates them.  Fitting is done by
Spark's own GBT and isotonic regression on the sample's features.  Scoring is
one pass over all texts; what is sent to its tasks is the lexicon (at most
``lexicon_size`` entries) and the trees.

Defined results: null and empty texts have zero features and are scored; labels
that are null or not 0 or 1 are not learnt from, nor ids that carry both;
repeated rows are rows of their own; with no labels, or one kind alone, every
score is the smoothed share of label 1; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import blocks, constants, joined, mix, runs, settle, slices, tidy
from .quality import sample

FOLDS = 5
#: Words from a lexicon word within which a second-person word counts as near.
NEAR = 6
STRIDE = 1 << 22

# Second-person words of the four languages.
SECOND_PERSON = ("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine "
                 "ihr euch euer sie ihnen tú ti tus usted ustedes vosotros os vuestro").split()

#: Digits and signs that stand for letters.
_LEET = bytes.maketrans(b"013457@$!", b"oieastasi")


def _classes() -> np.ndarray:
    """0 white space, 1 word bytes, 2 sentence marks; other signs within words count as word bytes."""
    c = np.ones(256, np.uint8)
    c[:33] = 0
    c[127] = 0
    for x in b".,;:?!\"'()[]{}|/\\<>&%#=+~^`":
        c[x] = 2
    return c


_CLASSES = _classes()
_KIND = np.zeros(256, np.uint8)  # 1 letter, 2 digit, 3 other sign
_KIND[33:127] = 3
_KIND[ord("a"):ord("z") + 1] = 1
_KIND[128:] = 1
_KIND[ord("0"):ord("9") + 1] = 2
_SALTS = constants(8, 301)


def _of_words(words: list[bytes]) -> np.ndarray:
    _, _, h = runs(b" ".join(words), np.where(np.arange(256) == 32, 0, 1).astype(np.uint8))
    return h


def _prefix(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    """Hash of the first ``k`` bytes of each word, 0 for words not longer."""
    held = np.zeros(len(starts), np.uint64)
    long_ = ends - starts > k
    at = starts[long_]
    value = np.zeros(len(at), np.uint64)
    for i in range(k):
        value |= buf[at + i].astype(np.uint64) << np.uint64(8 * i)
    with np.errstate(over="ignore"):
        held[long_] = mix(value * _SALTS[k] + np.uint64(k)) | np.uint64(1)
    return held


class Words:
    """The words of joined texts: their text, place, hashes and shapes."""

    def __init__(self, texts: list[bytes | None]) -> None:
        data, self.at = joined(texts)
        self.raw = np.frombuffer(data, np.uint8)
        low = data.lower()
        starts, ends, h = runs(low, _CLASSES)
        buf = np.frombuffer(low, np.uint8)
        self.signs = _CLASSES[buf[starts]] == 2
        self.sign_text = np.searchsorted(self.at, starts[self.signs], "right") - 1
        word = ~self.signs
        starts, ends, h = starts[word], ends[word], h[word]
        self.starts, self.ends = starts, ends
        self.text = np.searchsorted(self.at, starts, "right") - 1
        kind = _KIND[buf]
        strange = np.concatenate([[0], np.cumsum(kind >= 2)])
        letters = np.concatenate([[0], np.cumsum(kind == 1)])
        odd = strange[ends] - strange[starts]
        self.hidden = (odd > 0) & (letters[ends] - letters[starts] > odd) & (kind[starts] != 2)
        self.buf, self.low = buf, low
        self.grams = [h, *(_prefix(buf, starts, ends, k) for k in (4, 5, 6))]
        plain = self._plain()
        if plain is not None:
            at, again = plain
            self.grams[0] = self.grams[0].copy()
            self.grams[0][at] = again

    def _plain(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Hidden words as they would read without the disguise."""
        at = np.flatnonzero(self.hidden)
        if not len(at):
            return None
        out = [bytes(b for b in self.low[s:e].translate(_LEET) if _KIND[b] == 1) or b"?"
               for s, e in zip(self.starts[at].tolist(), self.ends[at].tolist())]
        return at, _of_words(out)


def _parts(texts: list[bytes | None]) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """Blocks of texts; a text beyond a stride comes alone, in pieces that end at white space."""
    for lo, hi in blocks(texts, STRIDE):
        if len(texts[lo] or b"") > STRIDE:
            for begin, end in slices(texts[lo], _CLASSES == 0, STRIDE):
                yield lo, hi, [texts[lo][begin:end]]
        else:
            yield lo, hi, texts[lo:hi]


def distinct_grams(texts: list[bytes | None]) -> list[np.ndarray]:
    """Distinct gram hashes of each text."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for lo, _, part in _parts(texts):
        w = Words(part)
        first = np.searchsorted(w.text, np.arange(len(part) + 1))
        for i in range(len(part)):
            s = slice(first[i], first[i + 1])
            found[lo + i].append(np.unique(np.concatenate([g[s] for g in w.grams])))
    none = np.zeros(0, np.uint64)
    return [(x := np.unique(np.concatenate(f)) if f else none)[x != 0] for f in found]


class Lexicon:
    """Gram hashes in ascending order with their log-odds."""

    def __init__(self, grams: np.ndarray, odds: np.ndarray) -> None:
        order = np.argsort(grams)
        self.grams, self.odds = grams[order], odds[order].astype(np.float64)
        self.front = np.zeros(1 << 16, bool)
        self.front[(self.grams >> np.uint64(48)).astype(np.int64)] = True

    def look_up(self, grams: np.ndarray) -> np.ndarray:
        """Log-odds of each gram, 0 for those not listed."""
        out = np.zeros(len(grams))
        maybe = np.flatnonzero(self.front[(grams >> np.uint64(48)).astype(np.int64)])
        if len(maybe) and len(self.grams):
            place = np.minimum(np.searchsorted(self.grams, grams[maybe]), len(self.grams) - 1)
            hit = self.grams[place] == grams[maybe]
            out[maybe[hit]] = self.odds[place[hit]]
        return out


def learn_lexicon(grams: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int,
                  size: int) -> Lexicon:
    """Grams at least e times likelier in toxic texts, in two of them or more,
    by weight of evidence."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    good = np.flatnonzero((odds > 1.0) & (toxic >= 2))
    best = good[np.lexsort((grams[good], -(toxic * odds)[good]))[:size]]
    return Lexicon(grams[best], odds[best])


NAMES = ["word_density", "word_sum", "word_peak", "word_second", "stem_density", "stem_sum", "stem_peak",
         "stem_second", "near_second", "second_density", "capitals", "signs", "exclaims", "digits",
         "hidden", "hidden_hits", "log_words"]


#: How the sums of a text become features: per word, per byte, and what else adds up.
_PER_WORD, _PER_BYTE, _ADDED = [0, 4, 9, 11, 14], [10, 12, 13], [1, 5, 15, 16]
#: Greatest and second greatest log-odds; the greatest near a second-person word.
_PEAKS, _NEAREST = [(2, 3), (6, 7)], 8


def _sums(part: list[bytes | None], lexicon: Lexicon, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts, sums and peaks of each text (columns as NAMES, before any division), and its bytes."""
    w = Words(part)
    n = len(part)
    word = lexicon.look_up(w.grams[0])
    stem = np.maximum.reduce([lexicon.look_up(g) for g in w.grams[1:]])
    total = lambda x: np.bincount(w.text, x, minlength=n)
    f = np.zeros((n, len(NAMES)))
    for at, odds in ((0, word), (4, stem)):
        hit = odds > 0
        f[:, at] = total(hit)
        f[:, at + 1] = total(odds)
        hits = np.flatnonzero(hit)
        order = hits[np.lexsort((-odds[hits], w.text[hits]))]
        of = w.text[order]
        start = np.searchsorted(of, np.arange(n))
        rank = np.arange(len(of)) - start[of]
        for r in (0, 1):
            f[of[rank == r], at + 2 + r] = odds[order[rank == r]]
    you = np.flatnonzero(np.isin(w.grams[0], second))
    hits = np.flatnonzero((word > 0) | (stem > 0))
    if len(you) and len(hits):
        after = np.minimum(np.searchsorted(you, hits), len(you) - 1)
        for near in (you[after], you[np.maximum(after - 1, 0)]):
            close = (np.abs(near - hits) <= NEAR) & (w.text[near] == w.text[hits])
            value = np.maximum(word, stem)[hits[close]] / np.maximum(np.abs(near - hits)[close], 1)
            np.maximum.at(f[:, _NEAREST], w.text[hits[close]], value)
    f[:, 9] = np.bincount(w.text[you], minlength=n)
    sums = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[w.at])
    f[:, 10] = sums((w.raw >= 65) & (w.raw <= 90))
    f[:, 11] = np.bincount(w.sign_text, minlength=n)
    f[:, 12] = sums(w.raw == 33)
    f[:, 13] = sums((w.raw >= 48) & (w.raw <= 57))
    f[:, 14] = total(w.hidden)
    f[:, 15] = total(w.hidden & (word > 0))
    f[:, 16] = np.bincount(w.text, minlength=n)
    return f, np.diff(w.at) - 1


def _words_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end."""
    starts, ends, _ = runs(text.lower(), _CLASSES)
    own = _CLASSES[np.frombuffer(text, np.uint8)[starts]] == 1
    return starts[own], ends[own]


def _tail(text: bytes) -> bytes:
    """The last words of a text, as many as can stand near one behind it."""
    some = text[-4096:]
    if len(some) < len(text):
        gap = np.flatnonzero(_CLASSES[np.frombuffer(some, np.uint8)] == 0)
        some = some[int(gap[0]):] if len(gap) else b""
        if len(_words_of(some)[0]) < NEAR:
            some = text
    starts, _ = _words_of(some)
    return some[int(starts[-NEAR:][0]):] if len(starts) else b""


def _head(text: bytes) -> bytes:
    """The first words of a text, as many as can stand near one before it."""
    _, ends = _words_of(text[:1 << 14])
    if len(ends) <= NEAR:
        _, ends = _words_of(text)
    return text[:int(ends[:NEAR][-1])] if len(ends) else b""


def dense(texts: list[bytes | None], lexicon: Lexicon) -> np.ndarray:
    """One row of features per text, whatever stands beside it.  A long text's pieces
    add up to what the whole gives."""
    out = np.zeros((len(texts), len(NAMES)))
    size = np.zeros(len(texts), np.int64)
    second = np.sort(_of_words([w.encode() for w in SECOND_PERSON]))
    piece, before = -1, b""
    for lo, hi, part in _parts(texts):
        f, n = _sums(part, lexicon, second)
        if len(texts[lo] or b"") <= STRIDE:
            out[lo:hi], size[lo:hi] = f, n
            continue
        add = [*_PER_WORD, *_PER_BYTE, *_ADDED]
        out[lo, add] += f[0, add]
        size[lo] += n[0]
        for peak, next_ in _PEAKS:
            held = sorted([out[lo, peak], out[lo, next_], f[0, peak], f[0, next_]])
            out[lo, peak], out[lo, next_] = held[-1], held[-2]
        near = [out[lo, _NEAREST], f[0, _NEAREST]]
        if piece == lo:
            near.append(_sums([before + _head(part[0])], lexicon, second)[0][0, _NEAREST])
        out[lo, _NEAREST] = max(near)
        piece, before = lo, _tail(before + part[0] if piece == lo else part[0])
    out[:, _PER_WORD] /= np.maximum(out[:, 16], 1)[:, None]
    out[:, _PER_BYTE] /= np.maximum(size, 1)[:, None]
    out[:, 16] = np.log1p(out[:, 16])
    return out


def _features(sent):
    """Features by the lexicon of the row's fold; fold -1 has the full one."""
    @F.arrow_udf("array<double>")
    def of(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, folds in columns:
            raw, folds = texts.cast(pa.binary()).to_pylist(), folds.to_numpy()
            out = np.zeros((len(raw), len(NAMES)))
            for fold in np.unique(folds).tolist():
                at = np.flatnonzero(folds == fold)
                out[at] = dense([raw[i] for i in at], sent.value[fold])
            yield pa.ListArray.from_arrays(
                pa.array(np.arange(len(raw) + 1, dtype=np.int32) * len(NAMES)), pa.array(out.ravel()))
        tidy()
    return of


@F.arrow_udf(T.ArrayType(T.LongType()))
def _grams(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in columns:
        found = distinct_grams(texts.cast(pa.binary()).to_pylist())
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        flat = np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)
        yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _lexicons(rows: DataFrame, counts: dict[tuple[int, int], int], size: int) -> dict[int, Lexicon]:
    """The full lexicon (-1) and, by fold, that of the other folds.  What is
    fetched are grams in two toxic texts or more that are likelier there,
    at most eight times ``size`` by weight."""
    tally = [F.sum(F.when((F.col("fold") == k) & (F.col("label") == y), 1).otherwise(0)).alias(f"n{k}_{y}")
             for k in range(FOLDS) for y in (0, 1)]
    pos = sum((F.col(f"n{k}_1") for k in range(FOLDS)), F.lit(0))
    neg = sum((F.col(f"n{k}_0") for k in range(FOLDS)), F.lit(0))
    n = {y: sum(v for (_, z), v in counts.items() if z == y) for y in (0, 1)}
    odds = F.log((pos + 0.5) / (n[1] + 1)) - F.log((neg + 0.5) / (n[0] + 1))
    table = (rows.select("fold", "label", F.explode(_grams(F.col("text"))).alias("gram"))
             .groupBy("gram").agg(*tally).where((pos >= 2) & (odds > 0.7))
             .orderBy((pos * odds).desc(), "gram").limit(8 * size).toPandas())
    grams = table["gram"].to_numpy(np.int64).view(np.uint64)
    each = {(k, y): table[f"n{k}_{y}"].to_numpy(np.int64) for k in range(FOLDS) for y in (0, 1)}
    out = {}
    for left in range(-1, FOLDS):
        use = [k for k in range(FOLDS) if k != left]
        t, c = (sum(each[k, y] for k in use) for y in (1, 0))
        nt, nc = (sum(counts.get((k, y), 0) for k in use) for y in (1, 0))
        out[left] = learn_lexicon(grams, t, c, nt, nc, size)
    return out


def score(docs: DataFrame, known: DataFrame, sample_rows: int = 16384, lexicon_size: int = 4096,
          trees: int = 20, depth: int = 4) -> DataFrame:
    """Per row of ``docs``: doc_id and score, learnt from ``known`` (doc_id, label)."""
    spark = docs.sparkSession
    chosen = sample(docs, known, sample_rows)
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    rows = chosen.withColumn("fold", fold)
    counts = {(r["fold"], r["label"]): r["count"] for r in rows.groupBy("fold", "label").count().collect()}
    ones = sum(v for (_, y), v in counts.items() if y == 1)
    n = sum(counts.values())
    ids = F.col("doc_id").cast("long").alias("doc_id")
    if ones in (0, n):
        return docs.select(ids, F.lit((ones + 1) / (n + 2)).alias("score"))
    lexicons = _lexicons(rows, counts, lexicon_size)
    features = _features(spark.sparkContext.broadcast(lexicons))
    vector = lambda x: array_to_vector(x).alias("features")
    fitted = settle(rows.select("fold", F.col("label").cast("double").alias("label"),
                                features("text", "fold").alias("x")), "features")
    fitted = fitted.select("fold", "label", vector("x")).coalesce(4)
    boosted = fitted.where(F.col("fold") != 0)
    both = boosted.agg(F.countDistinct("label")).first()[0] == 2
    boosted = boosted if both else fitted
    # shrunken steps on a logistic loss; each tree sees part of the rows
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, subsamplingRate=0.8, seed=7,
                          minInstancesPerNode=max(1, min(10, ones // 10))).fit(boosted)
    chance = vector_to_array("probability")[1]
    raw = model.transform(fitted.where(F.col("fold") == 0)).select("label", chance.alias("p"))
    # a row of each label at the ends of the scale keeps the calibration defined
    # where the fold has one kind of label only
    ends = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "label double, p double")
    step = IsotonicRegression(featuresCol="p", labelCol="label").fit(raw.unionByName(ends))
    text = docs.select(ids, F.col("text").cast("string").alias("text"))
    scored = model.transform(text.select("doc_id", vector(features("text", F.lit(-1)))))
    scored = step.transform(scored.select("doc_id", chance.alias("p")))
    # plateaus of the step function keep the trees' order
    mixed = 0.98 * F.col("prediction") + 0.02 * F.col("p")
    return scored.select("doc_id", F.least(F.greatest(mixed, F.lit(0.0)), F.lit(1.0)).alias("score"))


def classify(docs: DataFrame, known: DataFrame, threshold: float = 0.7, **fitting) -> DataFrame:
    """Per row of ``docs``: doc_id, score, predicted (1 from ``threshold`` on)."""
    return score(docs, known, **fitting).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
