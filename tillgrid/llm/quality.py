"""Quality classifier: logistic regression over hashed word n-grams, trained by
follow-the-regularised-leader (FTRL-proximal) updates.

Tokens are runs of letters, of digits or of punctuation, case kept.  Features
are hashed single tokens and pairs, and two fixed ones for a token that repeats
at once or after one other.  A feature's value is 1 + ln(count), and a text's
vector has length one.  A score is the logistic function of a sparse dot product.

Fitting reads a bounded sample of the labelled rows: the ``sample_rows`` with
the smallest hash of their id (all, if there are fewer).  Each of ``epochs``
passes streams the sample through one task, which holds the model's two
arrays and one batch; the weights are sent to the scoring tasks (8 bytes for
each of 2 ** ``bits`` places).  Scoring is one pass over all texts, no shuffle.

Defined results: null and empty texts have no features and score by the bias;
labels that are null or not 0 or 1 are not learnt from, nor ids that carry
both; repeated rows are rows of their own; with no labels, or one kind alone,
every score is the smoothed share of label 1; an empty table gives no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import blocks, joined, mix, parts_of, runs, settle, slices, text_lists, tidy

STRIDE = 1 << 22
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def token_classes() -> np.ndarray:
    """Byte classes: 0 white space and controls, 1 letters (and all beyond ASCII), 2 digits, 3 others."""
    c = np.full(256, 3, np.uint8)
    c[:33] = 0
    c[127] = 0
    c[ord("0"):ord("9") + 1] = 2
    c[ord("A"):ord("Z") + 1] = 1
    c[ord("a"):ord("z") + 1] = 1
    c[128:] = 1
    return c


_CLASSES = token_classes()


def _places(h: np.ndarray, row: np.ndarray, bits: int, told: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of every n-gram occurrence; places 0 and 1 are the repeats.  The first
    ``told`` tokens were counted before and only begin pairs that end behind them."""
    shift = np.uint64(64 - bits)
    rows, places = [row[told:]], [h[told:] >> shift]
    with np.errstate(over="ignore"):
        for gap in (1, 2):
            skip = max(0, told - gap)
            left, right = h[skip:len(h) - gap], h[skip + gap:]
            same = row[skip + gap:] == row[skip:len(h) - gap]
            a, b, r = left[same], right[same], row[skip + gap:][same]
            repeat = a == b
            if gap == 1:
                pair = mix(a * _PAIR + b) >> shift
                rows.append(r)
                places.append(np.where(repeat, np.uint64(0), pair))
            else:
                rows.append(r[repeat])
                places.append(np.ones(int(repeat.sum()), np.uint64))
    return np.concatenate(rows), np.concatenate(places).astype(np.int64)


def _long_counts(text: bytes, bits: int) -> np.ndarray:
    """How often each place occurs in one long text, stride by stride.  Strides end at white
    space and take the last two tokens along, so the counts are those of the whole text."""
    count = np.zeros(1 << bits, np.int64)
    tail = np.zeros(0, np.uint64)
    for lo, hi in slices(text, _CLASSES == 0, STRIDE):
        _, _, h = runs(text[lo:hi], _CLASSES)
        h = np.concatenate([tail, h])
        if len(h):
            count += np.bincount(_places(h, np.zeros(len(h), np.int64), bits, len(tail))[1], minlength=1 << bits)
        tail = h[-2:]
    return count


def features(texts: list[bytes | None], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(first places per row, places, values, rows) for blocks of texts.  A text's
    features do not depend on the texts beside it."""
    for lo, hi in blocks(texts, STRIDE):
        part = texts[lo:hi]
        if len(part[0] or b"") > STRIDE:
            counts = _long_counts(part[0], bits)
            place = np.flatnonzero(counts)
            row, count = np.zeros(len(place), np.int64), counts[place]
        else:
            data, at = joined(part)
            starts, _, h = runs(data, _CLASSES)
            row, place = _places(h, np.searchsorted(at, starts, "right") - 1, bits)
            both, count = np.unique(row << bits | place, return_counts=True)
            row, place = both >> bits, both & (1 << bits) - 1
        value = 1 + np.log(count)
        norm = np.sqrt(np.bincount(row, value * value, minlength=hi - lo))
        value = (value / norm[row]).astype(np.float32)
        yield np.searchsorted(row, np.arange(hi - lo + 1)), place, value, hi - lo


class Ftrl:
    """Per-coordinate FTRL-proximal logistic regression; the last place is the bias."""

    def __init__(self, bits: int, alpha: float = 4.0, beta: float = 1.0, l1: float = 0.02,
                 l2: float = 0.1) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << bits) + 1)
        self.n = np.zeros((1 << bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, place: np.ndarray, value: np.ndarray, label: int) -> None:
        place = np.append(place, len(self.z) - 1)
        value = np.append(value, 1.0)
        w = self.weights(place)
        g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        n = self.n[place]
        self.z[place] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[place] = n + g * g

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.save(out, np.stack([self.z, self.n]))
        return out.getvalue()

    def load(self, raw: bytes) -> "Ftrl":
        self.z, self.n = np.load(io.BytesIO(raw))
        return self


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the ids that carry one valid label."""
    each = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    each = each.where("doc_id IS NOT NULL AND label IN (0, 1)")
    return (each.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("top"))
            .where("label = top").drop("top"))


def sample(docs: DataFrame, known: DataFrame, sample_rows: int) -> DataFrame:
    """(doc_id, text, label) of the sampled ids, one row an id (of rows that repeat it, that
    with the least text), written to the shared folder: at most ``sample_rows``."""
    few = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(few), "doc_id")
    return settle(texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
                  .select("doc_id", "text", "label"), "sample")


def _epoch(model: Ftrl, bits: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in (part for whole in frames for part in parts_of(whole, 0)):
            texts = frame.column(0).cast(pa.binary()).to_pylist()
            labels = frame.column(1).to_pylist()
            done = 0
            for first, place, value, n in features(texts, bits):
                for i in range(n):
                    s = slice(first[i], first[i + 1])
                    model.learn(place[s], value[s], labels[done + i])
                done += n
        yield pa.RecordBatch.from_arrays([pa.array([model.dump()], pa.binary())], ["model"])
        tidy()
    return run


class Model:
    """What scoring needs: weights and the share of label 1 in the sample."""

    def __init__(self, bits: int, weights: np.ndarray | None, share: float) -> None:
        self.bits, self.weights, self.share = bits, weights, share


def fit(docs: DataFrame, known: DataFrame, sample_rows: int = 16384, bits: int = 18,
        epochs: int = 3) -> Model:
    """Fit on ``known`` (doc_id, label) with the texts of ``docs``."""
    chosen = sample(docs, known, sample_rows)
    counts = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    if len(counts) < 2:
        return Model(bits, None, share)
    model = Ftrl(bits)
    for _ in range(epochs):
        one = chosen.select("text", "label").coalesce(1)
        model.load(one.mapInArrow(_epoch(model, bits), "model binary").first()[0])
    return Model(bits, model.weights().astype(np.float64), share)


def score(docs: DataFrame, model: Model) -> Column:
    """The score of a text column named ``text`` under ``model``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = sent.value
        for column in texts:
            out = []
            if m.weights is None:
                out.append(np.full(len(column), m.share))
            else:
                for part in text_lists(column):
                    for first, place, value, n in features(part, m.bits):
                        row = np.repeat(np.arange(n), np.diff(first))
                        out.append(np.bincount(row, m.weights[place] * value, minlength=n) + m.weights[-1])
                out = [1 / (1 + np.exp(-np.clip(x, -35, 35))) for x in out]
            yield pa.array(np.concatenate(out) if out else np.zeros(0))
        tidy()
    return of(F.col("text").cast("string"))


def held_out(remainder: int, modulus: int) -> Column:
    """Whether crc32 of doc_id as text leaves ``remainder``; false for a null id."""
    r = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
    return F.coalesce(r == remainder, F.lit(False))


def classify(docs: DataFrame, known: DataFrame, threshold: float = 0.7, **fitting) -> DataFrame:
    """Per row of ``docs``: doc_id, score, predicted (1 from ``threshold`` on)."""
    model = fit(docs, known, **fitting)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(docs, model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep(docs: DataFrame, known: DataFrame, threshold: float, **fitting) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``."""
    return docs.where(score(docs, fit(docs, known, **fitting)) >= threshold)
