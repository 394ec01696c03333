"""Held-out accuracy of the two classifiers, their parts against plain versions, and edge cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tillgrid.llm import quality as Q
from tillgrid.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    for s in set(scores):
        same = np.array(scores) == s
        ranks[same] = ranks[same].mean()
    y = np.array(labels)
    return (ranks[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def held_out_rows(spark, scored, label):
    labels = Q.labelled(spark.read.parquet(f"{SF}/labels.parquet"), label)
    return scored.where("held_out").join(labels, "doc_id").select("score", "label", "predicted").collect()


def test_quality_held_out(spark):
    from tillgrid.llm.queries import op7_quality
    scored = op7_quality(spark, SF)
    rows = held_out_rows(spark, scored, "quality")
    assert auc([r["score"] for r in rows], [r["label"] for r in rows]) > 0.97
    assert sum(r["predicted"] == r["label"] for r in rows) / len(rows) > 0.93
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_toxicity_held_out(spark):
    from tillgrid.llm.queries import op3_toxicity
    scored = op3_toxicity(spark, SF)
    rows = held_out_rows(spark, scored, "toxic")
    assert auc([r["score"] for r in rows], [r["label"] for r in rows]) > 0.85
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_held_out_rows_and_other_columns_are_never_learnt_from(spark):
    """Turning the held-out labels, and lang and source, leaves every score as it was."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = Q.held_out(2, 4)
    turned = labels.selectExpr("doc_id", "1 - quality AS quality").where(out).unionByName(
        labels.select("doc_id", "quality").where(~out))
    a = Q.classify(docs, Q.labelled(labels, "quality").where(~out), epochs=1)
    other = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'yy' AS source")
    b = Q.classify(other, Q.labelled(turned, "quality").where(~out), epochs=1)
    rows = a.join(b.withColumnRenamed("score", "other"), "doc_id")
    assert rows.where("abs(score - other) > 1e-12").count() == 0


def test_held_out_by_crc(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(50), -3, None]], "doc_id long")
    got = {r[0]: r[1] for r in ids.select("doc_id", Q.held_out(2, 4)).collect()}
    assert got == {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in got}


# --- quality ------------------------------------------------------------------------------

def plain_features(text, bits):
    import re
    tokens = [m[0] for m in re.finditer(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff\x00-\x20\x7f]+", text)]
    grams = Counter()
    for t in tokens:
        grams[t] += 1
    for gap in (1, 2):
        for a, b in zip(tokens, tokens[gap:]):
            if a == b:
                grams["repeat", gap] += 1
            elif gap == 1:
                grams[a, b] += 1
    return grams


def test_features_count_as_a_plain_version():
    texts = [b"A a, b!! b!! b 12 12\x7f x", b"", None, "é é ü zz".encode(), b"w w w w"]
    got = {}
    done = 0
    for first, place, value, n in Q.features(texts, 40):
        for i in range(n):
            got[done + i] = value[first[i]:first[i + 1]]
        done += n
    for i, t in enumerate(texts):
        want = sorted(1 + math.log(c) for c in plain_features(t or b"", 40).values())
        norm = math.sqrt(sum(x * x for x in want)) or 1
        assert np.allclose(sorted(got[i].tolist()), [x / norm for x in want], atol=1e-6)


def _rows_of(texts, bits):
    return [(place[first[i]:first[i + 1]].tolist(), value[first[i]:first[i + 1]].tolist())
            for first, place, value, n in Q.features(texts, bits) for i in range(n)]


def test_long_texts_count_as_whole_ones_whatever_stands_beside_them(monkeypatch):
    rng = random.Random(4)
    words = ["alpha", "beta", "7", "--", "gamma!", "x" * 90, "é"]
    texts = [" ".join(rng.choices(words, k=n)).encode() for n in (3000, 5, 400, 1, 2500)] + [b"y" * 5000, None, b"hi there"]
    whole = [_rows_of([t], 14)[0] for t in texts]
    for stride in (64, 700, 6000):
        monkeypatch.setattr(Q, "STRIDE", stride)
        assert _rows_of(texts, 14) == whole
        assert _rows_of(texts[::-1], 14) == whole[::-1]


def plain_ftrl(rows, dims, alpha, beta, l1, l2):
    z, n = [0.0] * dims, [0.0] * dims

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return (math.copysign(l1, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)
    for x, y in rows:
        w = {i: weight(i) for i in x}
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
        for i, v in x.items():
            g = (p - y) * v
            s = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
            z[i] += g - s * w[i]
            n[i] += g * g
    return [weight(i) for i in range(dims)]


def test_ftrl_updates():
    rng = random.Random(4)
    model = Q.Ftrl(4)
    rows = []
    for _ in range(200):
        place = sorted(rng.sample(range(16), 5))
        value = [rng.random() for _ in place]
        y = int(sum(place) > 37)
        model.learn(np.array(place), np.array(value), y)
        rows.append(({**dict(zip(place, value)), 16: 1.0}, y))
    want = plain_ftrl(rows, 17, model.alpha, model.beta, model.l1, model.l2)
    assert np.allclose(model.weights(), want)
    assert np.allclose(Q.Ftrl(4).load(model.dump()).weights(), want)


EDGE = [(1, None, "a"), (2, "", "b"), (3, "good words here", "c"), (3, "good words here", "d"), (None, "bad !! bad !!", "e"),
        (5, "good " * 50000, "f")]


@pytest.mark.parametrize("classify", [Q.classify, T.classify])
def test_edge_cases(spark, classify):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r["score"] for r in classify(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(3, 1), (5, 1)], "doc_id long, label int")
    assert len({r["score"] for r in classify(docs, one).collect()}) == 1
    both = spark.createDataFrame([(3, 1), (5, 1), (2, 0), (1, 0)], "doc_id long, label int")
    rows = classify(docs, both).collect()
    assert len(rows) == len(EDGE) and all(0 <= r["score"] <= 1 for r in rows)
    assert classify(docs.limit(0), both).count() == 0


def test_labels_that_contradict_or_are_no_labels(spark):
    rows = [(1, 1), (1, 1), (2, 0), (2, 1), (3, None), (None, 1), (4, 7), (5, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    assert sorted(map(tuple, Q.labelled(labels, "quality").collect())) == [(1, 1), (5, 0)]


def test_keep_returns_the_documents_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = Q.labelled(spark.read.parquet(f"{SF}/labels.parquet"), "quality")
    kept = Q.keep(docs, labels, 0.5, epochs=1)
    assert kept.schema == docs.schema
    bad = kept.join(labels.where("label = 0"), "doc_id").count()
    good = kept.join(labels.where("label = 1"), "doc_id").count()
    assert bad < 0.1 * labels.where("label = 0").count() and good > 0.98 * labels.where("label = 1").count()


# --- toxicity -----------------------------------------------------------------------------

def lexicon(*words):
    return T.Lexicon(T._of_words([w.encode() for w in words]), np.arange(1, len(words) + 1, dtype=float))


def test_dense_features_see_the_lexicon_and_its_disguises():
    lex = lexicon("nasty", "vile")
    f = lambda t: dict(zip(T.NAMES, T.dense([t.encode()], lex)[0]))
    plain = f("you NASTY thing and vile words")
    assert plain["word_density"] == pytest.approx(2 / 6) and plain["word_sum"] == 3 and plain["word_peak"] == 2
    assert plain["near_second"] == 1.0 and plain["capitals"] > 0
    far = f("you are " + "so " * 20 + "nasty")
    assert far["near_second"] == 0 and far["second_density"] > 0
    hidden = f("what a n@5ty and v*ile thing!!")
    assert hidden["hidden"] > 0 and hidden["hidden_hits"] == 2 and hidden["exclaims"] > 0
    assert f("")["log_words"] == 0


def test_features_do_not_depend_on_the_block():
    lex = lexicon("nasty", "vile")
    texts = [b"you nasty", None, b"", b"vile vile and fine", b"plain 123 words."]
    alone = np.concatenate([T.dense([t], lex) for t in texts])
    assert np.allclose(T.dense(texts, lex), alone)


def test_long_texts_have_the_features_of_whole_ones_whatever_stands_beside_them(monkeypatch):
    rng = random.Random(9)
    lex = lexicon("nasty", "vile", "rotten")
    words = ["you", "n@5ty", "VILE", "rotten", "fine,", "day", "w" * 200, "12", "?!", "and", "so", "on"]
    texts = [" ".join(rng.choices(words, weights=[2, 1, 1, 1, 9, 9, 1, 3, 3, 9, 9, 9], k=n)).encode()
             for n in (2000, 3, 700, 1500)] + [b"z" * 3000 + b" you", None, b"hi there", b"you " + b"q" * 900 + b" vile"]
    whole = np.concatenate([T.dense([t], lex) for t in texts])
    for stride in (50, 333, 4000):
        monkeypatch.setattr(T, "STRIDE", stride)
        assert np.allclose(T.dense(texts, lex), whole, rtol=1e-12, atol=1e-12)
        assert np.allclose(T.dense(texts[::-1], lex), whole[::-1], rtol=1e-12, atol=1e-12)
        assert [g.tolist() for g in T.distinct_grams(texts)] == [T.distinct_grams([t])[0].tolist() for t in texts]


def test_the_sample_holds_one_row_an_id(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "c"), (3, "d")] + [(7, "hot")] * 500,
                                 "doc_id long, text string")
    known = spark.createDataFrame([(i, i % 2) for i in (1, 2, 7, 9)], "doc_id long, label int")
    held = sorted(map(tuple, Q.sample(docs, known, 101).collect()))
    assert held == [(1, "a", 1), (2, "c", 0), (7, "hot", 1)]


def test_lexicon_keeps_likelier_grams_only():
    grams = np.array([5, 9, 7], np.uint64)
    lex = T.learn_lexicon(grams, np.array([10, 10, 1]), np.array([0, 100, 0]), 20, 200, 10)
    assert lex.grams.tolist() == [5]
    assert lex.look_up(np.array([5, 6], np.uint64)).tolist() == [lex.odds[0], 0.0]


def test_an_epoch_lists_a_batch_in_parts(monkeypatch):
    from tillgrid.llm import quality
    texts = [f"{w} " * 500_000 for w in ("good", "bad", "fine", "poor")]
    labels, listed, features = [1, 0, 1, 0], [], quality.features
    monkeypatch.setattr(quality, "features", lambda part, bits: listed.append(len(part)) or features(part, bits))
    frame = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(labels)], ["text", "label"])
    model, whole = quality.Ftrl(10), quality.Ftrl(10)
    (out,) = quality._epoch(model, 10)(iter([frame]))
    for text, label in zip(texts, labels):
        for _, place, value, _ in features([text.encode()], 10):
            whole.learn(place, value, label)
    assert sum(listed) == 4 and max(listed) < 4  # all four at once before
    assert out["model"][0].as_py() == whole.dump()
