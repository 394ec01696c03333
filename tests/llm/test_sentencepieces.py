"""Merge rounds against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tillgrid.llm import sentencepieces as S

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return S.Model(PATH)


def equal(own, library, texts):
    got = list(own.encode([None if t is None else t.encode() for t in texts]))
    for text, ids in zip(texts, got):
        want = library.encode(text or "", add_eos=True)
        assert ids.tolist() == want, text
        assert own.decode(ids.astype(np.int64)).decode() == library.decode(want)


def test_edges(own, library):
    equal(own, library, [None, "", " ", "   ", "a", " a  b   c ", "\n\n x\t\r\n", "a▁b", "▁▁x", "x\x00y", "<s>", "</s>",
                         "<0x41>", "😀é́", "ﬁ ａ", "  x", "日本語と中文", "a" * 5000, " " * 700 + "x"])


def test_random_texts(own, library):
    rng = random.Random(5)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    single = [p for p in pieces if len(p) == 1]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 50))) for _ in range(200)]
    texts += ["".join(rng.choice(single) for _ in range(rng.randint(1, 900))) for _ in range(100)]
    texts += ["".join(rng.choice("aetnrs ") for _ in range(rng.randint(1, 900))) for _ in range(100)]
    texts += ["".join(rng.choice("aetnrs") for _ in range(rng.randint(200, 400))) for _ in range(60)]
    texts += ["".join(rng.choice([" ", "  ", "the", "ab"]) for _ in range(800)) for _ in range(20)]
    equal(own, library, texts)


def test_long_texts_are_cut_between_words_only(own, library, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 64)
    rng = random.Random(6)
    equal(own, library, [" ".join(rng.choice(["the", "", "quick", "brown" * 30, "  "]) for _ in range(300))
                         for _ in range(20)])


@pytest.mark.parametrize("long", [2, 1 << 30])
def test_heap_and_rounds_agree(own, library, monkeypatch, long):
    monkeypatch.setattr(S, "LONG", long)
    test_random_texts(own, library)


def test_decoding_of_any_ids(own, library):
    rng = random.Random(7)
    for _ in range(2000):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(131, 258), rng.randint(0, 31999), 259])
               for _ in range(rng.randint(0, 12))]
        assert own.decode(np.array(ids, np.int64)).decode() == library.decode(ids), ids


def test_colliding_hashes_do_not_merge_words(own, library, monkeypatch):
    monkeypatch.setattr(S, "mix", lambda x: x * np.uint64(0))
    equal(own, library, ["some words here", "and other words there"])


def test_rows(spark, library):
    rows = [(1, "Hello  world", "x"), (None, None, "y"), (1, "", "z"), (3, "naïve 日本", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, input_ids string")
    got = S.digest(S.decode(S.encode(df, PATH), PATH)).collect()
    want = []
    for i, text, _ in rows:
        ids = library.encode(text or "", add_eos=True)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert S.encode(df.limit(0), PATH).count() == 0


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb2
    proto = pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="identity"):
        S.Model(str(path))
