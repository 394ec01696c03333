"""Packing and id files against the tokenizers library called on whole texts."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillgrid.llm import idfile, packing
from tillgrid.llm._tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = ["", " ", "İ! x", "it's, 'REally'...", "áb é, ́x", "ＡＢ١٢٣", "x\x1cy\x85z\xa0q w e",
       "<|endoftext|> a<|startoftext|>b", "日本語テキスト。", "ΣΑΣ ß ẞ", "​zero﻿", "tab\tand\r\nlines\x0b\x0c", "“quoted”—dash…",
       "😀👍🏽!!", "word" * 3000, "Don't. DON'T, don't!"]


def test_encoder_equals_the_library_on_odd_texts(plain):
    coder = Encoder(PATH)
    assert [x.tolist() for x in coder.encode(ODD)] == [plain(x) for x in ODD]
    assert [x.tolist() for x in coder.encode(ODD, 1)] == [plain(x) + [1] for x in ODD]


def test_encoder_equals_the_library_on_random_texts(plain):
    rng = random.Random(8)
    alphabet = list("abXY'.,!* \n\t\x1c\x85éÉßİΣ́日٣½’—") + ["<|endoftext|>", "'s", "'re"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 25))) for _ in range(600)]
    assert [x.tolist() for x in Encoder(PATH).encode(texts)] == [plain(x) for x in texts]


def test_encoder_forgets_and_goes_stride_by_stride(plain, monkeypatch):
    from tillgrid.llm import _tokens
    monkeypatch.setattr(_tokens, "REMEMBERED", 20)
    monkeypatch.setattr(_tokens, "STRIDE", 50)
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randint(0, 99)}," for _ in range(n)) for n in (0, 3, 200, 40)]
    assert [x.tolist() for x in Encoder(PATH).encode(texts, block=30)] == [plain(x) for x in texts]


@pytest.mark.parametrize("n", [1, 2, 3, 4095, 4096, 4097, 12345])
def test_decomposition_is_made_of_powers_of_two(n):
    parts = packing.decompose(n, 4096)
    assert sum(parts) == n and parts == sorted(parts, reverse=True)
    assert all(p & p - 1 == 0 for p in parts) and len(set(parts) - {4096}) == len([p for p in parts if p < 4096])


def check_pieces(rows, texts, plain):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc, text in texts.items():
        ids = plain(text) + [2]
        at = 0
        for r in sorted(by_doc.pop(doc), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"], r["offset"]) == (at, len(ids), 0)
            assert r["ids_crc32"] == crc(ids[at:at + r["length"]])
            assert list(r["input_ids"]) == ids[at:at + r["length"]]
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    numbers = sorted((r["sequence_id"], r["length"]) for r in rows)
    assert [n for n, _ in numbers] == list(range(len(rows)))
    assert [x for _, x in numbers] == sorted((x for _, x in numbers), reverse=True)


def test_pieces_of_the_documents_table(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(docs.repartition(5), PATH).collect()
    check_pieces(rows, {r["doc_id"]: r["text"] for r in docs.collect()}, plain)


def test_a_vocabulary_of_another_make_is_encoded_whole(tmp_path):
    import json
    made = json.load(open(PATH))
    for name, change in {"no-normaliser": {"normalizer": None}, "other-split": {"pre_tokenizer": {
            "type": "Sequence", "pretokenizers": [{"type": "Whitespace"}, made["pre_tokenizer"]["pretokenizers"][1]]}}}.items():
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(made | change))
        other = Tokenizer.from_file(str(path))
        texts = [*ODD, "Some Words, in CAPITALS: 12345 a-b"]
        assert [x.tolist() for x in Encoder(str(path)).encode(texts)] == [
            other.encode(t, add_special_tokens=False).ids for t in texts]
    assert Encoder(PATH).cuts


def test_packing_edge_cases(spark, plain):
    docs = spark.createDataFrame([(None, "a b", 1, "s"), (1, None, 2, None), (2, "", 3, "t")],
                                 "doc_id long, text string, length int, task string")
    check_pieces(packing.pack(docs, PATH).collect(), {None: "a b", 1: "", 2: ""}, plain)
    twice = spark.createDataFrame([(1, "a b c"), (1, "a b c")], "doc_id long, text string")
    rows = packing.pack(twice, PATH).collect()
    assert len(rows) == 2 and {r["sequence_id"] for r in rows} == {0, 1} and {r["length"] for r in rows} == {4}
    assert packing.pack(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, longest=100)
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, end_id=70000)


# --- id files ---------------------------------------------------------------------------

@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0], [1, 2, 3], [7, 7, 9, 1000, 1000, 123456789],
                                    list(range(0, 5000, 3)), [0] * 300 + [1 << 40]])
def test_elias_fano_select_and_values(values):
    ef = idfile.EliasFano.build(np.array(values, np.uint64))
    assert ef.values().tolist() == values
    assert [ef.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        ef.select(len(values))


def test_elias_fano_needs_few_bits():
    rng = np.random.default_rng(1)
    values = np.cumsum(rng.integers(1, 3000, 20000))
    ef = idfile.EliasFano.build(values)
    assert ef.values().tolist() == values.tolist()
    bits = 8 * (ef.low.nbytes + ef.high.nbytes + ef.sample.nbytes) / len(values)
    assert bits < 2 + np.log2(values[-1] / len(values)) + 1.2


def test_file_round_trip_and_damage():
    ids = [np.array(x, "<u2") for x in ([3, 4, 5], [1], [49407, 1])]
    raw = b"".join(idfile.dump(ids, [-7, 12, None]))
    f = idfile.IdFile(io.BytesIO(raw))
    assert [f.doc_id(i) for i in range(3)] == [-7, 12, None]
    assert [f.document(i).tolist() for i in range(3)] == [x.tolist() for x in ids]
    with pytest.raises(ValueError):
        idfile.IdFile(io.BytesIO(raw[:-1]))
    with pytest.raises(ValueError):
        idfile.IdFile(io.BytesIO(b"nothing"))


def expected_rows(rows, plain):
    out, at = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = plain(text) + [1]
        out.append((doc, at, len(ids), crc(ids)))
        at += len(ids)
    return out


def by_start(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[1])


def test_id_files_of_the_documents_table(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert by_start(idfile.round_trip(docs.repartition(4), PATH)) == expected_rows(rows, plain)


def test_id_files_edge_cases(spark, plain, tmp_path):
    rows = [(5, "b"), (None, "n"), (-3, ""), (4, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, file string, start int")
    assert by_start(idfile.round_trip(docs, PATH)) == expected_rows(rows, plain)
    assert idfile.round_trip(docs.limit(0), PATH).count() == 0
    twice = spark.createDataFrame([(1, "same text")] * 2, "doc_id long, text string")
    got = by_start(idfile.round_trip(twice, PATH))
    assert [r[1] for r in got] == [0, got[0][2]] and got[0][2:] == got[1][2:]
    # many small files keep one order
    many = [(i, f"text number {i}") for i in range(40)]
    folder = f"file://{tmp_path}/ids"
    files = idfile.write_ids(spark.createDataFrame(many, "doc_id long, text string"), PATH, 1, folder, file_ids=10)
    assert files.count() > 8
    assert by_start(idfile.read_ids(files, folder)) == expected_rows(many, plain)


def test_a_worker_cuts_texts_in_small_blocks(monkeypatch):
    import pyarrow as pa

    from tillgrid.llm import packing
    asked = []

    class Coder:
        def encode(self, texts, end, block):
            asked.append((sum(map(len, texts)), block))
            return [np.array([end], np.uint16) for _ in texts]

    monkeypatch.setattr(packing, "encoder", lambda path: Coder())
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 0})())
    frame = pa.RecordBatch.from_pydict({"doc_id": list(range(5000)), "text": ["w " * 500] * 5000})
    got = [n for b in packing._cutter("x", 2, 8)([frame]) for n in b.column(0).to_pylist()]
    assert got == list(range(5000)) and all(n <= 1 << 19 and b <= 1 << 19 for n, b in asked)
