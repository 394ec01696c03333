"""The corpus pipeline stage by stage, each held against what its operator reports on the stage's own input."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as P
from tillgrid.llm import decontaminate, simhash, substrings
from tillgrid.llm._shared import settle

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        docs = settle(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "substrings", "decontamination", "packing"]
    for df in stages[1:5]:
        assert df.schema == stages[0].schema


def test_quality_drops_low_labels_and_keeps_clean_ones(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    kept = ids(stages[1])
    good = [r["doc_id"] for r in labels if r["quality"] == 1]
    bad = [r["doc_id"] for r in labels if r["quality"] == 0]
    assert len(kept & set(good)) > 0.98 * len(good) and len(kept & set(bad)) < 0.1 * len(bad)


def test_one_document_of_each_group_stays(stages):
    groups = {r["component"] for r in simhash.groups(stages[1]).collect()}
    assert ids(stages[2]) == groups


def test_no_document_keeps_a_passage_of_an_earlier_one(stages):
    before = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    after = {r["doc_id"]: r for r in stages[3].collect()}
    touched = {r["doc_id"] for r in substrings.repeats(stages[2]).collect()}
    assert touched and all(after[d]["text"] == t for d, t in before.items() if d not in touched)
    assert all(after[d]["n_chars"] == len(after[d]["text"]) < len(before[d]) for d in touched if d in after)
    seen = {}
    for doc, row in sorted(after.items()):
        w = substrings._CLASSES, row["text"].encode().lower()
        s, e, _ = substrings.runs(w[1], w[0])
        words = [w[1][a:b] for a, b in zip(s.tolist(), e.tolist())]
        for i in range(len(words) - 54):
            run = tuple(words[i:i + 55])
            assert seen.setdefault(run, doc) == doc


def test_contaminated_documents_go_and_others_stay(spark, stages):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = decontaminate.digest(decontaminate.contamination(stages[3], bench)).collect()
    assert ids(stages[4]) == {r["doc_id"] for r in found if not r["contaminated"]}
    assert any(r["contaminated"] for r in found)


def test_packed_ids_are_those_of_the_texts(stages):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in stages[5].collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], list(r["input_ids"])))
    texts = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    assert pieces.keys() == texts.keys()
    for doc, text in texts.items():
        got = [i for _, part in sorted(pieces[doc]) for i in part]
        assert got == t.encode(text, add_special_tokens=False).ids + [2]


def test_run_gives_the_last_stage(spark, stages):
    names = ["doc_id", "start", "length", "ids_crc32"]
    a = P.run(spark, SF).select(*names)
    b = stages[5].select(*names)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_registered_queries():
    ours = [n for n in entry.queries() if n[:2] == "op" and n[2].isdigit()]
    assert sorted({n.split("_")[0] for n in ours}) == sorted(f"op{k}" for k in range(1, 14)) and len(ours) == 13
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        docs = settle(stage(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0


def test_odd_rows_pass_every_stage(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "no id but words of its own here", "en", "s", 31), (7, None, "en", None, None),
         (7, "", None, "s", 0), (8, "same row", "en", "s", 8), (8, "same row", "en", "s", 8), (9, "x " * 30000, "en", "s", 60000)],
        base.schema).selectExpr("*", "1 AS score", "'r' AS `row`", "array(1) AS spans")
    docs = odd
    for name, stage in P.STAGES[:4]:
        docs = settle(stage(spark, docs, SF), f"odd-{name}")
        assert docs.columns == odd.columns
    assert P.STAGES[4][1](spark, docs, SF).count() >= 0
    all_kept = simhash.keep_one(odd)
    assert all_kept.where("doc_id = 8").count() == 1
