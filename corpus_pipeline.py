"""A training corpus from raw documents: five stages, each on all that its predecessor kept.

1. quality: documents that the classifier rejects go.
2. near_duplicates: one document of each SimHash group stays.
3. substrings: passages that an earlier document holds are cut out.
4. decontamination: documents that hold a benchmark window go.
5. packing: the remaining texts as power-of-two sequences of token ids.

``run`` writes each stage's result as Parquet below the session's shared folder
and reads it back, so that a lost executor costs a re-read at most.  No SQL can
express the stages (a trained classifier, SimHash over XXH64, min-hash windows
and a BPE vocabulary); each is tested against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillgrid.llm import decontaminate, packing, quality, simhash, substrings
from tillgrid.llm._shared import settle, table
from tillgrid.llm._tokens import TOKENIZER

#: Documents that score below are rejected: rather keep a doubtful document than lose a clean one.
QUALITY_THRESHOLD = 0.5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = quality.labelled(table(spark, sf_dir, "labels"), "quality")
    return quality.keep(docs, labels.where(~quality.held_out(2, 4)), QUALITY_THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, distance=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.cut(docs, least_words=50, similarity=0.8)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=10)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, TOKENIZER, end_id=2, longest=4096)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("substrings", repeated_passages),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
