"""The registered queries of the ten operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, idfile, licenses, merkle, neighbours, packing, quality, sentencepieces, simhash,
               substrings, toxicity, warc, whitening)
from ._shared import table
from ._tokens import TOKENIZER

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, end_id=2, longest=4096)
    return pieces.drop("input_ids")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = quality.labelled(table(spark, sf_dir, "labels"), "toxic")
    out = quality.held_out(1, 3)
    return (toxicity.classify(table(spark, sf_dir, "documents"), labels.where(~out), threshold=0.7)
            .select("doc_id", out.alias("held_out"), "score", "predicted"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(table(spark, sf_dir, "documents"), least_words=50, similarity=0.8)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = quality.labelled(table(spark, sf_dir, "labels"), "quality")
    out = quality.held_out(2, 4)
    return (quality.classify(table(spark, sf_dir, "documents"), labels.where(~out), threshold=0.7)
            .select("doc_id", out.alias("held_out"), "score", "predicted"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = neighbours.usable(table(spark, sf_dir, "embeddings"))
    return neighbours.nearest(vectors.where("id % 20 = 0"), vectors, k=20)


def op9_idfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfile.round_trip(table(spark, sf_dir, "documents"), TOKENIZER, end_id=1)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepieces.encode(table(spark, sf_dir, "documents"), PIECES)
    return sentencepieces.digest(sentencepieces.decode(coded, PIECES))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.without_newlines())


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_decontamination, op3_toxicity, op4_licenses, op5_substrings,
                            op6_simhash, op7_quality, op8_neighbours, op9_idfile, op10_warc,
                            op11_sentencepiece, op12_merkle, op13_whitening)}

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLD = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _decontamination_sql() -> str:
    words = "regexp_extract_all({}, '{}')".format(_FOLD.format("text"), _WORDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
i AS (SELECT item_id, {words} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, w[s : s + least(10, len(w)) - 1] AS x FROM (
      SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(x) AS n FROM p),
t AS (SELECT r, s, n, w[s : s + n - 1] AS x FROM (
      SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT r, s, n, item_id FROM t JOIN p USING (x)),
marked AS (SELECT r, count(DISTINCT k) AS n_hit FROM (
           SELECT r, unnest(range(s, s + n)) AS k FROM (SELECT DISTINCT r, s, n FROM hits)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (r) LEFT JOIN named USING (r)"""


def _licenses_sql() -> str:
    rows = ", ".join("('{}', [{}])".format(name, ", ".join(f"'{g}'" for g in licenses.template_bigrams(text)))
                     for name, text in licenses.TEMPLATES)
    words = f"list_filter(string_split_regex(lower({{}}), '{licenses.GAP}'), lambda x: x <> '')"
    return f"""
WITH t(license, grams) AS (VALUES {rows}),
u AS (SELECT DISTINCT doc_id, unit FROM (
      SELECT doc_id, unnest(list_concat(string_split(text, chr(10)),
             string_split_regex(text, '\\n[ \\t\\r]*\\n'), [text])) AS unit FROM documents)),
w AS (SELECT doc_id, {words.format('unit')} AS w FROM u),
a AS (SELECT doc_id, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS a FROM w),
s AS (SELECT doc_id, license, 2.0::DOUBLE * len(list_intersect(a, grams)) / (len(a) + len(grams)) AS dice
      FROM a, t WHERE len(a) > 0)
SELECT doc_id, license, max(dice) AS dice FROM s WHERE dice >= 0.8 GROUP BY ALL"""


_NEIGHBOURS = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""

_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h),
x AS (SELECT page_id, h, first, sha1(h) AS s FROM p JOIN f USING (h)),
b AS (SELECT *, list_transform(range(0, 8), lambda k: CAST('0x' || s[k * 5 + 1 : k * 5 + 5] AS BIGINT)) AS g FROM x)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda k:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((g[k // 4 + 1] >> (15 - 5 * (k % 4))) & 31) + 1 AS INTEGER), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM b"""

def _merkle_sql() -> str:
    def field(c: str) -> str:
        return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def walk(name: str, start: str, steps: str) -> str:
        return f"""{name} AS ({start} UNION ALL
      SELECT k, w.s, w.p // 3, w.lvl + 1, proof || l || r, sha256(l || folded || r), leaf, subroot
      FROM {name} w JOIN {steps} q ON w.s = q.s AND w.lvl = q.lvl AND w.p = q.p)"""

    def tree(name: str, start: str) -> str:
        return f"""{name}(s, lvl, p, n, digest) AS ({start} UNION ALL
      SELECT s, lvl + 1, p // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY p))
      FROM {name} WHERE n > 1 GROUP BY s, lvl, p // 3, n)"""

    def steps(name: str, nodes: str) -> str:
        return f"""{name} AS (SELECT a.s, a.lvl, a.p,
      coalesce(string_agg(b.digest, '' ORDER BY b.p) FILTER (b.p < a.p), '') AS l,
      coalesce(string_agg(b.digest, '' ORDER BY b.p) FILTER (b.p > a.p), '') AS r
      FROM {nodes} a JOIN {nodes} b ON a.s = b.s AND a.lvl = b.lvl AND a.p // 3 = b.p // 3
      WHERE a.n > 1 GROUP BY ALL)"""

    # crc32, bit by bit: a byte enters before the first of its eight shifts
    bits = ("list_concat([4294967295::BIGINT], flatten(list_transform(range(1, len(i) + 1), "
            "lambda k: [ascii(i[k])::BIGINT, 0, 0, 0, 0, 0, 0, 0])))")
    crc = (f"xor(list_reduce({bits}, lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384::BIGINT)), "
           "4294967295::BIGINT)")
    return f"""
WITH RECURSIVE c AS (SELECT *, CAST(doc_id AS VARCHAR) AS i FROM documents),
d AS (SELECT row_number() OVER () AS k, doc_id, coalesce('x' || source, '') AS s, {leaf('text')} AS leaf,
      CASE WHEN {crc} % 2 = 0 AND text IS NOT NULL THEN {leaf("replace(text, chr(10), '')")} END AS other FROM c),
x AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
      count(*) OVER (PARTITION BY s) AS n FROM d),
{tree('t', 'SELECT s, 0, p, n, leaf FROM x')},
{steps('tq', 't')},
b AS (SELECT s, digest, row_number() OVER (ORDER BY s) - 1 AS p, count(*) OVER () AS n FROM t WHERE n = 1),
{tree('u', "SELECT '', 0, p, n, digest FROM b")},
{steps('uq', 'u')},
{walk('w', "SELECT k, s, p, 0 AS lvl, '' AS proof, coalesce(other, leaf) AS folded, leaf, '' AS subroot FROM x", 'tq')},
{walk('v', "SELECT k, '' AS s, b.p, 0 AS lvl, proof, folded, leaf, b.digest AS subroot FROM w JOIN t ON w.s = t.s "
           "AND w.lvl = t.lvl AND t.n = 1 JOIN b ON w.s = b.s", 'uq')}
SELECT doc_id, v.leaf, subroot, u.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = u.digest AS verified
FROM v JOIN u ON u.n = 1 AND u.lvl = v.lvl JOIN d USING (k)"""


ORACLE: dict[str, str] = {
    "op2_decontamination": _decontamination_sql(),
    "op4_licenses": _licenses_sql(),
    "op8_neighbours": _NEIGHBOURS,
    "op10_warc": _WARC,
    "op12_merkle": _merkle_sql(),
}
