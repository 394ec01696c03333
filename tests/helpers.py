"""Test helpers: run the distributed grounding operators on small inputs."""

import json

from pyspark.sql import functions as F

from tillgrid.operators import grounding as GR


def check(spark, narrative: dict, *sources: dict):
    """(missing, sign_only) lists like the source system's check, computed
    with the Spark operators (tolerance join, JSON leaves)."""
    texts = spark.createDataFrame(
        [("r", k, v if isinstance(v, str) else None) for k, v in narrative.items()],
        "rid string, field string, text string")
    docs = spark.createDataFrame([("r", json.dumps(s)) for s in sources] or [("r", "{}")],
                                 "rid string, j string")
    allowed = GR.allowed_from_json(docs, ["rid"], "j").unionByName(
        GR.prose_numbers(docs, ["rid"]))
    toks = GR.explode_tokens(texts, ["rid", "field"])
    found = GR.classify_tokens(toks, allowed, ["rid"]).orderBy("field", "pos").collect()
    missing = [f"[{r.field}] {r.value}{r.message}" for r in found if r.status == "missing"]
    sign = [f"[{r.field}] {r.value}{r.message}" for r in found if r.status == "sign_only"]
    return missing, sign


def extract(spark, text: str) -> list[float]:
    df = spark.createDataFrame([(text,)], "text string")
    return df.select(GR.number_tokens("text").alias("n")).first()["n"]


def one(spark, expr, schema: str, row: tuple):
    df = spark.createDataFrame([row], schema)
    return df.select(expr.alias("x")).first()["x"]


def col(name):
    return F.col(name)
