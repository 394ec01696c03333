"""Numeric grounding: every number quoted in a text must be traceable to the
report data, within a tolerance.

  G1  number tokens from text (a hyphen before a number that is followed by
      a month word is a range mark, not a minus)
  G2  allowed values from report blocks at 2/1/0 decimals, plus digit runs
      in strings
  G3  small prose numbers are always allowed
  G4  each token is ok (|v-a| <= tol), sign_only (magnitudes match) or missing
  G5  per-text verdict

The tolerance test is an equi-join on (key, value bucket): the allowed values
collapse to the least and the greatest of each bucket, the tokens to their
distinct values, so neither a long allow-list nor a number that is quoted
everywhere makes more than a few joined rows per distinct value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions.numeric import round_half_up

NUMBER = r"-?[0-9][0-9,]*\.?[0-9]*"
WS = r"[ \t\n\r\f\x0B]"
DATE_ALT = "|".join(vocab.DATE_WORDS)
RANGE_MINUS = rf"-(?=[0-9][0-9,]*+\.?+[0-9]*+{WS}*(?i:{DATE_ALT}))"
HUGE = 1e15  # above this, doubles are spaced >= 0.125 apart: tolerance == equality


def number_tokens(text: str | Column) -> Column:
    """G1: array of numbers in the text, in order."""
    t = F.col(text) if isinstance(text, str) else text
    cleaned = F.regexp_replace(F.coalesce(t, F.lit("")), RANGE_MINUS, " ")
    toks = F.regexp_extract_all(cleaned, F.lit(NUMBER), 0)
    vals = F.transform(toks, lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double"))
    # a token too long for a double stays, as infinity, and is reported as missing
    return F.filter(vals, lambda v: v.isNotNull())


def explode_tokens(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, pos, value) — one row per number token (G6: NULL text ignored)."""
    return texts.filter(F.col(text_col).isNotNull()).select(
        *keys, F.posexplode(number_tokens(text_col)).alias("pos", "value"))


def allowed_from_numbers(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """G2 (numeric part): every value of ``cols`` at 2, 1 and 0 decimals; halves
    of whole numbers, which a double holds exactly, go to even."""
    arr = F.array(*[F.col(c).cast("double") for c in cols])
    v = df.select(*keys, F.explode(arr).alias("v")).filter(F.col("v").isNotNull())
    return v.select(*keys, F.explode(F.array(round_half_up(F.col("v"), 2),
                                             round_half_up(F.col("v"), 1),
                                             F.bround("v", 0))).alias("a"))


def allowed_from_strings(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """G2 (string part): every digit run inside string values."""
    arr = F.array(*[F.col(c).cast("string") for c in cols])
    s = df.select(*keys, F.explode(arr).alias("s")).filter(F.col("s").isNotNull())
    return s.select(*keys, F.explode(F.regexp_extract_all("s", F.lit("[0-9]+"), 0)).alias("d")) \
        .select(*keys, F.col("d").try_cast("double").alias("a")).filter(F.col("a").isNotNull())


def prose_numbers(keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """The prose allow-list for every key."""
    return keys_df.select(*keys).distinct().select(
        *keys, F.explode(F.array(*[F.lit(float(x)) for x in vocab.NARRATIVE_NUMBERS])).alias("a"))


def _bucket(v: Column, width: float) -> Column:
    return F.when(F.abs(v) < HUGE, F.floor(v / width).cast("double")).otherwise(v)


def _status(ok: Column, sg: Column) -> tuple[Column, Column]:
    status = F.when(ok, F.lit("ok")).when(sg, F.lit("sign_only")).otherwise(F.lit("missing"))
    msg = (F.when(ok, F.lit(None).cast("string"))
           .when(sg, F.lit(vocab.GROUNDING_SIGN_ONLY))
           .otherwise(F.lit(vocab.GROUNDING_MISSING)))
    return status, msg


def classify_tokens(tokens: DataFrame, allowed: DataFrame, keys: list[str],
                    tol: float = vocab.GROUNDING_TOLERANCE) -> DataFrame:
    """Status per token — ok / sign_only / missing — with a message.

    Buckets are half a tolerance wide.  Of the allowed values in a bucket only
    the least and the greatest are kept: if any is within the tolerance of a
    value, the nearer of these is.  Distinct (key, value) pairs are tested
    against the seven buckets around them, and the result is joined back to
    the tokens, so equal tokens keep their rows.  Every join is an equi-join
    whose sides the planner sizes by bytes."""
    width = tol / 2
    tagged = allowed.where(F.col("a").isNotNull()).select(*keys, F.explode(F.array(
        F.struct(F.lit("ok").alias("tag"), F.col("a").alias("av")),
        F.struct(F.lit("sign").alias("tag"), F.abs("a").alias("av")))).alias("x"))
    ends = (tagged.select(*keys, "x.tag", "x.av", _bucket(F.col("x.av"), width).alias("_b"))
            .groupBy(*keys, "tag", "_b").agg(F.min("av").alias("lo"), F.max("av").alias("hi")))
    values = tokens.select(*keys, "value").distinct()
    probe = values.select(*keys, "value", F.explode(F.array(
        F.struct(F.lit("ok").alias("tag"), F.col("value").alias("tv")),
        F.struct(F.lit("sign").alias("tag"), F.abs("value").alias("tv")))).alias("x"))
    around = F.when(F.abs("tv") < HUGE, F.transform(
        F.sequence(F.lit(-3), F.lit(3)),
        lambda d: F.floor(F.col("tv") / width).cast("double") + d)).otherwise(F.array("tv"))
    near = lambda c: F.abs(F.col("tv") - F.col(c)) <= tol
    hits = (probe.select(*keys, "value", "x.tag", "x.tv")
            .select("*", F.explode(around).alias("_b"))
            .join(ends, [*keys, "tag", "_b"])
            .where(near("lo") | near("hi"))
            .groupBy(*keys, "value").agg(F.max(F.col("tag") == "ok").alias("_ok")))
    ok = F.coalesce(F.col("_ok"), F.lit(False))
    status, msg = _status(ok, F.col("_ok").isNotNull())
    return tokens.join(hits, [*keys, "value"], "left").select(
        *tokens.columns, status.alias("status"), msg.alias("message"))


def verdict(findings: DataFrame, keys: list[str]) -> DataFrame:
    """Per text — counts and whether a person must review it."""
    return (findings.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_numbers"),
                 F.count_if(F.col("status") == "missing").alias("n_missing"),
                 F.count_if(F.col("status") == "sign_only").alias("n_sign_only"))
            .withColumn("needs_review", F.col("n_missing") > 0))


def strip_fences(text: Column) -> Column:
    """P25 (part 1): remove a leading/trailing markdown code fence."""
    t = F.regexp_replace(text, r"^\s*```[a-zA-Z]*\s*", "")
    return F.regexp_replace(t, r"\s*```\s*$", "")


def parse_lenient(text: str | Column) -> Column:
    """P25: strip fences and parse; only a text that fails has its trailing
    commas dropped and is parsed again.  A map of the string values (G6: others
    are skipped), NULL when still unparseable or no object."""
    t = strip_fences(F.col(text) if isinstance(text, str) else text)
    repaired = F.regexp_replace(t, r",(\s*[}\]])", "$1")
    v = F.coalesce(F.try_parse_json(t), F.try_parse_json(repaired))
    held = F.try_variant_get(v, "$", "map<string,variant>")
    strings = F.map_filter(held, lambda _, x: F.schema_of_variant(x) == "STRING")
    return F.transform_values(strings, lambda _, x: F.try_variant_get(x, "$", "string"))


#: What a JSON text without escaped quotes consists of: strings (a key has its colon behind) and bare words.
JSON_TOKEN = r'"[^"]*"(?:\s*:)?|[^\s"{}\[\],:]+'


def json_leaves(df: DataFrame, keys: list[str], json_col: str) -> DataFrame:
    """S11 / G2 for nested documents: every scalar leaf of a JSON text as
    (keys, kind, num, str) with kind in number / string (booleans and nulls
    dropped, object keys not used).

    A leaf needs no way down to it: the text, once the parser has found it to be
    JSON, is cut into its tokens in one pass, whatever its depth.  Escaped
    backslashes and quotes are spelled as code points first, so that a quote is an
    end of a string always.  Texts that are no JSON have no leaves."""
    text = F.col(json_col)
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022"))
    leaf = F.col("leaf")
    tokens = (df.where(F.try_parse_json(text).isNotNull())
              .select(*keys, F.explode(F.regexp_extract_all(plain, F.lit(JSON_TOKEN), F.lit(0))).alias("leaf"))
              .where(~leaf.endswith(":") & ~leaf.isin("true", "false", "null")))
    told = leaf.startswith('"')
    return tokens.select(
        *keys, F.when(told, "string").otherwise("number").alias("kind"),
        F.when(~told, leaf.try_cast("double")).alias("num"),
        F.when(told, F.try_variant_get(F.try_parse_json(leaf), "$", "string")).alias("str"))


def allowed_from_json(df: DataFrame, keys: list[str], json_col: str) -> DataFrame:
    """G2 over nested JSON documents: numbers at 2/1/0 decimals and digit
    runs inside strings."""
    leaves = json_leaves(df, keys, json_col)
    nums = allowed_from_numbers(leaves.filter(F.col("kind") == "number"), keys, ["num"])
    strs = allowed_from_strings(leaves.filter(F.col("kind") == "string"), keys, ["str"])
    return nums.unionByName(strs)


def _leaf_arrays(c: Column, dt) -> tuple[list[Column], list[Column]]:
    """Numbers and strings under ``c`` (typed), as lists of array columns."""
    from pyspark.sql import types as T
    if isinstance(dt, T.StructType):
        nums, strs = [], []
        for f in dt.fields:
            n, s = _leaf_arrays(c.getField(f.name), f.dataType)
            nums += n
            strs += s
        return nums, strs
    if isinstance(dt, T.ArrayType):
        n, s = _leaf_arrays(F.lit(None), dt.elementType)  # probe which kinds exist
        # an absent block has no leaves; its null must not empty the other blocks
        def under(which: int, kind: str) -> Column:
            inner = F.transform(c, lambda x: F.concat(*_leaf_arrays(x, dt.elementType)[which]))
            return F.coalesce(F.flatten(inner), F.array().cast(f"array<{kind}>"))

        return [under(0, "double")] if n else [], [under(1, "string")] if s else []
    if isinstance(dt, T.BooleanType):
        return [], []
    if isinstance(dt, T.NumericType):
        return [F.array(c.cast("double"))], []
    if isinstance(dt, T.StringType):
        return [], [F.array(c)]
    return [], []


def allowed_from_typed_json(df: DataFrame, keys: list[str], json_col: str, schema) -> DataFrame:
    """G2 over JSON documents whose schema is known: one ``from_json`` and
    one projection (no per-level joins); numbers at 2/1/0 decimals, digit
    runs in strings, object keys not used."""
    doc = F.from_json(json_col, schema)
    nums, strs = _leaf_arrays(F.col("_d"), schema)
    base = df.select(*keys, doc.alias("_d"))
    n = base.select(*keys, F.explode(F.concat(*nums)).alias("num"))
    s = base.select(*keys, F.explode(F.concat(*strs)).alias("str"))
    return (allowed_from_numbers(n, keys, ["num"])
            .unionByName(allowed_from_strings(s, keys, ["str"])))
