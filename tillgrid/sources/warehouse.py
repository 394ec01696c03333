"""Derived star-schema tables written once and read by every report.

The source system imports a month once into its star schema and then runs
many report queries against it.  Here the derived tables (fact_sales,
dim_product, fact_channel) are written as Parquet under the shared folder the
cluster names in ``spark.checkpoint.dir`` (facts partitioned by ``period`` so
a one-month report prunes partitions), keyed by a fingerprint of the input
files so a changed input never reads a stale table.  Writing goes to a
private temporary folder that is then renamed into place, so concurrent or
re-tried jobs never see a half-written table, and the written table cuts the
lineage for everything downstream.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

VERSION = "v1"


def _code_version() -> str:
    """Hash of this package's source: a code change never reads tables
    derived by older code (the shared folder may outlive one run).  The
    training-data operators derive none of them."""
    import pathlib
    h = hashlib.sha1(VERSION.encode())
    pkg = pathlib.Path(__file__).resolve().parent.parent
    for f in sorted(f for f in pkg.rglob("*.py") if "llm" not in f.relative_to(pkg).parts):
        h.update(f.relative_to(pkg).as_posix().encode())
        h.update(f.read_bytes())
    return h.hexdigest()[:12]


CODE_VERSION = _code_version()


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


_FP_CACHE: dict[tuple, str] = {}


def _fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Hash of every input file's path, size and modification time (a driver
    metadata listing; cached per application unless disabled)."""
    cache = spark.conf.get("spark.tillgrid.fingerprintCache", "true") == "true"
    ck = (spark.sparkContext.applicationId, tuple(sorted(paths)))
    if cache and ck in _FP_CACHE:
        return _FP_CACHE[ck]
    fp = _compute_fingerprint(spark, paths)
    _FP_CACHE[ck] = fp
    return fp


def _compute_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    h = hashlib.sha1(CODE_VERSION.encode())
    for path in sorted(paths):
        fs, p = _fs(spark, path)
        if not fs.exists(p):
            h.update(f"{path}:missing".encode())
            continue
        it = fs.listFiles(p, True)
        while it.hasNext():
            st = it.next()
            h.update(f"{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}".encode())
    return h.hexdigest()[:16]


def root(spark: SparkSession) -> str:
    """The folder of the stored tables: the one configured, or below the shared folder as the
    cluster names it, where a later application finds them again.  (An application's own
    checkpoint folder lies below that, under a name of its own.)"""
    configured = spark.conf.get("spark.tillgrid.warehouse", None)
    shared = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return configured or shared.rstrip("/") + "/tillgrid-star"


def enabled(spark: SparkSession) -> bool:
    return spark.conf.get("spark.tillgrid.materialize", "true") != "false"


def folder(spark: SparkSession, inputs: list[str]) -> str:
    """Where the tables derived from these inputs are stored."""
    return f"{root(spark)}/{_fingerprint(spark, inputs)}"


def materialized(spark: SparkSession, name: str, inputs: list[str],
                 build: Callable[[], DataFrame], partition_by: list[str] | None = None,
                 cluster_by: list[str] | None = None, store: bool = True, dealt: bool = False) -> DataFrame:
    """Return table ``name`` derived by ``build()`` from ``inputs``; build and
    write it on first use.

    A partitioned table is range-partitioned on (partition columns, cluster
    columns) before the write: each task writes a contiguous slice, so the
    file count is about tasks + partitions (not tasks x partitions) and a hot
    partition value is split over many tasks by the cluster key.  A plan that
    ends range-partitioned in that way (``dealt``) is written as it lies."""
    if not store or not enabled(spark):
        return build()
    place = folder(spark, inputs)
    final = f"{place}/{name}"
    fs, fp = _fs(spark, final)
    schema_path = _fs(spark, final + "/_schema.json")[1]
    if fs.exists(_fs(spark, final + "/_SUCCESS")[1]) and fs.exists(schema_path):
        schema = T.StructType.fromJson(json.loads(_read_text(fs, schema_path)))
    else:
        plan = build()
        schema = plan.schema
        tmp = f"{place}/_tmp-{name}-{uuid.uuid4().hex}"
        out = plan
        if partition_by and not dealt:
            n = int(spark.conf.get("spark.sql.shuffle.partitions"))
            out = plan.repartitionByRange(n, *partition_by, *(cluster_by or []))
        w = out.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(tmp)
        _write_text(fs, _fs(spark, tmp + "/_schema.json")[1], schema.json())
        fs.mkdirs(fp.getParent())
        if not fs.rename(_fs(spark, tmp)[1], fp) and not fs.exists(fp):
            raise RuntimeError(f"could not publish {final}")
    # explicit schema: partition values are read back with their own types,
    # and the (possibly large) builder plan is not even analysed on reuse
    return spark.read.schema(schema).parquet(final).select(*schema.fieldNames())


def _read_text(fs, path) -> str:
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def _write_text(fs, path, text: str) -> None:
    out = fs.create(path, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
