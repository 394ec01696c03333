"""A table in versions, of which a load writes the touched parts only.

A version is a manifest: for each part (a month) the folder that holds its rows.  A
load writes new folders for the parts its batch touches and a manifest that names
these and, for all other parts, the folders of the version before.  Folders are
never written again, so a reader of an older version is undisturbed, and untouched
files keep name and time.  A load shows once its manifest is there; one that fails
or is refused before leaves the last version in place.

The manifest also names what the load applied (batches, files of a stream): a batch
that is handed in again is recognised by the same commit that stored its rows.

Checks are metrics observed on the plan that writes the batch, so they cost no scan
of their own; any that counts a row stops the load.  One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.upsert import latest_per_key, upsert_rows

MANIFEST = "kind string, name string, base string, folder string"
#: Values of the part column that can name a folder.
PART_VALUE = r"^[0-9A-Za-z_.-]+$"


class LoadRefused(Exception):
    """A check counted rows; nothing was published."""

    def __init__(self, counts: dict[str, int]) -> None:
        super().__init__("load refused: " + ", ".join(f"{n} x {c}" for c, n in sorted(counts.items())))
        self.counts = counts


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, part: str = "period") -> None:
        self.spark, self.root, self.schema, self.part = spark, root.rstrip("/"), schema, part

    # --- versions ----------------------------------------------------------------------

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST + ", v int").parquet(f"{self.root}/manifest")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def version(self) -> int:
        """The latest version; 0 before the first load."""
        found = self._manifests()
        return 0 if found is None else found.agg(F.max("v")).first()[0] or 0

    def folders(self, version: int | None = None) -> dict[str, tuple[str, str]]:
        """By part: (base, folder).  One row per part, so its size is that of the calendar."""
        version = self.version() if version is None else version
        if not version:
            return {}
        rows = self._manifests().where((F.col("v") == version) & (F.col("kind") == "part"))
        return {r["name"]: (r["base"], r["folder"]) for r in rows.collect()}

    def read(self, version: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version (default: the latest), of some parts only if named."""
        held = self.folders(version)
        by_base: dict[str, list[str]] = {}
        for value, (base, folder) in sorted(held.items()):
            if parts is None or value in parts:
                by_base.setdefault(base, []).append(folder)
        out = None
        for base, folders in by_base.items():
            rows = (self.spark.read.schema(self.schema).option("basePath", base).parquet(*folders)
                    .select(*self.schema.fieldNames()))
            out = rows if out is None else out.unionByName(rows)
        return out if out is not None else self.spark.createDataFrame([], self.schema)

    def applied(self, stream: str) -> DataFrame:
        """(name) of all that loads of a stream have applied."""
        found = self._manifests()
        if found is None:
            return self.spark.createDataFrame([], "name string")
        return found.where((F.col("kind") == "applied") & (F.col("base") == stream)).select("name").distinct()

    def _publish(self, version: int, folders: dict[str, tuple[str, str]], log: tuple[str, list[str]] | None) -> int:
        rows = [("part", value, base, folder) for value, (base, folder) in sorted(folders.items())]
        rows += [("applied", name, log[0], None) for name in (log[1] if log else [])]
        rows.append(("version", str(version), None, None))
        if self.version() != version - 1:
            raise RuntimeError(f"{self.root}: version {version} was published by another load")
        # one file, which shows when the job commits; what a job that died here left is no manifest
        (self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append")
         .parquet(f"{self.root}/manifest/v={version}"))
        return version

    # --- loads -------------------------------------------------------------------------

    def adopt(self, folder: str) -> int:
        """A first version that names the parts of a stored, partitioned folder, without a copy."""
        base = folder.rstrip("/")
        values = [r[0] for r in self.spark.read.schema(self.schema).parquet(base).select(self.part)
                  .distinct().collect()]
        return self._publish(self.version() + 1, {v: (base, f"{base}/{self.part}={v}") for v in values}, None)

    def _write(self, rows: DataFrame, place: str, name: str) -> tuple[str, dict[str, tuple[str, str]]]:
        base = f"{self.root}/{place}"
        folder = f"{base}/load={name}"
        rows.write.partitionBy(self.part).parquet(folder)
        values = [r[0] for r in self.spark.read.schema(self.schema).parquet(folder).select(self.part)
                  .distinct().collect()]
        return folder, {v: (base, f"{folder}/{self.part}={v}") for v in values}

    def upsert(self, batch: DataFrame, keys: list[str], order: str | None = None,
               checks: dict[str, Column] | None = None, log: tuple[str, list[str]] | None = None) -> int:
        """Replace the rows of the keys in ``batch``; other rows stay.  Returns the new version.

        Of rows with one key the last by ``order`` counts.  ``checks`` are conditions
        over the batch's columns that no row may meet.  ``log`` is (stream, names) of
        what the batch holds; with all of them applied before, nothing happens."""
        version = self.version()
        if log and log[1]:
            known = {r["name"] for r in self.applied(log[0]).where(F.col("name").isin(*log[1])).collect()}
            if known.issuperset(log[1]):
                return version
        name = uuid.uuid4().hex
        names = {f"c{i}": c for i, c in enumerate(checks or {})}
        part_ok = F.coalesce(F.col(self.part).rlike(PART_VALUE), F.lit(False))
        seen = Observation(f"load-{name}")
        watched = batch.observe(seen, F.count_if(~part_ok).alias("no_part"), *(
            F.count_if(checks[c]).alias(a) for a, c in names.items()))
        columns = self.schema.fieldNames()
        rows = watched if order is None else latest_per_key(watched.select(*columns, order), keys, order)
        # a row that a check refuses must still pass the observed plan, so parts are kept as they are
        staged, touched = self._write(rows.select(*columns), "staged", name)
        counts = {"rows without a part": seen.get["no_part"]} | {c: seen.get[a] for a, c in names.items()}
        if any(counts.values()):
            raise LoadRefused({c: n for c, n in counts.items() if n})
        if not touched:
            return self._publish(version + 1, self.folders(version), log) if log else version
        new = self.spark.read.schema(self.schema).parquet(staged).select(*columns)
        merged = upsert_rows(self.read(version, list(touched)), new, keys)
        # rows of one part meet in few files, and a large part is dealt over several tasks by its keys
        dealt = merged.repartitionByRange(self.part, *keys)
        _, written = self._write(dealt, "data", name)
        return self._publish(version + 1, self.folders(version) | written, log)
