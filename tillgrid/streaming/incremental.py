"""Incremental loads with Structured Streaming.

The source system handles late corrections by re-importing a month and upserting
it (rows not in the new file survive).  The streaming form: month extracts land as
files in a folder, a file-source stream picks up each new file, and ``foreachBatch``
upserts it into a versioned table, which writes the touched months only.

A file is applied once.  The table's manifest names the files of each load and is
published together with its rows, so a batch that is replayed, or handed in again
after the stream's checkpoint was reset and batch numbers start anew, is recognised
by its files: those applied are passed over, the others are loaded.  (A replay of an
old file would else undo a later correction.)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..sources.versioned import VersionedTable

FACT_KEYS = ["store_id", "period", "partkey"]


def apply_batch(table: VersionedTable, stream: str, keys: list[str] = FACT_KEYS) -> Callable[[DataFrame, int], None]:
    """foreachBatch handler: the batch's new files (column ``_file``) go into the table,
    of lines with one key the last by ``load_seq``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.join(table.applied(stream).withColumnRenamed("name", "_file"), "_file", "left_anti")
        files = sorted(r["_file"] for r in fresh.select("_file").distinct().collect())  # maxFilesPerTrigger at most
        if files:
            table.upsert(fresh, keys, order="load_seq", log=(stream, files))
    return run


def start_fact_stream(spark: SparkSession, landing: str, table_root: str, checkpoint: str,
                      schema: StructType, once: bool = False, stream: str = "fact stream") -> StreamingQuery:
    """Stream month extracts (Parquet files with ``schema`` plus ``load_seq``) from
    ``landing`` into the versioned fact table at ``table_root``."""
    files = StructType([*schema.fields, StructField("load_seq", LongType())])
    name = F.concat_ws("#", "_metadata.file_path", F.unix_millis("_metadata.file_modification_time").cast("string"))
    rows = (spark.readStream.schema(files).option("maxFilesPerTrigger", 1).parquet(landing)
            .select("*", name.alias("_file")).withColumn("load_seq", F.coalesce("load_seq", F.lit(0))))
    table = VersionedTable(spark, table_root, schema)
    writer = rows.writeStream.foreachBatch(apply_batch(table, stream)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
