"""Readers for the input tables (one Parquet dataset per table)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@dataclass
class Tables:
    """Lazy handle on a directory of ``<name>.parquet`` datasets.

    Reads are lazy: Catalyst prunes to the referenced columns and pushes
    filters into the Parquet scan, so passing the whole table around is free.
    """

    spark: SparkSession
    root: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.read(name)
        raise AttributeError(name)


def month_start(period: str) -> _dt.datetime:
    y, m = int(period[:4]), int(period[5:7])
    return _dt.datetime(y, m, 1)


def next_month_start(period: str) -> _dt.datetime:
    y, m = int(period[:4]), int(period[5:7])
    return _dt.datetime(y + (m == 12), m % 12 + 1, 1)
