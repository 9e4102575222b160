"""A1/A2/A3: table registry and scans.

A logical name maps to a parquet path (or a catalog table); Catalyst prunes
columns and pushes filters into the scan, so callers never pre-select.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(base_dir: str, name: str) -> str:
    return os.path.join(base_dir, f"{name}.parquet")


def read_table(spark: SparkSession, base_dir: str | None, name: str, jdbc: dict | None = None) -> DataFrame:
    """A1: read a logical table.  ``base_dir=None`` reads a catalog table; ``jdbc``
    (url, user, ... options) reads it through Spark's JDBC source instead, which is
    how a relational source of the release tables is attached."""
    if jdbc is not None:
        return spark.read.format("jdbc").options(dbtable=name, **jdbc).load()
    if base_dir is None:
        return spark.table(name)
    return spark.read.parquet(table_path(base_dir, name))


def select_all(df: DataFrame) -> DataFrame:
    """A2: full scan (identity; projection happens where it is used)."""
    return df


def select_distinct(df: DataFrame) -> DataFrame:
    """A3: scan + whole-row de-duplication (one shuffle on all columns)."""
    return df.distinct()
