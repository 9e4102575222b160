"""Helpers shared by the training-data operators.

``Scratch`` holds the intermediate tables of one operator call. They are Parquet tables in the
folder named by ``spark.checkpoint.dir`` (shared by driver and executors), so lineage is cut and a
lost executor reads them again. Off a cluster, where that setting is absent, a folder under the
warehouse is used.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables; a default only for a local master."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/relforge-llm"


class Scratch:
    """Intermediate tables of one operator call."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and read it back; shuffle files behind it can then be released."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        schema = df.schema
        del df
        release(self.spark)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files and broadcasts that nothing refers to any more."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


def col(name: str) -> Column:
    """A column by its exact name (dots and blanks in a name are not a path)."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet (names are compared without case)."""
    used = {c.lower() for c in df.columns}
    while base.lower() in used:
        base += "_"
    return base


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches of a task in small pieces, so that the Python copies of their texts stay small.

    At the end what has been freed goes back to the system: a worker waits for its next task beside others.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:  # glibc
        trim(0)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
