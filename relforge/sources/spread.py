"""Numbers of tasks that follow from the size of the source, so that a task's share of a large table stays the same as it grows.

Spark sizes tasks by compressed bytes, which say little about rows of repeated text: 64 MB of them may take gigabytes once
they are sorted or hashed. Where a history is shuffled anyway, it is dealt by the key of the next step over that many tasks.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relforge.sources import files

#: Bytes of source files for each task that sorts or hashes their rows.
TASK_BYTES = 4_000_000
#: Tasks whose rows one key may bring together before a join by it deals them further.
HOT_TASKS = 128
#: Tasks from which rows are not sorted any more to meet many others by few keys.
UNSORTED_TASKS = 32


def tasks(df: DataFrame) -> int:
    """Tasks for the rows of a table, from the sizes of the files that it is read from (names and sizes only)."""
    return -(-sum(files.size(df.sparkSession, path) for path in df.inputFiles()) // TASK_BYTES)


def spread(df: DataFrame, *keys: str, source: DataFrame | None = None) -> DataFrame:
    """The rows dealt by ``keys`` over the tasks of their source (of ``df``); as they are where one task is enough."""
    n = tasks(df if source is None else source)
    return df if n < 2 else df.repartition(max(n, df.sparkSession.sparkContext.defaultParallelism), *keys)


def join_by_hot_key(rows: DataFrame, few: DataFrame, key: str, few_key: str, deal_by: str, how: str = "inner", source: DataFrame | None = None,
                    many: bool = False) -> DataFrame:
    """``rows.join(few, rows[key] == few[few_key], how)``, inner or left semi, where one key may hold a large share of all rows.

    Over a large source each key is cut into parts by another column, and ``few`` gets a copy of its rows for each part. The
    copies (``many``: the rows of ``few`` themselves) are then too many to be sent to every task. They are hashed where they meet the
    rows: a sort of the rows would take the more memory the larger the shares are that Spark reads the shuffle back in."""
    n = tasks(rows if source is None else source)
    parts = n // HOT_TASKS
    if parts < 2:
        few = few.hint("shuffle_hash") if many and n >= UNSORTED_TASKS else few
        return rows.join(few, rows[key] == few[few_key], how)
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(deal_by), F.lit(parts)).cast("int"))
    copies = few.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).hint("shuffle_hash")
    joined = dealt.join(copies, (dealt[key] == copies[few_key]) & (dealt["_part"] == copies["_copy"]), how)
    return joined.drop("_part", "_copy")


@contextmanager
def task_share(spark: SparkSession, size: int):
    """AQE merges and splits shuffled rows to tasks of ``size`` bytes, or of less where that is configured; for the jobs inside."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) <= size:
        yield
        return
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)
