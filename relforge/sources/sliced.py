"""Tables kept in slices, of which any number are replaced in one step (B9), and stored snapshots on top of them.

A slice is the rows of one value of a column: a module, or a bucket of ids. The rows of one replacement are in one folder,
``data/version=.../<column>=<value>``; a list says for each value which version holds its rows. A replacement writes its
slices first and then a new list, a file of a few bytes for each value; readers take the newest list, and so see all
of a replacement or nothing of it. A value without rows in its version has no rows. Spark prunes by version and value.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relforge.operators.history import _cols
from relforge.sources import files
from relforge.sources.spread import tasks

VERSION = "_version"


class SlicedTable:
    """A table under ``root``, in slices by ``column``."""

    def __init__(self, spark: SparkSession, root: str, column: str):
        self.spark, self.root, self.column = spark, root.rstrip("/"), column

    # --- lists

    def _newest(self) -> tuple[int, dict]:
        found = [n for n in files.names(self.spark, f"{self.root}/lists") if n.isdigit()]
        if not found:
            return 0, {"schema": None, "slices": []}
        return int(found[-1]), json.loads(files.read_text(self.spark, f"{self.root}/lists/{found[-1]}"))

    def slices(self) -> dict:
        """The version of each value."""
        return {value: version for value, version in self._newest()[1]["slices"]}

    # --- reading

    def read(self, values=None) -> DataFrame:
        """The rows, or those of the given values alone (other folders are not read)."""
        _, found = self._newest()
        if found["schema"] is None:
            raise ValueError(f"{self.root} holds no table yet")
        schema = T.StructType.fromJson(found["schema"])
        held: dict[str, list] = {}
        wanted = None if values is None else set(values)
        for value, version in found["slices"]:
            if wanted is None or value in wanted:
                held.setdefault(version, []).append(value)
        if not held:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/data/{VERSION}={v}" for v in held]
        stored = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
        rows = self.spark.read.schema(stored).option("basePath", f"{self.root}/data").parquet(*paths)
        return rows.filter(reduce(or_, ((F.col(VERSION) == v) & self._is_in(each) for v, each in held.items()))).select(*schema.names)

    def _is_in(self, values) -> Column:
        known = F.col(self.column).isin([v for v in values if v is not None])
        return known | F.col(self.column).isNull() if None in values else known

    # --- writing

    def replace(self, rows: DataFrame, values) -> None:
        """Put ``rows`` in the place of all rows of ``values``, in one step; values without rows are emptied.

        Other values are neither read nor written. A row of another value fails the replacement, and so does one of a table
        that somebody else has replaced in the meantime; the table then stays as it was.
        """
        at, found = self._newest()
        values = list(dict.fromkeys(values))
        columns = [f for f in rows.schema.fields if f.name != self.column] + [rows.schema[self.column]]
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in columns])  # all nullable, as files are
        if found["schema"] is not None and T.StructType.fromJson(found["schema"]) != schema:
            raise ValueError("the rows have other columns than the table")
        version = uuid.uuid4().hex
        path = f"{self.root}/data/{VERSION}={version}"
        wrong = F.raise_error(F.concat(F.lit(f"{self.column}: no slice to replace: "), F.coalesce(F.col(self.column).cast("string"), F.lit("null"))))
        checked = rows.withColumn(self.column, F.when(F.coalesce(self._is_in(values), F.lit(False)), F.col(self.column)).otherwise(wrong))
        try:
            checked.select(*schema.names).write.partitionBy(self.column).parquet(path)
            kept = [[value, v] for value, v in found["slices"] if value not in set(values)]
            files.write_text(self.spark, f"{self.root}/lists/{at + 1:012d}",
                             json.dumps({"schema": schema.jsonValue(), "slices": kept + [[value, version] for value in values]}))
        except BaseException:
            files.delete(self.spark, path)
            raise

    def drop_old(self, keep: int = 1) -> list[str]:
        """Delete all lists but the newest ``keep``, and the versions that none of these names; the deleted versions."""
        lists = [n for n in files.names(self.spark, f"{self.root}/lists") if n.isdigit()]
        used = {v for n in lists[-keep:] for _, v in json.loads(files.read_text(self.spark, f"{self.root}/lists/{n}"))["slices"]}
        for n in lists[:-keep]:
            files.delete(self.spark, f"{self.root}/lists/{n}")
        gone = [n for n in files.names(self.spark, f"{self.root}/data") if n.startswith(f"{VERSION}=") and n.partition("=")[2] not in used]
        for n in gone:
            files.delete(self.spark, f"{self.root}/data/{n}")
        return [n.partition("=")[2] for n in gone]


def replace_modules(table: SlicedTable, new_rows: DataFrame, modules) -> None:
    """B9 for several modules at once: each listed one gets its rows of ``new_rows``, or none; others stay."""
    table.replace(new_rows, modules)


class StoredSnapshot:
    """B5 as stored state: the snapshot of a release, brought forward by the rows of the next one.

    Rows are in buckets by id. ``advance`` reads its delta and those buckets that hold an id of it, and writes these buckets
    anew; the snapshot of (old snapshot and delta) is the snapshot of the whole history, since a row that is not the latest
    of its id never becomes it again.
    """

    BUCKET = "_bucket"

    def __init__(self, spark: SparkSession, root: str, buckets: int, id_cols="id", time_col: str = "effectiveTime"):
        self.table, self.buckets = SlicedTable(spark, root, self.BUCKET), buckets
        self.ids, self.time = _cols(id_cols), time_col

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(self.BUCKET, F.pmod(F.xxhash64(*self.ids), F.lit(self.buckets)).cast("int"))

    def _latest(self, rows: DataFrame) -> DataFrame:
        # one exchange, on the bucket: it serves the window, the DISTINCT and one file for each bucket; a bucket that is too
        # much for a task is dealt over several by the id, with a file for each
        parts = -(-tasks(rows) // self.buckets)
        if parts < 2:
            dealt, by = rows.repartition(self.BUCKET), [self.BUCKET]
        else:
            part = F.pmod(F.xxhash64(F.lit(parts), *self.ids), F.lit(parts)).cast("int")
            dealt, by = rows.withColumn("_task", F.col(self.BUCKET) * parts + part).repartitionById(self.buckets * parts, "_task"), ["_task", self.BUCKET]
        w = Window.partitionBy(*by, *self.ids).orderBy(F.col(self.time).desc())
        return dealt.withColumn("_rk", F.rank().over(w)).filter("_rk = 1").drop("_rk").distinct().drop("_task")

    def create(self, history: DataFrame, as_of: str) -> None:
        """The snapshot at a date, from the history."""
        self.table.replace(self._latest(self._bucketed(history.filter(F.col(self.time) <= as_of))), range(self.buckets))

    def advance(self, delta: DataFrame) -> list[int]:
        """Take in rows that came after the stored release (late ones too); the buckets that were touched."""
        new = self._bucketed(delta)
        touched = sorted(r[0] for r in new.select(self.BUCKET).distinct().collect())  # at most one for each bucket
        if touched:
            self.table.replace(self._latest(self.table.read(touched).unionByName(new)), touched)
        return touched

    def read(self) -> DataFrame:
        return self.table.read().drop(self.BUCKET)
