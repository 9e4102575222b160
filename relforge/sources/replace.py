"""Tables that are replaced safely, and clones that are verified before anybody sees them.

A new table is written to a folder of its own first; the name is pointed at it only when it is complete, in one step of
the catalog. A job that fails, or a driver that is lost, leaves the old table as it was.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from relforge.functions.fingerprint import fingerprint
from relforge.sources import files

#: Tables copied at a time (each is a Spark job).
WORKERS = 8


def default_root(spark: SparkSession, name: str) -> str:
    """The folder of a table's versions, next to the tables of its database."""
    db, _, table = name.rpartition(".")
    return f"{spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{table.lower()}-versions"


def stage(df: DataFrame, root: str) -> str:
    """Write a table to a fresh folder under ``root``; the folder. A failed write leaves none."""
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
    except BaseException:
        files.delete(df.sparkSession, path)
        raise
    return path


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _shape(spark: SparkSession, name: str) -> list[tuple]:
    return [(f.name, f.dataType) for f in spark.table(name).schema.fields]


def publish(spark: SparkSession, name: str, path: str, keep_old: bool = False) -> None:
    """Point a table's name at a complete folder, creating the table where there is none.

    A table of the same columns has its location set, one change of the catalog. One of other columns is renamed
    aside, and back again if the new one cannot take its name. The old rows go last, unless ``keep_old``.
    """
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
        return
    old, mark = _location(spark, name), uuid.uuid4().hex[:8]
    db, dot, table = name.rpartition(".")
    staged, aside = f"{db}{dot}{table}__new_{mark}", f"{db}{dot}{table}__old_{mark}"
    spark.sql(f"CREATE TABLE {staged} USING parquet LOCATION '{path}'")
    try:
        same = _shape(spark, name) == _shape(spark, staged) and spark.catalog.getTable(name).tableType == "EXTERNAL"
        if same:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        else:
            spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
            try:
                spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
            except BaseException:
                spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
                raise
    finally:
        for left in (staged, aside):
            if left == staged or spark.catalog.tableExists(name):
                spark.sql(f"DROP TABLE IF EXISTS {left}")
    spark.catalog.refreshTable(name)
    before, now = files.plain(spark, old), files.plain(spark, path)
    if not keep_old and now != before and not now.startswith(f"{before}/"):  # a table that lay in the root itself holds the new folder
        files.delete(spark, old)


def create_table_as(df: DataFrame, name: str, root: str | None = None, keep_old: bool = False) -> str:
    """Create a table from rows, or replace it, whole or not at all; the folder of its rows.

    ``root``: the folder under which each version gets a folder of its own. The rows may come from the table itself."""
    path = stage(df, root or default_root(df.sparkSession, name))
    publish(df.sparkSession, name, path, keep_old)
    return path


def clone_tables(spark: SparkSession, names, src_db: str, dst_db: str, root: str | None = None) -> DataFrame:
    """A10: copy tables into a sandbox database, together; the manifest: name, rows, fingerprint, path.

    All copies are written at the same time and compared with their sources by fingerprint; only when each is right
    are the names of the sandbox pointed at them. One wrong or failed copy leaves the sandbox as it was.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {dst_db}")

    def copy(name: str) -> tuple[str, int, str, str]:
        source = spark.table(f"{src_db}.{name}")
        path = stage(source, f"{root}/{name}" if root else default_root(spark, f"{dst_db}.{name}"))
        want, got = (fingerprint(df).first() for df in (source, spark.read.schema(source.schema).parquet(path)))
        if want != got:
            files.delete(spark, path)
            raise ValueError(f"{src_db}.{name}: the copy has {got['rows']} rows, the table {want['rows']}, or other values")
        return name, want["rows"], want["fingerprint"], path

    with ThreadPoolExecutor(WORKERS) as pool:
        running = [pool.submit(copy, n) for n in names]
    done = [r.result() for r in running if r.exception() is None]
    if len(done) < len(running):
        for _, _, _, path in done:
            files.delete(spark, path)
        raise next(r.exception() for r in running if r.exception())
    for name, _, _, path in done:
        publish(spark, f"{dst_db}.{name}", path)
    return spark.createDataFrame(done, "name string, rows bigint, fingerprint string, path string")
