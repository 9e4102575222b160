"""B10, B11 over the catalog: tables whose names end in a release date (``..._yyyyMMdd``).

Only metadata is handled: a row for each table, of which there are a few for each release.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relforge.functions.text import name_suffix_date
from relforge.operators.history import previous_release, retain_releases


def dated_tables(spark: SparkSession, databases) -> DataFrame:
    """database, table, base (its name before the date), release_date, of the dated tables of one or more databases."""
    databases = [databases] if isinstance(databases, str) else list(databases)
    shown = reduce(DataFrame.unionByName, (spark.sql(f"SHOW TABLES IN {d}").filter("NOT isTemporary") for d in databases))
    named = shown.select(F.col("namespace").alias("database"), F.col("tableName").alias("table"),
                         name_suffix_date("tableName").alias("release_date"))
    base = F.regexp_replace("table", "_?[0-9]{8}$", "")
    return named.filter("release_date IS NOT NULL").select("database", "table", base.alias("base"), "release_date")


def retain_tables(spark: SparkSession, database: str, keep_n: int = 1, dry_run: bool = True) -> DataFrame:
    """Keep the tables of the latest ``keep_n`` release dates of a database and drop the older ones.

    Returns the log: table, release_date, release_rank, action (keep, drop), status (``kept``, ``would drop``, ``dropped``, or
    ``failed: ...``; a table that cannot be dropped does not stop the others). Tables without a date are not touched.
    """
    tables = dated_tables(spark, database)
    ranked = retain_releases(tables.select("release_date").distinct(), keep_n)
    plan = tables.join(ranked, "release_date").orderBy("release_date", "table").collect()  # one row for each table

    def status(r) -> str:
        if r["action"] == "keep":
            return "kept"
        if dry_run:
            return "would drop"
        try:
            spark.sql(f"DROP TABLE {database}.`{r['table']}`")
            return "dropped"
        except Exception as e:  # noqa: BLE001  whatever the catalog says goes into the log
            return f"failed: {str(e).splitlines()[0]}"

    return spark.createDataFrame([(r["table"], r["release_date"], r["release_rank"], r["action"], status(r)) for r in plan],
                                 "table string, release_date string, release_rank bigint, action string, status string")


def previous_release_with(spark: SparkSession, databases, needed, current: str, max_months_back: int | None = None) -> DataFrame:
    """The latest release before ``current`` for which every ``needed`` table (base name) is there.

    Releases that lack one are passed over. One row: previous_release, status (see ``previous_release``).
    """
    needed = {needed} if isinstance(needed, str) else set(needed)
    have = dated_tables(spark, databases).filter(F.col("base").isin(sorted(needed)))
    whole = have.groupBy("release_date").agg(F.count_distinct("base").alias("n")).filter(F.col("n") == len(needed))
    return previous_release(whole.select("release_date"), current, max_months_back)
