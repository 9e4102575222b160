"""Text files, manifests, report files, partitioned exports, checks.

Every write is one distributed Spark job; driver-side loops are over manifests and
table names (metadata), never over data. ``release_export`` has the one-pass release
export, ``replace`` safe replacement and clones, ``sliced`` tables in slices.  Output folders must be on
shared storage (on a cluster: under the configured ``spark.checkpoint.dir`` or
another shared root), never a machine-local temporary folder.
"""

from __future__ import annotations

import os
import uuid
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relforge.session import checkpoint_dir
from relforge.sources import release_export as RX
from relforge.sources.release_export import export_tree  # noqa: F401
from relforge.sources.replace import clone_tables, create_table_as  # noqa: F401
from relforge.sources.spread import task_share

MANIFEST_COLUMNS = ["SQL_Name", "Export_Name", "Path", "Content"] + [f"Column {i}" for i in range(1, 14)]
LEGACY_ENCODING = "ISO-8859-1"
#: Null in a text file (an empty field is the empty string).
NULL_MARK = "\\N"
#: Shuffled bytes for each task that copies its rows before it writes them.
COPIED_SHARE = 4_000_000


def scratch_root(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root (set only where unset, as in tests)."""
    return os.path.join(checkpoint_dir(spark), "relforge-out", f"{name}-{uuid.uuid4().hex[:12]}")


def string_schema(cols) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A4: read the export manifest; return (populated, empty) rows."""
    m = spark.read.option("header", True).schema(string_schema(MANIFEST_COLUMNS)).csv(path)
    return m.filter(F.col("Content") == "Populated"), m.filter(F.col("Content") == "Empty")


def read_name_map(spark: SparkSession, path: str, cols) -> DataFrame:
    """A5: a two/three-column label table (CSV with header)."""
    return spark.read.option("header", True).schema(string_schema(cols)).csv(path)


def text_options(**more) -> dict:
    """Options under which a text file gives back exactly what was written.

    Blanks at either end stay, a quote is doubled (the usual CSV form), values may hold
    line ends, and null is the marker ``NULL_MARK``, so that an empty string (``""``) stays empty.
    """
    return {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "quote": '"',
            "escape": '"', "nullValue": NULL_MARK, "multiLine": "true", "lineSep": "\n", **more}


def _writable(df: DataFrame, mode: str, **more):
    """A text writer; values equal to the null marker are refused while writing."""
    safe = {f.name: F.when(F.col(f"`{f.name}`") == NULL_MARK, F.raise_error(F.lit(f"{f.name}: a value equals the null marker")))
            .otherwise(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(safe).write.mode(mode).options(**text_options(emptyValue='""', **more))


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Tab-separated text (release files fail if present). The first part file holds the column names, the others rows,
    as in a release export: ``cat part-*`` is the text file, and ``read_tsv`` reads it."""
    names = df.sparkSession.createDataFrame([(_names(df.columns),)], "line string")
    columns = [F.col(f"`{c}`") for c in df.columns]
    names.coalesce(1).unionByName(df.select(_render(columns, df.columns).alias("line"))).write.mode(mode).option("lineSep", "\n").text(path)


def read_tsv(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """The rows of one or more tab-separated texts of ``write_tsv`` or of a release export, without the lines of names."""
    rows = spark.read.options(**text_options(sep="\t", header="false")).schema(schema).csv(path)
    return rows.filter(~F.startswith(F.col("_metadata.file_name"), F.lit(RX.HEADER_FILE)))


def not_encodable(df: DataFrame, encoding: str = LEGACY_ENCODING) -> DataFrame:
    """(column, value) of every string that the encoding cannot hold."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in text))
    return df.select(F.inline(pairs)).filter(F.col("value").isNotNull() & ~_fits(F.col("value"), encoding))


def _fits(c, encoding: str):
    # a character beyond the encoding is neither kept nor told apart by the text writer
    pattern = {"ISO-8859-1": r"^[\x00-\xFF]*$", "US-ASCII": r"^[\x00-\x7F]*$"}[encoding.upper()]
    return F.replace(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(" ")).rlike(pattern)


def write_csv_legacy(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = LEGACY_ENCODING) -> None:
    """CSV in a single-byte encoding. A value that it cannot hold fails the write
    (``not_encodable`` lists them; C10 makes known words safe)."""
    checked = {f.name: F.when(_fits(F.col(f"`{f.name}`"), encoding), F.col(f"`{f.name}`"))
               .when(F.col(f"`{f.name}`").isNotNull(), F.raise_error(F.concat(F.lit(f"{f.name}: not in {encoding}: "), F.col(f"`{f.name}`"))))
               for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    _writable(df.withColumns(checked), mode, encoding=encoding).csv(path)


def read_csv_legacy(spark: SparkSession, path: str, schema: T.StructType, encoding: str = LEGACY_ENCODING) -> DataFrame:
    return spark.read.options(**text_options(encoding=encoding)).schema(schema).csv(path)


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One result table per report."""
    df.write.mode("overwrite").format(fmt).option("header", True).save(path)


def _render(columns, names):
    options = {k: v for k, v in text_options(sep="\t", emptyValue='""').items() if k not in ("header", "multiLine", "lineSep")}
    return RX.text_line(columns, names, options, NULL_MARK)


def _names(names) -> str:
    quoted = [f'"{n.replace(chr(34), chr(34) * 2)}"' if any(c in n for c in '\t\n"') else n for n in names]
    return "\t".join(quoted)


def export_release(spark: SparkSession, manifest: DataFrame, tables: dict, out_root: str, suffix: str = "", compression: str = "none") -> DataFrame:
    """A11 for prepared tables: the DISTINCT rows of each Populated manifest row's table, and a file of column names for each
    Empty row, in one job. Returns the export log: dataset, path, content, rows, fingerprint (see ``release_export``)."""
    wanted = {n: tables[n] for r in manifest.filter("Content = 'Populated'").select("SQL_Name").collect() for n in [r["SQL_Name"]]}
    parts = [(RX.tagged(df, n, _render), [n]) for n, df in wanted.items()]
    return RX.write_file_sets(spark, manifest, parts, {n: df.columns for n, df in wanted.items()}, _names, out_root, suffix, compression)


def export_history(spark: SparkSession, manifest: DataFrame, sources, release_date: str, out_root: str, suffix: str = "",
                   compression: str = "none") -> DataFrame:
    """A11 from the histories: full, snapshot and delta of every slice of every source, each history read once."""
    return RX.export_sources(spark, manifest, sources, release_date, out_root, _render, _names, suffix, compression)


def read_back(spark: SparkSession, export_log: DataFrame) -> DataFrame:
    """Rows and fingerprint of each file set of a log, from its files, in one read."""
    return RX.read_back(spark, export_log, text_options(sep="\t"))


def export_check(expected: DataFrame, written: DataFrame) -> DataFrame:
    """Expected vs read-back rows (and fingerprints, where both sides have them) per dataset, full outer join ->
    ``ok`` / ``missing`` / ``extra`` / ``wrong count`` / ``wrong rows``."""
    j = expected.join(written, "dataset", "full_outer")
    status = (F.when(F.col("written_rows").isNull(), "missing")
               .when(F.col("expected_rows").isNull(), "extra")
               .when(F.col("written_rows") != F.col("expected_rows"), "wrong count"))
    if "expected_fingerprint" in expected.columns and "written_fingerprint" in written.columns:
        status = status.when(F.col("written_fingerprint") != F.col("expected_fingerprint"), "wrong rows")
    return j.select("dataset", "expected_rows", "written_rows", status.otherwise("ok").alias("status"))


def export_partitioned(df: DataFrame, keys, path: str, fmt: str = "csv", mode: str = "overwrite", compression: str | None = None,
                       dealt: bool = False) -> None:
    """One folder per key combination, one job (replaces a query per ruleset).

    ``rebalance`` clusters rows by the keys and lets AQE split a hot key over
    several tasks (and merge tiny ones), so one huge ruleset is not one task. ``dealt`` rows are so already, and copied since:
    AQE's tasks are smaller for the job, as they hold (and sort by folder) several copies of what they read.
    ``compression``: of Spark's writer (its own where none is given); readers see it by the files' names.
    """
    parts = df if dealt else df.hint("rebalance", *keys)
    writer = _writable(parts, mode) if fmt == "csv" else parts.write.mode(mode)
    writer = writer if compression is None else writer.option("compression", compression)
    with task_share(df.sparkSession, COPIED_SHARE) if dealt else nullcontext():
        writer.partitionBy(*keys).format(fmt).save(path)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a partitioned CSV export."""
    return spark.read.options(**text_options()).schema(schema).csv(path)


def replace_module_partition(spark: SparkSession, table: str, new_rows: DataFrame, module: str,
                             module_col: str = "moduleId") -> None:
    """B9 on a ``moduleId``-partitioned catalog table: replace exactly one module.

    A static partition spec overwrites that partition only, and empties it when the
    new slice has no rows -- the case dynamic overwrite cannot express.  Other
    modules are not rewritten.
    """
    cols = [c for c in spark.table(table).columns if c != module_col]
    body = new_rows.filter(F.col(module_col) == module).select(*cols)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({module_col} = :m) SELECT * FROM {{body}}",
              args={"m": module}, body=body)


def overwrite_module(new_rows: DataFrame, path: str, module_col: str = "moduleId") -> None:
    """B9 on disk: replace the module partitions present in ``new_rows`` of a
    ``moduleId``-partitioned table (dynamic partition overwrite; other modules
    are untouched).  A module absent from ``new_rows`` keeps its old partition;
    use ``replace_module_partition`` on a catalog table for that case."""
    (new_rows.hint("rebalance", module_col).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(module_col).parquet(path))
