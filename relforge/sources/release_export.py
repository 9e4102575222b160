"""A release exported from one scan of its history, in one write, and checked by fingerprint.

A ``Source`` is a history; its ``Slice``s are the tables of the release that are taken from it, each a choice of rows and
columns. One window over the component id finds the latest time of every slice at once; a row then says for each slice
whether it belongs to the full, snapshot and delta form, and is written out as one text line. The tasks that make the lines of all sources write
them, in one job, a folder for each file set, and count and sum them on their way (nothing is kept or shuffled in between).
A file set's first file holds the line of column names, the others its rows: ``cat part-*`` gives the release file.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from relforge.functions.fingerprint import row_hashes, total
from relforge.operators.history import SENTINEL, stamp_release
from relforge.sources import files

#: Columns of a manifest row (``Column 1`` ...), and so of a file at most.
WIDTH = 13
FORMS = ("full", "snapshot", "delta")
HEADER_FILE = "part-00000-"


@dataclass
class Slice:
    """A table of the release: rows of a source for which ``where`` holds, with columns by name."""

    name: str
    columns: dict[str, Column | str]
    where: Column | None = None


@dataclass
class Source:
    """A history and what is taken from it. Rows of one id and time are one version of a component."""

    rows: DataFrame
    slices: list[Slice]
    id_col: str = "id"
    time_col: str = "effectiveTime"
    dates: list[str] = field(default_factory=list)  # other columns that hold the release date


def text_line(columns: list[Column], names: list[str], options: dict, null_mark: str) -> Column:
    """A row as one line of text; a value equal to the null marker fails the job."""
    safe = [F.when(c.cast("string") == null_mark, F.raise_error(F.lit(f"{n}: a value equals the null marker"))).otherwise(c).alias(n)
            for n, c in zip(names, columns, strict=True)]
    return F.to_csv(F.struct(*safe), options)


def padded_hashes(columns: list[Column]) -> list[Column]:
    """Row hashes over the widest file's columns, so that rows read back without their table's schema compare."""
    return row_hashes([c.cast("string") for c in columns] + [F.lit(None).cast("string")] * (WIDTH - len(columns)))


def tagged(df: DataFrame, dataset: str, render: Callable) -> DataFrame:
    """The distinct rows of one prepared table as (dataset, line, h1, h2)."""
    columns = [F.col(f"`{c}`").cast("string") for c in df.columns]
    return df.distinct().select(F.lit(dataset).alias("dataset"), render(columns, df.columns).alias("line"),
                                *(h.alias(n) for h, n in zip(padded_hashes(columns), ("h1", "h2"))))


def release_lines(source: Source, release_date: str, render: Callable, sentinel: str = SENTINEL) -> DataFrame:
    """All forms of all slices of a source as (dataset, line, h1, h2), from one pass.

    The source is partitioned by id at most once (not at all where it is stored so): the windows and the removal of equal rows
    share that partitioning. A slice's id must follow from its line, as an id column does.
    """
    df = stamp_release(source.rows, [source.time_col, *source.dates], release_date, sentinel)
    time, w = F.col(source.time_col), Window.partitionBy(source.id_col)
    held = [F.lit(True) if s.where is None else F.coalesce(s.where, F.lit(False)) for s in source.slices]
    df = df.withColumns({f"_last{i}": F.max(F.when(h, time)).over(w) for i, h in enumerate(held)})
    each = []
    for i, (s, h) in enumerate(zip(source.slices, held)):
        columns = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in s.columns.values()]
        h1, h2 = padded_hashes(columns)
        each.append(F.when(h, F.struct(F.lit(s.name).alias("slice"), render(columns, list(s.columns)).alias("line"), h1.alias("h1"), h2.alias("h2"),
                                       F.coalesce(time == F.col(f"_last{i}"), F.lit(False)).alias("snapshot"),
                                       F.coalesce(time == release_date, F.lit(False)).alias("delta"))))
    rows = df.select(F.col(source.id_col).alias("_id"), F.inline(F.filter(F.array(*each), lambda x: x.isNotNull())))
    once = rows.groupBy("_id", "slice", "line", "h1", "h2").agg(F.bool_or("snapshot").alias("snapshot"), F.bool_or("delta").alias("delta"))
    forms = F.array(F.lit("full"), F.when(F.col("snapshot"), "snapshot"), F.when(F.col("delta"), "delta"))
    return (once.select(F.explode(F.filter(forms, lambda x: x.isNotNull())).alias("form"), "slice", "line", "h1", "h2")
                .select(F.concat_ws("_", "slice", "form").alias("dataset"), "line", "h1", "h2"))


def write_file_sets(spark: SparkSession, manifest: DataFrame, parts: list[tuple[DataFrame, list[str]]], headers: dict[str, list[str]],
                    render_names: Callable, out_root: str, suffix: str, compression: str = "none") -> DataFrame:
    """Write every file set of a manifest in one job; the log: dataset, path, content, rows, fingerprint.

    ``parts``: lines as (dataset, line, h1, h2), and the data sets that are among them. ``headers``: column names of each populated file set; an
    empty set takes them from its manifest row. File sets that are there already are an error,
    before anything is written; what is written appears under its names only when all of it is complete. ``compression``: of Spark's text
    writer; readers see it by the files' names, and with ``gzip`` ``cat part-*`` gives the gzip of the release file.
    """
    sets = manifest.collect()  # metadata: a row for each file set
    found = {}
    for r in sets:
        names = headers[r["SQL_Name"]] if r["Content"] == "Populated" else [r[f"Column {i}"] for i in range(1, WIDTH + 1) if r[f"Column {i}"]]
        found[r["SQL_Name"]] = (os.path.join(out_root, r["Path"], f"{r['Export_Name']}{suffix}"), r["Content"], names)
    taken = [path for path, _, _ in found.values() if files.exists(spark, path)]
    if taken:
        raise FileExistsError(f"file sets are there already: {taken[:3]}")
    # the lines of names are one task of their own, the first, whatever the others are, and so are in files of their own
    known = spark.sparkContext.parallelize([(n, render_names(names)) for n, (_, _, names) in found.items()], 1)
    watched = [_watched(lines, names) for lines, names in parts]
    lines = reduce(DataFrame.unionByName, (df.select("dataset", "line") for df, _ in watched), spark.createDataFrame(known, "dataset string, line string"))
    staged = os.path.join(out_root, f"_staged-{uuid.uuid4().hex[:12]}")
    try:
        lines.write.partitionBy("dataset").options(lineSep="\n", compression=compression).text(staged)
        counted = {name: sums for _, seen in watched for name, sums in seen()}
        for name, (path, _, _) in found.items():
            files.move(spark, f"{staged}/dataset={name}", path)
    finally:
        files.delete(spark, staged)
    log = [(n, path, content, *counted.get(n, (0, "0:0"))) for n, (path, content, _) in found.items()]
    return spark.createDataFrame(log, "dataset string, path string, content string, rows bigint, fingerprint string")


def _watched(lines: DataFrame, names: list[str]) -> tuple[DataFrame, Callable]:
    """The lines, and what gives (data set, (rows, fingerprint)) of each of ``names`` once a job has written them.

    The tasks that write count and sum the lines (each task once, whether or not it is tried again), so nothing is between the two."""
    seen, sums = Observation(), []
    for i, name in enumerate(names):
        here = F.col("dataset") == name
        sums += [F.count(F.when(here, 1)).alias(f"rows{i}"), *(total(F.when(here, F.col(h))).alias(f"{h}_{i}") for h in ("h1", "h2"))]

    def counted() -> list[tuple]:
        got = seen.get
        return [(n, (got.get(f"rows{i}") or 0, ":".join(str(int(got.get(f"{h}_{i}") or 0)) for h in ("h1", "h2")))) for i, n in enumerate(names)]
    return lines.observe(seen, *sums), counted


def _joined() -> Column:
    return F.concat_ws(":", *(F.coalesce(total(h), F.lit(0)).cast("decimal(38,0)").cast("string") for h in ("h1", "h2")))


def read_all_rows(spark: SparkSession, export_log: DataFrame, options: dict) -> DataFrame:
    """(_file, c1...c13) of the rows of all file sets of a log, in one read."""
    logged = export_log.select("path").collect()  # one row for each file set
    schema = ", ".join(f"c{i} string" for i in range(1, WIDTH + 1))
    rows = spark.read.options(**{**options, "header": "false"}).schema(schema).csv([r["path"] for r in logged])
    return rows.select("*", F.col("_metadata.file_path").alias("_file")).filter(~F.startswith(F.col("_metadata.file_name"), F.lit(HEADER_FILE)))


def _datasets(spark: SparkSession, export_log: DataFrame, by_file: DataFrame) -> DataFrame:
    """The data set of each file, by its folder."""
    logged = export_log.select("dataset", "path").collect()  # one row for each file set
    names = spark.createDataFrame([(r["dataset"], files.plain(spark, r["path"])) for r in logged], "dataset string, _folder string")
    plain = F.regexp_replace(F.regexp_replace("_file", "/[^/]*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return by_file.withColumn("_folder", F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))).join(names, "_folder").drop("_folder")


def read_back(spark: SparkSession, export_log: DataFrame, options: dict) -> DataFrame:
    """dataset, written_rows, written_fingerprint of every file set of a log, from its files; 0 rows where only names are.

    Rows are counted and summed file by file, where they are read, and only these sums are shuffled and get their data set's name."""
    h1, h2 = row_hashes([f"c{i}" for i in range(1, WIDTH + 1)])
    sums = (read_all_rows(spark, export_log, options).select("_file", h1.alias("h1"), h2.alias("h2")).groupBy("_file")
            .agg(F.count(F.lit(1)).alias("rows"), total("h1").alias("h1"), total("h2").alias("h2")))
    found = (_datasets(spark, export_log, sums).groupBy("dataset")
             .agg(F.sum("rows").alias("written_rows"), _joined().alias("written_fingerprint")))
    return (export_log.select("dataset").join(found, "dataset", "left")
                      .select("dataset", F.coalesce("written_rows", F.lit(0)).alias("written_rows"),
                              F.coalesce("written_fingerprint", F.lit("0:0")).alias("written_fingerprint")))


def export_tree(spark: SparkSession, export_log: DataFrame, out_root: str, folder_count: int | None = None) -> DataFrame:
    """Numbers of folders and file sets under a release folder against the manifest's, and the outcome (Pass, Error).

    A folder is one that holds file sets or other folders; ``folder_count`` takes the place of the number that the manifest
    implies. Only names are listed, level by level; file contents are not read.
    """
    def inside(path: str) -> tuple[int, int]:
        kept = [n for n in files.names(spark, path) if not n.startswith(("_", "."))]
        if any(n.startswith("part-") for n in kept):
            return 0, 1
        below = [inside(f"{path}/{n}") for n in kept]
        return 1 + sum(b[0] for b in below), sum(b[1] for b in below)

    folders, sets = inside(out_root.rstrip("/"))
    logged = [os.path.relpath(r["path"], out_root).split("/")[:-1] for r in export_log.select("path").collect()]
    implied = {tuple(parts[: k + 1]) for parts in logged for k in range(len(parts))}
    want = len(implied) if folder_count is None else folder_count
    outcome = "Pass" if (folders - 1, sets) == (want, len(logged)) else "Error"
    return spark.createDataFrame([(folders - 1, want, sets, len(logged), outcome)],
                                 "folders bigint, expected_folders bigint, file_sets bigint, expected_file_sets bigint, outcome string")


def export_sources(spark: SparkSession, manifest: DataFrame, sources: list[Source], release_date: str, out_root: str, render: Callable,
                   render_names: Callable, suffix: str, compression: str = "none") -> DataFrame:
    """Export all forms of all slices of some histories; each history is read once."""
    parts = [(release_lines(s, release_date, render), [f"{t.name}_{form}" for t in s.slices for form in FORMS]) for s in sources]
    headers = {f"{s.name}_{form}": list(s.columns) for source in sources for s in source.slices for form in FORMS}
    return write_file_sets(spark, manifest, parts, headers, render_names, out_root, suffix, compression)
