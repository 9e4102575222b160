"""B5, B9-B11, A9-A12, D3 over stored tables: what is read, what is written, and what is left when something fails."""

import gzip
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from relforge.functions.fingerprint import fingerprint
from relforge.operators import diff as D
from relforge.operators import history as H
from relforge.sources import dated, files
from relforge.sources import io as IO
from relforge.sources import release_export as RX
from relforge.sources import replace as RP
from relforge.sources.sliced import SlicedTable, StoredSnapshot, replace_modules

HISTORY = "id string, effectiveTime string, active string, moduleId string"


def same(a, b):
    a = a.select(*b.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def failing(df, column):
    """The same rows, but the job that writes them fails at the last one."""
    last = df.agg(F.max(column)).first()[0]
    return df.withColumn(column, F.when(F.col(column) == last, F.raise_error(F.lit("lost in the middle"))).otherwise(F.col(column)))


@pytest.fixture
def name():
    return "t_" + uuid.uuid4().hex[:12]


# ---------------------------------------------------------------- fingerprints

def test_fingerprint_counts_copies_and_tells_nulls_apart(spark):
    schema = "a string, b string"

    def of(*rows, portable=False):
        return tuple(fingerprint(spark.createDataFrame(list(rows), schema).repartition(3), portable=portable).first())
    for portable in (False, True):
        assert of(("x", "y"), ("z", None), portable=portable) == of(("z", None), ("x", "y"), portable=portable)
        kinds = [(("x", None),), ((None, "x"),), (("x", ""),), (("", "x"),), (("x", "y"), ("x", "y")), (("x", "y"),), (("xy", ""),), ((None, None),)]
        assert len({of(*k, portable=portable) for k in kinds}) == len(kinds)
    assert of() == (0, "0:0")


def test_fingerprint_by_group_survives_large_sums(spark):
    df = spark.range(200_000).select((F.col("id") % 2).alias("g"), F.lit("same").alias("v"))
    one = fingerprint(df.filter("id = 0 AND g = 0"), "g").first()["fingerprint"]
    many = {r["g"]: r for r in fingerprint(df, "g").collect()}
    assert many[0]["fingerprint"] == many[1]["fingerprint"] == ":".join(str(int(x) * 100_000) for x in one.split(":"))


# ---------------------------------------------------------------- A11, A12

def manifest(spark, names, empty=()):
    rows = [(n, f"{n}_", f"Full/{n[:3]}", "Populated") + (None,) * 13 for n in names] + [(n, f"{n}_", "Delta/e", "Empty", "a", "b") + (None,) * 11 for n in empty]
    return spark.createDataFrame(rows, IO.string_schema(IO.MANIFEST_COLUMNS))


def history(spark, rows):
    return spark.createDataFrame(rows, HISTORY)


ROWS = [("1", "20010101", "1", "A"), ("1", "20010201", "0", "A"), ("2", "20010101", "1", "A"), ("2", "99999999", "1", "B"), ("3", "99999999", "0", "B"),
        ("3", "99999999", "0", "B"), ("4", "20010101", "1", None), (None, "20010101", "1", "A"), ("5", None, "1", "A"), ("6", "20010301", "1", 'q"\t\n')]


def test_forms_of_all_slices_equal_the_plain_operators(spark):
    df = history(spark, ROWS)
    cols = ["id", "effectiveTime", "active", "moduleId"]
    source = RX.Source(df, [RX.Slice("all", {c: c for c in cols}), RX.Slice("live", {"id": F.concat(F.lit("L"), "id"), "effectiveTime": "effectiveTime"}, F.col("active") == "1")])
    names = [f"{t}_{form}" for t in ("all", "live") for form in RX.FORMS]
    log = IO.export_history(spark, manifest(spark, names, ["none"]), [source], "20010401", IO.scratch_root(spark, "t-forms"))
    stamped = H.stamp_release(df, "effectiveTime", "20010401")
    live = stamped.filter("active = '1'").select(F.concat(F.lit("L"), "id").alias("id"), "effectiveTime")
    paths = {r["dataset"]: r["path"] for r in log.collect()}
    for t, base in (("all", stamped), ("live", live)):
        for form, want in (("full", base.distinct()), ("snapshot", H.snapshot(base.filter("effectiveTime IS NOT NULL"))), ("delta", H.delta(base, "20010401").distinct())):
            assert same(IO.read_tsv(spark, paths[f"{t}_{form}"], IO.string_schema(base.columns)), want), (t, form)
    text = "".join(open(os.path.join(paths["all_full"], f)).read() for f in sorted(os.listdir(paths["all_full"])) if f.startswith("part-"))
    assert text.startswith("id\teffectiveTime\tactive\tmoduleId\n") and text.count("effectiveTime") == 1
    assert IO.read_tsv(spark, paths["none"], IO.string_schema(["a", "b"])).isEmpty()


def test_the_history_is_scanned_once(spark, fx, name):
    """All slices and forms: one scan; no exchange of the history where it is stored by id, one where it is not."""
    path = IO.scratch_root(spark, "t-once")
    fx.refset_full.write.bucketBy(4, "id").option("path", path).saveAsTable(name)
    cols = {c: c for c in fx.refset_full.columns}
    slices = [RX.Slice("a", cols, F.col("active") == "1"), RX.Slice("b", cols, F.col("moduleId") == "M_EXT"), RX.Slice("c", cols)]

    def plan(df):
        lines = RX.release_lines(RX.Source(df, slices), "20010601", IO._render)
        return lines._jdf.queryExecution().executedPlan().toString()
    stored, plain = plan(spark.table(name)), plan(spark.read.parquet(path))
    assert stored.count("FileScan") == plain.count("FileScan") == 1
    assert stored.count("Exchange") == 0 and plain.count("Exchange hashpartitioning") == 1
    spark.sql(f"DROP TABLE {name}")


def test_a_wrong_row_of_the_same_count_is_found(spark):
    root = IO.scratch_root(spark, "t-wrong")
    tables = {n: spark.createDataFrame([("1", "x"), ("2", None), ("3", "y")], "id string, v string") for n in ("good", "bad")}
    log = IO.export_release(spark, manifest(spark, ["good", "bad"], ["none"]), tables, root)
    expected = log.select("dataset", F.col("rows").alias("expected_rows"), F.col("fingerprint").alias("expected_fingerprint"))

    def statuses():
        return {r["dataset"]: r["status"] for r in IO.export_check(expected, IO.read_back(spark, log)).collect()}
    assert set(statuses().values()) == {"ok"}
    assert IO.export_tree(spark, log, root).first()["outcome"] == "Pass"
    bad = next(r["path"] for r in log.collect() if r["dataset"] == "bad")
    IO.write_tsv(spark.createDataFrame([("1", "x"), ("2", "y"), ("3", None)], "id string, v string"), bad, "overwrite")
    assert statuses() == {"good": "ok", "bad": "wrong rows", "none": "ok"}
    plan = IO.export_check(expected, IO.read_back(spark, log))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    files.delete(spark, bad)
    tree = IO.export_tree(spark, log, root).first()
    assert tree["outcome"] == "Error" and (tree["file_sets"], tree["expected_file_sets"]) == (2, 3)
    assert IO.export_tree(spark, log.filter("dataset <> 'bad'"), root, folder_count=9).first()["outcome"] == "Error"


def test_a_failed_export_leaves_no_file_set(spark):
    root = IO.scratch_root(spark, "t-fail")
    tables = {"good": spark.createDataFrame([("1",)], "id string"), "bad": spark.createDataFrame([(IO.NULL_MARK,)], "id string")}
    with pytest.raises(Exception, match="null marker"):
        IO.export_release(spark, manifest(spark, ["good", "bad"]), tables, root)
    assert [n for n in files.names(spark, root) if not n.startswith("_")] == []


def test_awkward_paths_are_read_back(spark):
    root = IO.scratch_root(spark, "t-path") + "/a b+c%20d=é"
    log = IO.export_release(spark, manifest(spark, ["t1"]), {"t1": spark.createDataFrame([("1",), ("2",)], "id string")}, root)
    assert IO.read_back(spark, log).first()["written_rows"] == 2


def test_lines_are_neither_kept_nor_shuffled_to_be_written(spark, monkeypatch):
    """From the tasks that make them to the files: no table in between, and no exchange but that of the history by its id."""
    from pyspark.sql.readwriter import DataFrameWriter
    written, real = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, *a, **k: (written.append(self._df), real(self, *a, **k))[1])
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: pytest.fail("the lines are stored"))
    columns = {c: c for c in ("id", "effectiveTime", "active", "moduleId")}
    source = RX.Source(history(spark, ROWS), [RX.Slice("all", columns), RX.Slice("live", columns, F.col("active") == "1")])
    log = IO.export_history(spark, manifest(spark, [f"{t}_{form}" for t in ("all", "live") for form in RX.FORMS], ["none"]), [source], "20010401", IO.scratch_root(spark, "t-pass"))
    plan = written[0]._jdf.queryExecution().executedPlan().toString()
    assert len(written) == 1 and re.findall(r"Exchange (\w+)\((\w+)#", plan) == [("hashpartitioning", "id")]
    back = {r["dataset"]: (r["written_rows"], r["written_fingerprint"]) for r in IO.read_back(spark, log).collect()}
    assert back == {r["dataset"]: (r["rows"], r["fingerprint"]) for r in log.collect()}
    assert back["none"] == (0, "0:0") and back["all_full"][0] == 9


@pytest.mark.parametrize("tables", [1, 2])
def test_names_are_apart_from_rows_of_a_single_task(spark, tables):
    names = ["a", "b"][:tables]
    rows = {n: spark.range(5, numPartitions=1).select(F.col("id").cast("string").alias("id")) for n in names}
    log = IO.export_release(spark, manifest(spark, names), rows, IO.scratch_root(spark, "t-single"))
    assert {(r["dataset"], r["written_rows"]) for r in IO.read_back(spark, log).collect()} == {(n, 5) for n in names}
    assert all([r["id"] for r in IO.read_tsv(spark, p["path"], rows["a"].schema).orderBy("id").collect()] == list("01234") for p in log.collect())


def test_an_export_without_rows_or_tables(spark):
    none = spark.createDataFrame([], "id string")
    log = IO.export_release(spark, manifest(spark, ["a"], ["none"]), {"a": none}, IO.scratch_root(spark, "t-no-rows"))
    assert {(r["dataset"], r["rows"], r["fingerprint"]) for r in log.collect()} == {("a", 0, "0:0"), ("none", 0, "0:0")}
    log = IO.export_release(spark, manifest(spark, [], ["none"]), {}, IO.scratch_root(spark, "t-no-tables"))
    assert [(r["dataset"], r["rows"]) for r in log.collect()] == [("none", 0)]


def test_compressed_file_sets_are_the_gzip_of_the_text(spark):
    tables = {"t1": spark.createDataFrame([(str(i), None if i % 3 else 'q"\t\n') for i in range(50)], "id string, v string").repartition(3)}
    texts, logs = [], []
    for kind in ("none", "gzip"):
        logs.append(IO.export_release(spark, manifest(spark, ["t1"], ["none"]), tables, IO.scratch_root(spark, "t-gzip"), "", kind))
        folder = next(r["path"] for r in logs[-1].collect() if r["dataset"] == "t1").removeprefix("file:")
        parts = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
        assert all(f.endswith(".gz") for f in parts) == (kind == "gzip")
        raw = b"".join(open(os.path.join(folder, f), "rb").read() for f in parts)
        texts.append((gzip.decompress(raw) if kind == "gzip" else raw).decode())
        assert same(IO.read_tsv(spark, folder, tables["t1"].schema), tables["t1"])
    assert texts[0].startswith("id\tv\n") and texts[1].startswith("id\tv\n") and len(texts[0]) == len(texts[1])
    plain, packed = (log.select("dataset", "rows", "fingerprint") for log in logs)
    assert same(plain, packed) and same(IO.read_back(spark, logs[1]).toDF("dataset", "rows", "fingerprint"), packed)


# ---------------------------------------------------------------- A9, A10

def test_a_failed_replacement_leaves_the_table(spark, name):
    old = spark.range(100).select("id", F.lit("old").alias("v"))
    root = IO.scratch_root(spark, "t-ctas")
    IO.create_table_as(old, name, root)
    with pytest.raises(Exception, match="lost in the middle"):
        IO.create_table_as(failing(spark.range(500).select(F.col("id").cast("string").alias("v"), F.col("id")).repartition(8), "v"), name, root)
    assert same(spark.table(name), old) and len(files.names(spark, root)) == 1
    spark.sql(f"DROP TABLE {name}")


def test_replacement_from_itself_with_other_columns_and_managed(spark, name):
    root = IO.scratch_root(spark, "t-self")
    for df in (spark.range(10), spark.range(3).withColumn("v", F.lit("x"))):
        IO.create_table_as(df, name, root)
        assert same(spark.table(name), df)
    IO.create_table_as(spark.table(name).withColumn("v", F.lit("y")), name, root)
    assert [r["v"] for r in spark.table(name).collect()] == ["y"] * 3
    assert len(files.names(spark, root)) == 1  # the old versions are gone
    spark.sql(f"DROP TABLE {name}")
    root = IO.scratch_root(spark, "t-root")
    spark.range(4).write.option("path", root).saveAsTable(name)  # in the root itself
    IO.create_table_as(spark.range(6), name, root)
    assert spark.table(name).count() == 6
    spark.sql(f"DROP TABLE {name}")
    spark.range(5).write.saveAsTable(name)  # managed
    IO.create_table_as(spark.range(7), name)
    assert spark.table(name).count() == 7
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(name + "__")]
    spark.sql(f"DROP TABLE {name}")


def test_the_old_name_comes_back_when_the_new_one_cannot_take_it(spark, name, monkeypatch):
    root = IO.scratch_root(spark, "t-rename")
    IO.create_table_as(spark.range(10), name, root)
    path = RP.stage(spark.range(3).withColumn("v", F.lit("x")), root)
    real = type(spark).sql

    def sql(self, text, *a, **k):
        if "__new_" in text.split("RENAME")[0] and "RENAME" in text:
            raise RuntimeError("the catalog is away")
        return real(self, text, *a, **k)
    monkeypatch.setattr(type(spark), "sql", sql)
    with pytest.raises(RuntimeError):
        RP.publish(spark, name, path)
    monkeypatch.undo()
    assert spark.table(name).count() == 10
    spark.sql(f"DROP TABLE {name}")


def test_clones_are_all_right_or_none(spark, name, monkeypatch):
    src, dst = f"{name}_src", f"{name}_dst"
    spark.sql(f"CREATE DATABASE {src}")
    for t, n in (("one", 10), ("two", 20)):
        spark.range(n).write.saveAsTable(f"{src}.{t}")
    rows = IO.clone_tables(spark, ["one", "two"], src, dst).collect()
    assert {(r["name"], r["rows"]) for r in rows} == {("one", 10), ("two", 20)}
    spark.range(30).write.mode("overwrite").saveAsTable(f"{src}.one")
    spark.range(40).write.mode("overwrite").saveAsTable(f"{src}.two")
    real = RP.stage
    monkeypatch.setattr(RP, "stage", lambda df, root: real(df.filter("id <> 7") if "two" in root else df, root))
    with pytest.raises(ValueError, match="two"):
        IO.clone_tables(spark, ["one", "two"], src, dst)
    monkeypatch.undo()
    assert [spark.table(f"{dst}.{t}").count() for t in ("one", "two")] == [10, 20]
    for db in (src, dst):
        spark.sql(f"DROP DATABASE {db} CASCADE")


# ---------------------------------------------------------------- B9, B5

def test_modules_are_replaced_in_one_step(spark):
    table = SlicedTable(spark, IO.scratch_root(spark, "t-modules"), "moduleId")
    df = history(spark, [("1", "x", "1", "A"), ("2", "x", "1", "B"), ("3", "x", "1", "C"), ("4", "x", "1", None)])
    table.replace(df, ["A", "B", "C", None])
    assert same(table.read(), df)
    before = table.slices()
    replace_modules(table, history(spark, [("9", "y", "1", "A"), ("8", "y", "1", "D")]), ["A", "B", "D"])  # B has no rows any more, D is new
    assert {(r["id"], r["moduleId"]) for r in table.read().collect()} == {("9", "A"), ("8", "D"), ("3", "C"), ("4", None)}
    assert table.slices()["C"] == before["C"] and table.slices()["A"] != before["A"]
    assert [r["id"] for r in table.read(["D"]).collect()] == ["8"] and table.read(["B"]).isEmpty()
    # a failed one, and one with a row of a module that is not to be replaced, change nothing
    kept = sorted(map(tuple, table.read().collect()), key=str)
    for rows, error in ((failing(history(spark, [("7", "z", "1", "A"), ("6", "z", "1", "C")]), "id"), "lost in the middle"),
                        (history(spark, [("7", "z", "1", "A"), ("6", "z", "1", "E")]), "no slice to replace")):
        with pytest.raises(Exception, match=error):
            replace_modules(table, rows, ["A", "C"])
    assert sorted(map(tuple, table.read().collect()), key=str) == kept
    with pytest.raises(ValueError, match="other columns"):
        table.replace(spark.range(1).withColumn("moduleId", F.lit("A")), ["A"])
    table.replace(history(spark, []), ["A", "C", "D", None])
    assert table.read().isEmpty()
    assert table.drop_old() and table.read().isEmpty()


def test_of_two_writers_one_is_told(spark):
    root = IO.scratch_root(spark, "t-two")
    table = SlicedTable(spark, root, "moduleId")
    table.replace(history(spark, [("1", "x", "1", "A")]), ["A"])
    other = SlicedTable(spark, root, "moduleId")
    stale = other._newest()
    table.replace(history(spark, [("2", "x", "1", "A")]), ["A"])
    other._newest = lambda: stale  # as if both had begun at the same time
    with pytest.raises(FileExistsError):
        other.replace(history(spark, [("3", "x", "1", "A")]), ["A"])
    assert [r["id"] for r in table.read().collect()] == ["2"]


def test_stored_snapshot_equals_the_window_on_every_release(spark, fx):
    full = fx.refset_full
    dates = sorted(r[0] for r in H.release_dates(full).collect())[-8:]
    stored = StoredSnapshot(spark, IO.scratch_root(spark, "t-stored"), 8)
    stored.create(full, dates[0])
    for date in dates[1:]:
        stored.advance(H.delta(full, date))
        assert same(stored.read(), H.snapshot_as_of(full, date)), date


def test_stored_snapshot_reads_and_writes_touched_buckets_only(spark):
    rows = [(str(i), "20010101", "1", "A") for i in range(200)] + [(None, "20010101", "1", "A")]
    stored = StoredSnapshot(spark, IO.scratch_root(spark, "t-touched"), 16)
    stored.create(history(spark, rows), "20010101")
    before = stored.table.slices()
    # a new version, a tie, a late row that must lose, an id without a row so far
    delta = [("7", "20010201", "0", "A"), ("7", "20010201", "0", "B"), ("7", "20000101", "1", "Z"), ("new", "20010201", "1", "A"), (None, "20010201", "0", "A")]
    touched = stored.advance(history(spark, delta))
    after = stored.table.slices()
    assert 1 <= len(touched) <= 3 and {b for b in after if after[b] != before[b]} == set(touched)
    plan = stored.table.read(touched)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*_bucket", plan)
    assert same(stored.read(), H.snapshot_as_of(history(spark, rows + delta), "20010201"))
    assert stored.advance(history(spark, [])) == []


# ---------------------------------------------------------------- B10, B11

@pytest.fixture
def dated_db(spark, name):
    spark.sql(f"CREATE DATABASE {name}")
    for t in ("refset_20010101", "refset_20010201", "refset_20010301", "concept_20010101", "concept_20010201", "refset", "odd_20011399", "refset_99"):
        spark.range(1).write.saveAsTable(f"{name}.{t}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_retention_over_the_catalog(spark, dated_db):
    there = {t.name for t in spark.catalog.listTables(dated_db)}
    plan = {r["table"]: r["status"] for r in dated.retain_tables(spark, dated_db, 2).collect()}
    assert plan == {"refset_20010101": "would drop", "concept_20010101": "would drop", "refset_20010201": "kept", "concept_20010201": "kept", "refset_20010301": "kept"}
    assert {t.name for t in spark.catalog.listTables(dated_db)} == there  # a dry run
    log = {r["table"]: r["status"] for r in dated.retain_tables(spark, dated_db, 1, dry_run=False).collect()}
    assert [t for t, s in log.items() if s == "dropped"] == ["concept_20010101", "refset_20010101", "concept_20010201", "refset_20010201"]
    assert {t.name for t in spark.catalog.listTables(dated_db)} == {"refset_20010301", "refset", "odd_20011399", "refset_99"}
    assert {r["status"] for r in dated.retain_tables(spark, dated_db, 5, dry_run=False).collect()} == {"kept"}


def test_a_release_without_the_needed_table_is_passed_over(spark, dated_db):
    def found(*a):
        return tuple(dated.previous_release_with(spark, dated_db, *a).first())
    assert found("refset", "20010401") == ("20010301", "ok")
    assert found(["refset", "concept"], "20010401") == ("20010201", "ok")
    assert found(["refset", "concept"], "20010201") == ("20010101", "ok")
    assert found(["refset", "other"], "20010401") == (None, "none")
    assert found(["refset", "concept"], "20020401", 12) == ("20010201", "too old")


# ---------------------------------------------------------------- D3

def test_stored_releases_meet_without_an_exchange(spark, name):
    schema = "Cluster_ID string, Cluster_Description string, Refset_ID string, referencedComponentId string"
    old = spark.createDataFrame([("C", "d", "r", "1"), ("C", "e", "r", "1"), ("C", "d", "r", "2"), (None, "d", "r", "3"), ("C", "d", "r", None), ("C", "d", "r", "2")], schema)
    new = spark.createDataFrame([("C", "z", "r", "1"), ("D", "d", "r", "2"), (None, "d", "r", "3"), ("C", "d", "r", None)], schema)
    stored = [D.store_content(df, f"{name}_{k}", IO.scratch_root(spark, "t-content"), 4) for k, df in (("old", old), ("new", new))]
    found = D.release_diff_stored(*stored)
    assert same(found, D.release_diff(old, new))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = D.release_diff_stored(*stored)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2 and "SortMergeJoin" in plan
    for k in ("old", "new"):
        spark.sql(f"DROP TABLE {name}_{k}")
