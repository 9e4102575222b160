"""A6-A13 round trips on shared scratch storage."""

import os

import pytest
from pyspark.sql import functions as F

from relforge.sources import io as IO


def test_export_release_with_empty_file(spark, fx):
    root = IO.scratch_root(spark, "t-export")
    rows = [("t1", "T1_", "Full", "Populated") + (None,) * 13,
            ("t2", "T2_", "Full", "Empty", "a", "b") + (None,) * 11]
    man = spark.createDataFrame(rows, IO.string_schema(IO.MANIFEST_COLUMNS))
    tables = {"t1": fx.refset_full.limit(0).unionByName(fx.refset_full)}
    log = IO.export_release(spark, man, tables, root, "20010601")
    paths = {r["dataset"]: r["path"] for r in log.collect()}
    assert IO.read_tsv(spark, paths["t1"], IO.string_schema(fx.refset_full.columns)).count() \
        == fx.refset_full.distinct().count()
    empty = spark.read.options(**IO.text_options(sep="\t")).csv(paths["t2"])
    assert empty.columns == ["a", "b"] and empty.count() == 0
    written = IO.read_back(spark, log)
    n = fx.refset_full.distinct().count()
    assert {(r["dataset"], r["rows"]) for r in log.collect()} == {("t1", n), ("t2", 0)}
    exp = spark.createDataFrame([("t1", n), ("t2", 0), ("t3", 1)], "dataset string, expected_rows bigint")
    status = {r["dataset"]: r["status"] for r in IO.export_check(exp, written).collect()}
    assert status == {"t1": "ok", "t2": "ok", "t3": "missing"}
    with pytest.raises(FileExistsError):  # nothing is written over
        IO.export_release(spark, man, tables, root, "20010601")


def test_overwrite_module_partition(spark, fx):
    path = IO.scratch_root(spark, "t-modules")
    base = fx.refset_full
    base.write.partitionBy("moduleId").parquet(path)
    new = base.filter(F.col("moduleId") == "M_PCD").limit(5)
    IO.overwrite_module(new, path)
    back = spark.read.parquet(path)
    assert back.filter(F.col("moduleId") == "M_PCD").count() == 5
    assert back.filter(F.col("moduleId") == "M_EXT").count() == base.filter(F.col("moduleId") == "M_EXT").count()


def test_legacy_encoding_roundtrip(spark):
    df = spark.createDataFrame([("café, crème", 1)], "t string, n int")
    path = IO.scratch_root(spark, "t-legacy")
    IO.write_csv_legacy(df, path)
    raw = b"".join(open(os.path.join(path, f), "rb").read() for f in os.listdir(path) if f.endswith(".csv"))
    assert "café".encode("latin-1") in raw
    assert IO.read_csv_legacy(spark, path, df.schema).collect()[0]["t"] == "café, crème"


def test_replace_module_partition_including_empty_slice(spark, fx):
    from relforge.operators import history as H
    table = "t_sct_refset_modules"
    base = H.snapshot_as_of(fx.refset_full, "20001201")
    base.write.mode("overwrite").partitionBy("moduleId").option("path", IO.scratch_root(spark, "t-tab")) \
        .saveAsTable(table)
    new = H.snapshot_as_of(fx.refset_full, "20010601")
    IO.replace_module_partition(spark, table, new, "M_PCD")
    got = spark.table(table)
    want = base.filter(F.col("moduleId") != "M_PCD").unionByName(new.filter(F.col("moduleId") == "M_PCD")) \
               .select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    IO.replace_module_partition(spark, table, new.limit(0), "M_EXT")  # module absent from the new slice
    assert spark.table(table).filter(F.col("moduleId") == "M_EXT").count() == 0
    assert spark.table(table).filter(F.col("moduleId") == "M_PCD").count() == new.filter(
        F.col("moduleId") == "M_PCD").count()


def test_create_and_clone_tables(spark, fx):
    IO.create_table_as(fx.clusters, "t_clusters_src")
    IO.create_table_as(fx.rulesets, "t_rulesets_src")
    spark.sql("CREATE DATABASE IF NOT EXISTS t_src")
    IO.create_table_as(fx.clusters, "t_src.clusters")
    IO.clone_tables(spark, ["clusters"], "t_src", "t_sandbox")
    assert spark.table("t_sandbox.clusters").count() == fx.clusters.count()
    assert spark.table("t_clusters_src").count() == fx.clusters.count()


def test_scans_name_map_and_report(spark, fx):
    from relforge.sources import tables as TB
    assert TB.select_all(fx.clusters).count() == fx.clusters.count()
    assert TB.select_distinct(fx.clusters.unionByName(fx.clusters)).count() == fx.clusters.distinct().count()
    assert TB.read_table(spark, "/root/testdata/sf0.001", "region").count() == 5
    path = IO.scratch_root(spark, "t-names")
    fx.service_names.select("Service", "Service_Full_Name").write.option("header", True).csv(path)
    names = IO.read_name_map(spark, path, ["Service", "Service_Full_Name"])
    assert names.count() == fx.service_names.count()
    rep = IO.scratch_root(spark, "t-report")
    IO.write_report(fx.rulesets, rep)
    assert spark.read.parquet(rep).count() == fx.rulesets.count()


def test_scratch_is_the_configured_folder(spark):
    from relforge.session import checkpoint_dir
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == root
    assert IO.scratch_root(spark, "x").startswith(root)


def test_legacy_refuses_what_it_cannot_hold(spark):
    import pytest
    df = spark.createDataFrame([(1, "caf\u00e9"), (2, "M\u0101ori"), (3, "en\u2013dash"), (4, None)], "n int, t string")
    assert sorted(r["value"] for r in IO.not_encodable(df).collect()) == ["M\u0101ori", "en\u2013dash"]
    with pytest.raises(Exception, match="not in ISO-8859-1"):
        IO.write_csv_legacy(df, IO.scratch_root(spark, "t-refuse"))


def test_null_marker_as_a_value_is_refused(spark):
    import pytest
    df = spark.createDataFrame([(IO.NULL_MARK,)], "t string")
    with pytest.raises(Exception, match="null marker"):
        IO.write_tsv(df, IO.scratch_root(spark, "t-null"))
