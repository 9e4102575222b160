"""Tasks that follow from the size of the source: the same rows, a bounded share for each task, no key in one task."""

import random
import re

import pytest
from pyspark.sql import functions as F

from relforge.functions.fingerprint import fingerprint
from relforge.operators import diff as D
from relforge.operators import history as H
from relforge.operators import lists as L
from relforge.operators import refdata as R
from relforge.plans import export_queries as X
from relforge.sources import io as IO
from relforge.sources import release_export as RX
from relforge.sources import spread as S
from relforge.sources.fixtures import Fixtures
from relforge.sources.sliced import StoredSnapshot
from tests.conftest import SF_SMALL
from tests.test_plans import plan

SHARE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
REFSET = "id string, effectiveTime string, active string, moduleId string, refsetId string, referencedComponentId string"


def stored(spark, rows, schema):
    path = IO.scratch_root(spark, "t-spread")
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(path)
    return spark.read.parquet(path)


def members(spark):
    """A third of the rows in one refset, with repeated rows and null keys."""
    pick = random.Random(5)
    rows = []
    for i in range(400):
        refset = "R0" if i % 3 == 0 else pick.choice(["R1", "R2", "R3", None])
        rows.append((f"m{i % 150}" if i % 40 else None, pick.choice(["20000101", "20010101", "20010601", None]), pick.choice("01"), "M", refset,
                     pick.choice([f"c{i % 30}", f"c{i % 30}", None])))
    return stored(spark, rows + rows[:60], REFSET)


@pytest.fixture
def tables(spark):
    names = [(f"c{i}", f"name {i}", "F" if i % 2 else "P", "1") for i in range(25)] + [(f"R{i}", f"refset {i}", "F", "1") for i in range(4)] + [(None, "x", "F", "1"), ("c1", "name 1", "F", "1")] * 2
    return {"refset": members(spark),
            "description": stored(spark, names, "conceptId string, term string, DescriptionType string, active string"),
            "concept": stored(spark, [(f"c{i}", "20000101", "1", "M") for i in range(20)] + [(None, "20000101", "0", "M"), ("c1", "20000101", "1", "M")], "id string, effectiveTime string, active string, moduleId string"),
            "clusters": stored(spark, [(f"C{i}", f"list {i}", f"R{i % 5}", None, "cat") for i in range(8)] + [("C9", "list 9", None, None, "cat"), ("C0", "list 0", "R0", None, "other")],
                               "Cluster_ID string, Cluster_Description string, Refset_ID string, Cluster_Date_Inactive date, Cluster_Category string"),
            "links": stored(spark, [(f"C{i % 9}", "S", f"RS{i % 2}", 1, None) for i in range(20)],
                            "Cluster_ID string, Service_ID string, Ruleset_ID string, Ruleset_Version int, Cluster_Ruleset_Date_Inactive date")}


OPERATORS = {
    "enriched": lambda t: R.enrich_refset(t["refset"], t["description"], t["concept"], t["clusters"], ("R1",)),
    "static": lambda t: L.static_by_ruleset(t["links"], t["clusters"], t["refset"], t["description"], t["concept"]),
    "change class": lambda t: H.release_change_class(t["refset"], "20010601", t["clusters"], t["description"], t["concept"], t["links"], "2001-07-01"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_the_rows_do_not_depend_on_the_number_of_tasks(spark, tables, monkeypatch, name):
    plain = OPERATORS[name](tables)
    want = fingerprint(plain).first()
    assert want["rows"] and "REPARTITION_BY_NUM" not in plan(plain)
    monkeypatch.setattr(S, "TASK_BYTES", 1500)
    monkeypatch.setattr(S, "HOT_TASKS", 2)
    assert S.tasks(tables["refset"]) >= 4
    dealt = OPERATORS[name](tables)
    text = plan(dealt)
    assert re.search(r"hashpartitioning\(referencedComponentId#\d+, \d+\), REPARTITION_BY_NUM", text)
    assert name == "change class" or "_part" in text
    assert fingerprint(dealt).first() == fingerprint(dealt.distinct()).first() == want


def test_one_exchange_by_id_serves_the_distinct_and_the_snapshot(spark, monkeypatch):
    want = fingerprint(H.snapshot(Fixtures(spark, SF_SMALL).refset_full)).first()
    monkeypatch.setattr(S, "TASK_BYTES", 20_000)
    snap = H.snapshot(Fixtures(spark, SF_SMALL).refset_full)
    assert re.findall(r"hashpartitioning\((\w+)#", plan(snap)) == ["id"]
    assert fingerprint(snap).first() == want


@pytest.mark.parametrize("task_bytes", [1500, 10**9])
def test_a_stored_bucket_is_dealt_over_several_tasks(spark, monkeypatch, task_bytes):
    history = members(spark)
    monkeypatch.setattr(S, "TASK_BYTES", task_bytes)
    snapshot = StoredSnapshot(spark, IO.scratch_root(spark, "t-buckets"), 2)
    snapshot.create(history, "20010101")
    assert (len(snapshot.read().inputFiles()) > 2) == (task_bytes < 10**9)
    snapshot.advance(H.delta(history, "20010601"))
    assert fingerprint(snapshot.read()).first() == fingerprint(H.snapshot_as_of(history, "20010601")).first()


def test_one_rulesets_lists_are_sent_to_the_rows(spark):
    nc = stored(spark, [("C0", f"c{i % 40}") for i in range(90)] + [("C1", None), (None, "c1")], "Cluster_ID string, ConceptId string")
    links = stored(spark, [("C0", "A", None), ("C0", "A", None), (None, "A", None), ("C1", "B", None)], "Cluster_ID string, Ruleset_ID string, Cluster_Ruleset_Date_Inactive date")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        subset = R.subset_by_ruleset(nc, links, "A")
        assert not re.search(r"hashpartitioning\(Cluster_ID#\d+, \d+\)", plan(subset))
        assert subset.count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_read_back_shuffles_sums_alone(spark):
    names = ["a", "b"]
    rows = [(n, f"{n}_", f"Full/{n} x+y", "Populated") + (None,) * 13 for n in names]
    tables = {n: stored(spark, [(str(i), None if i % 3 else "v") for i in range(50)], "id string, v string") for n in names}
    log = IO.export_release(spark, spark.createDataFrame(rows, IO.string_schema(IO.MANIFEST_COLUMNS)), tables, IO.scratch_root(spark, "t-back"))
    back = RX.read_back(spark, log, IO.text_options(sep="\t"))
    assert {(r["dataset"], r["written_rows"], r["written_fingerprint"]) for r in back.collect()} == {(r["dataset"], r["rows"], r["fingerprint"]) for r in log.collect()}
    assert re.search(r"hashpartitioning\(_file#\d+, ", plan(back))


def test_folder_keys_are_sent_to_the_rows(spark, monkeypatch):
    written = []
    monkeypatch.setattr(X.IO, "export_partitioned", lambda df, *more: written.append(df))
    monkeypatch.setattr(X.IO, "read_partitioned", lambda *more: None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        X.q_export_partitioned_roundtrip(spark, SF_SMALL)
        assert "BroadcastHashJoin" in plan(written[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_distinct_members_are_dealt_and_not_sorted_to_meet_their_lists(spark, tables, monkeypatch):
    want = fingerprint(OPERATORS["static"](tables)).first()
    monkeypatch.setattr(S, "TASK_BYTES", 1500)
    monkeypatch.setattr(S, "UNSORTED_TASKS", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        static = OPERATORS["static"](tables)
        text = plan(static)
        assert re.search(r"hashpartitioning\(refsetId#\d+, referencedComponentId#\d+, \d+\), REPARTITION_BY_NUM", text)
        assert not re.search(r"hashpartitioning\(refsetId#\d+, referencedComponentId#\d+, \d+\), ENSURE_REQUIREMENTS", text)
        assert "ShuffledHashJoin Inner BuildRight" in text
        assert fingerprint(static).first() == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_parts_of_a_hot_key_are_not_sorted(spark, tables, monkeypatch, how):
    rows, few = tables["refset"], tables["clusters"].select("Refset_ID")
    want = fingerprint(rows.join(few, rows.refsetId == few.Refset_ID, how)).first()
    monkeypatch.setattr(S, "TASK_BYTES", 1500)
    monkeypatch.setattr(S, "HOT_TASKS", 2)
    joined = S.join_by_hot_key(rows, few, "refsetId", "Refset_ID", "referencedComponentId", how)
    assert "ShuffledHashJoin" in plan(joined) and "SortMergeJoin" not in plan(joined)
    assert want["rows"] and fingerprint(joined).first() == want


def test_every_history_of_a_release_is_dealt_by_its_id(spark, monkeypatch):
    def lines():
        sources = X._release_sources(Fixtures(spark, SF_SMALL))
        return {s.slices[-1].name: RX.release_lines(s, X.CURRENT_RELEASE, IO._render) for s in sources}
    want = {name: fingerprint(df).first() for name, df in lines().items()}
    monkeypatch.setattr(S, "TASK_BYTES", 500)
    dealt = lines()
    for name in ("language", "concept", "description", "decision"):
        exchanges = re.findall(r"hashpartitioning\((\w+)#\d+, \d+\), (\w+)", plan(dealt[name]))
        assert exchanges == [("id", "REPARTITION_BY_NUM")], name
    assert {name: fingerprint(df).first() for name, df in dealt.items()} == want


def test_a_release_is_written_compressed(spark):
    paths = [r["path"] for r in X._export(spark, SF_SMALL).select("path").collect()]
    assert len(paths) == 66 and all(f.endswith(".txt.gz") for f in spark.read.text(paths).inputFiles())


def test_rows_are_dealt_before_they_are_copied_to_their_rulesets(spark):
    decorated = stored(spark, [(f"C{i % 4}", f"c{i}", None if i % 9 else "x") for i in range(60)] * 2 + [(None, "c1", "x")],
                       "Cluster_ID string, SNOMED_concept_ID string, Code_description string")
    for name in ("Cluster_description", "Type_of_Refset", "Cluster_Code_String", "Active_status", "Outcome"):
        decorated = decorated.withColumn(name, F.lit(name))
    # a list in more rulesets than are copied at once, one in a single one, one in none; repeated links and null keys
    links = stored(spark, [("C0", "S", f"R{i}", i % 3) for i in range(2 * D.COPIES + 3)] * 2 + [("C1", "S", "R1", 1), ("C2", None, "R1", 1), ("C2", "S", None, None), (None, "S", "R1", 1)],
                   "Cluster_ID string, Service_ID string, Ruleset_ID string, Ruleset_Version int")
    plain, dealt = (D.changed_by_ruleset(decorated, links, dealt=each) for each in (False, True))
    assert dealt.schema.names == plain.schema.names and dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
    assert plain.count() == 30 * (2 * D.COPIES + 3 + 1 + 2)
    text = dealt._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(_rulesets#\d+, _part#\d+, \d+\), REBALANCE_PARTITIONS_BY_COL", text)
    assert text.index("Generate inline") < text.index("REBALANCE_PARTITIONS_BY_COL")


def test_the_copies_of_a_row_are_not_shuffled_to_be_written(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    written, real = [], DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a, **k: (written.append((self._df, spark.conf.get(SHARE))), real(self, *a, **k))[1])
    before = spark.conf.get(SHARE)
    back = X.q_export_partitioned_roundtrip(spark, SF_SMALL)
    text = written[0][0]._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"\((\w+)#\d+, (\w+)#\d+, \d+\), REBALANCE_PARTITIONS_BY_COL", text) == [("_rulesets", "_part")]
    assert int(written[0][1]) == IO.COPIED_SHARE and spark.conf.get(SHARE) == before
    assert back.inputFiles() and all(f.endswith(".csv.gz") for f in back.inputFiles())


def test_a_smaller_share_stays_and_a_failed_job_restores_it(spark):
    before = spark.conf.get(SHARE)
    try:
        spark.conf.set(SHARE, "1k")
        with S.task_share(spark, 5000):
            assert spark.conf.get(SHARE) == "1k"
        spark.conf.set(SHARE, "6k")
        with pytest.raises(ValueError), S.task_share(spark, 5000):
            assert spark.conf.get(SHARE) == "5000"
            raise ValueError
        assert spark.conf.get(SHARE) == "6k"
    finally:
        spark.conf.set(SHARE, before)
