"""Plan properties kept as regression tests (see PLANS.md)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(E._plans.queries()))
def test_no_nested_loop_or_cartesian(spark, name):
    txt = plan(E.queries()[name](spark, SF_SMALL))
    assert not re.search(r"NestedLoop|CartesianProduct", txt)


def test_static_lists_read_the_history_once(spark):
    """The lists without codes are told from the same exchange that the codes come from."""
    df = E.queries()["static_by_ruleset"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert len(re.findall(r"Window \[rank", final)) == 1


def test_flagship_diff_shuffles_history_once(spark):
    from relforge.plans.diff_queries import diff_df
    from relforge.sources.fixtures import Fixtures
    f = Fixtures(spark, SF_SMALL)
    f.store(source_bytes=1)
    try:
        txt = plan(diff_df(f))
    finally:
        f.drop()
    # both snapshots from the id-bucketed table: no shuffle on the member id
    assert not re.search(r"hashpartitioning\(id#", txt)
    # one history-sized exchange, on (component, code list)
    assert len(re.findall(r"hashpartitioning\(referencedComponentId#\d+, Cluster_ID#\d+", txt)) == 1
    assert "Bucketed: true" in txt
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(effectiveTime,20010601\)", txt)


WRITES = re.compile(r"roundtrip|export|awkward|write_report|create_table|clone_|read_name_map|release_diff_stored|replace_modules|snapshot_incremental|retain_tables|retained_rows|previous_release_with|^op\d+_|^pipeline$")


def test_building_a_query_starts_no_job(spark):
    """Queries are plans until somebody asks for their rows (those that write files apart)."""
    tracker = spark.sparkContext.statusTracker()
    for name, build in E.queries().items():
        if WRITES.search(name):
            continue
        build(spark, SF_SMALL)  # parquet footers of a table read for the first time are a job of the reader
        spark.sparkContext.setJobGroup(f"build {name}", name)
        build(spark, SF_SMALL)
        jobs = [j for j in tracker.getJobIdsForGroup(f"build {name}")]
        infos = [tracker.getJobInfo(j) for j in jobs]
        assert len(jobs) <= 14 and all(len(i.stageIds) <= 1 for i in infos if i), name  # schema reads only
    spark.sparkContext.setJobGroup(None, None)


@pytest.mark.parametrize("name", ["reference_data", "reference_enriched", "membership_history"])
def test_hot_refset_is_no_join_key_of_the_names(spark, name):
    """With broadcast off, no side of the description table is dealt by refset id next to the members."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        txt = plan(E.queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = re.findall(r"SortMergeJoin.*?\nLeft keys \[\d+\]: \[(.*?)\]\nRight keys \[\d+\]: \[(.*?)\]", txt)
    by_refset = [j for j in joins if "refsetId" in j[0] + j[1]]
    if name == "membership_history":
        assert not by_refset
    else:  # once: the members meet the few named lists
        assert len(by_refset) == 1 and "Refset_ID" in by_refset[0][0] + by_refset[0][1]
