"""Operators vs brute-force Python on small random inputs (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from relforge.operators import diff as D
from relforge.operators import history as H

RF = "id string, effectiveTime string, active string, moduleId string, refsetId string, referencedComponentId string"
DATES = ["20000101", "20000601", "20010101", "20010601", "99999999"]

history_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.sampled_from(DATES),
                                  st.sampled_from(["0", "1"]), st.just("m"), st.sampled_from(["r1", "r2"]),
                                  st.sampled_from(["1", "2"])), min_size=1, max_size=25)
content_rows = st.lists(st.tuples(st.sampled_from(["A", "B"]), st.sampled_from(["x", "y"]),
                                  st.sampled_from(["r1", "r2"]), st.sampled_from(["1", "2", "3", None])), max_size=12)
SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))


def brute_snapshot(rows, as_of):
    rows = [r for r in rows if r[1] <= as_of]
    top = {}
    for r in rows:
        top[r[0]] = max(top.get(r[0], r[1]), r[1])
    return {r for r in rows if r[1] == top[r[0]]}


@SETTINGS
@given(history_rows, st.sampled_from(DATES))
def test_snapshot_as_of(spark, rows, as_of):
    df = spark.createDataFrame(rows, RF)
    got = {tuple(r) for r in H.snapshot_as_of(df, as_of).collect()}
    assert got == brute_snapshot(rows, as_of)


@SETTINGS
@given(history_rows)
def test_two_snapshots(spark, rows):
    df = spark.createDataFrame(rows, RF)
    out = H.two_snapshots(df, "20000601", "20010601").collect()
    assert {tuple(r[:6]) for r in out if r["in_old"]} == brute_snapshot(rows, "20000601")
    assert {tuple(r[:6]) for r in out if r["in_new"]} == brute_snapshot(rows, "20010601")


def brute_diff(old, new):
    # the reference: full outer join on (component, code list), attributes old-first, DISTINCT;
    # SQL equality: a NULL key matches nothing
    def match(a, b):
        return a[3] is not None and b[3] is not None and a[3] == b[3] and a[0] == b[0]
    out = set()
    for o in old:
        partners = [n for n in new if match(o, n)]
        out.add((o[0], o[1], o[2], o[3], "no change" if partners else "removed"))
    for n in new:
        if not any(match(o, n) for o in old):
            out.add((n[0], n[1], n[2], n[3], "added"))
    return out


@SETTINGS
@given(content_rows, content_rows)
def test_release_diff(spark, old, new):
    schema = "Cluster_ID string, Cluster_Description string, Refset_ID string, referencedComponentId string"
    got = D.release_diff(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)).collect()
    rows = [tuple(r) for r in got]
    assert len(rows) == len(set(rows))
    assert set(rows) == brute_diff(old, new)


@SETTINGS
@given(history_rows)
def test_published_snapshot(spark, rows):
    df = spark.createDataFrame(rows, RF)
    pub = [r for r in rows if r[1] != "99999999"]
    top = {}
    for r in pub:
        k = (r[0], r[4], r[5])
        top[k] = max(top.get(k, r[1]), r[1])
    want = {r for r in pub if r[1] == top[(r[0], r[4], r[5])] and r[2] == "1"}
    got = {tuple(r) for r in H.published_snapshot(df).collect()}
    assert got == want
