"""Counts on the fixtures at sf0.001, taken from the fixture texts in DuckDB alone."""

from pyspark.sql import functions as F

from relforge.operators import diff as D
from relforge.operators import history as H
from relforge.operators import lists as L
from relforge.operators import publish as P
from relforge.operators import quality as Q
from relforge.sources.fixtures import AS_OF, CURRENT_RELEASE, PREVIOUS_RELEASE, SENTINEL


def test_snapshot_counts(fx):
    snap = H.snapshot(fx.refset_full)
    assert snap.count() == 1770
    assert snap.select("id").distinct().count() == 1749


def test_sentinel_and_delta(fx):
    assert fx.refset_full.filter(F.col("effectiveTime") == SENTINEL).count() == 209
    assert H.delta(fx.refset_full, CURRENT_RELEASE).count() == 60


def test_tied_keys(fx):
    both = (fx.refset_full.groupBy("id", "effectiveTime").agg(F.countDistinct("active").alias("n"))
            .filter(F.col("n") == 2))
    assert both.count() == 85


def test_release_diff_probe(fx):
    # probe form: lists with no inactive date, no ruleset restriction
    used = fx.clusters.filter(F.col("Cluster_Date_Inactive").isNull()) \
                      .select("Cluster_ID", "Cluster_Description", "Refset_ID").distinct()
    diff = D.release_diff_from_history(fx.refset_full, PREVIOUS_RELEASE, CURRENT_RELEASE, used)
    counts = {r["Outcome"]: r["count"] for r in diff.groupBy("Outcome").count().collect()}
    assert counts == {"added": 85, "no change": 860, "removed": 58}


def test_rulesets_and_publication(fx):
    st = L.ruleset_stage(fx.rulesets, AS_OF)
    counts = {r["Stage"]: r["count"] for r in st.groupBy("Stage").count().collect()}
    assert counts == {"Live": 24, "Upcoming": 9}
    assert fx.rulesets.count() == 37
    assert fx.rulesets.select("Service_ID", "Ruleset_ID").distinct().count() == 30
    pub = P.published(fx.ruleset_published, AS_OF)
    assert fx.cluster_ruleset.join(pub, P.RS_KEYS, "left_semi").count() == 42


def _labels(fx, as_of):
    iss = Q.publication_issues(fx.ruleset_published, fx.rulesets, as_of)
    return {r["Publication_issues"]: r["count"] for r in iss.groupBy("Publication_issues").count().collect()}


def test_publication_issue_labels(fx):
    assert _labels(fx, "2001-07-01") == {Q.LABEL_ACTIVE: 25, Q.LABEL_ONGOING: 4}
    assert _labels(fx, "2002-06-01") == {Q.LABEL_ACTIVE: 25, Q.LABEL_ISSUE: 4}
    later = (Q.publication_issues(fx.ruleset_published, fx.rulesets, "2001-07-01")
             .filter(F.col("Latest_version") > F.col("Ruleset_Version")))
    assert later.count() == 7


def test_publication_tables(fx):
    pub = P.published(fx.ruleset_published, AS_OF)
    assert P.published_outputs(fx.outputs, fx.output_ruleset, pub).count() == 120
    assert P.published_cluster_output(fx.cluster_output, fx.output_ruleset, fx.clusters, pub).count() == 84
    assert P.published_population_ruleset(fx.population_ruleset, pub).count() == 480
    assert fx.cluster_population.count() == 64
    assert fx.output_population.count() == 480


def test_retire_decisions(fx):
    assert Q.retired_recently(fx.decision_log, "2024-01-31", 14).count() == 87


def test_id_table(fx):
    assert fx.id_table.count() == 6


def test_refset_ids_are_unique_and_one_is_hot(fx):
    lists = fx.clusters.select("Refset_ID").distinct().count()
    assert lists == fx.refset_full.select("refsetId").union(fx.clusters.select("Refset_ID")).distinct().count()
    per = [r["count"] for r in fx.refset_full.groupBy("refsetId").count().collect()]
    assert max(per) > 0.3 * sum(per)


def test_keys_of_any_width_stay_apart(spark):
    from relforge.sources.fixtures import _rid
    ids = spark.sql(f"SELECT {_rid('k')} AS id FROM VALUES (1), (10), (1000), (10000), (10001), (100005), (123456789) t(k)")
    assert ids.distinct().count() == 7


def test_outputs_and_populations_cover_all_parts(fx):
    assert fx.outputs.count() + fx.populations.count() == fx.part.count()
    assert fx.outputs.select("Output_ID").distinct().count() == fx.outputs.count()


def test_unlisted_publications_are_unmatched(fx):
    found = Q.publication_issues(fx.ruleset_published, fx.rulesets, "2001-07-01")
    assert {r["matched"]: r["count"] for r in found.groupBy("matched").count().collect()} == {True: 24, False: 5}
