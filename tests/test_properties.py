
from pyspark.sql import functions as F

from relforge.operators import diff as D
from relforge.operators import history as H
from relforge.operators import publish as P
from relforge.operators import refdata as R
from relforge.sources.fixtures import AS_OF, CURRENT_RELEASE, LOCAL_MODULE, PREVIOUS_RELEASE

RF = ["id", "effectiveTime", "active", "moduleId", "refsetId", "referencedComponentId"]


def test_snapshot_subset_of_full(fx):
    snap = H.snapshot(fx.refset_full)
    assert snap.exceptAll(fx.refset_full.distinct()).count() == 0


def test_delta_plus_older_is_full(fx):
    full = fx.refset_full
    older = full.filter(F.col("effectiveTime") != CURRENT_RELEASE)
    assert H.delta(full, CURRENT_RELEASE).unionByName(older).exceptAll(full).count() == 0
    assert full.exceptAll(H.delta(full, CURRENT_RELEASE).unionByName(older)).count() == 0


def test_two_snapshots_equal_separate_snapshots(fx):
    both = H.two_snapshots(fx.refset_full, PREVIOUS_RELEASE, CURRENT_RELEASE)
    old = both.filter("in_old").select(*RF).distinct()
    new = both.filter("in_new").select(*RF).distinct()
    for got, want in ((old, H.snapshot_as_of(fx.refset_full, PREVIOUS_RELEASE)),
                      (new, H.snapshot_as_of(fx.refset_full, CURRENT_RELEASE))):
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _content(fx, date):
    used = D.clusters_in_use(fx.cluster_ruleset, fx.clusters)
    snap = H.snapshot_as_of(fx.refset_full, date)
    return D.merged_content(snap.filter(F.col("moduleId") == LOCAL_MODULE), snap, LOCAL_MODULE, used)


def test_diff_with_itself_is_no_change(fx):
    c = _content(fx, CURRENT_RELEASE)
    outcomes = {r["Outcome"] for r in D.release_diff(c, c).select("Outcome").distinct().collect()}
    assert outcomes == {"no change"}


def test_added_is_removed_reversed(fx):
    a, b = _content(fx, PREVIOUS_RELEASE), _content(fx, CURRENT_RELEASE)
    keys = ["Cluster_ID", "SNOMED_concept_ID"]
    added = D.release_diff(a, b).filter(F.col("Outcome") == "added").select(*keys)
    removed = D.release_diff(b, a).filter(F.col("Outcome") == "removed").select(*keys)
    assert added.exceptAll(removed).count() == 0 and removed.exceptAll(added).count() == 0


def test_fused_diff_equals_two_input_diff(fx):
    used = D.clusters_in_use(fx.cluster_ruleset, fx.clusters)
    fused = D.release_diff_from_history(fx.refset_full, PREVIOUS_RELEASE, CURRENT_RELEASE, used)
    plain = D.release_diff(_content(fx, PREVIOUS_RELEASE), _content(fx, CURRENT_RELEASE))
    assert fused.exceptAll(plain).count() == 0 and plain.exceptAll(fused).count() == 0


def test_reference_data_unique_on_key(fx):
    snap = H.snapshot(fx.refset_full.filter(F.col("effectiveTime") != "99999999"))
    ref = R.reference_data(snap, fx.description, fx.concept, fx.clusters, AS_OF, LOCAL_MODULE)
    assert ref.count() == ref.select("ConceptId", "Cluster_ID").distinct().count()


def test_best_sensitive_matches_full_fanout(fx):
    snap = H.snapshot(fx.refset_full.filter(F.col("effectiveTime") != "99999999"))
    sens = ["900021000230105", "900061000230105"]
    cl = R.dedupe_clusters(R.active_over_retired(R.eligible_clusters(fx.clusters, AS_OF)))
    full = R.dedupe_concepts(R.enrich_refset(snap, fx.description, fx.concept, cl, sens, LOCAL_MODULE))
    fast = R.dedupe_concepts(R.enrich_refset(snap, fx.description, fx.concept, cl, sens, LOCAL_MODULE,
                                             best_sensitive_only=True))
    assert full.exceptAll(fast).count() == 0 and fast.exceptAll(full).count() == 0


def test_replace_module_slice_idempotent(fx):
    target = H.snapshot_as_of(fx.refset_full, PREVIOUS_RELEASE)
    new = H.snapshot_as_of(fx.refset_full, CURRENT_RELEASE).filter(F.col("moduleId") == LOCAL_MODULE)
    once = H.replace_module_slice(target, new, LOCAL_MODULE)
    twice = H.replace_module_slice(once, new, LOCAL_MODULE)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_publication_tables_within_bridges(fx):
    pub = P.published(fx.ruleset_published, AS_OF)
    e2 = P.published_cluster_ruleset(fx.cluster_ruleset, P.published(fx.ruleset_published, AS_OF, True))
    assert e2.exceptAll(fx.cluster_ruleset.select(*P.RS_KEYS, "Cluster_ID")).count() == 0
    e9 = P.published_output_population(fx.output_population, fx.population_ruleset, fx.output_ruleset, pub)
    assert e9.exceptAll(fx.output_population).count() == 0


def test_reference_data_columns(fx):
    snap = H.snapshot(fx.refset_full.filter(F.col("effectiveTime") != "99999999"))
    ref = R.reference_data(snap, fx.description, fx.concept, fx.clusters, AS_OF, LOCAL_MODULE)
    assert ref.columns == R.REFERENCE_COLUMNS
    assert R.strip_characters(ref).columns == [c for c in R.REFERENCE_COLUMNS if c != "DescriptionType"]
