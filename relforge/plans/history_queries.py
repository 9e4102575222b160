"""Driver queries for B1-B14 (release building) on the fixture tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from relforge.operators import history as H
from relforge.plans.common import (AS_OF, CURRENT_RELEASE, LOCAL_MODULE, PREVIOUS_RELEASE, SENTINEL, fx,
                                   snap_sql)
from relforge.plans.registry import query

CONCEPT_MODULE = "777"
RF = "id, effectiveTime, active, moduleId, refsetId, referencedComponentId"


@query("stamp_release", f"""
SELECT id, CASE WHEN effectiveTime = '{SENTINEL}' THEN '{CURRENT_RELEASE}' ELSE effectiveTime END AS effectiveTime,
       active, moduleId, refsetId, referencedComponentId FROM refset_full""")
def q_stamp_release(spark, d):
    return H.stamp_release(fx(spark, d).refset_full, "effectiveTime", CURRENT_RELEASE)


@query("stamp_dependency", f"""
SELECT id, {", ".join(f"CASE WHEN {c} = '{SENTINEL}' THEN '{CURRENT_RELEASE}' ELSE {c} END AS {c}"
                      for c in ("effectiveTime", "sourceEffectiveTime", "targetEffectiveTime"))}, active, moduleId
FROM module_dependency""")
def q_stamp_dependency(spark, d):
    # B1 on a table with three date columns
    out = H.stamp_release(fx(spark, d).module_dependency, ["effectiveTime", "sourceEffectiveTime", "targetEffectiveTime"], CURRENT_RELEASE)
    return out.select("id", "effectiveTime", "sourceEffectiveTime", "targetEffectiveTime", "active", "moduleId")


@query("release_full", f"SELECT {RF} FROM refset_full")
def q_release_full(spark, d):
    return H.full(fx(spark, d).refset_full)


@query("release_delta", f"SELECT {RF} FROM refset_full WHERE effectiveTime = '{CURRENT_RELEASE}'")
def q_release_delta(spark, d):
    return H.delta(fx(spark, d).refset_full, CURRENT_RELEASE)


@query("release_snapshot", snap_sql(None))
def q_release_snapshot(spark, d):
    return H.snapshot(fx(spark, d).refset_full)


@query("snapshot_as_of", snap_sql(PREVIOUS_RELEASE))
def q_snapshot_as_of(spark, d):
    return H.snapshot_as_of(fx(spark, d).refset_full, PREVIOUS_RELEASE)


@query("published_snapshot", f"""
SELECT DISTINCT b.{RF.replace(', ', ', b.')} FROM (SELECT id, refsetId, referencedComponentId, max(effectiveTime) AS mx
  FROM refset_full WHERE effectiveTime <> '{SENTINEL}' GROUP BY id, refsetId, referencedComponentId) a
JOIN refset_full b ON a.mx = b.effectiveTime AND a.id = b.id WHERE b.active = '1'""")
def q_published_snapshot(spark, d):
    return H.published_snapshot(fx(spark, d).refset_full).distinct()


@query("latest_release_rows", """
SELECT DISTINCT b.Cluster_ID, a.refsetId AS Refset_ID, a.referencedComponentId AS SNOMED_concept_ID,
       d.term AS Code_description, a.active AS Active_status, a.effectiveTime
FROM refset_full a
JOIN (SELECT DISTINCT Cluster_ID, Refset_ID FROM clusters) b ON a.refsetId = b.Refset_ID
JOIN (SELECT refsetId, max(effectiveTime) AS mx FROM refset_full GROUP BY refsetId) c
  ON a.refsetId = c.refsetId AND a.effectiveTime = c.mx
LEFT JOIN description d ON a.referencedComponentId = d.conceptId AND d.active = '1' AND d.DescriptionType = 'F'""")
def q_latest_release_rows(spark, d):
    f = fx(spark, d)
    return H.latest_release_rows(f.refset_full, f.clusters, f.description)


@query("release_change_class", f"""
WITH g AS (SELECT refsetId, referencedComponentId, max(active) AS act, max(effectiveTime) AS maxeffectiveTime,
    CASE WHEN max(effectiveTime) = '{CURRENT_RELEASE}' AND max(active) = '1' THEN 'addition'
         WHEN max(effectiveTime) = '{CURRENT_RELEASE}' AND max(active) = '0' THEN 'removal'
         ELSE 'no change' END AS change
  FROM ({snap_sql(CURRENT_RELEASE)}) s WHERE moduleId = '{LOCAL_MODULE}' GROUP BY refsetId, referencedComponentId)
SELECT DISTINCT p.Service_ID || '_' || p.Ruleset_ID AS Service_Ruleset, p.Service_ID, p.Ruleset_ID, p.Ruleset_Version,
  g.refsetId AS Refset_ID, a.Cluster_ID, a.Cluster_Description AS Cluster_description,
  g.referencedComponentId AS SNOMED_concept_ID, d.term AS Code_description, g.maxeffectiveTime, g.change,
  c.active AS code_active
FROM g LEFT JOIN clusters a ON a.Refset_ID = g.refsetId
LEFT JOIN description d ON g.referencedComponentId = d.conceptId AND d.DescriptionType = 'F'
LEFT JOIN concept c ON g.referencedComponentId = c.id
LEFT JOIN (SELECT * FROM cluster_ruleset WHERE Cluster_Ruleset_Date_Inactive IS NULL
           OR Cluster_Ruleset_Date_Inactive > DATE '{AS_OF}') p ON a.Cluster_ID = p.Cluster_ID
WHERE g.change IN ('addition', 'removal')""")
def q_release_change_class(spark, d):
    f = fx(spark, d)
    snap = H.snapshot_as_of(f.refset_full, CURRENT_RELEASE).filter(F.col("moduleId") == LOCAL_MODULE)
    return H.release_change_class(snap, CURRENT_RELEASE, f.clusters, f.description, f.concept,
                                  f.cluster_ruleset, AS_OF)


@query("latest_two_releases", f"""
SELECT DISTINCT effectiveTime AS release_date FROM refset_full WHERE effectiveTime <> '{SENTINEL}'
ORDER BY release_date DESC LIMIT 2""")
def q_latest_two_releases(spark, d):
    return H.latest_releases(H.release_dates(fx(spark, d).refset_full), 2)


def _previous_sql(release: str, months: int) -> str:
    return f"""
SELECT p AS previous_release, CASE WHEN p IS NULL THEN 'none' WHEN try_strptime(p, '%Y%m%d')::DATE
  < DATE '{release[:4]}-{release[4:6]}-{release[6:]}' - INTERVAL {months} MONTH THEN 'too old' ELSE 'ok' END AS status
FROM (SELECT max(effectiveTime) AS p FROM refset_full WHERE effectiveTime <> '{SENTINEL}' AND effectiveTime < '{release}') x"""


#: A release long after the data, whose predecessor lies outside of the look-back.
LATE_RELEASE = "20050101"


@query("previous_release", " UNION ALL ".join(f"SELECT * FROM ({_previous_sql(r, 16)}) p{i}"
                                              for i, r in enumerate((CURRENT_RELEASE, LATE_RELEASE, "19000101"))))
def q_previous_release(spark, d):
    dates = H.release_dates(fx(spark, d).refset_full)
    found = [H.previous_release(dates, r, max_months_back=16) for r in (CURRENT_RELEASE, LATE_RELEASE, "19000101")]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("replace_module_slice", f"""
SELECT 'PCD_Refsets' AS SourceData, * FROM ({snap_sql(CURRENT_RELEASE)}) n WHERE moduleId = '{LOCAL_MODULE}'
UNION ALL
SELECT SourceData, {RF} FROM (SELECT 'UK' AS SourceData, * FROM ({snap_sql(PREVIOUS_RELEASE)}) o) t
WHERE moduleId <> '{LOCAL_MODULE}'""")
def q_replace_module_slice(spark, d):
    f = fx(spark, d)
    target = H.snapshot_as_of(f.refset_full, PREVIOUS_RELEASE).withColumn("SourceData", F.lit("UK"))
    new = H.snapshot_as_of(f.refset_full, CURRENT_RELEASE).filter(F.col("moduleId") == LOCAL_MODULE)
    return H.replace_module_slice(target, new, LOCAL_MODULE, source_label="PCD_Refsets")


@query("retain_releases", f"""
SELECT release_date, CAST(dense_rank() OVER (ORDER BY release_date DESC) AS BIGINT) AS release_rank,
       CASE WHEN dense_rank() OVER (ORDER BY release_date DESC) <= 3 THEN 'keep' ELSE 'drop' END AS action
FROM (SELECT DISTINCT effectiveTime AS release_date FROM refset_full WHERE effectiveTime <> '{SENTINEL}') r""")
def q_retain_releases(spark, d):
    return H.retain_releases(H.release_dates(fx(spark, d).refset_full), 3)


@query("release_membership_counts", f"""
SELECT s.active_status, CAST(coalesce(c.refsets, 0) AS BIGINT) AS refsets
FROM (SELECT '0' AS active_status UNION ALL SELECT '1') s
LEFT JOIN (SELECT active, count(id) AS refsets FROM concept
           WHERE effectiveTime = (SELECT max(sourceEffectiveTime) FROM module_dependency WHERE moduleId = '{CONCEPT_MODULE}')
           GROUP BY active) c ON s.active_status = c.active""")
def q_release_membership_counts(spark, d):
    f = fx(spark, d)
    return H.release_membership_counts(f.concept, f.module_dependency, CONCEPT_MODULE)


@query("active_total", f"""
SELECT active, CAST(count(id) AS BIGINT) AS active_refsets FROM ({snap_sql(CURRENT_RELEASE)}) s
WHERE active = '1' AND moduleId = '{LOCAL_MODULE}' GROUP BY active""")
def q_active_total(spark, d):
    # the local module's snapshot of the release
    snap = H.snapshot_as_of(fx(spark, d).refset_full, CURRENT_RELEASE)
    return H.active_total(snap.filter(F.col("moduleId") == LOCAL_MODULE))
