"""Driver queries for D1-D17 (release diff, expanded lists, roll-ups)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from relforge.operators import diff as D
from relforge.operators import history as H
from relforge.operators import lists as L
from relforge.plans.common import (AS_OF, CURRENT_RELEASE, LOCAL_MODULE, PREVIOUS_RELEASE, SCT_REFSET_SQL, fx,
                                   sct_refset, snap_sql, used_sql)
from relforge.plans.registry import query
from relforge.sources.io import scratch_root

# Fixed fixture parameters (FIXTURES.md "Parameter values for fixture runs").
BIG_LISTS = ("C1_COD", "C2_COD")
SUBSET_RULESET = "NATION_1"
OTHER_RULESET = "NATION_2"
MIN_VERSIONS = {"NATION_1": "1.0", "NATION_2": "2.0"}
SERVICES = ("ASIA", "EUROPE")


def content_sql(date: str) -> str:
    """D2 from the definition: the active members of a release in the code lists in use."""
    return f"SELECT * FROM ({snap_sql(date)}) m JOIN ({used_sql}) c ON m.refsetId = c.Refset_ID WHERE m.active = '1'"


# D3 from the definition: which releases hold a code in a list; the list is described as in the older of them.
DIFF_SQL = f"""
WITH held AS (SELECT 1 AS release, * FROM ({content_sql(PREVIOUS_RELEASE)}) a UNION ALL SELECT 2, * FROM ({content_sql(CURRENT_RELEASE)}) b)
SELECT DISTINCT Cluster_ID, Cluster_Description, Refset_ID, referencedComponentId AS SNOMED_concept_ID, ['removed', 'added', 'no change'][sides] AS Outcome
FROM (SELECT *, min(release) OVER code AS since, CAST(bit_or(release) OVER code AS BIGINT) AS sides FROM held
      WINDOW code AS (PARTITION BY Cluster_ID, referencedComponentId)) h WHERE release = since"""

DECORATED_SQL = f"""
SELECT l.Cluster_ID, l.Cluster_Description AS Cluster_description, l.SNOMED_concept_ID, d.term AS Code_description,
  CASE WHEN l.Refset_ID LIKE '%100000110%' THEN 'Drug Refset' WHEN l.Refset_ID LIKE '%100023010%' THEN 'PCD Refset'
       ELSE 'Refset' END AS Type_of_Refset,
  '^' || l.Refset_ID AS Cluster_Code_String, c.active AS Active_status, l.Outcome
FROM ({DIFF_SQL}) l
LEFT JOIN description d ON l.SNOMED_concept_ID = d.conceptId AND d.DescriptionType = 'F' AND d.active = '1'
LEFT JOIN concept c ON l.SNOMED_concept_ID = c.id"""



def stages_sql(stages: list[str]) -> str:
    """D9 from the definition: of the rulesets that have not ended, those under way, those to come, and those to come
    whose end is set already; of several versions over the same days the highest."""
    return f"""
SELECT DISTINCT {stages}[1 + CAST(starts > 0 AS INT) + CAST(starts > 0 AND ends < 1000000 AS INT)] AS Stage, Service_ID, Ruleset_ID, Ruleset_Version
FROM (SELECT *, Ruleset_Date_Effective - DATE '{AS_OF}' AS starts, coalesce(Ruleset_Date_Inactive - DATE '{AS_OF}', 1000000) AS ends FROM rulesets) days
WHERE ends >= 0 QUALIFY rank() OVER (PARTITION BY Service_ID, Ruleset_ID, starts, ends ORDER BY Ruleset_Version DESC) = 1"""


STAGES_SQL = stages_sql(["Live", "Upcoming", "Ruleset needs checking"])

# D10 from the definition: each staged ruleset beside its code lists, alone if it has none.
STAGED_SQL = f"""
SELECT Stage, Service_ID, Ruleset_ID, Ruleset_Version, Cluster_ID, Cluster_Ruleset_Date_Inactive, Cluster_ID IS NOT NULL AS matched
FROM ({STAGES_SQL}) s LEFT JOIN cluster_ruleset USING (Service_ID, Ruleset_ID, Ruleset_Version)"""

COUNTS_SQL = f"""
SELECT Cluster_ID, CAST(count(CASE WHEN Outcome = 'added' THEN 1 END) AS BIGINT) AS additions,
       CAST(count(CASE WHEN Outcome = 'removed' THEN 1 END) AS BIGINT) AS removals,
       CAST(count(CASE WHEN Outcome = 'no change' THEN 1 END) AS BIGINT) AS unchanged
FROM ({DIFF_SQL}) x GROUP BY Cluster_ID
HAVING count(CASE WHEN Outcome IN ('added', 'removed') THEN 1 END) > 0"""

CHANGED_RS_SQL = f"""
SELECT Stage, Service_ID, Ruleset_ID, Ruleset_Version,
       string_agg(DISTINCT Cluster_ID, ',' ORDER BY Cluster_ID) AS changed_clusters,
       CAST(count(DISTINCT Cluster_ID) AS BIGINT) AS n_changed_clusters,
       Service_ID || '_' || Ruleset_ID || '_' || CAST(Ruleset_Version AS VARCHAR) AS UID
FROM ({STAGED_SQL}) s WHERE Cluster_ID IN (SELECT Cluster_ID FROM ({COUNTS_SQL}) c)
GROUP BY Stage, Service_ID, Ruleset_ID, Ruleset_Version"""

STAGE_COUNTS_SQL = f"""
SELECT Stage, CAST(count(UID) AS BIGINT) AS outputs FROM (SELECT DISTINCT Stage, UID FROM ({CHANGED_RS_SQL}) r) x GROUP BY Stage"""

SERVICES_SQL = f"""
SELECT Stage, Service_ID, max(Ruleset_Version) AS Ruleset_Version, CAST(floor(max(Ruleset_Version)) AS INT) AS Version_Floor
FROM ({STAGES_SQL}) s WHERE Service_ID IN ('ASIA', 'EUROPE') GROUP BY Stage, Service_ID"""


# each service's own lists, also where two services share a ruleset id
RULESET_LISTS_SQL = "SELECT DISTINCT Service_ID, Ruleset_ID, Ruleset_Version, Cluster_ID FROM cluster_ruleset"


def _used(f):
    return D.clusters_in_use(f.cluster_ruleset, f.clusters)


def diff_df(f):
    return D.release_diff_from_history(f.refset_full, PREVIOUS_RELEASE, CURRENT_RELEASE, _used(f))


def decorated_df(f):
    return D.decorate_codes(diff_df(f), f.description, f.concept)


def stages_df(f):
    return L.ruleset_stage(f.rulesets, AS_OF)


@query("release_diff", DIFF_SQL)
def q_release_diff(spark, d):
    return diff_df(fx(spark, d))


@query("release_diff_two_inputs", DIFF_SQL)
def q_release_diff_two_inputs(spark, d):
    # D3 over two separately built contents (the general two-table form)
    f = fx(spark, d)
    used = _used(f)
    old = D.merged_content(H.snapshot_as_of(f.refset_full, PREVIOUS_RELEASE).filter(F.col("moduleId") == LOCAL_MODULE),
                           H.snapshot_as_of(f.refset_full, PREVIOUS_RELEASE), LOCAL_MODULE, used)
    new = D.merged_content(H.snapshot_as_of(f.refset_full, CURRENT_RELEASE).filter(F.col("moduleId") == LOCAL_MODULE),
                           H.snapshot_as_of(f.refset_full, CURRENT_RELEASE), LOCAL_MODULE, used)
    return D.release_diff(old, new)


@query("release_diff_stored", DIFF_SQL)
def q_release_diff_stored(spark, d):
    # D3 over two releases stored in the same buckets
    f, mark = fx(spark, d), uuid.uuid4().hex[:12]
    used, stored = _used(f), []
    for date in (PREVIOUS_RELEASE, CURRENT_RELEASE):
        snap = H.snapshot_as_of(f.refset_full, date)
        content = D.merged_content(snap.filter(F.col("moduleId") == LOCAL_MODULE), snap, LOCAL_MODULE, used)
        table = f"relforge_content_{date}_{mark}"
        stored.append(D.store_content(content, table, scratch_root(spark, table), 8))
        spark.sql(f"DROP TABLE {table}")  # an external table: its files and buckets stay
    return D.release_diff_stored(*stored)


@query("clusters_in_use", used_sql)
def q_clusters_in_use(spark, d):
    return _used(fx(spark, d))


@query("merged_content", content_sql(CURRENT_RELEASE))
def q_merged_content(spark, d):
    f = fx(spark, d)
    snap = H.snapshot_as_of(f.refset_full, CURRENT_RELEASE)
    return D.merged_content(snap.filter(F.col("moduleId") == LOCAL_MODULE), snap, LOCAL_MODULE, _used(f))


@query("decorated_diff", DECORATED_SQL)
def q_decorated_diff(spark, d):
    return decorated_df(fx(spark, d))


@query("changed_by_ruleset", f"""
SELECT l.Service_ID, l.Ruleset_ID AS Ruleset, l.Ruleset_Version, 'SNOMED CT' AS Coding_ID, x.*
FROM ({DECORATED_SQL}) x JOIN ({RULESET_LISTS_SQL}) l ON x.Cluster_ID = l.Cluster_ID""")
def q_changed_by_ruleset(spark, d):
    f = fx(spark, d)
    return D.changed_by_ruleset(decorated_df(f), f.cluster_ruleset)


@query("changed_by_service", f"""
SELECT l.Service_ID, l.Ruleset_Version, 'SNOMED CT' AS Coding_ID, x.*
FROM ({DECORATED_SQL}) x
JOIN (SELECT DISTINCT Service_ID, CAST(floor(Ruleset_Version) AS INT) AS Ruleset_Version, Cluster_ID FROM cluster_ruleset) l
  ON x.Cluster_ID = l.Cluster_ID""")
def q_changed_by_service(spark, d):
    f = fx(spark, d)
    return D.changed_by_service(decorated_df(f), f.cluster_ruleset)


@query("changed_clusters", f"SELECT Cluster_ID FROM ({COUNTS_SQL}) c")
def q_changed_clusters(spark, d):
    return D.changed_clusters(diff_df(fx(spark, d)))


@query("outcome_counts", COUNTS_SQL)
def q_outcome_counts(spark, d):
    return D.outcome_counts(diff_df(fx(spark, d)))


@query("ruleset_stage", STAGES_SQL)
def q_ruleset_stage(spark, d):
    return stages_df(fx(spark, d))


@query("ruleset_stage_basic", stages_sql(["Live", "Upcoming", "Upcoming"]))
def q_ruleset_stage_basic(spark, d):
    return L.ruleset_stage(fx(spark, d).rulesets, AS_OF, upcoming_needs_open_end=False)


@query("staged_clusters", STAGED_SQL, iso_dates=("Cluster_Ruleset_Date_Inactive",))
def q_staged_clusters(spark, d):
    f = fx(spark, d)
    return L.staged_clusters(f.cluster_ruleset, stages_df(f))


@query("changed_rulesets", CHANGED_RS_SQL)
def q_changed_rulesets(spark, d):
    f = fx(spark, d)
    return D.changed_rulesets(L.staged_clusters(f.cluster_ruleset, stages_df(f)),
                              D.changed_clusters(diff_df(f)))


@query("stage_counts", STAGE_COUNTS_SQL)
def q_stage_counts(spark, d):
    f = fx(spark, d)
    return D.stage_counts(D.changed_rulesets(L.staged_clusters(f.cluster_ruleset, stages_df(f)),
                                             D.changed_clusters(diff_df(f))))


@query("services_to_publish", SERVICES_SQL)
def q_services_to_publish(spark, d):
    return D.services_to_publish(stages_df(fx(spark, d)), SERVICES)


@query("change_summary", f"""
SELECT 'cluster' AS level, Cluster_ID AS key, 'additions' AS metric, additions AS value FROM ({COUNTS_SQL}) c
UNION ALL SELECT 'cluster', Cluster_ID, 'removals', removals FROM ({COUNTS_SQL}) c
UNION ALL SELECT 'cluster', Cluster_ID, 'unchanged', unchanged FROM ({COUNTS_SQL}) c
UNION ALL SELECT 'ruleset', UID, 'changed_clusters', n_changed_clusters FROM ({CHANGED_RS_SQL}) r
UNION ALL SELECT 'stage', Stage, 'outputs', outputs FROM ({STAGE_COUNTS_SQL}) s
UNION ALL SELECT 'service', Stage || '_' || Service_ID, 'version_floor', CAST(Version_Floor AS BIGINT) FROM ({SERVICES_SQL}) v""")
def q_change_summary(spark, d):
    f = fx(spark, d)
    diff = diff_df(f)
    counts = D.outcome_counts(diff)
    changed_rs = D.changed_rulesets(L.staged_clusters(f.cluster_ruleset, stages_df(f)), counts.select("Cluster_ID"))
    return D.change_summary(counts, changed_rs, D.stage_counts(changed_rs),
                            D.services_to_publish(stages_df(f), SERVICES))


# D17 from its definition: the rows of the publication date in the lists of each kind; big lists are matched with
# the subset ruleset's lists by code and direction, the other ruleset's lists stand alone.
CAUSE_SQL = f"""
WITH kinds AS (
  SELECT 'big' AS kind, Cluster_ID, Refset_ID FROM clusters WHERE Cluster_Date_Inactive IS NULL AND Cluster_ID IN {BIG_LISTS}
  UNION
  SELECT CASE v.Ruleset_ID WHEN '{SUBSET_RULESET}' THEN 'subset' ELSE 'other' END, k.Cluster_ID, k.Refset_ID
  FROM clusters k, cluster_ruleset v
  WHERE k.Cluster_ID = v.Cluster_ID AND k.Cluster_Date_Inactive IS NULL AND k.Cluster_ID NOT IN {BIG_LISTS}
    AND v.Ruleset_Version >= CASE v.Ruleset_ID {" ".join(f"WHEN '{r}' THEN {v}" for r, v in MIN_VERSIONS.items())} END),
moved AS (
  SELECT DISTINCT kind, referencedComponentId AS SNOMED_code, Cluster_ID AS Cluster, effectiveTime AS Date_changes_published,
         if(active = '1', 'added to', 'removed from') AS added_removed
  FROM refset_full, kinds WHERE refsetId = Refset_ID AND effectiveTime IN (SELECT max(effectiveTime) FROM module_dependency)),
explained AS (
  SELECT '{SUBSET_RULESET}' AS Ruleset, m.*, s.Cluster AS due_to_underlying_changes_in
  FROM moved m LEFT JOIN (SELECT * FROM moved WHERE kind = 'subset') s USING (SNOMED_code, added_removed) WHERE m.kind = 'big'
  UNION ALL SELECT '{OTHER_RULESET}', m.*, 'n/a' FROM moved m WHERE m.kind = 'other')
SELECT Ruleset, SNOMED_code, term AS Code_description, added_removed, due_to_underlying_changes_in, Date_changes_published
FROM explained LEFT JOIN (SELECT conceptId, term FROM description WHERE active = '1' AND DescriptionType = 'F') n ON conceptId = SNOMED_code"""


@query("cause_of_change", CAUSE_SQL)
def q_cause_of_change(spark, d):
    f = fx(spark, d)
    return D.cause_of_change(f.refset_full, f.module_dependency, f.cluster_ruleset, f.clusters, f.description,
                             BIG_LISTS, SUBSET_RULESET, OTHER_RULESET, MIN_VERSIONS)


# D7, D8 from their definition: (keys, list) pairs, each list's current codes or one null code, and names.
def _static_sql(keys: list[str], pairs: str) -> str:
    cols = ", ".join(keys)
    return f"""
WITH current_code AS (SELECT DISTINCT refsetId, referencedComponentId AS code FROM ({SCT_REFSET_SQL}) s WHERE active = '1'),
held AS (SELECT DISTINCT {cols}, Cluster_ID, Cluster_Description, Refset_ID FROM ({pairs}) p NATURAL JOIN
         (SELECT Cluster_ID, Cluster_Description, Refset_ID FROM clusters WHERE Cluster_Date_Inactive IS NULL) k),
filled AS (SELECT held.*, code FROM held JOIN current_code ON refsetId = Refset_ID
           UNION ALL SELECT held.*, NULL FROM held WHERE Refset_ID NOT IN (SELECT refsetId FROM current_code))
SELECT DISTINCT {cols}, 'SNOMED CT' AS Coding_ID, Cluster_ID, Cluster_Description AS Cluster_description, code AS SNOMED_concept_ID,
  (SELECT any_value(term) FROM description WHERE conceptId = code AND active = '1' AND DescriptionType = 'F') AS Code_description,
  if(contains(Refset_ID, '100023010'), 'PCD Refset', if(contains(Refset_ID, '1000001'), 'Drug Refset', 'Refset')) AS Type_of_Refset,
  concat('^', Refset_ID) AS Cluster_Code_String, (SELECT any_value(active) FROM concept WHERE id = code) AS Active_status
FROM filled"""


@query("static_by_ruleset", _static_sql(
    ["Service_ID", "Ruleset_ID", "Ruleset_Version"], RULESET_LISTS_SQL))
def q_static_by_ruleset(spark, d):
    f = fx(spark, d)
    return L.static_by_ruleset(f.cluster_ruleset, f.clusters, sct_refset(f),
                               f.description, f.concept)


@query("static_by_service", _static_sql(
    ["Service_ID", "Requested_Version"],
    "SELECT v.Service_ID, v.Ruleset_Version AS Requested_Version, u.Cluster_ID FROM "
    f"(SELECT Service_ID, max(Ruleset_Version) AS Ruleset_Version FROM ({STAGES_SQL}) g WHERE Stage = 'Live' GROUP BY Service_ID) v "
    "JOIN cluster_ruleset u ON u.Service_ID = v.Service_ID AND u.Ruleset_Version >= v.Ruleset_Version "
    "AND u.Cluster_Ruleset_Date_Inactive IS NULL"))
def q_static_by_service(spark, d):
    # one version for each service with a Live ruleset: its highest
    f = fx(spark, d)
    live = stages_df(f).filter(F.col("Stage") == "Live")
    wanted = live.groupBy("Service_ID").agg(F.max("Ruleset_Version").alias("Requested_Version"))
    return L.static_by_service(f.cluster_ruleset, f.clusters, sct_refset(f),
                               f.description, f.concept, wanted)
