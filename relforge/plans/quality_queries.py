"""Driver queries for F1-F13 (checks), B15-B19 (module dependencies), G8/G14 (functions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from relforge.functions import text as T
from relforge.operators import deps as M
from relforge.operators import history as H
from relforge.operators import quality as Q
from relforge.operators import refdata as R
from relforge.plans.common import (AS_OF, CURRENT_RELEASE, LOCAL_MODULE, PREVIOUS_RELEASE, SCT_REFSET_SQL, SENTINEL,
                                   fx, sct_refset, snap_sql)
from relforge.plans.refdata_queries import (ALLOW, DENY, EXCLUDE_DESC, NC_SQL, REF_SQL, SENSITIVE, SUBSET_RULESET,
                                            nc_df, reference_df, reference_sql, sensitive_source)
from relforge.plans.registry import query

MARKER = "é"
LATE_AS_OF = "2002-06-01"
DECISION_AS_OF = "2024-01-31"
DOC_COLS = {"text": "documents text"}

ACCEPTED_RE = "|".join(Q.ACCEPTED_CHARACTERS)  # none of them is a regex metacharacter

# ---------------------------------------------------------------- F1-F10

REF_COLS_SQL = ("Cluster_Category, Cluster_ID, Cluster_Desc, Active_in_Refset, Refset_Status_Date, RefsetId, "
                "Refset_Description, ConceptId, ConceptId_Description, DescriptionType, Active_Code_Status, "
                "Code_Status_Date, Type_of_Inclusion, Sensitive_Status, Sensitive_Status_Date")


# F1 from its definition: a row appears once under each label whose rule it breaks.
RULES_SQL = f"""
SELECT unnest(broken) AS Table_purpose, {REF_COLS_SQL} FROM (
  SELECT *, list_filter([if(ConceptId_Description IS NULL, '{Q.RULE_NULL_TERM}', NULL),
    if(contains(ConceptId_Description, '{MARKER}') OR contains(Refset_Description, '{MARKER}'), '{Q.RULE_SPECIAL}', NULL),
    if(coalesce(Cluster_Category, 'NULL') = 'NULL', '{Q.RULE_NULL_CATEGORY}', NULL)], lambda x: x IS NOT NULL) AS broken
  FROM ({{}}) t) r"""


#: A list without a category gets the text NULL here, as an export would write it, so that the rule fires.
UNLABELLED_SQL = f"SELECT * REPLACE (if(Cluster_Category = '{R.TO_BE_CONFIRMED}', 'NULL', Cluster_Category) AS Cluster_Category) FROM ({REF_SQL}) u"


@query("rule_violations", RULES_SQL.format(UNLABELLED_SQL))
def q_rule_violations(spark, d):
    category = F.col("Cluster_Category")
    ref = reference_df(fx(spark, d)).withColumn("Cluster_Category", F.when(category == R.TO_BE_CONFIRMED, "NULL").otherwise(category))
    return Q.rule_violations(ref, MARKER)


@query("non_ascii_documents", """
SELECT text AS Description_with_Error, 'documents text' AS Table_Col_Location FROM documents
WHERE text IS NOT NULL AND text <> '' AND octet_length(encode(text)) <> length(text)""")
def q_non_ascii_documents(spark, d):
    return Q.non_ascii_values(fx(spark, d).documents, DOC_COLS)


# The check's location labels (comma-stripped GPData table and its ruleset subset).
GPDATA_COLS = {"ConceptId_Description": "GPData ConceptId_Description",
               "Refset_Description": "GPData Refset_Description"}
SUBSET_COLS = {"ConceptId_Description": "GDPRR ConceptId_Description",
               "Refset_Description": "GDPRR Refset_Description"}


def _non_ascii_sql(table_sql: str, col: str, label: str, i: int) -> str:
    return (f"SELECT {col} AS Description_with_Error, '{label}' AS Table_Col_Location FROM ({table_sql}) t{i} "
            f"WHERE {col} IS NOT NULL AND {col} <> '' AND octet_length(encode({col})) <> length({col})")


SUBSET_SQL = f"""SELECT DISTINCT * FROM ({NC_SQL}) n WHERE Cluster_ID IN
  (SELECT Cluster_ID FROM cluster_ruleset WHERE Ruleset_ID = '{SUBSET_RULESET}' AND Cluster_Ruleset_Date_Inactive IS NULL)"""

NON_ASCII_REF_SQL = " UNION ALL ".join(
    [_non_ascii_sql(SUBSET_SQL, c, lbl, i) for i, (c, lbl) in enumerate(SUBSET_COLS.items())]
    + [_non_ascii_sql(NC_SQL, c, lbl, i + 2) for i, (c, lbl) in enumerate(GPDATA_COLS.items())])


def _non_ascii_ref(f):
    nc = nc_df(f)
    subset = R.subset_by_ruleset(nc, f.cluster_ruleset, SUBSET_RULESET)
    return Q.non_ascii_values(subset, SUBSET_COLS).unionByName(Q.non_ascii_values(nc, GPDATA_COLS))


@query("non_ascii_reference", NON_ASCII_REF_SQL)
def q_non_ascii_reference(spark, d):
    return _non_ascii_ref(fx(spark, d))


@query("accepted_characters", f"""
SELECT Description_with_Error, 'documents text' AS Table_Col_Location,
       regexp_matches(Description_with_Error, '{ACCEPTED_RE}') AS Accepted_Character
FROM (SELECT text AS Description_with_Error FROM documents
      WHERE text IS NOT NULL AND text <> '' AND octet_length(encode(text)) <> length(text)) n""")
def q_accepted_characters(spark, d):
    return Q.accepted_characters(Q.non_ascii_values(fx(spark, d).documents, DOC_COLS))


@query("split_by_flag", f"""
SELECT CASE WHEN regexp_matches(Description_with_Error, '{ACCEPTED_RE}') THEN 'accepted' ELSE 'not accepted' END AS list,
       Description_with_Error AS value
FROM ({NON_ASCII_REF_SQL}) n""")
def q_split_by_flag(spark, d):
    return Q.split_by_flag(Q.accepted_characters(_non_ascii_ref(fx(spark, d))))


@query("empty_columns", f"""
SELECT * FROM (
  {" UNION ALL ".join(f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM ({REF_SQL}) t{i}"
                      for i, c in enumerate(REF_COLS_SQL.split(', ')))}
) x WHERE null_count > 0""")
def q_empty_columns(spark, d):
    return Q.empty_columns(reference_df(fx(spark, d)))


@query("blank_strings", """
SELECT 'documents text' AS Table_Col_Location,
       CAST(count(CASE WHEN coalesce(text, '') = '' THEN 1 END) AS BIGINT) AS blank_count FROM documents""")
def q_blank_strings(spark, d):
    return Q.blank_strings(fx(spark, d).documents, DOC_COLS)


@query("newline_columns", """
SELECT * FROM (
  SELECT 'text' AS column, CAST(count(CASE WHEN contains(text, chr(10)) THEN 1 END) AS BIGINT) AS rows FROM documents
  UNION ALL SELECT 'lang', CAST(count(CASE WHEN contains(lang, chr(10)) THEN 1 END) AS BIGINT) FROM documents
  UNION ALL SELECT 'source', CAST(count(CASE WHEN contains(source, chr(10)) THEN 1 END) AS BIGINT) FROM documents
) x WHERE rows > 0""")
def q_newline_columns(spark, d):
    return Q.newline_columns(fx(spark, d).documents)


@query("newline_rows", """
SELECT doc_id, 'text' AS column FROM documents WHERE contains(text, chr(10))
UNION ALL SELECT doc_id, 'lang' FROM documents WHERE contains(lang, chr(10))
UNION ALL SELECT doc_id, 'source' FROM documents WHERE contains(source, chr(10))""")
def q_newline_rows(spark, d):
    return Q.newline_rows(fx(spark, d).documents, "doc_id")


COUNTS_SQL = "SELECT CAST(count(DISTINCT Cluster_ID) AS BIGINT) AS Number_of_clusters, " \
             "CAST(count(Cluster_ID) AS BIGINT) AS Number_of_rows FROM ({}) r"


@query("cluster_row_counts", COUNTS_SQL.format(REF_SQL))
def q_cluster_row_counts(spark, d):
    return Q.cluster_row_counts(reference_df(fx(spark, d)))


PREV_REF_SQL = reference_sql(snap_sql(PREVIOUS_RELEASE))


@query("release_trend", f"""
SELECT Number_of_clusters, Number_of_rows, Code_release,
       CAST(Number_of_clusters - lag(Number_of_clusters) OVER (ORDER BY o) AS DOUBLE) AS Clusters_Difference,
       CASE WHEN lag(Number_of_clusters) OVER (ORDER BY o) IS NULL THEN NULL
            ELSE Number_of_clusters - lag(Number_of_clusters) OVER (ORDER BY o) >= 0 END AS ok
FROM (SELECT *, 'Previous' AS Code_release, 0 AS o FROM ({COUNTS_SQL.format(PREV_REF_SQL)}) p
      UNION ALL SELECT *, 'Current', 1 FROM ({COUNTS_SQL.format(REF_SQL)}) c) t""")
def q_release_trend(spark, d):
    f = fx(spark, d)
    prev = R.reference_data(H.snapshot_as_of(f.refset_full, PREVIOUS_RELEASE), f.description, f.concept, f.clusters,
                            AS_OF, LOCAL_MODULE, SENSITIVE, DENY, ALLOW, EXCLUDE_DESC,
                            sensitive_source(f, PREVIOUS_RELEASE))
    return Q.release_trend(Q.cluster_row_counts(prev), Q.cluster_row_counts(reference_df(f)))


# the merged table after its local slice was replaced, against the release's own snapshot.
@query("reconcile", f"""
WITH merged AS (SELECT * FROM ({snap_sql(PREVIOUS_RELEASE)}) o WHERE moduleId <> '{LOCAL_MODULE}'
                UNION ALL SELECT * FROM ({snap_sql(CURRENT_RELEASE)}) n WHERE moduleId = '{LOCAL_MODULE}'),
side AS (SELECT 'a' AS which, * FROM merged UNION ALL SELECT 'b', * FROM ({snap_sql(CURRENT_RELEASE)}) s),
figure AS (SELECT which, unnest(['distinct_effective_times', 'distinct_components']) AS metric,
                  unnest([count(DISTINCT effectiveTime), count(DISTINCT referencedComponentId)]) AS n
           FROM side WHERE moduleId = '{LOCAL_MODULE}' GROUP BY which)
SELECT metric, CAST(a.n AS BIGINT) AS value_a, CAST(b.n AS BIGINT) AS value_b, a.n = b.n AS equal
FROM figure a JOIN figure b USING (metric) WHERE a.which = 'a' AND b.which = 'b'""")
def q_reconcile(spark, d):
    f = fx(spark, d)
    release = H.snapshot_as_of(f.refset_full, CURRENT_RELEASE).filter(F.col("moduleId") == LOCAL_MODULE)
    merged = H.replace_module_slice(H.snapshot_as_of(f.refset_full, PREVIOUS_RELEASE), release, LOCAL_MODULE)
    return Q.reconcile(merged.filter(F.col("moduleId") == LOCAL_MODULE), release)


# F11 from its definition: open publications with the state of the version they publish.
def _issues_sql(as_of: str) -> str:
    return f"""
WITH version AS (SELECT Service_ID, Ruleset_ID, max(Ruleset_Version) AS Latest_version FROM rulesets GROUP BY ALL),
listed AS (SELECT DISTINCT *, true AS found FROM (SELECT Service_ID, Ruleset_ID, Ruleset_Version, Ruleset_Date_Inactive FROM rulesets) q)
SELECT DISTINCT Service_ID, Ruleset_ID, Ruleset_Version, Ruleset_Publication_Effective, Ruleset_Date_Inactive, Latest_version,
  if(Ruleset_Date_Inactive IS NULL, '{Q.LABEL_ACTIVE}', if(Ruleset_Date_Inactive > DATE '{as_of}', '{Q.LABEL_ONGOING}', '{Q.LABEL_ISSUE}'))
    AS Publication_issues, coalesce(found, false) AS matched
FROM (SELECT * FROM ruleset_published WHERE Ruleset_Publication_Inactive IS NULL) p
LEFT JOIN listed USING (Service_ID, Ruleset_ID, Ruleset_Version) LEFT JOIN version USING (Service_ID, Ruleset_ID)"""


PUB_DATES = ("Ruleset_Publication_Effective", "Ruleset_Date_Inactive")


def _level_sql(as_of: str, release: str) -> str:
    rel = f"DATE '{release[:4]}-{release[4:6]}-{release[6:]}'"
    return f"""
SELECT CAST(CASE WHEN max(CASE WHEN contains(lower(Publication_issues), 'issue') THEN 1 ELSE 0 END) = 1 THEN 1
            WHEN max(CASE WHEN contains(lower(Publication_issues), 'still ongoing') THEN 1 ELSE 0 END) = 1 THEN
                 CASE WHEN max(CASE WHEN Ruleset_Date_Inactive <= {rel} THEN 1 ELSE 0 END) = 1 THEN 2 ELSE 0 END
            WHEN count(CASE WHEN contains(lower(Publication_issues), 'active ruleset') THEN 1 END) = count(*) THEN 0
            ELSE 1 END AS INT) AS error_level
FROM ({_issues_sql(as_of)}) i"""


@query("publication_issues", _issues_sql(AS_OF), iso_dates=PUB_DATES)
def q_publication_issues(spark, d):
    f = fx(spark, d)
    return Q.publication_issues(f.ruleset_published, f.rulesets, AS_OF)


@query("publication_issues_late", _issues_sql(LATE_AS_OF), iso_dates=PUB_DATES)
def q_publication_issues_late(spark, d):
    f = fx(spark, d)
    return Q.publication_issues(f.ruleset_published, f.rulesets, LATE_AS_OF)


@query("publication_error_level", _level_sql(AS_OF, CURRENT_RELEASE))
def q_publication_error_level(spark, d):
    f = fx(spark, d)
    return Q.publication_error_level(Q.publication_issues(f.ruleset_published, f.rulesets, AS_OF), CURRENT_RELEASE)


@query("publication_error_level_late", _level_sql(LATE_AS_OF, "20020601"))
def q_publication_error_level_late(spark, d):
    f = fx(spark, d)
    return Q.publication_error_level(Q.publication_issues(f.ruleset_published, f.rulesets, LATE_AS_OF), "20020601")


@query("retired_recently", f"""
SELECT * FROM decision_log WHERE Final_Decision = 'Retire'
AND try_strptime(Date_Actioned, '%Y%m%d')::DATE BETWEEN DATE '{DECISION_AS_OF}' - 14 AND DATE '{DECISION_AS_OF}'""")
def q_retired_recently(spark, d):
    return Q.retired_recently(fx(spark, d).decision_log, DECISION_AS_OF, 14)


# ---------------------------------------------------------------- B15-B19

# B15 from its definition: the modules of all member components, their group and latest source date.
_GROUP_ROWS = ", ".join(f"('{m}', '{label}')" for label, modules in M.RELEASE_TYPES for m in modules)
DEP_SUMMARY_SQL = f"""
WITH reached AS (SELECT DISTINCT moduleId FROM (SELECT DISTINCT referencedComponentId AS id FROM refset_full) g LEFT JOIN concept USING (id)),
dated AS (SELECT moduleId, max(sourceEffectiveTime) AS sourceEffectiveTime FROM module_dependency WHERE active = '1' GROUP BY moduleId),
labelled(moduleId, label) AS (VALUES {_GROUP_ROWS})
SELECT coalesce(label, '{M.OTHER_TYPE}') AS ReleaseType, moduleId, sourceEffectiveTime
FROM reached LEFT JOIN dated USING (moduleId) LEFT JOIN labelled USING (moduleId)"""

FILLED_SQL = f"""
WITH summary AS ({DEP_SUMMARY_SQL}),
given AS (SELECT * REPLACE (coalesce(sourceEffectiveTime, if(moduleId = '{M.NULL_DATE_MODULE}',
          (SELECT max(sourceEffectiveTime) FROM summary WHERE moduleId = '{M.SIBLING_MODULE}'), NULL)) AS sourceEffectiveTime) FROM summary)
SELECT ReleaseType, moduleId, sourceEffectiveTime, sourceEffectiveTime IS NULL AS needs_input FROM given"""


def _dep_summary(f):
    return M.dependency_summary(f.refset_full, f.concept, f.module_dependency)


@query("dependency_summary", DEP_SUMMARY_SQL)
def q_dependency_summary(spark, d):
    return _dep_summary(fx(spark, d))


@query("dependency_filled", FILLED_SQL)
def q_dependency_filled(spark, d):
    return M.fill_dependency_date(_dep_summary(fx(spark, d)))


@query("dependency_insert", f"""
WITH cand AS (SELECT b.Unique_ID_Generated AS id, '{SENTINEL}' AS effectiveTime, '1' AS active, b.moduleId, b.refsetId,
                     b.conceptId AS referencedComponentId, '{SENTINEL}' AS sourceEffectiveTime,
                     s.sourceEffectiveTime AS targetEffectiveTime
              FROM id_table b JOIN ({FILLED_SQL}) s ON b.conceptId = s.moduleId
              WHERE b.moduleId = '{LOCAL_MODULE}' AND b.refsetId = '900000000000534007' AND s.sourceEffectiveTime IS NOT NULL)
SELECT * FROM module_dependency
UNION ALL
SELECT * FROM cand WHERE NOT EXISTS (SELECT 1 FROM module_dependency t WHERE t.effectiveTime = cand.effectiveTime
  AND t.active = cand.active AND t.moduleId = cand.moduleId AND t.refsetId = cand.refsetId
  AND t.referencedComponentId = cand.referencedComponentId AND t.sourceEffectiveTime = cand.sourceEffectiveTime
  AND t.targetEffectiveTime = cand.targetEffectiveTime)""")
def q_dependency_insert(spark, d):
    f = fx(spark, d)
    cand = M.dependency_candidates(f.id_table, M.fill_dependency_date(_dep_summary(f)), LOCAL_MODULE)
    return M.insert_if_absent(f.module_dependency, cand, M.DEPENDENCY_KEYS)


@query("dependency_rows", f"""
SELECT effectiveTime, active, moduleId, refsetId, referencedComponentId, sourceEffectiveTime, targetEffectiveTime
FROM module_dependency WHERE effectiveTime = '{CURRENT_RELEASE}'""")
def q_dependency_rows(spark, d):
    return M.dependency_rows_at(fx(spark, d).module_dependency, CURRENT_RELEASE)


@query("dependency_dates", f"""
SELECT w.ReleaseType, coalesce(max(f.sourceEffectiveTime), '') AS release_date
FROM (SELECT 'Drug' AS ReleaseType UNION ALL SELECT 'International' UNION ALL SELECT 'Pathology') w
LEFT JOIN ({FILLED_SQL}) f ON f.ReleaseType = w.ReleaseType GROUP BY w.ReleaseType""")
def q_dependency_dates(spark, d):
    return M.pick_release_dates(M.fill_dependency_date(_dep_summary(fx(spark, d))))


# ---------------------------------------------------------------- G8, G14

@query("date_formats", """
SELECT effectiveTime, d IS NOT NULL AS valid, strftime(d, '%d %B %Y') AS ddMonthYYYY, strftime(d, '%Y%m%d') AS YYYYMMDD,
       strftime(d, '%Y') AS YYYY, strftime(d, '%b%y') AS MonYY, strftime(d, '%d.%m.%y') AS ddmmyy,
       strftime(d, '%Y-%m-%d') AS YmdDashes
FROM (SELECT effectiveTime, CASE WHEN length(effectiveTime) = 8 THEN try_strptime(effectiveTime, '%Y%m%d')::DATE END AS d
      FROM (SELECT DISTINCT effectiveTime FROM refset_full) r) x""")
def q_date_formats(spark, d):
    return T.date_formats(fx(spark, d).refset_full.select("effectiveTime").distinct(), "effectiveTime")


@query("string_list", """
SELECT Cluster_ID, string_agg(DISTINCT Service_ID || ' ' || Ruleset_ID, ' | ' ORDER BY Service_ID || ' ' || Ruleset_ID)
       AS Rulesets
FROM cluster_ruleset GROUP BY Cluster_ID""")
def q_string_list(spark, d):
    cr = fx(spark, d).cluster_ruleset
    return cr.groupBy("Cluster_ID").agg(T.ordered_distinct_join(F.concat_ws(" ", "Service_ID", "Ruleset_ID"))
                                        .alias("Rulesets"))
