"""Driver queries for E1-E16 (publication tables)."""

from __future__ import annotations

from relforge.operators import publish as P
from relforge.plans.common import AS_OF, fx, pub_sql
from relforge.plans.registry import query


def _pub(f, inclusive=False):
    return P.published(f.ruleset_published, AS_OF, inclusive)


# Oracles from the definitions: "published" is a set of ruleset keys, and every table is restricted to it.
KEYS = "(Service_ID, Ruleset_ID, Ruleset_Version)"


def _published(inclusive: bool = False) -> str:
    """Keys open at the clock; a publication that ends on that very day counts only where inclusive."""
    end = "coalesce(Ruleset_Publication_Inactive, DATE '9999-12-31')"
    return (f"(SELECT Service_ID, Ruleset_ID, Ruleset_Version FROM ruleset_published WHERE Ruleset_Publication_Effective <= DATE '{AS_OF}' "
            f"AND {end} {'>=' if inclusive else '>'} DATE '{AS_OF}')")


LIVE = "Cluster_Date_Inactive IS NULL"
USED_LISTS = f"(SELECT Cluster_ID FROM cluster_ruleset WHERE {KEYS} IN {_published()})"
OUTPUT_KEYS = f"(SELECT Output_ID, Output_Version FROM output_ruleset WHERE {KEYS} IN {_published()})"
POPULATION_KEYS = f"(SELECT Population_ID, Population_Version FROM population_ruleset WHERE {KEYS} IN {_published()})"
LIVE_LISTS = f"(SELECT Cluster_ID FROM clusters WHERE {LIVE})"
NAMED = f"NOT starts_with(Cluster_ID, 'DEMENTIA_') AND contains(Cluster_ID, '_COD') AND NOT contains(Cluster_Description, '{P.EXCLUDE_DESCRIPTION_LIKE.strip('%')}')"


def _codes(snapshot_sql: str, lists_sql: str) -> str:
    """(list columns, code, its name, its refset) of published codes in the given lists."""
    return (f"SELECT own.*, refsetId AS PCD_Refset_ID, referencedComponentId AS SNOMED_code, term AS SNOMED_code_description "
            f"FROM ({lists_sql}) own JOIN ({snapshot_sql}) held ON refsetId = Refset_ID "
            f"LEFT JOIN (SELECT conceptId, term FROM description WHERE active = '1' AND DescriptionType = 'F') n ON conceptId = referencedComponentId")


def _elsewhere(named: str) -> str:
    """One placeholder row for each used live list whose refset another body holds."""
    return (f"SELECT Cluster_ID, Refset_ID, '{P.PLACEHOLDER_CODE}', '{P.PLACEHOLDER_DESCRIPTION}' FROM clusters "
            f"WHERE {LIVE} AND NOT contains(Refset_ID, '100023010') AND Cluster_ID IN {USED_LISTS} AND {named}")


@query("published_rulesets", f"SELECT DISTINCT Service_ID, Ruleset_ID FROM rulesets WHERE {KEYS} IN {_published(True)}")
def q_published_rulesets(spark, d):
    f = fx(spark, d)
    return P.published_rulesets(f.rulesets, _pub(f, True))


@query("published_cluster_ruleset", f"SELECT DISTINCT Service_ID, Ruleset_ID, Ruleset_Version, Cluster_ID FROM cluster_ruleset WHERE {KEYS} IN {_published(True)}")
def q_published_cluster_ruleset(spark, d):
    f = fx(spark, d)
    return P.published_cluster_ruleset(f.cluster_ruleset, _pub(f, True))


@query("published_clusters", f"SELECT DISTINCT Cluster_ID, Cluster_Description, Refset_ID FROM clusters WHERE {LIVE} AND Cluster_ID IN {USED_LISTS}")
def q_published_clusters(spark, d):
    f = fx(spark, d)
    return P.published_clusters(f.clusters, f.cluster_ruleset, _pub(f))


@query("published_output_ruleset", f"SELECT DISTINCT Service_ID, Ruleset_ID, Ruleset_Version, Output_ID, Output_Version FROM output_ruleset WHERE {KEYS} IN {_published()}")
def q_published_output_ruleset(spark, d):
    f = fx(spark, d)
    return P.published_output_ruleset(f.output_ruleset, _pub(f))


@query("published_outputs", f"SELECT DISTINCT Output_ID, Output_Version, Output_Description, Output_Type FROM outputs WHERE (Output_ID, Output_Version) IN {OUTPUT_KEYS}")
def q_published_outputs(spark, d):
    f = fx(spark, d)
    return P.published_outputs(f.outputs, f.output_ruleset, _pub(f))


# a bag: as many rows as there are open publications of the key
@query("published_population_ruleset", f"SELECT * FROM population_ruleset NATURAL JOIN {_published()} k")
def q_published_population_ruleset(spark, d):
    f = fx(spark, d)
    return P.published_population_ruleset(f.population_ruleset, _pub(f))


@query("published_populations", f"""
SELECT DISTINCT Population_ID, Population_Description, Population_Version, Population_Type FROM populations
WHERE (Population_ID, Population_Version) IN {POPULATION_KEYS}""")
def q_published_populations(spark, d):
    f = fx(spark, d)
    return P.published_populations(f.populations, f.population_ruleset, _pub(f))


@query("published_cluster_population", f"""
SELECT DISTINCT Population_ID, Population_Version, Cluster_ID FROM cluster_population
WHERE (Population_ID, Population_Version) IN {POPULATION_KEYS} AND Cluster_ID IN {LIVE_LISTS}""")
def q_published_cluster_population(spark, d):
    f = fx(spark, d)
    return P.published_cluster_population(f.cluster_population, f.population_ruleset, f.clusters, _pub(f))


@query("published_output_population", f"""
SELECT DISTINCT Population_ID, Population_Version, Output_ID, Output_Version FROM output_population
WHERE (Population_ID, Population_Version) IN {POPULATION_KEYS} AND (Output_ID, Output_Version) IN {OUTPUT_KEYS}""")
def q_published_output_population(spark, d):
    f = fx(spark, d)
    return P.published_output_population(f.output_population, f.population_ruleset, f.output_ruleset, _pub(f))


@query("published_cluster_output", f"""
SELECT DISTINCT Output_ID, Output_Version, Cluster_ID FROM cluster_output
WHERE (Output_ID, Output_Version) IN {OUTPUT_KEYS} AND Cluster_ID IN {LIVE_LISTS}""")
def q_published_cluster_output(spark, d):
    f = fx(spark, d)
    return P.published_cluster_output(f.cluster_output, f.output_ruleset, f.clusters, _pub(f))


KNOWN_KEYS = f"(SELECT Service_ID, Ruleset_ID, Ruleset_Version FROM rulesets WHERE {KEYS} IN {_published()})"


@query("cluster_refset_content", f"""
SELECT Cluster_ID, PCD_Refset_ID, SNOMED_code, SNOMED_code_description FROM ({_codes(pub_sql(),
    f"SELECT DISTINCT Cluster_ID, Refset_ID FROM clusters WHERE {LIVE} AND {NAMED} AND Cluster_ID IN "
    f"(SELECT Cluster_ID FROM cluster_ruleset WHERE {KEYS} IN {KNOWN_KEYS})")}) c
UNION {_elsewhere(NAMED)}""")
def q_cluster_refset_content(spark, d):
    f = fx(spark, d)
    return P.cluster_refset_content(f.refset_full, f.description, f.clusters, f.cluster_ruleset, f.rulesets, _pub(f))


USERS_SQL = f"""SELECT Cluster_ID, array_to_string(list_sort(list_distinct(list(Service_ID || ' ' || Ruleset_ID))), ' | ') AS Service_and_Ruleset
FROM cluster_ruleset WHERE {KEYS} IN {_published()} GROUP BY Cluster_ID"""


@query("refset_content_file", f"""
SELECT DISTINCT Cluster_ID, Cluster_Description AS Cluster_description, SNOMED_code, SNOMED_code_description, PCD_Refset_ID, Service_and_Ruleset
FROM ({_codes(pub_sql(), f"SELECT * FROM (SELECT Cluster_ID, Cluster_Description, Refset_ID FROM clusters WHERE {LIVE} "
                         f"AND contains(Refset_ID, '100023010')) h JOIN ({USERS_SQL}) u USING (Cluster_ID)")}) c""")
def q_refset_content_file(spark, d):
    f = fx(spark, d)
    return P.refset_content_file(f.refset_full, f.description, f.clusters, f.cluster_ruleset, _pub(f))


@query("output_lookup", f"""
SELECT Service_ID, Ruleset_ID, Output_ID, Output_Description, 'O' AS Type
FROM outputs NATURAL JOIN (SELECT * FROM output_ruleset WHERE {KEYS} IN {_published()}) used
UNION
SELECT Service_ID, Ruleset_ID, Population_ID, Population_Description, 'P'
FROM populations NATURAL JOIN (SELECT * FROM population_ruleset WHERE {KEYS} IN {_published()}) used""")
def q_output_lookup(spark, d):
    f = fx(spark, d)
    return P.output_lookup(f.outputs, f.output_ruleset, f.populations, f.population_ruleset, _pub(f))


@query("refset_by_output", f"""
WITH pair AS (SELECT Output_ID, Cluster_ID FROM cluster_output WHERE (Output_ID, Output_Version) IN {OUTPUT_KEYS}
              UNION SELECT Population_ID, Cluster_ID FROM cluster_population WHERE (Population_ID, Population_Version) IN {POPULATION_KEYS}),
described AS (SELECT DISTINCT Output_ID, Cluster_ID, Cluster_Description FROM pair JOIN clusters USING (Cluster_ID) WHERE {LIVE}),
content AS (SELECT Cluster_ID, PCD_Refset_ID, SNOMED_code, SNOMED_code_description
            FROM ({_codes(pub_sql(('id',)), f"SELECT DISTINCT Cluster_ID, Refset_ID FROM clusters WHERE {LIVE}")}) c
            UNION {_elsewhere('true')})
SELECT Output_ID, Cluster_ID, Cluster_Description, SNOMED_code, SNOMED_code_description, PCD_Refset_ID FROM described JOIN content USING (Cluster_ID)""")
def q_refset_by_output(spark, d):
    f = fx(spark, d)
    return P.refset_by_output(f.refset_full, f.description, f.clusters, f.cluster_ruleset, f.cluster_output,
                              f.output_ruleset, f.cluster_population, f.population_ruleset, _pub(f))


def _drift_sql(kind: str, used: str, names: str, label: str) -> str:
    return (f"SELECT '{kind}' AS kind, value, if(value IN (SELECT {label} FROM {names}), 'unused', 'unmapped') AS drift FROM "
            f"((SELECT {used} AS value FROM rulesets WHERE {KEYS} IN {_published(True)} EXCEPT SELECT {label} FROM {names}) UNION "
            f"(SELECT {label} FROM {names} EXCEPT SELECT {used} FROM rulesets WHERE {KEYS} IN {_published(True)})) x")


@query("name_map_drift", _drift_sql("service", "Service_ID", "service_names", "Service") + " UNION ALL "
       + _drift_sql("ruleset", "Ruleset_ID", "ruleset_names", "Ruleset"))
def q_name_map_drift(spark, d):
    f = fx(spark, d)
    a = P.published_rulesets(f.rulesets, _pub(f, True))
    return (P.name_map_drift(a, "Service_ID", f.service_names, "Service", "service")
            .unionByName(P.name_map_drift(a, "Ruleset_ID", f.ruleset_names, "Ruleset", "ruleset")))


@query("name_map_file", "SELECT Service, Service_Full_Name FROM service_names")
def q_name_map_file(spark, d):
    return P.name_map_file(fx(spark, d).service_names)
