"""Current (static) expanded code lists and ruleset stages.

The reference ran one query per ruleset / service; here each operator is one
join for all keys, and a single ruleset is a filter on the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relforge.operators.diff import CODING_ID, REFSET_TYPE_RULES_STATIC, refset_type, ruleset_lists
from relforge.sources.spread import join_by_hot_key, spread


def ruleset_stage(rulesets: DataFrame, as_of: str, upcoming_needs_open_end: bool = True) -> DataFrame:
    """Live / Upcoming / needs checking; max version per (service, ruleset, dates).

    ``upcoming_needs_open_end=False`` is the first (unused) variant of the reference.
    """
    d = F.lit(as_of).cast("date")
    eff, ina = F.col("Ruleset_Date_Effective"), F.col("Ruleset_Date_Inactive")
    upcoming = eff >= d
    if upcoming_needs_open_end:
        upcoming = upcoming & ina.isNull()
    stage = (F.when((eff <= d) & ((ina >= d) | ina.isNull()), "Live")
              .when(upcoming, "Upcoming").otherwise("Ruleset needs checking"))
    return (rulesets.filter((ina >= d) | ina.isNull())
                    .groupBy("Service_ID", "Ruleset_ID", "Ruleset_Date_Effective", "Ruleset_Date_Inactive")
                    .agg(F.max("Ruleset_Version").alias("Ruleset_Version"))
                    .select(stage.alias("Stage"), "Service_ID", "Ruleset_ID", "Ruleset_Version"))


def staged_clusters(cluster_ruleset: DataFrame, stages: DataFrame) -> DataFrame:
    """Code lists of the staged rulesets (right join: every staged ruleset kept).

    Keys come from the staged side; ``matched`` tells whether any link exists.
    """
    cr = cluster_ruleset.select(F.col("Service_ID").alias("_s"), F.col("Ruleset_ID").alias("_r"),
                                F.col("Ruleset_Version").alias("_v"), "Cluster_ID", "Cluster_Ruleset_Date_Inactive")
    j = cr.join(stages, (cr._s == stages.Service_ID) & (cr._r == stages.Ruleset_ID)
                & (cr._v == stages.Ruleset_Version), "right")
    return j.select("Stage", "Service_ID", "Ruleset_ID", "Ruleset_Version", "Cluster_ID",
                    "Cluster_Ruleset_Date_Inactive", F.col("Cluster_ID").isNotNull().alias("matched"))


def _static(lists: DataFrame, refset: DataFrame, descriptions: DataFrame, concepts: DataFrame,
            key_cols) -> DataFrame:
    """Current content of each (key, code list), one row per code and name.

    Only members of the wanted refsets are reduced to distinct codes and named; they are
    then fanned out to the code lists.  Lists without content come from an anti join
    against the refsets that have members (one row per refset).  Every input is
    de-duplicated first, so the output is distinct by construction -- no DISTINCT
    over the fanned-out rows.
    """
    lists = lists.select(*key_cols, "Cluster_ID", "Cluster_Description", "Refset_ID").distinct()
    wanted = lists.select(F.col("Refset_ID").alias("_wanted")).distinct()
    active = refset.filter(F.col("active") == "1").select("refsetId", "referencedComponentId")
    held = join_by_hot_key(active, wanted, "refsetId", "_wanted", "referencedComponentId", "left_semi")
    members = spread(held, "refsetId", "referencedComponentId", source=refset).distinct()
    d = (descriptions.filter((F.col("active") == "1") & (F.col("DescriptionType") == "F"))
                     .select(F.col("conceptId").alias("_did"), F.col("term").alias("Code_description")).distinct())
    c = concepts.select(F.col("id").alias("_cid"), F.col("active").alias("Active_status")).distinct()
    # names are found over as many tasks as the history needs
    dealt = spread(members, "referencedComponentId", source=refset)
    named = (dealt.join(d, dealt.referencedComponentId == d._did, "left")
                  .join(c, dealt.referencedComponentId == c._cid, "left")
                  .select("refsetId", "referencedComponentId", "Code_description", "Active_status"))
    hit = join_by_hot_key(named, lists, "refsetId", "Refset_ID", "referencedComponentId", source=refset, many=True)
    # asking for the number of codes keeps this branch on the very exchange that the members above come from, which Spark
    # then runs once; one row per refset is left, which AQE broadcasts from its measured size
    have = members.groupBy(F.col("refsetId").alias("_have")).agg(F.count("referencedComponentId").alias("_n")).filter(F.col("_n") >= 0)
    empty = (lists.join(have, lists.Refset_ID == have._have, "left_anti")
                  .select(*key_cols, "Cluster_ID", "Cluster_Description", "Refset_ID",
                          F.lit(None).cast("string").alias("referencedComponentId"),
                          F.lit(None).cast("string").alias("Code_description"),
                          F.lit(None).cast("string").alias("Active_status")))
    cols = [*key_cols, "Cluster_ID", "Cluster_Description", "Refset_ID", "referencedComponentId",
            "Code_description", "Active_status"]
    both = hit.select(*cols).unionByName(empty.select(*cols))
    return both.select(*key_cols, F.lit(CODING_ID).alias("Coding_ID"), "Cluster_ID",
                       F.col("Cluster_Description").alias("Cluster_description"),
                       F.col("referencedComponentId").alias("SNOMED_concept_ID"), "Code_description",
                       refset_type("Refset_ID", REFSET_TYPE_RULES_STATIC).alias("Type_of_Refset"),
                       F.concat(F.lit("^"), F.col("Refset_ID")).alias("Cluster_Code_String"),
                       "Active_status")


def static_by_ruleset(cluster_ruleset: DataFrame, clusters: DataFrame, refset: DataFrame,
                      descriptions: DataFrame, concepts: DataFrame) -> DataFrame:
    """D7 for all rulesets: current content of each ruleset's unretired code lists;
    a list without content keeps one row with a null code."""
    live = clusters.filter(F.col("Cluster_Date_Inactive").isNull()).select("Cluster_ID", "Cluster_Description", "Refset_ID")
    lists = ruleset_lists(cluster_ruleset).join(live, "Cluster_ID")
    return _static(lists, refset, descriptions, concepts, ["Service_ID", "Ruleset_ID", "Ruleset_Version"])


def static_by_service(cluster_ruleset: DataFrame, clusters: DataFrame, refset: DataFrame,
                      descriptions: DataFrame, concepts: DataFrame, requested: DataFrame) -> DataFrame:
    """D8 for the requested (Service_ID, Requested_Version) pairs: lists of the service's
    rulesets at that version or later, unretired list-ruleset links only."""
    live = clusters.filter(F.col("Cluster_Date_Inactive").isNull()).select("Cluster_ID", "Cluster_Description", "Refset_ID")
    links = cluster_ruleset.filter(F.col("Cluster_Ruleset_Date_Inactive").isNull()) \
                           .select("Service_ID", "Ruleset_Version", "Cluster_ID")
    versions = requested.select(F.col("Service_ID").alias("_svc"), "Requested_Version").distinct()
    # equi-join on the service, range condition on the version (bridge tables only)
    picked = links.join(versions, (links.Service_ID == versions._svc)
                        & (links.Ruleset_Version >= versions.Requested_Version))
    lists = picked.select("Service_ID", "Requested_Version", "Cluster_ID").distinct().join(live, "Cluster_ID")
    return _static(lists, refset, descriptions, concepts, ["Service_ID", "Requested_Version"])
