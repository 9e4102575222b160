"""Publication tables of the rulesets published at ``as_of``.

``published(as_of)`` is computed once from the (small) publication table.  E1-E10
join only dimension / bridge tables, so Catalyst picks the strategy freely.  The
only large input is the refset history feeding E11, E12 and E14: it is reduced by
the published-snapshot window (no exchange on the id-bucketed table) and meets
the code lists through a size-checked broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relforge.operators.history import published_snapshot
from relforge.operators.refdata import EXCLUDE_DESCRIPTION_LIKE, EXCLUDE_ID_LIKE, INCLUDE_ID_LIKE

RS_KEYS = ["Service_ID", "Ruleset_ID", "Ruleset_Version"]
# Placeholder rows for code lists whose content is held elsewhere.
PLACEHOLDER_CODE = "Check the SNOMED browser for refset content"
PLACEHOLDER_DESCRIPTION = "Refset not managed or maintained by the PCD team"
LOCAL_REFSET_LIKE = "%100023010%"


def published(ruleset_published: DataFrame, as_of: str, inclusive: bool = False) -> DataFrame:
    """Ruleset keys published at ``as_of``: effective <= as_of and inactive null or
    after as_of (``inclusive``: on or after, as in E1/E2)."""
    d = F.lit(as_of).cast("date")
    ina = F.col("Ruleset_Publication_Inactive")
    later = (ina >= d) if inclusive else (ina > d)
    return (ruleset_published.filter((ina.isNull() | later) & (F.col("Ruleset_Publication_Effective") <= d))
                             .select(*RS_KEYS))


def _on_published(bridge: DataFrame, pub: DataFrame) -> DataFrame:
    return bridge.join(pub, RS_KEYS, "left_semi")


def published_rulesets(rulesets: DataFrame, pub_ge: DataFrame) -> DataFrame:
    """E1 (A): distinct (service, ruleset) with a published version."""
    return rulesets.join(pub_ge, RS_KEYS).select("Service_ID", "Ruleset_ID").distinct()


def published_cluster_ruleset(cluster_ruleset: DataFrame, pub_ge: DataFrame) -> DataFrame:
    """E2 (B)."""
    return _on_published(cluster_ruleset, pub_ge).select(*RS_KEYS, "Cluster_ID").distinct()


def _live(clusters: DataFrame) -> DataFrame:
    return clusters.filter(F.col("Cluster_Date_Inactive").isNull())


def published_clusters(clusters: DataFrame, cluster_ruleset: DataFrame, pub: DataFrame) -> DataFrame:
    """E3 (C): distinct unretired code lists of published rulesets."""
    ids = _on_published(cluster_ruleset, pub).select("Cluster_ID")
    return (_live(clusters).join(ids, "Cluster_ID", "left_semi")
                           .select("Cluster_ID", "Cluster_Description", "Refset_ID").distinct())


def published_output_ruleset(output_ruleset: DataFrame, pub: DataFrame) -> DataFrame:
    """E4 (D)."""
    return _on_published(output_ruleset, pub).select(*RS_KEYS, "Output_ID", "Output_Version").distinct()


def published_outputs(outputs: DataFrame, output_ruleset: DataFrame, pub: DataFrame) -> DataFrame:
    """E5 (E)."""
    keys = _on_published(output_ruleset, pub).select("Output_ID", "Output_Version")
    return (outputs.join(keys, ["Output_ID", "Output_Version"], "left_semi")
                   .select("Output_ID", "Output_Version", "Output_Description", "Output_Type").distinct())


def published_population_ruleset(population_ruleset: DataFrame, pub: DataFrame) -> DataFrame:
    """E6 (F): bag, as in the reference (no DISTINCT)."""
    return (population_ruleset.join(pub, RS_KEYS)
                              .select(*RS_KEYS, "Population_ID", "Population_Version"))


def published_populations(populations: DataFrame, population_ruleset: DataFrame, pub: DataFrame) -> DataFrame:
    """E7 (G)."""
    keys = _on_published(population_ruleset, pub).select("Population_ID", "Population_Version")
    return (populations.join(keys, ["Population_ID", "Population_Version"], "left_semi")
                       .select("Population_ID", "Population_Description", "Population_Version", "Population_Type")
                       .distinct())


def published_cluster_population(cluster_population: DataFrame, population_ruleset: DataFrame,
                                 clusters: DataFrame, pub: DataFrame) -> DataFrame:
    """E8 (H): links of published populations to unretired code lists."""
    keys = _on_published(population_ruleset, pub).select("Population_ID", "Population_Version")
    return (cluster_population.join(keys, ["Population_ID", "Population_Version"], "left_semi")
                              .join(_live(clusters).select("Cluster_ID"), "Cluster_ID", "left_semi")
                              .select("Population_ID", "Population_Version", "Cluster_ID").distinct())


def published_output_population(output_population: DataFrame, population_ruleset: DataFrame,
                                output_ruleset: DataFrame, pub: DataFrame) -> DataFrame:
    """E9 (I): output-population links whose two ends are both published."""
    f = _on_published(population_ruleset, pub).select("Population_ID", "Population_Version")
    e = _on_published(output_ruleset, pub).select("Output_ID", "Output_Version")
    return (output_population.join(f, ["Population_ID", "Population_Version"], "left_semi")
                             .join(e, ["Output_ID", "Output_Version"], "left_semi")
                             .select("Population_ID", "Population_Version", "Output_ID", "Output_Version").distinct())


def published_cluster_output(cluster_output: DataFrame, output_ruleset: DataFrame, clusters: DataFrame,
                             pub: DataFrame) -> DataFrame:
    """E10 (J)."""
    keys = _on_published(output_ruleset, pub).select("Output_ID", "Output_Version")
    return (cluster_output.join(keys, ["Output_ID", "Output_Version"], "left_semi")
                          .join(_live(clusters).select("Cluster_ID"), "Cluster_ID", "left_semi")
                          .select("Output_ID", "Output_Version", "Cluster_ID").distinct())


def _name_filters(df: DataFrame) -> DataFrame:
    cid = F.col("Cluster_ID")
    return df.filter(~cid.like(EXCLUDE_ID_LIKE) & cid.like(INCLUDE_ID_LIKE)
                     & ~F.col("Cluster_Description").like(EXCLUDE_DESCRIPTION_LIKE))


def _fsn(descriptions: DataFrame, alias: str) -> DataFrame:
    return (descriptions.filter((F.col("DescriptionType") == "F") & (F.col("active") == "1"))
                        .select(F.col("conceptId").alias("_sd_id"), F.col("term").alias(alias)))


def _placeholders(clusters: DataFrame, cluster_ruleset: DataFrame, pub: DataFrame, name_filters: bool) -> DataFrame:
    lists = _live(clusters).filter(~F.col("Refset_ID").like(LOCAL_REFSET_LIKE))
    if name_filters:
        lists = _name_filters(lists)
    ids = _on_published(cluster_ruleset, pub).select("Cluster_ID")
    return (lists.join(ids, "Cluster_ID", "left_semi")
                 .select("Cluster_ID", F.col("Refset_ID").alias("PCD_Refset_ID"),
                         F.lit(PLACEHOLDER_CODE).alias("SNOMED_code"),
                         F.lit(PLACEHOLDER_DESCRIPTION).alias("SNOMED_code_description")).distinct())


def cluster_refset_content(history: DataFrame, descriptions: DataFrame, clusters: DataFrame,
                           cluster_ruleset: DataFrame, rulesets: DataFrame, pub: DataFrame) -> DataFrame:
    """E11 (K): published codes of the published code lists (with names), plus a
    placeholder row per list held elsewhere; set union."""
    live_rs = rulesets.join(pub, RS_KEYS).select(*RS_KEYS).distinct()
    ids = cluster_ruleset.join(live_rs, RS_KEYS, "left_semi").select("Cluster_ID")
    lists = _name_filters(_live(clusters)).join(ids, "Cluster_ID", "left_semi") \
                                          .select("Cluster_ID", "Refset_ID").distinct()
    rows = published_snapshot(history)
    sd = _fsn(descriptions, "SNOMED_code_description")
    j = (rows.join(lists, rows.refsetId == lists.Refset_ID)
             .join(sd, rows.referencedComponentId == sd._sd_id, "left"))
    codes = j.select("Cluster_ID", F.col("refsetId").alias("PCD_Refset_ID"),
                     F.col("referencedComponentId").alias("SNOMED_code"), "SNOMED_code_description")
    return codes.unionByName(_placeholders(clusters, cluster_ruleset, pub, True)).distinct()


def refset_content_file(history: DataFrame, descriptions: DataFrame, clusters: DataFrame,
                        cluster_ruleset: DataFrame, pub: DataFrame, sep: str = " | ") -> DataFrame:
    """K for locally held lists plus, per code list, the sorted distinct
    ``service ruleset`` pairs joined by `` | ``."""
    local = (_live(clusters).filter(F.col("Refset_ID").like(LOCAL_REFSET_LIKE))
           .join(_on_published(cluster_ruleset, pub).select("Cluster_ID", "Service_ID", "Ruleset_ID"), "Cluster_ID")
           .select("Cluster_ID", "Cluster_Description", "Refset_ID", "Service_ID", "Ruleset_ID").distinct())
    per_list = (local.groupBy("Cluster_ID")
                   .agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(" ", "Service_ID", "Ruleset_ID"))), sep)
                        .alias("Service_and_Ruleset")))
    e = local.select("Cluster_ID", "Cluster_Description", "Refset_ID").distinct().join(per_list, "Cluster_ID")
    rows = published_snapshot(history)
    c = _fsn(descriptions, "SNOMED_code_description")
    j = (rows.join(e, rows.refsetId == e.Refset_ID)
             .join(c, rows.referencedComponentId == c._sd_id, "left"))
    return j.select("Cluster_ID", F.col("Cluster_Description").alias("Cluster_description"),
                    F.col("referencedComponentId").alias("SNOMED_code"), "SNOMED_code_description",
                    F.col("refsetId").alias("PCD_Refset_ID"), "Service_and_Ruleset").distinct()


def output_lookup(outputs: DataFrame, output_ruleset: DataFrame, populations: DataFrame,
                  population_ruleset: DataFrame, pub: DataFrame) -> DataFrame:
    """Outputs (type O) and populations (type P) of published rulesets; set union."""
    o_r = _on_published(output_ruleset, pub).select("Service_ID", "Ruleset_ID", "Output_ID", "Output_Version")
    o = outputs.join(o_r, ["Output_ID", "Output_Version"]) \
               .select("Service_ID", "Ruleset_ID", "Output_ID", "Output_Description", F.lit("O").alias("Type"))
    p_r = _on_published(population_ruleset, pub).select("Service_ID", "Ruleset_ID", "Population_ID",
                                                         "Population_Version")
    p = populations.join(p_r, ["Population_ID", "Population_Version"]) \
                   .select("Service_ID", "Ruleset_ID", F.col("Population_ID").alias("Output_ID"),
                           F.col("Population_Description").alias("Output_Description"), F.lit("P").alias("Type"))
    return o.unionByName(p).distinct()


def refset_by_output(history: DataFrame, descriptions: DataFrame, clusters: DataFrame,
                     cluster_ruleset: DataFrame, cluster_output: DataFrame, output_ruleset: DataFrame,
                     cluster_population: DataFrame, population_ruleset: DataFrame, pub: DataFrame) -> DataFrame:
    """(output or population) x code list x code, for all unretired lists;
    placeholder rows as K without the name filters."""
    co = (cluster_output.join(_on_published(output_ruleset, pub).select("Output_ID", "Output_Version"),
                              ["Output_ID", "Output_Version"], "left_semi").select("Output_ID", "Cluster_ID"))
    cp = (cluster_population.join(_on_published(population_ruleset, pub)
                                  .select("Population_ID", "Population_Version"),
                                  ["Population_ID", "Population_Version"], "left_semi")
          .select(F.col("Population_ID").alias("Output_ID"), "Cluster_ID"))
    cd = _live(clusters).select("Cluster_ID", "Cluster_Description", "Refset_ID").distinct()
    opc = co.unionByName(cp).join(cd.select("Cluster_ID", "Cluster_Description"), "Cluster_ID") \
            .select("Output_ID", "Cluster_ID", "Cluster_Description").distinct()
    rows = published_snapshot(history, keys="id")
    sd = _fsn(descriptions, "SNOMED_code_description")
    j = (rows.join(cd, rows.refsetId == cd.Refset_ID)
             .join(sd, rows.referencedComponentId == sd._sd_id, "left"))
    content = (j.select("Cluster_ID", F.col("refsetId").alias("PCD_Refset_ID"),
                        F.col("referencedComponentId").alias("SNOMED_code"), "SNOMED_code_description")
                .unionByName(_placeholders(clusters, cluster_ruleset, pub, False)).distinct())
    return (content.join(opc, "Cluster_ID")
                   .select("Output_ID", "Cluster_ID", "Cluster_Description", "SNOMED_code",
                           "SNOMED_code_description", "PCD_Refset_ID"))


def name_map_drift(in_use: DataFrame, id_col: str, names: DataFrame, name_col: str, kind: str) -> DataFrame:
    """Ids in use without a label ('unmapped') and labels no longer used ('unused')."""
    u = in_use.select(F.col(id_col).alias("_u")).distinct()
    m = names.select(F.col(name_col).alias("_m")).distinct()
    j = u.join(m, u._u == m._m, "full_outer")
    return (j.filter(F.col("_u").isNull() | F.col("_m").isNull())
             .select(F.lit(kind).alias("kind"), F.coalesce("_u", "_m").alias("value"),
                     F.when(F.col("_m").isNull(), "unmapped").otherwise("unused").alias("drift")))


def name_map_file(names: DataFrame, order_col: str = "Display_Order") -> DataFrame:
    """The label table without its ordering column."""
    return names.drop(order_col)
