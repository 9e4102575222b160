"""Reference data -- eligible code lists, de-duplication by preference,
enrichment with names / status / sensitivity, text clean-up, subsets.

All de-duplications are ``row_number() = 1`` windows with a total order
(tie-breakers appended), so results are deterministic on any cluster layout.
Windows are keyed by (code list, refset) or (concept, code list): many small
groups, never one group per code list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relforge.functions import text as T
from relforge.sources.spread import join_by_hot_key, spread


# Fixed values of the reference's reference-data build.
DENY_CLUSTERS = ("GDPPR_COD", "GDPPR2YR_COD", "POBJEC_COD", "POBJECW_COD", "NAOBJEC_COD", "NDAOBJEC_COD",
                 "NACONS_COD", "NDACONS_COD")
ALLOW_CLUSTERS = ("NDABP_COD",)
EXCLUDE_ID_LIKE = "DEMENTIA_%"
INCLUDE_ID_LIKE = "%_COD%"
EXCLUDE_DESCRIPTION_LIKE = "%agreed by the Firearms Working Group based on DVLA driving guidance%"
TO_BE_CONFIRMED = "To be confirmed"
SENSITIVE_REFSETS = ("999004371000000100", "999004351000000109", "999004381000000103", "999004361000000107")
NO_SENSITIVE_DATE = "19000101"
LOCAL_MODULE = "999000011000230102"
NC_COLUMNS = ("Cluster_Category", "Cluster_Desc", "Refset_Description", "ConceptId_Description")
# Fixed value: word list made ASCII before the CSV export (word -> ASCII form).
TRANSLITERATE_WORDS = {"Māori": "Maori"}

REFERENCE_COLUMNS = ["Cluster_Category", "Cluster_ID", "Cluster_Desc", "Active_in_Refset", "Refset_Status_Date",
                     "RefsetId", "Refset_Description", "ConceptId", "ConceptId_Description", "DescriptionType",
                     "Active_Code_Status", "Code_Status_Date", "Type_of_Inclusion", "Sensitive_Status",
                     "Sensitive_Status_Date"]


def eligible_clusters(clusters: DataFrame, as_of: str, deny=DENY_CLUSTERS, allow=ALLOW_CLUSTERS,
                      exclude_description_like: str = EXCLUDE_DESCRIPTION_LIKE) -> DataFrame:
    """Code lists eligible for the reference data (active, or retired within a
    year of ``as_of``, or allow-listed); null category -> 'To be confirmed'."""
    cid, ina = F.col("Cluster_ID"), F.col("Cluster_Date_Inactive")
    year_ago = F.add_months(F.lit(as_of).cast("date"), -12)
    keep = (~cid.isin(list(deny)) & ~cid.like(EXCLUDE_ID_LIKE) & cid.like(INCLUDE_ID_LIKE)
            & ~F.col("Cluster_Description").like(exclude_description_like)
            & (ina.isNull() | (ina >= year_ago) | cid.isin(list(allow)))
            & F.col("Refset_ID").isNotNull() & (F.col("Refset_ID") != "N/A"))
    return (clusters.filter(keep)
                    .select("Cluster_ID", "Refset_ID", "Cluster_Description", "Cluster_Date_Inactive",
                            F.coalesce(F.col("Cluster_Category"), F.lit(TO_BE_CONFIRMED)).alias("Cluster_Category"))
                    .distinct())


def active_over_retired(eligible: DataFrame) -> DataFrame:
    """Per full key, the inactive date is null if any row is active, else the latest."""
    ina = F.col("Cluster_Date_Inactive")
    return (eligible.groupBy("Cluster_ID", "Refset_ID", "Cluster_Description", "Cluster_Category")
                    .agg(F.when(F.max(F.when(ina.isNull(), 1).otherwise(0)) == 0, F.max(ina))
                          .alias("Cluster_Date_Inactive")))


def dedupe_rank(df: DataFrame, keys, order) -> DataFrame:
    """Generic keep-first-per-key (``row_number() = 1``) with an explicit total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedupe_clusters(merged: DataFrame) -> DataFrame:
    """One row per (code list, refset); active (null date) first, then the
    tie-breakers description, category."""
    return dedupe_rank(merged, ["Cluster_ID", "Refset_ID"],
                       [F.col("Cluster_Date_Inactive").asc_nulls_first(),
                        F.col("Cluster_Description").asc_nulls_first(), F.col("Cluster_Category").asc_nulls_first()])


def sensitive_status(refset: DataFrame, sensitive_refsets=SENSITIVE_REFSETS) -> DataFrame:
    """Distinct (component, active, time) rows of the sensitive-code refsets."""
    return (refset.filter(F.col("refsetId").isin(list(sensitive_refsets)))
                  .select(F.col("referencedComponentId").alias("_sc_comp"), F.col("active").alias("_sc_active"),
                          F.col("effectiveTime").alias("_sc_time")).distinct())


def best_sensitive(sc: DataFrame) -> DataFrame:
    """C5 reduced to one row per component: highest active, then latest date.

    C7 ranks sensitivity last and it depends on the component only, so the row C7
    keeps always carries this one; joining it instead of all rows removes the
    fan-out before the dedupe.  ``max(struct)`` is a partial (map-side) aggregate.
    """
    return (sc.groupBy("_sc_comp").agg(F.max(F.struct("_sc_active", "_sc_time")).alias("_b"))
              .select("_sc_comp", F.col("_b._sc_active").alias("_sc_active"), F.col("_b._sc_time").alias("_sc_time")))


def inclusion_type(module_col: str = "moduleId", local_module: str = LOCAL_MODULE) -> Column:
    """C6: 'PC refset' for the local module, else 'Refset'."""
    return F.when(F.col(module_col) == local_module, "PC refset").otherwise("Refset")


def enrich_refset(refset: DataFrame, descriptions: DataFrame, concepts: DataFrame, clusters: DataFrame,
                  sensitive_refsets=SENSITIVE_REFSETS, local_module: str = LOCAL_MODULE,
                  best_sensitive_only: bool = False, distinct: bool = True,
                  sensitive_source: DataFrame | None = None) -> DataFrame:
    """C4 (+C5, C6): every refset member of an eligible list with refset name (inner),
    all active terms of the code (left), code status (left), sensitivity (left); distinct.

    ``sensitive_source``: the snapshot rows of the sensitivity refsets only.  A member
    id belongs to one refset, so filtering the history by refset before the snapshot
    window gives the same rows -- and lets ``refsetId IN (...)`` reach the scan
    instead of snapshotting the whole history a second time.

    ``distinct=False`` when a keep-first dedupe follows: it already returns one of
    any identical rows, so the extra exchange of the DISTINCT is skipped."""
    s = refset.select("refsetId", "referencedComponentId", "active", "effectiveTime", "moduleId")
    names = (descriptions.filter((F.col("active") == "1") & (F.col("DescriptionType") == "F"))
             .select(F.col("conceptId").alias("_rs_id"), F.col("term").alias("Refset_Description")))
    terms = (descriptions.filter(F.col("active") == "1")
             .select(F.col("conceptId").alias("_y_id"), F.col("term").alias("ConceptId_Description"),
                     F.col("DescriptionType").alias("_y_type")))
    c = concepts.select(F.col("id").alias("_c_id"), F.col("active").alias("Active_Code_Status"),
                        F.col("effectiveTime").alias("Code_Status_Date"))
    sc = sensitive_status(refset if sensitive_source is None else sensitive_source, sensitive_refsets)
    if best_sensitive_only:
        sc = best_sensitive(sc)
    # the few code lists get their refset's name first; the members then meet that small
    # result once, and only members of eligible lists reach the description joins
    named = clusters.join(names, clusters.Refset_ID == names._rs_id)
    j = join_by_hot_key(s, named, "refsetId", "Refset_ID", "referencedComponentId")
    # dealt by code over as many tasks as the history needs: the joins below and what removes equal rows share this exchange
    j = spread(j, "referencedComponentId", source=refset)
    j = (j.join(terms, j.referencedComponentId == terms._y_id, "left")
          .join(c, j.referencedComponentId == c._c_id, "left")
          .join(sc, j.referencedComponentId == sc._sc_comp, "left"))
    out = j.select(
        F.coalesce(F.col("Cluster_Category"), F.lit(TO_BE_CONFIRMED)).alias("Cluster_Category"),
        "Cluster_ID", F.col("Cluster_Description").alias("Cluster_Desc"),
        F.col("active").alias("Active_in_Refset"), F.col("effectiveTime").alias("Refset_Status_Date"),
        F.col("refsetId").alias("RefsetId"), "Refset_Description",
        F.col("referencedComponentId").alias("ConceptId"), "ConceptId_Description",
        F.when(F.col("ConceptId_Description").isNull(), "Z").otherwise(F.col("_y_type")).alias("DescriptionType"),
        "Active_Code_Status", "Code_Status_Date",
        inclusion_type("moduleId", local_module).alias("Type_of_Inclusion"),
        F.when(F.col("_sc_time").isNotNull(), F.col("_sc_active")).otherwise(F.lit("0")).alias("Sensitive_Status"),
        F.coalesce(F.col("_sc_time"), F.lit(NO_SENSITIVE_DATE)).alias("Sensitive_Status_Date"),
    )
    return out.distinct() if distinct else out


def dedupe_concepts(enriched: DataFrame) -> DataFrame:
    """One row per (concept, code list): in-refset first, description type
    F < P < S < Z, term; then newest refset status, sensitive active, newest sensitive date."""
    order = [F.col("Active_in_Refset").desc_nulls_last(),
             F.coalesce(F.col("DescriptionType"), F.lit("z")).asc_nulls_first(),
             F.col("ConceptId_Description").asc_nulls_first(),
             F.col("Refset_Status_Date").desc_nulls_last(),
             F.col("Sensitive_Status").desc_nulls_last(),
             F.col("Sensitive_Status_Date").desc_nulls_last(),
             F.col("RefsetId").asc_nulls_first(), F.col("Refset_Description").asc_nulls_first(),
             F.col("Type_of_Inclusion").asc_nulls_first()]
    return dedupe_rank(enriched, ["ConceptId", "Cluster_ID"], order)


def reference_data(refset: DataFrame, descriptions: DataFrame, concepts: DataFrame, clusters: DataFrame,
                   as_of: str, local_module: str = LOCAL_MODULE, sensitive_refsets=SENSITIVE_REFSETS,
                   deny=DENY_CLUSTERS, allow=ALLOW_CLUSTERS,
                   exclude_description_like: str = EXCLUDE_DESCRIPTION_LIKE,
                   sensitive_source: DataFrame | None = None) -> DataFrame:
    """C1 -> C2 -> C3 -> C4 -> C7: the de-duplicated reference data table."""
    cl = dedupe_clusters(active_over_retired(eligible_clusters(clusters, as_of, deny, allow,
                                                                exclude_description_like)))
    return dedupe_concepts(enrich_refset(refset, descriptions, concepts, cl, sensitive_refsets, local_module,
                                         best_sensitive_only=True, distinct=False,
                                         sensitive_source=sensitive_source))


def strip_characters(df: DataFrame, cols=NC_COLUMNS, replace_en_dash: bool = False) -> DataFrame:
    """The ``_nc`` table -- commas removed from the text columns in one projection;
    ``DescriptionType`` is not carried.  The en-dash rule of the reference never
    fires (it is guarded by a comma test after commas are gone); it is optional here."""
    out = df.drop("DescriptionType")
    repl = {c: F.regexp_replace(F.col(c), ",", "") for c in cols}
    if replace_en_dash:
        repl["ConceptId_Description"] = F.regexp_replace(repl["ConceptId_Description"], "–", "-")
    return out.withColumns(repl)


def subset_by_ruleset(nc: DataFrame, cluster_ruleset: DataFrame, ruleset_id: str) -> DataFrame:
    """Rows whose code list is used by ``ruleset_id`` (open link); distinct."""
    ids = cluster_ruleset.filter((F.col("Ruleset_ID") == ruleset_id)
                                 & F.col("Cluster_Ruleset_Date_Inactive").isNull()).select("Cluster_ID")
    # the lists of one ruleset are few: sent to the rows, which would meet list by list otherwise, a hot one in one task
    return nc.join(F.broadcast(ids), "Cluster_ID", "left_semi").distinct()


def transliterate(df: DataFrame, words: dict | None = None) -> DataFrame:
    """Replace listed words by their ASCII form in every string column."""
    words = TRANSLITERATE_WORDS if words is None else words
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: T.transliterate_words(F.col(c), words) for c in text})


def membership_history(refset: DataFrame, history: DataFrame, concepts: DataFrame, descriptions: DataFrame,
                       refset_id: str) -> DataFrame:
    """C11: current membership of one refset with labels, preferred names and the
    first date each code became an active member (min over the full history)."""
    r = refset.filter(F.col("refsetId") == refset_id)
    c = concepts.select(F.col("id").alias("_c_id"), F.col("active").alias("_concept_status"))
    fsn = descriptions.filter((F.col("active") == "1") & (F.col("DescriptionType") == "F"))
    d = fsn.select(F.col("conceptId").alias("_d_id"), F.col("term").alias("fullySpecifiedName"))
    # the refset's own names as one row, so that no join has the one refset id as its key
    own = (fsn.filter(F.col("conceptId") == refset_id)
              .agg(F.sort_array(F.collect_list("term")).alias("_names")).scalar())
    first = (history.filter((F.col("refsetId") == refset_id) & (F.col("active") == "1"))
                    .groupBy(F.col("referencedComponentId").alias("_f_comp"))
                    .agg(F.min("effectiveTime").alias("firstMembershipTime")))
    b = (r.join(c, r.referencedComponentId == c._c_id, "left")
          .join(d, r.referencedComponentId == d._d_id, "left")
          .withColumn("refsetName", F.explode_outer(own)))
    j = b.join(first, b.referencedComponentId == first._f_comp, "left")
    return j.select("referencedComponentId", "firstMembershipTime",
                    F.when(F.col("active") == "1", "member").when(F.col("active") == "0", "exmember")
                     .otherwise("unknown").alias("currentMembership"),
                    F.when(F.col("_concept_status") == "1", "active").when(F.col("_concept_status") == "0", "inactive")
                     .otherwise("unknown").alias("conceptStatus"),
                    "fullySpecifiedName", "refsetName", "refsetId")
