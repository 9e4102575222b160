"""Release-to-release diff of code lists and its roll-ups.

Plan shape for the diff (the expensive part at scale):
  history --(1 exchange on id)--> both snapshots in one window pass
          --(join, sized at runtime by AQE)--> code lists in use
          --(1 exchange on (component, cluster))--> outcome per code
The full outer join of the reference is expressed as a tagged union + one
window, so the two sides are not shuffled separately and the final DISTINCT
reuses the same partitioning.  A code list holding a third of all rows is
spread over (component, cluster) keys, so no task receives a whole list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relforge.operators.history import two_snapshots

# Ordered LIKE rules that label a refset id (first match wins).
REFSET_TYPE_RULES_DIFF = (("%100000110%", "Drug Refset"), ("%100023010%", "PCD Refset"))
REFSET_TYPE_RULES_STATIC = (("%100023010%", "PCD Refset"), ("%1000001%", "Drug Refset"))
REFSET_TYPE_DEFAULT = "Refset"
CODING_ID = "SNOMED CT"
#: Rulesets to which one shuffled row is copied at most, where rows are dealt to be written by ruleset.
COPIES = 8
#: Parts, by code, in which the rows of a list are dealt then: AQE splits what it shuffles by the tasks that the rows come from, and a hot list may come from one.
DEALT_PARTS = 32

def refset_type(col, rules=REFSET_TYPE_RULES_DIFF, default: str = REFSET_TYPE_DEFAULT):
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for pattern, label in rules:
        expr = F.when(c.like(pattern), label) if expr is None else expr.when(c.like(pattern), label)
    return expr.otherwise(default)


def clusters_in_use(cluster_ruleset: DataFrame, clusters: DataFrame) -> DataFrame:
    """Distinct unretired code lists attached to any ruleset."""
    live = clusters.filter(F.col("Cluster_Date_Inactive").isNull()) \
                   .select("Cluster_ID", "Cluster_Description", "Refset_ID")
    used = cluster_ruleset.select("Cluster_ID").distinct()
    return live.join(used, "Cluster_ID", "left_semi").distinct()


def merged_content(local_snap: DataFrame, external_snap: DataFrame, local_module: str,
                   used_clusters: DataFrame) -> DataFrame:
    """Local snapshot + every external row not of the local module, in a used
    code list, active only."""
    merged = local_snap.distinct().unionByName(external_snap.filter(F.col("moduleId") != local_module))
    merged = merged.filter(F.col("active") == "1")
    return merged.join(used_clusters, merged.refsetId == used_clusters.Refset_ID)


#: What a diff compares by.
DIFF_KEYS = ("referencedComponentId", "Cluster_ID")


def _diff_tagged(t: DataFrame) -> DataFrame:
    """Core of D3 over a tagged union (columns of DIFF key/attrs + ``_o``/``_n`` ints).

    Keys present on both sides are ``no change``; old-only ``removed``; new-only
    ``added`` (attributes from the old side when it exists).  As in the outer join,
    a NULL component or code list never matches: such a row is ``removed`` if old
    and ``added`` if new.  Outcomes are an exploded per-row array, so the single
    exchange on (component, code list) also serves the final DISTINCT.
    """
    w = Window.partitionBy("referencedComponentId", "Cluster_ID")
    t = t.withColumn("_ho", F.max("_o").over(w)).withColumn("_hn", F.max("_n").over(w))
    null_key = F.col("referencedComponentId").isNull() | F.col("Cluster_ID").isNull()
    keyed = F.when((F.col("_o") == 1) | (F.col("_ho") == 0),
                   F.array(F.when(F.col("_ho") == 0, "added").when(F.col("_hn") == 1, "no change")
                            .otherwise("removed")))
    unmatched = F.array(F.when(F.col("_o") == 1, "removed"), F.when(F.col("_n") == 1, "added"))
    outcomes = F.filter(F.when(null_key, unmatched).otherwise(F.coalesce(keyed, F.array().cast("array<string>"))),
                        lambda x: x.isNotNull())
    return (t.select("Cluster_ID", "Cluster_Description", "Refset_ID",
                     F.col("referencedComponentId").alias("SNOMED_concept_ID"),
                     F.explode(outcomes).alias("Outcome"))
             .distinct())


def release_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """D3: full outer comparison of two contents on (component, code list):
    ``added`` / ``removed`` / ``no change``; attributes taken from the old side first."""
    cols = ["Cluster_ID", "Cluster_Description", "Refset_ID", "referencedComponentId"]
    t = (old.select(*cols, F.lit(1).alias("_o"), F.lit(0).alias("_n"))
            .unionByName(new.select(*cols, F.lit(0).alias("_o"), F.lit(1).alias("_n"))))
    return _diff_tagged(t)


def store_content(content: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Store a release's content for ``release_diff_stored``: bucketed by (component, code list), an external table at ``path``."""
    (content.select("Cluster_ID", "Cluster_Description", "Refset_ID", "referencedComponentId").write.bucketBy(buckets, *DIFF_KEYS).sortBy(*DIFF_KEYS)
            .option("path", path).saveAsTable(table))
    return content.sparkSession.table(table)


def release_diff_stored(old: DataFrame, new: DataFrame) -> DataFrame:
    """D3 over two stored releases with the same buckets: a full outer join in which no row is exchanged.

    Each side is reduced to one row per (component, code list) within its buckets, with the few descriptions that the list has,
    and the join meets bucket by bucket. So the next release is compared with a stored one for a scan of each.
    """
    def by_key(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*DIFF_KEYS).agg(F.collect_set(F.struct("Cluster_Description", "Refset_ID")).alias(name))

    o, n = by_key(old, "_old").alias("o"), by_key(new, "_new").alias("n")
    j = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in DIFF_KEYS], "full_outer")
    outcome = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("no change")
    key = {k: F.when(F.col("_old").isNull(), F.col(f"n.{k}")).otherwise(F.col(f"o.{k}")) for k in DIFF_KEYS}
    return j.select(key["Cluster_ID"].alias("Cluster_ID"), key["referencedComponentId"].alias("SNOMED_concept_ID"), outcome.alias("Outcome"),
                    F.inline(F.coalesce("_old", "_new"))) \
            .select("Cluster_ID", "Cluster_Description", "Refset_ID", "SNOMED_concept_ID", "Outcome")


def release_diff_from_history(history: DataFrame, old_date: str, new_date: str,
                              used_clusters: DataFrame) -> DataFrame:
    """D1-D3 fused: both releases' merged content from one pass over the history."""
    s = two_snapshots(history, old_date, new_date).filter(F.col("active") == "1")
    j = s.join(used_clusters, s.refsetId == used_clusters.Refset_ID)
    t = j.select("Cluster_ID", "Cluster_Description", "Refset_ID", "referencedComponentId",
                 F.col("in_old").cast("int").alias("_o"), F.col("in_new").cast("int").alias("_n"))
    return _diff_tagged(t)


def decorate_codes(diff: DataFrame, descriptions: DataFrame, concepts: DataFrame,
                   rules=REFSET_TYPE_RULES_DIFF) -> DataFrame:
    """Preferred active name, code status, refset type, ``^refset`` string."""
    d = descriptions.filter((F.col("DescriptionType") == "F") & (F.col("active") == "1")) \
                    .select(F.col("conceptId").alias("_did"), F.col("term").alias("Code_description"))
    c = concepts.select(F.col("id").alias("_cid"), F.col("active").alias("Active_status"))
    j = (diff.join(d, diff.SNOMED_concept_ID == d._did, "left")
             .join(c, diff.SNOMED_concept_ID == c._cid, "left"))
    return j.select("Cluster_ID", F.col("Cluster_Description").alias("Cluster_description"),
                    "SNOMED_concept_ID", "Code_description",
                    refset_type("Refset_ID", rules).alias("Type_of_Refset"),
                    F.concat(F.lit("^"), F.col("Refset_ID")).alias("Cluster_Code_String"),
                    "Active_status", "Outcome")


def ruleset_lists(cluster_ruleset: DataFrame) -> DataFrame:
    """(service, ruleset, version) -> code lists; a ruleset id that two services share keeps
    each service's own lists."""
    return cluster_ruleset.select("Service_ID", "Ruleset_ID", "Ruleset_Version", "Cluster_ID").distinct()


def changed_by_ruleset(decorated: DataFrame, cluster_ruleset: DataFrame, dealt: bool = False) -> DataFrame:
    """D5 for every ruleset at once: diff rows of each ruleset's code lists (exact version).

    ``dealt``: to be written by ruleset. Rows are dealt by the rulesets of their list first (AQE splits a set of rulesets that
    holds many, and merges small ones) and copied to each of them then, so that one row for ``COPIES`` of them is shuffled, not every copy.
    """
    links = ruleset_lists(cluster_ruleset)
    if dealt:
        every = links.groupBy("Cluster_ID").agg(F.array_sort(F.collect_set(F.struct("Service_ID", "Ruleset_ID", "Ruleset_Version"))).alias("_every"))
        starts = F.sequence(F.lit(1), F.size("_every"), F.lit(COPIES))
        sets = every.select("Cluster_ID", F.explode(F.transform(starts, lambda at: F.slice("_every", at, COPIES))).alias("_rulesets"))
        part = F.pmod(F.xxhash64("SNOMED_concept_ID"), F.lit(DEALT_PARTS)).cast("int")
        j = decorated.join(sets, "Cluster_ID").withColumn("_part", part).hint("rebalance", "_rulesets", "_part").select("*", F.inline("_rulesets"))
    else:
        j = decorated.join(links, "Cluster_ID")
    return j.select("Service_ID", F.col("Ruleset_ID").alias("Ruleset"), "Ruleset_Version",
                    F.lit(CODING_ID).alias("Coding_ID"), "Cluster_ID", "Cluster_description",
                    "SNOMED_concept_ID", "Code_description", "Type_of_Refset", "Cluster_Code_String",
                    "Active_status", "Outcome")


def changed_by_service(decorated: DataFrame, cluster_ruleset: DataFrame) -> DataFrame:
    """D6 for every service at once: versions grouped by their floor."""
    links = cluster_ruleset.select(
        "Service_ID", F.floor("Ruleset_Version").cast("int").alias("Ruleset_Version"), "Cluster_ID").distinct()
    j = decorated.join(links, "Cluster_ID")
    return j.select("Service_ID", "Ruleset_Version", F.lit(CODING_ID).alias("Coding_ID"), "Cluster_ID",
                    "Cluster_description", "SNOMED_concept_ID", "Code_description", "Type_of_Refset",
                    "Cluster_Code_String", "Active_status", "Outcome")


def outcome_counts(diff: DataFrame) -> DataFrame:
    """D11 + D12: code lists with at least one added/removed code and their counts.

    Partial (map-side) aggregation first, so a huge list costs one row per task.
    """
    o = F.col("Outcome")
    g = diff.groupBy("Cluster_ID").agg(
        F.count(F.when(o == "added", 1)).cast("bigint").alias("additions"),
        F.count(F.when(o == "removed", 1)).cast("bigint").alias("removals"),
        F.count(F.when(o == "no change", 1)).cast("bigint").alias("unchanged"))
    return g.filter((F.col("additions") + F.col("removals")) > 0)


def changed_clusters(diff: DataFrame) -> DataFrame:
    """Code lists with at least one added or removed code."""
    return outcome_counts(diff).select("Cluster_ID")


def changed_rulesets(staged: DataFrame, changed: DataFrame) -> DataFrame:
    """Staged rulesets touching a changed code list, with the sorted list and count."""
    s = staged.filter(F.col("Cluster_ID").isNotNull()).join(changed.select("Cluster_ID"), "Cluster_ID", "left_semi")
    return (s.groupBy("Stage", "Service_ID", "Ruleset_ID", "Ruleset_Version")
             .agg(F.array_join(F.array_sort(F.collect_set("Cluster_ID")), ",").alias("changed_clusters"),
                  F.countDistinct("Cluster_ID").cast("bigint").alias("n_changed_clusters"))
             .withColumn("UID", F.concat_ws("_", "Service_ID", "Ruleset_ID",
                                             F.col("Ruleset_Version").cast("string"))))


def stage_counts(changed_rs: DataFrame) -> DataFrame:
    """Expected outputs per stage (distinct ruleset UIDs)."""
    return (changed_rs.select("Stage", "UID").distinct().groupBy("Stage")
                      .agg(F.count("UID").cast("bigint").alias("outputs")))


def services_to_publish(stages: DataFrame, services, stage: str | None = None, k: int = 1) -> DataFrame:
    """Configured services by stage, the ``k`` highest versions (numeric order),
    with the floored version label.  ``k=1`` is what the reference publishes.

    Top-k per (stage, service) is a window over one service's distinct versions.
    """
    s = stages.filter(F.col("Service_ID").isin(list(services)))
    if stage is not None:
        s = s.filter(F.col("Stage") == stage)
    v = s.select("Stage", "Service_ID", "Ruleset_Version").distinct()
    if k == 1:
        top = v.groupBy("Stage", "Service_ID").agg(F.max("Ruleset_Version").alias("Ruleset_Version"))
    else:
        w = Window.partitionBy("Stage", "Service_ID").orderBy(F.col("Ruleset_Version").desc())
        top = v.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")
    return top.withColumn("Version_Floor", F.floor("Ruleset_Version").cast("int"))


def change_summary(counts: DataFrame, changed_rs: DataFrame, per_stage: DataFrame,
                   services: DataFrame) -> DataFrame:
    """The text lines of the change report as one (level, key, metric, value) table."""
    def rows(df, level, key, metrics):
        return df.select(F.lit(level).alias("level"), key.alias("key"),
                         F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("bigint").alias("value"))
                                             for m, c in metrics])).alias("_m")) \
                 .select("level", "key", "_m.metric", "_m.value")
    return (rows(counts, "cluster", F.col("Cluster_ID"),
                 [("additions", "additions"), ("removals", "removals"), ("unchanged", "unchanged")])
            .unionByName(rows(changed_rs, "ruleset", F.col("UID"), [("changed_clusters", "n_changed_clusters")]))
            .unionByName(rows(per_stage, "stage", F.col("Stage"), [("outputs", "outputs")]))
            .unionByName(rows(services, "service", F.concat_ws("_", "Stage", "Service_ID"),
                              [("version_floor", "Version_Floor")])))


def cause_of_change(history: DataFrame, dependency: DataFrame, cluster_ruleset: DataFrame,
                    clusters: DataFrame, descriptions: DataFrame, big_lists, subset_ruleset: str,
                    other_ruleset: str, min_versions: dict) -> DataFrame:
    """Changes published at the latest release in the "big" lists, matched with
    same-direction changes in the subset ruleset's underlying lists, plus the other
    ruleset's changes (``n/a``).  Bag result, as in the reference.

    The publication date is a scalar subquery over the small dependency table, which the
    history scan gets as a literal; the three list sets are tagged and joined to that slice.
    """
    pub = dependency.agg(F.max("effectiveTime")).scalar()
    live = clusters.filter(F.col("Cluster_Date_Inactive").isNull())
    cond = None
    for rs, v in min_versions.items():
        c = (F.col("Ruleset_ID") == rs) & (F.col("Ruleset_Version") >= F.lit(v).cast("decimal(9,1)"))
        cond = c if cond is None else (cond | c)
    under = (cluster_ruleset.filter(cond & ~F.col("Cluster_ID").isin(list(big_lists)))
             .join(live.select("Cluster_ID", "Refset_ID"), "Cluster_ID")
             .select("Ruleset_ID", "Ruleset_Version", "Cluster_ID", "Refset_ID").distinct())
    big = live.filter(F.col("Cluster_ID").isin(list(big_lists))).select("Cluster_ID", "Refset_ID").distinct()
    tagged = (big.select("Cluster_ID", "Refset_ID", F.lit("big").alias("_kind"))
              .unionByName(under.filter(F.col("Ruleset_ID") == subset_ruleset)
                                .select("Cluster_ID", "Refset_ID", F.lit("sub").alias("_kind")))
              .unionByName(under.filter(F.col("Ruleset_ID") == other_ruleset)
                                .select("Cluster_ID", "Refset_ID", F.lit("other").alias("_kind"))))
    at = history.filter(F.col("effectiveTime") == pub)
    j = at.join(tagged, at.refsetId == tagged.Refset_ID)
    changes = j.select("_kind", F.col("referencedComponentId").alias("SNOMED_code"),
                       F.when(F.col("active") == "1", "added to").otherwise("removed from").alias("added_removed"),
                       F.col("Cluster_ID").alias("Cluster")).distinct()
    link = changes.filter(F.col("_kind") == "big")
    b = changes.filter(F.col("_kind") == "sub").select(
        F.col("SNOMED_code").alias("_c"), F.col("added_removed").alias("_ar"),
        F.col("Cluster").alias("due_to_underlying_changes_in"))
    part1 = (link.join(b, (link.SNOMED_code == b._c) & (link.added_removed == b._ar), "left")
                 .select(F.lit(subset_ruleset).alias("Ruleset"), "SNOMED_code", "added_removed",
                         "due_to_underlying_changes_in"))
    part2 = changes.filter(F.col("_kind") == "other").select(
        F.lit(other_ruleset).alias("Ruleset"), "SNOMED_code", "added_removed",
        F.lit("n/a").alias("due_to_underlying_changes_in"))
    allr = part1.unionByName(part2).withColumn("Date_changes_published", pub)
    d = descriptions.filter((F.col("active") == "1") & (F.col("DescriptionType") == "F")) \
                    .select(F.col("conceptId").alias("_did"), F.col("term").alias("Code_description"))
    return (allr.join(d, allr.SNOMED_code == d._did, "left")
                .select("Ruleset", "SNOMED_code", "Code_description", "added_removed",
                        "due_to_underlying_changes_in", "Date_changes_published"))
