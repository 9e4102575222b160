"""Versioned history tables -> full / snapshot / delta releases.

A history table holds one row per (component id, effectiveTime).  Every
operator here is declarative; the only shuffles are the ones the semantics
need (one hash partitioning on the component id for any snapshot).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relforge.sources.spread import spread

# Fixed value: the effectiveTime of rows not yet published.
SENTINEL = "99999999"


def _cols(c) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def stamp_release(df: DataFrame, cols, release_date: str, sentinel: str = SENTINEL) -> DataFrame:
    """B1: replace the sentinel by the release date in one or more date columns."""
    return df.withColumns({c: F.when(F.col(c) == sentinel, F.lit(release_date)).otherwise(F.col(c))
                           for c in _cols(cols)})


def full(df: DataFrame) -> DataFrame:
    """B2: the full release is the whole history."""
    return df


def delta(df: DataFrame, release_date: str, time_col: str = "effectiveTime") -> DataFrame:
    """Rows effective at the release date (pushed into the scan)."""
    return df.filter(F.col(time_col) == release_date)


def snapshot(df: DataFrame, id_cols="id", time_col: str = "effectiveTime") -> DataFrame:
    """Rows at the latest time per id; ties kept; distinct.

    One exchange on the id (window), instead of aggregate + self-join.
    """
    w = Window.partitionBy(*_cols(id_cols)).orderBy(F.col(time_col).desc())
    return (df.withColumn("_rk", F.rank().over(w))
              .filter(F.col("_rk") == 1).drop("_rk").distinct())


def snapshot_as_of(df: DataFrame, as_of: str, id_cols="id", time_col: str = "effectiveTime") -> DataFrame:
    """State at a release date (``time <= as_of``, then B4)."""
    return snapshot(df.filter(F.col(time_col) <= as_of), id_cols, time_col)


def published_snapshot(df: DataFrame, keys=("id", "refsetId", "referencedComponentId"),
                       time_col: str = "effectiveTime", active_col: str = "active",
                       sentinel: str = SENTINEL) -> DataFrame:
    """Latest published row per key, then active only (rank first, filter after)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(F.col(time_col).desc())
    return (df.filter(F.col(time_col) != sentinel)
              .withColumn("_rk", F.rank().over(w))
              .filter((F.col("_rk") == 1) & (F.col(active_col) == "1"))
              .drop("_rk"))


def two_snapshots(df: DataFrame, old_date: str, new_date: str, id_cols="id",
                  time_col: str = "effectiveTime") -> DataFrame:
    """B5 twice in one pass: rows of the snapshot at ``old_date`` and/or ``new_date``.

    Adds boolean ``in_old`` / ``in_new``.  Both snapshots share one exchange on the
    id, so a release-to-release diff reads and shuffles the history once.
    """
    w = Window.partitionBy(*_cols(id_cols))
    t = F.col(time_col)
    return (df.filter(t <= new_date)
              .withColumn("_mo", F.max(F.when(t <= old_date, t)).over(w))
              .withColumn("_mn", F.max(t).over(w))
              .withColumn("in_old", F.coalesce(t == F.col("_mo"), F.lit(False)))
              .withColumn("in_new", t == F.col("_mn"))
              .filter(F.col("in_old") | F.col("in_new"))
              .drop("_mo", "_mn"))


def latest_release_rows(refsets: DataFrame, clusters: DataFrame, descriptions: DataFrame,
                        cluster_ids=None) -> DataFrame:
    """Each refset's rows at that refset's latest date, for the given code lists
    (all when ``cluster_ids`` is None), with the preferred active name.

    The wanted refsets are picked first, so neither the maximum nor the join back sees others."""
    c = clusters.select("Cluster_ID", "Refset_ID")
    if cluster_ids is not None:
        c = c.filter(F.col("Cluster_ID").isin(list(cluster_ids)))
    c = c.distinct()
    # one refset may hold a large share of all members: take its latest date with a
    # partial (map-side) aggregate, one row per refset, and semi-join it back --
    # never a window that puts a whole refset into one task
    wanted = refsets.join(c, refsets.refsetId == c.Refset_ID, "left_semi")
    mx = wanted.groupBy("refsetId").agg(F.max("effectiveTime").alias("effectiveTime"))
    latest = wanted.join(mx, ["refsetId", "effectiveTime"], "left_semi")  # AQE sizes it at runtime
    d = descriptions.filter((F.col("active") == "1") & (F.col("DescriptionType") == "F")) \
                    .select(F.col("conceptId").alias("_cid"), F.col("term"))
    return (latest.join(c, latest.refsetId == c.Refset_ID)
                  .join(d, latest.referencedComponentId == d._cid, "left")
                  .select("Cluster_ID", F.col("refsetId").alias("Refset_ID"),
                          F.col("referencedComponentId").alias("SNOMED_concept_ID"),
                          F.col("term").alias("Code_description"),
                          F.col("active").alias("Active_status"), "effectiveTime")
                  .distinct())


def release_change_class(snap: DataFrame, release_date: str, clusters: DataFrame,
                         descriptions: DataFrame, concepts: DataFrame,
                         cluster_ruleset: DataFrame, as_of: str) -> DataFrame:
    """Per (refset, component) of a release snapshot: addition / removal,
    with names, code status and the rulesets that use the code list.

    Every input is reduced to its distinct rows first, so the output is distinct by construction: a hot list's rows are not
    gathered again for a DISTINCT after they are fanned out to its rulesets."""
    # dealt by component over as many tasks as the history needs; the names below are found by it, too
    g = (spread(snap.select("refsetId", "referencedComponentId", "active", "effectiveTime"), "referencedComponentId")
             .groupBy("refsetId", "referencedComponentId")
             .agg(F.max("active").alias("_act"), F.max("effectiveTime").alias("maxeffectiveTime")))
    g = g.withColumn("change",
                     F.when((F.col("maxeffectiveTime") == release_date) & (F.col("_act") == "1"), "addition")
                      .when((F.col("maxeffectiveTime") == release_date) & (F.col("_act") == "0"), "removal")
                      .otherwise("no change")) \
         .filter(F.col("change").isin("addition", "removal"))
    a = clusters.select("Cluster_ID", "Cluster_Description", "Refset_ID").distinct()
    d = descriptions.filter(F.col("DescriptionType") == "F").select(F.col("conceptId").alias("_did"), "term").distinct()
    c = concepts.select(F.col("id").alias("_cid"), F.col("active").alias("code_active")).distinct()
    p = (cluster_ruleset.filter(F.col("Cluster_Ruleset_Date_Inactive").isNull()
                                | (F.col("Cluster_Ruleset_Date_Inactive") > F.lit(as_of).cast("date")))
                        .select(F.col("Cluster_ID").alias("_pcl"), "Service_ID", "Ruleset_ID", "Ruleset_Version").distinct())
    j = (g.join(a, a.Refset_ID == g.refsetId, "left")
          .join(d, g.referencedComponentId == d._did, "left")
          .join(c, g.referencedComponentId == c._cid, "left")
          .join(p, a.Cluster_ID == p._pcl, "left"))
    return j.select(
        F.concat(F.col("Service_ID"), F.lit("_"), F.col("Ruleset_ID")).alias("Service_Ruleset"),
        "Service_ID", "Ruleset_ID", "Ruleset_Version",
        F.col("refsetId").alias("Refset_ID"), "Cluster_ID",
        F.col("Cluster_Description").alias("Cluster_description"),
        F.col("referencedComponentId").alias("SNOMED_concept_ID"),
        F.col("term").alias("Code_description"), "maxeffectiveTime", "change", "code_active",
    )


def replace_module_slice(target: DataFrame, new_rows: DataFrame, module: str,
                         source_label: str | None = None, module_col: str = "moduleId",
                         type_col: str | None = None, fsn_type: str = "900000000000003001") -> DataFrame:
    """Drop one module's rows from ``target`` and put the new slice in their place.

    ``source_label`` adds a ``SourceData`` literal (concept / refset form);
    ``type_col`` derives ``DescriptionType`` (F for the FSN type id, else P).
    On disk the same thing is a ``moduleId``-partitioned table written with
    dynamic partition overwrite (see ``sources.io.overwrite_module``).
    """
    new = new_rows
    if source_label is not None:
        new = new.withColumn("SourceData", F.lit(source_label))
    if type_col is not None:
        new = new.withColumn("DescriptionType", F.when(F.col(type_col) == fsn_type, "F").otherwise("P"))
    return target.filter(F.col(module_col) != module).unionByName(new)


def release_dates(df: DataFrame, time_col: str = "effectiveTime", sentinel: str = SENTINEL) -> DataFrame:
    """Distinct published release dates of a history (one row per date)."""
    return (df.select(F.col(time_col).alias("release_date"))
              .filter(F.col("release_date") != sentinel).distinct())


def retain_releases(dates: DataFrame, keep_n: int) -> DataFrame:
    """Rank releases newest first; keep the latest ``keep_n``, list the rest to drop.

    ``dates`` has one row per release (a few hundred at most), so the global
    ordering window runs on a tiny, already-distinct input.
    """
    w = Window.orderBy(F.col("release_date").desc())
    return (dates.withColumn("release_rank", F.dense_rank().over(w).cast("bigint"))
                 .withColumn("action", F.when(F.col("release_rank") <= keep_n, "keep").otherwise("drop")))


def previous_release(dates: DataFrame, current: str, max_months_back: int | None = None) -> DataFrame:
    """The latest release strictly before ``current`` (one row, null if there is none).

    ``status`` is ``ok``, ``none``, or ``too old`` when a look-back of ``max_months_back``
    months is asked for and the release lies before it; the date is returned either way.
    """
    prev = dates.filter(F.col("release_date") < current).agg(F.max("release_date").alias("previous_release"))
    status = F.when(F.col("previous_release").isNull(), "none")
    if max_months_back is not None:
        since = F.add_months(F.to_date(F.lit(current), "yyyyMMdd"), -max_months_back)
        status = status.when(F.try_to_date("previous_release", "yyyyMMdd") < since, "too old")
    return prev.withColumn("status", status.otherwise("ok"))


def latest_releases(dates: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` latest distinct release dates (top-k is the feature)."""
    return dates.select("release_date").distinct().orderBy(F.col("release_date").desc()).limit(n)


def release_membership_counts(concepts: DataFrame, dependency: DataFrame, module: str) -> DataFrame:
    """Components by active state at the module's latest source date.

    The date is a scalar subquery over the small dependency table; both classes are always
    reported (0 when absent).
    """
    date = dependency.filter(F.col("moduleId") == module).agg(F.max("sourceEffectiveTime")).scalar()
    at = concepts.filter(F.col("effectiveTime") == date)
    counts = at.agg(F.count(F.when(F.col("active") == "0", F.col("id"))).alias("c0"),
                    F.count(F.when(F.col("active") == "1", F.col("id"))).alias("c1"))
    return counts.select(F.explode(F.array(
        F.struct(F.lit("0").alias("active_status"), F.col("c0").cast("bigint").alias("refsets")),
        F.struct(F.lit("1").alias("active_status"), F.col("c1").cast("bigint").alias("refsets")),
    )).alias("s")).select("s.*")


def active_total(df: DataFrame, active_col: str = "active", id_col: str = "id") -> DataFrame:
    """Number of active rows."""
    return (df.filter(F.col(active_col) == "1").groupBy(active_col)
              .agg(F.count(id_col).cast("bigint").alias("active_refsets")))
