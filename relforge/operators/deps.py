"""Module dependency rows of a release."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Module id -> release type (first match wins, ``Other`` otherwise).
RELEASE_TYPES = (
    ("International", ("900000000000207008", "900000000000012004")),
    ("UK", ("999000041000000102", "83821000000107")),
    ("Drug", ("999000011000001104", "999000021000001108")),
    ("UK other", ("999000011000000103", "999000021000000109")),
    ("Pathology", ("1326031000000103", "")),
)
OTHER_TYPE = "Other"
# The module whose missing date is copied from its sibling.
NULL_DATE_MODULE = "900000000000012004"
SIBLING_MODULE = "900000000000207008"
DEPENDENCY_REFSET = "900000000000534007"
WANTED_TYPES = ("Drug", "International", "Pathology")
SENTINEL = "99999999"


def release_type(col: str = "moduleId"):
    expr = None
    for label, modules in RELEASE_TYPES:
        cond = F.col(col).isin(list(modules))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(OTHER_TYPE)


def dependency_summary(refsets: DataFrame, concepts: DataFrame, dependency: DataFrame) -> DataFrame:
    """Modules reached from the refset content, classified, with the latest
    source date of their active dependency rows.

    The member table is reduced to its distinct components first (map-side
    partial aggregation), so the joins see one row per component, not per member.
    """
    comps = refsets.select("referencedComponentId").distinct()
    c = concepts.select(F.col("id").alias("_cid"), "moduleId")
    m = dependency.filter(F.col("active") == "1").select(F.col("moduleId").alias("_mm"), "sourceEffectiveTime")
    j = (comps.join(c, comps.referencedComponentId == c._cid, "left")
              .join(m, F.col("moduleId") == m._mm, "left"))
    return (j.groupBy("moduleId").agg(F.max("sourceEffectiveTime").alias("sourceEffectiveTime"))
             .select(release_type().alias("ReleaseType"), "moduleId", "sourceEffectiveTime"))


def fill_dependency_date(summary: DataFrame, null_module: str = NULL_DATE_MODULE,
                         sibling_module: str = SIBLING_MODULE) -> DataFrame:
    """Copy the sibling module's date into the known null-date module; rows still
    without a date are flagged ``needs_input`` (the reference asked a person).

    The sibling's date is re-keyed to the target module and merged by one group-by
    on the module id (no join on a literal key, which would plan a nested loop).
    """
    own = summary.select("moduleId", "ReleaseType", "sourceEffectiveTime",
                         F.lit(None).cast("string").alias("_sib"), F.lit(1).alias("_own"))
    sib = (summary.filter(F.col("moduleId") == sibling_module)
                  .select(F.lit(null_module).alias("moduleId"), F.lit(None).cast("string").alias("ReleaseType"),
                          F.lit(None).cast("string").alias("sourceEffectiveTime"),
                          F.col("sourceEffectiveTime").alias("_sib"), F.lit(0).alias("_own")))
    g = (own.unionByName(sib).groupBy("moduleId")
            .agg(F.max("ReleaseType").alias("ReleaseType"), F.max("sourceEffectiveTime").alias("_own_date"),
                 F.max("_sib").alias("_sib"), F.max("_own").alias("_own"))
            .filter(F.col("_own") == 1))
    filled = F.coalesce(F.col("_own_date"), F.col("_sib"))
    return g.select("ReleaseType", "moduleId", filled.alias("sourceEffectiveTime"),
                    filled.isNull().alias("needs_input"))


def insert_if_absent(target: DataFrame, rows: DataFrame, keys) -> DataFrame:
    """B17 (generic): add ``rows`` whose key is not already in ``target``."""
    return target.unionByName(rows.join(target.select(*keys).distinct(), list(keys), "left_anti"))


def dependency_candidates(id_table: DataFrame, filled: DataFrame, module: str,
                          refset: str = DEPENDENCY_REFSET, sentinel: str = SENTINEL) -> DataFrame:
    """B17 rows to insert: one unpublished dependency row per dated module, its id
    taken from the id table."""
    dated = filled.filter(F.col("sourceEffectiveTime").isNotNull()) \
                  .select(F.col("moduleId").alias("_x"), F.col("sourceEffectiveTime").alias("_date"))
    ids = id_table.filter((F.col("moduleId") == module) & (F.col("refsetId") == refset))
    j = ids.join(dated, ids.conceptId == dated._x)  # derived from the members: sized by AQE at runtime
    return j.select(F.col("Unique_ID_Generated").alias("id"), F.lit(sentinel).alias("effectiveTime"),
                    F.lit("1").alias("active"), "moduleId", "refsetId",
                    F.col("conceptId").alias("referencedComponentId"),
                    F.lit(sentinel).alias("sourceEffectiveTime"), F.col("_date").alias("targetEffectiveTime"))


DEPENDENCY_KEYS = ("effectiveTime", "active", "moduleId", "refsetId", "referencedComponentId",
                   "sourceEffectiveTime", "targetEffectiveTime")


def dependency_rows_at(dependency: DataFrame, release_date: str) -> DataFrame:
    """The release's dependency rows (newest source first when ordered)."""
    return (dependency.filter(F.col("effectiveTime") == release_date)
                      .select(*DEPENDENCY_KEYS).orderBy(F.col("sourceEffectiveTime").desc()))


def pick_release_dates(summary: DataFrame, wanted=WANTED_TYPES) -> DataFrame:
    """A date per wanted release type (latest non-null), '' when none."""
    aggs = [F.max(F.when(F.col("ReleaseType") == t, F.col("sourceEffectiveTime"))).alias(f"_{i}")
            for i, t in enumerate(wanted)]
    one = summary.agg(*aggs)
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("ReleaseType"), F.coalesce(F.col(f"_{i}"), F.lit("")).alias("release_date"))
        for i, t in enumerate(wanted)])).alias("s")).select("s.*")
