"""Shared parameters and oracle SQL fragments for the driver query catalogue."""

from __future__ import annotations

from relforge.sources.fixtures import (AS_OF, CURRENT_RELEASE, LOCAL_MODULE, PREVIOUS_RELEASE,
                                       SENTINEL, Fixtures)

__all__ = ["AS_OF", "CURRENT_RELEASE", "PREVIOUS_RELEASE", "SENTINEL", "LOCAL_MODULE", "fx",
           "snap_sql", "used_sql", "sct_refset", "SCT_REFSET_SQL", "pub_sql"]


def fx(spark, sf_dir) -> Fixtures:
    return Fixtures.of(spark, sf_dir)


def snap_sql(as_of: str | None) -> str:
    """B4/B5 from the definition: the rows whose time is the latest of their id."""
    where = f"WHERE effectiveTime <= '{as_of}'" if as_of else ""
    return f"SELECT DISTINCT * FROM refset_full {where} QUALIFY effectiveTime = max(effectiveTime) OVER (PARTITION BY id)"


def pub_sql(keys=("id", "refsetId", "referencedComponentId")) -> str:
    """B6 from the definition: of the published rows, the latest of each key, if active."""
    return (f"SELECT * FROM (SELECT * FROM refset_full WHERE effectiveTime <> '{SENTINEL}' "
            f"QUALIFY rank() OVER (PARTITION BY {', '.join(keys)} ORDER BY effectiveTime DESC) = 1) p WHERE active = '1'")


def sct_refset(f):
    """The merged terminology refset table (SCT_REFSET): snapshot over published rows."""
    from relforge.operators.history import snapshot
    from pyspark.sql import functions as F
    return snapshot(f.refset_full.filter(F.col("effectiveTime") != SENTINEL))


SCT_REFSET_SQL = (f"SELECT DISTINCT * FROM refset_full WHERE effectiveTime <> '{SENTINEL}' "
                  "QUALIFY effectiveTime = max(effectiveTime) OVER (PARTITION BY id)")

used_sql = ("SELECT DISTINCT Cluster_ID, Cluster_Description, Refset_ID FROM clusters "
            "WHERE Cluster_Date_Inactive IS NULL AND Cluster_ID IN (SELECT Cluster_ID FROM cluster_ruleset)")
