"""Data-quality and reconciliation checks.

Checks that scan a table do it in one pass (all rules / all columns in one
projection or one aggregate); their outputs are small tables.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rule labels of the reference-data check.
RULE_NULL_TERM = "Records with null code description"
RULE_SPECIAL = "Descriptions with special characters"
RULE_NULL_CATEGORY = "Cluster category is null"
MOJIBAKE_MARKER = "Ã"
# Fixed value: non-ASCII characters known to export correctly.
ACCEPTED_CHARACTERS = ("é", "ö", "ü", "Å", "ë", "å", "è", "ç", "à", "ā", "–")
# Publication check labels.
LABEL_ACTIVE = "Active ruleset"
LABEL_ONGOING = "Service still ongoing - check next version published as well"
LABEL_ISSUE = "ISSUE - service no longer active"


def rule_violations(ref: DataFrame, marker: str = MOJIBAKE_MARKER) -> DataFrame:
    """rule label + offending row, for every rule a row breaks.

    Rows that break none go first. A row's broken rules are a number, whose labels are looked up in a constant table, so
    that all of it stays compiled and a row is copied only if it breaks several."""
    like = f"%{marker}%"
    rules = [
        (RULE_NULL_TERM, F.col("ConceptId_Description").isNull()),
        (RULE_SPECIAL, F.col("ConceptId_Description").like(like) | F.col("Refset_Description").like(like)),
        (RULE_NULL_CATEGORY, (F.col("Cluster_Category") == "NULL") | F.col("Cluster_Category").isNull()),
    ]
    broken = [F.coalesce(c, F.lit(False)) for _, c in rules]
    number = reduce(add, (F.when(c, 1 << i).otherwise(0) for i, c in enumerate(broken)))
    labels = F.array(*(F.array(*(F.lit(label) for i, (label, _) in enumerate(rules) if n >> i & 1)).cast("array<string>") for n in range(1 << len(rules))))
    return (ref.filter(reduce(or_, broken)).withColumn("_broken", number)
               .select(F.explode(labels[F.col("_broken")]).alias("Table_purpose"), *ref.columns))


def non_ascii_values(df: DataFrame, cols_to_location: dict) -> DataFrame:
    """values whose UTF-8 byte length differs from their character length, with
    their location label; duplicates kept, nulls / empty strings skipped."""
    pairs = F.array(*[F.struct(F.col(c).alias("v"), F.lit(loc).alias("loc")) for c, loc in cols_to_location.items()])
    e = df.select(F.explode(pairs).alias("p")).select(F.col("p.v").alias("Description_with_Error"),
                                                      F.col("p.loc").alias("Table_Col_Location"))
    v = F.col("Description_with_Error")
    return e.filter(v.isNotNull() & (v != "") & (F.octet_length(v) != F.char_length(v)))


def accepted_pattern(chars=ACCEPTED_CHARACTERS) -> str:
    return "|".join(re.escape(c) for c in chars)


def accepted_characters(nonascii: DataFrame, chars=ACCEPTED_CHARACTERS,
                        col: str = "Description_with_Error") -> DataFrame:
    """flag values that contain one of the accepted characters."""
    return nonascii.withColumn("Accepted_Character", F.col(col).rlike(accepted_pattern(chars)))


def split_by_flag(flagged: DataFrame, flag_col: str = "Accepted_Character",
                  value_col: str = "Description_with_Error") -> DataFrame:
    """the accepted / not accepted lists, as a labelled table (no collection)."""
    return flagged.select(F.when(F.col(flag_col), "accepted").otherwise("not accepted").alias("list"),
                          F.col(value_col).alias("value"))


def empty_columns(df: DataFrame) -> DataFrame:
    """columns holding nulls, with their null counts (one aggregate, unpivoted)."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).cast("bigint").alias(c) for c in df.columns])
    return (counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count"))
                                              for c in df.columns])).alias("s"))
                  .select("s.*").filter(F.col("null_count") > 0))


def blank_strings(df: DataFrame, cols_to_location: dict) -> DataFrame:
    """number of empty (or null) values per checked column."""
    counts = df.agg(*[F.count(F.when(F.coalesce(F.col(c), F.lit("")) == "", 1)).cast("bigint").alias(f"_{i}")
                      for i, c in enumerate(cols_to_location)])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(loc).alias("Table_Col_Location"), F.col(f"_{i}").alias("blank_count"))
        for i, loc in enumerate(cols_to_location.values())])).alias("s")).select("s.*")


def newline_columns(df: DataFrame) -> DataFrame:
    """string columns that contain a newline, with the number of offending rows."""
    cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    counts = df.agg(*[F.count(F.when(F.col(c).contains("\n"), 1)).cast("bigint").alias(c) for c in cols])
    return (counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("rows"))
                                              for c in cols])).alias("s"))
                  .select("s.*").filter(F.col("rows") > 0))


def newline_rows(df: DataFrame, key_col: str) -> DataFrame:
    """F7 (rows): (key, column) of every string value holding a newline."""
    cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    hits = F.array(*[F.when(F.col(c).contains("\n"), F.lit(c)) for c in cols])
    return (df.select(key_col, F.filter(hits, lambda x: x.isNotNull()).alias("_h"))
              .select(key_col, F.explode("_h").alias("column")))


def cluster_row_counts(ref: DataFrame) -> DataFrame:
    """F8: number of code lists and number of rows."""
    return ref.agg(F.countDistinct("Cluster_ID").cast("bigint").alias("Number_of_clusters"),
                   F.count("Cluster_ID").cast("bigint").alias("Number_of_rows"))


def release_trend(previous: DataFrame, current: DataFrame) -> DataFrame:
    """previous vs current counts and the difference; ``ok`` false when it fell.

    The two one-row inputs are folded into one row by a conditional aggregate and
    unpivoted again (no join, no window).
    """
    t = (previous.withColumn("_o", F.lit(0)).unionByName(current.withColumn("_o", F.lit(1))))
    one = t.agg(*[F.max(F.when(F.col("_o") == i, F.col(c))).alias(f"{c}_{i}")
                  for i in (0, 1) for c in ("Number_of_clusters", "Number_of_rows")])
    # a difference of counts, NaN-able for the first release like a pandas diff(): DOUBLE
    diff = (F.col("Number_of_clusters_1") - F.col("Number_of_clusters_0")).cast("double")
    rows = F.array(
        F.struct(F.col("Number_of_clusters_0").alias("Number_of_clusters"),
                 F.col("Number_of_rows_0").alias("Number_of_rows"), F.lit("Previous").alias("Code_release"),
                 F.lit(None).cast("double").alias("Clusters_Difference"), F.lit(None).cast("boolean").alias("ok")),
        F.struct(F.col("Number_of_clusters_1").alias("Number_of_clusters"),
                 F.col("Number_of_rows_1").alias("Number_of_rows"), F.lit("Current").alias("Code_release"),
                 diff.alias("Clusters_Difference"), (diff >= 0).alias("ok")))
    return one.select(F.explode(rows).alias("r")).select("r.*")


def reconcile(a: DataFrame, b: DataFrame, time_col: str = "effectiveTime",
              comp_col: str = "referencedComponentId") -> DataFrame:
    """distinct effective times and components, side by side; ``equal`` per metric.

    Stacked (side, metric, value) rows grouped by metric -- no cartesian product.
    """
    def stats(df, side):
        one = df.agg(F.countDistinct(time_col).cast("bigint").alias("t"),
                     F.countDistinct(comp_col).cast("bigint").alias("c"))
        return one.select(F.explode(F.array(
            F.struct(F.lit(side).alias("side"), F.lit("distinct_effective_times").alias("metric"), F.col("t").alias("v")),
            F.struct(F.lit(side).alias("side"), F.lit("distinct_components").alias("metric"), F.col("c").alias("v")),
        )).alias("s")).select("s.*")
    s = stats(a, "a").unionByName(stats(b, "b"))
    g = s.groupBy("metric").agg(F.max(F.when(F.col("side") == "a", F.col("v"))).alias("value_a"),
                                F.max(F.when(F.col("side") == "b", F.col("v"))).alias("value_b"))
    return g.withColumn("equal", F.col("value_a").eqNullSafe(F.col("value_b")))


def publication_issues(ruleset_published: DataFrame, rulesets: DataFrame, as_of: str) -> DataFrame:
    """open publications, the latest known version, and a three-way label.

    A publication with no ruleset row is labelled as active (as the reference
    does); ``matched`` shows it.
    """
    keys = ["Service_ID", "Ruleset_ID", "Ruleset_Version"]
    p = ruleset_published.filter(F.col("Ruleset_Publication_Inactive").isNull())
    r = rulesets.select(*keys, "Ruleset_Date_Inactive", F.lit(True).alias("_hit"))
    m = rulesets.groupBy("Service_ID", "Ruleset_ID").agg(F.max("Ruleset_Version").alias("Latest_version"))
    j = p.join(r, keys, "left").join(m, ["Service_ID", "Ruleset_ID"], "left")
    g = (j.groupBy(*keys, "Ruleset_Publication_Effective", "Ruleset_Date_Inactive")
          .agg(F.max("Latest_version").alias("Latest_version"), F.max("_hit").alias("_hit")))
    ina = F.col("Ruleset_Date_Inactive")
    return g.select(*keys, "Ruleset_Publication_Effective", "Ruleset_Date_Inactive", "Latest_version",
                    F.when(ina.isNull(), LABEL_ACTIVE).when(ina > F.lit(as_of).cast("date"), LABEL_ONGOING)
                     .otherwise(LABEL_ISSUE).alias("Publication_issues"),
                    F.coalesce(F.col("_hit"), F.lit(False)).alias("matched"))


def publication_error_level(issues: DataFrame, release_date: str) -> DataFrame:
    """1 if any issue; else if any ongoing: 2 when some end date <= release date,
    else 0; else 0 when every row is active; else 1.  One aggregate, one row."""
    lab = F.lower(F.col("Publication_issues"))
    rel = F.to_date(F.lit(release_date), "yyyyMMdd")
    a = issues.agg(
        F.coalesce(F.max(lab.contains("issue").cast("int")), F.lit(0)).alias("_issue"),
        F.coalesce(F.max(lab.contains("still ongoing").cast("int")), F.lit(0)).alias("_ongoing"),
        F.coalesce(F.max((F.col("Ruleset_Date_Inactive") <= rel).cast("int")), F.lit(0)).alias("_past"),
        F.count(F.lit(1)).alias("_n"),
        F.count(F.when(lab.contains("active ruleset"), 1)).alias("_active"))
    level = (F.when(F.col("_issue") == 1, 1)
              .when(F.col("_ongoing") == 1, F.when(F.col("_past") == 1, 2).otherwise(0))
              .when(F.col("_active") == F.col("_n"), 0).otherwise(1))
    return a.select(level.cast("int").alias("error_level"))


def retired_recently(decisions: DataFrame, as_of: str, days: int = 14) -> DataFrame:
    """``Retire`` decisions actioned within ``days`` before ``as_of`` (inclusive)."""
    end = F.lit(as_of).cast("date")
    when = F.try_to_date(F.col("Date_Actioned"), "yyyyMMdd")
    return decisions.filter((F.col("Final_Decision") == "Retire")
                            & when.between(F.date_sub(end, days), end))
