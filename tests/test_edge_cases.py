
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from relforge.functions import text as T
from relforge.operators import diff as D
from relforge.operators import history as H
from relforge.operators import quality as Q
from relforge.operators import refdata as R

RF = "id string, effectiveTime string, active string, moduleId string, refsetId string, referencedComponentId string"


def test_like_underscore_is_a_wildcard(spark):  # S2
    df = spark.createDataFrame([("DEMENTIAX1_COD",), ("C1_COD",), ("XCOD",), ("COD",)], "Cluster_ID string")
    out = {r[0] for r in df.filter(~F.col("Cluster_ID").like(R.EXCLUDE_ID_LIKE)
                                   & F.col("Cluster_ID").like(R.INCLUDE_ID_LIKE)).collect()}
    assert out == {"C1_COD", "XCOD"}  # '_' matches any one character, as in T-SQL


def test_dedupe_puts_null_first(spark):  # S4
    rows = [("C1_COD", "R1", "d", "c", dt.date(2001, 1, 1)), ("C1_COD", "R1", "d", "c", None)]
    df = spark.createDataFrame(rows, "Cluster_ID string, Refset_ID string, Cluster_Description string, "
                                     "Cluster_Category string, Cluster_Date_Inactive date")
    assert R.dedupe_clusters(df).collect()[0]["Cluster_Date_Inactive"] is None


def test_snapshot_keeps_ties(spark):  # S5
    df = spark.createDataFrame([("a", "20010101", "1", "m", "r", "c"), ("a", "20010101", "0", "m", "r", "c"),
                                ("a", "20000101", "1", "m", "r", "c")], RF)
    assert H.snapshot(df).count() == 2


def test_published_snapshot_ranks_before_active_filter(spark):  # B6
    df = spark.createDataFrame([("a", "20010101", "0", "m", "r", "c"), ("a", "20000101", "1", "m", "r", "c"),
                                ("b", "99999999", "1", "m", "r", "d"), ("b", "20000101", "1", "m", "r", "d")], RF)
    out = {(r["id"], r["effectiveTime"]) for r in H.published_snapshot(df).collect()}
    assert out == {("b", "20000101")}  # 'a' was removed at its latest release: not resurrected


def test_highest_version_is_numeric(spark):  # S13
    df = spark.createDataFrame([("Live", "S", "R", Decimal("9.0")), ("Live", "S", "R", Decimal("10.0"))],
                               "Stage string, Service_ID string, Ruleset_ID string, Ruleset_Version decimal(9,1)")
    r = D.services_to_publish(df, ["S"]).collect()[0]
    assert r["Ruleset_Version"] == Decimal("10.0") and r["Version_Floor"] == 10


def test_sensitive_fanout_tie_break(spark):  # S18
    sc = spark.createDataFrame([("c", "0", "20010101"), ("c", "1", "20000101"), ("c", "1", "20000601")],
                               "_sc_comp string, _sc_active string, _sc_time string")
    r = R.best_sensitive(sc).collect()[0]
    assert (r["_sc_active"], r["_sc_time"]) == ("1", "20000601")


def test_unmatched_publication_reported_active(spark):  # S20
    pub = spark.createDataFrame([("S", "R", Decimal("1.0"), dt.date(1998, 1, 1), None)],
                                "Service_ID string, Ruleset_ID string, Ruleset_Version decimal(9,1), "
                                "Ruleset_Publication_Effective date, Ruleset_Publication_Inactive date")
    rs = spark.createDataFrame([("S", "R", Decimal("2.0"), dt.date(1998, 1, 1), None)],
                               "Service_ID string, Ruleset_ID string, Ruleset_Version decimal(9,1), "
                               "Ruleset_Date_Effective date, Ruleset_Date_Inactive date")
    r = Q.publication_issues(pub, rs, "2001-07-01").collect()[0]
    assert r["Publication_issues"] == Q.LABEL_ACTIVE and r["matched"] is False
    assert r["Latest_version"] == Decimal("2.0")


def test_error_level(spark):  # F12
    cols = "Publication_issues string, Ruleset_Date_Inactive date"
    lvl = lambda rows: Q.publication_error_level(spark.createDataFrame(rows, cols), "20010601").collect()[0][0]
    assert lvl([(Q.LABEL_ISSUE, dt.date(2000, 1, 1)), (Q.LABEL_ACTIVE, None)]) == 1
    assert lvl([(Q.LABEL_ONGOING, dt.date(2001, 5, 1))]) == 2
    assert lvl([(Q.LABEL_ONGOING, dt.date(2002, 5, 1))]) == 0
    assert lvl([(Q.LABEL_ACTIVE, None)]) == 0


def test_date_formats_and_bad_dates(spark):  # G8, cases of the reference date tests
    df = spark.createDataFrame([("20240117",), ("2024011",), ("202401171",), ("20241301",), ("20240230",)], "d string")
    rows = {r["d"]: r for r in T.date_formats(df, "d").collect()}
    good = rows["20240117"]
    assert good["valid"] and good["ddMonthYYYY"] == "17 January 2024" and good["MonYY"] == "Jan24"
    assert good["ddmmyy"] == "17.01.24" and good["YmdDashes"] == "2024-01-17" and good["YYYY"] == "2024"
    for bad in ("2024011", "202401171", "20241301", "20240230"):
        assert not rows[bad]["valid"] and rows[bad]["YYYYMMDD"] is None


def test_rule_violations_one_row_per_rule(spark):  # F1
    df = spark.createDataFrame([(None, "x", None), ("aÃb", "y", "cat")],
                               "ConceptId_Description string, Refset_Description string, Cluster_Category string")
    labels = sorted(r[0] for r in Q.rule_violations(df).collect())
    assert labels == sorted([Q.RULE_NULL_TERM, Q.RULE_NULL_CATEGORY, Q.RULE_SPECIAL])


def test_non_ascii_and_accepted(spark):  # F2, F3
    df = spark.createDataFrame([("plain",), ("café",), ("日本",), ("",), (None,)], "t string")
    out = Q.accepted_characters(Q.non_ascii_values(df, {"t": "loc"}))
    got = {r["Description_with_Error"]: r["Accepted_Character"] for r in out.collect()}
    assert got == {"café": True, "日本": False}


def test_strip_characters_drops_commas(spark):  # C8 / S17
    df = spark.createDataFrame([("a,b", "c,d", "e,f", "g–h,", "F")],
                               "Cluster_Category string, Cluster_Desc string, Refset_Description string, "
                               "ConceptId_Description string, DescriptionType string")
    r = R.strip_characters(df).collect()[0]
    assert (r["Cluster_Category"], r["ConceptId_Description"]) == ("ab", "g–h") and "DescriptionType" not in r
    assert R.strip_characters(df, replace_en_dash=True).collect()[0]["ConceptId_Description"] == "g-h"


def test_transliterate(spark):  # C10
    df = spark.createDataFrame([("Māori health", 1)], "t string, n int")
    assert R.transliterate(df).collect()[0]["t"] == "Maori health"


def test_previous_release_window(spark):  # B11
    dates = spark.createDataFrame([("20000101",), ("20010601",)], "release_date string")

    def found(*args, **kw):
        return tuple(H.previous_release(dates, *args, **kw).collect()[0])
    assert found("20010701") == found("20010701", max_months_back=16) == ("20010601", "ok")
    assert found("20030101") == ("20010601", "ok")  # no look-back unless asked for
    assert found("20030101", max_months_back=16) == ("20010601", "too old")
    assert found("19990101") == (None, "none")

def test_services_top_k(spark):  # D15
    df = spark.createDataFrame([("Live", "S", "R1", Decimal("5.1")), ("Live", "S", "R2", Decimal("5.2")),
                                ("Live", "S", "R3", Decimal("4.0")), ("Live", "X", "R", Decimal("1.0"))],
                               "Stage string, Service_ID string, Ruleset_ID string, Ruleset_Version decimal(9,1)")
    got = {(r["Service_ID"], str(r["Ruleset_Version"])) for r in D.services_to_publish(df, ["S"], k=2).collect()}
    assert got == {("S", "5.2"), ("S", "5.1")}


def test_null_in_not_like_drops_the_row(spark):  # S3: SQL semantics, not pandas '!='
    rows = [("C1_COD", None, "cat", "R1", None), ("C2_COD", "ok", "cat", "R2", None)]
    df = spark.createDataFrame(rows, "Cluster_ID string, Cluster_Description string, Cluster_Category string, "
                                     "Refset_ID string, Cluster_Date_Inactive date")
    out = [r["Cluster_ID"] for r in R.eligible_clusters(df, "2001-07-01", deny=(), allow=()).collect()]
    assert out == ["C2_COD"]


def test_two_latest_distinct_dates(spark):  # S19
    dates = spark.createDataFrame([("20010101",), ("20010601",), ("20010601",), ("20000101",)], "release_date string")
    assert [r[0] for r in H.latest_releases(dates, 2).collect()] == ["20010601", "20010101"]


def test_uk_date_and_name_suffix(spark):  # G7, G12
    df = spark.createDataFrame([("der2_Refset_SimpleSnapshot_20240117", dt.date(2024, 1, 17)),
                                ("der2_Refset_SimpleSnapshot_2024011X", dt.date(2024, 2, 1))], "t string, d date")
    rows = df.select(T.uk_date("d").alias("uk"), T.name_suffix_date("t").alias("rel")).collect()
    assert [(r["uk"], r["rel"]) for r in rows] == [("17/01/2024", "20240117"), ("01/02/2024", None)]
    dated = df.select(T.name_suffix_date("t").alias("release_date")).filter(F.col("release_date").isNotNull())
    kept = H.retain_releases(dated, 1).collect()
    assert [(r["release_date"], r["action"]) for r in kept] == [("20240117", "keep")]


def test_case_insensitive_keys(spark):  # S1
    from relforge.operators import publish as P
    keys = "Service_ID string, Ruleset_ID string, Ruleset_Version decimal(9,1)"
    cr = spark.createDataFrame([("qof", "mmr", Decimal("1.0"), "C1_COD")], keys + ", Cluster_ID string")
    rp = spark.createDataFrame([("QOF", "MMR", Decimal("1.0"), dt.date(1998, 1, 1), None)],
                               keys + ", Ruleset_Publication_Effective date, Ruleset_Publication_Inactive date")
    pub = P.published(rp, "2001-07-01", True)
    assert P.published_cluster_ruleset(cr, pub).count() == 0  # binary equality by default
    ci = ["Service_ID", "Ruleset_ID"]
    assert P.published_cluster_ruleset(T.collate_keys(cr, ci), T.collate_keys(pub, ci)).count() == 1


def test_ruleset_lists_keep_each_service_apart(spark):  # D5 / D7 selection
    cr = spark.createDataFrame([("S1", "R", Decimal("1.0"), "A_COD"), ("S2", "R", Decimal("1.0"), "B_COD"),
                                ("S2", "R", Decimal("2.0"), "C_COD")],
                               "Service_ID string, Ruleset_ID string, Ruleset_Version decimal(9,1), Cluster_ID string")
    got = {(r["Service_ID"], str(r["Ruleset_Version"]), r["Cluster_ID"]) for r in D.ruleset_lists(cr).collect()}
    assert got == {("S1", "1.0", "A_COD"), ("S2", "1.0", "B_COD"), ("S2", "2.0", "C_COD")}
