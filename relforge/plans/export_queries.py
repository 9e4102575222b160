"""Driver queries for A4-A13: write to shared scratch storage, read back, compare."""

from __future__ import annotations

import os
import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relforge.functions import text as T
from relforge.functions.fingerprint import fingerprint
from relforge.operators import diff as D
from relforge.operators import history as H
from relforge.operators import lists as L
from relforge.operators import refdata as R
from relforge.plans.common import CURRENT_RELEASE, LOCAL_MODULE, PREVIOUS_RELEASE, SENTINEL, fx, snap_sql
from relforge.plans.diff_queries import CHANGED_RS_SQL, diff_df, stages_df
from relforge.plans.refdata_queries import NC_COLS, NC_SQL, WORDS, nc_df
from relforge.plans.registry import ORACLE, query
from relforge.sources import io as IO
from relforge.sources import release_export as RX
from relforge.sources.dated import dated_tables, previous_release_with, retain_tables
from relforge.sources.sliced import SlicedTable, StoredSnapshot, replace_modules
from relforge.sources.spread import spread
from relforge.sources.tables import select_all, select_distinct

# The eight tables of a release, from the fixtures (one text for Spark and DuckDB); id and effectiveTime lead.
RELEASE_TABLES = {
    "refset_simple": "SELECT id, effectiveTime, active, moduleId, refsetId, referencedComponentId FROM {refset_full} WHERE refsetId LIKE '%100023010%'",
    "refset_drug": "SELECT id, effectiveTime, active, moduleId, refsetId, referencedComponentId FROM {refset_full} WHERE refsetId LIKE '%100000110%'",
    "refset_other": "SELECT id, effectiveTime, active, moduleId, refsetId, referencedComponentId FROM {refset_full} WHERE refsetId LIKE '%100099910%'",
    "concept": "SELECT id, effectiveTime, active, moduleId FROM {concept}",
    "description": "SELECT concat(conceptId, '-', DescriptionType) AS id, '20000101' AS effectiveTime, active, conceptId, DescriptionType, term FROM {description}",
    "language": "SELECT concat('L', id) AS id, effectiveTime, active, refsetId, referencedComponentId, 'preferred' AS acceptability FROM {refset_full} WHERE active = '1'",
    "module_dependency": "SELECT id, effectiveTime, active, moduleId, refsetId, referencedComponentId, sourceEffectiveTime, targetEffectiveTime FROM {module_dependency}",
    "decision": "SELECT Cluster AS id, Date_Actioned AS effectiveTime, Final_Decision AS decision FROM {decision_log}",
}
#: Date columns stamped besides effectiveTime.
MORE_DATES = {"module_dependency": ["sourceEffectiveTime", "targetEffectiveTime"]}
FORMS = ("full", "snapshot", "delta")
EMPTY_COLUMNS = ["id", "effectiveTime", "active", "moduleId", "refsetId", "referencedComponentId"]
EMPTY_SETS = 42
_LEAD = re.compile(r"SELECT (.*) FROM", re.S)


def _columns(table: str) -> list[str]:
    body = _LEAD.match(RELEASE_TABLES[table])[1]
    return [c.split(" AS ")[-1].strip() for c in re.split(r",(?![^(]*\))", body)]


def _manifest() -> list[tuple]:
    """66 rows: every table in three forms, and 42 file sets that have only a header."""
    rows = [(f"{t}_{form}", f"rel_{t}_{form}_", f"{form.title()}/{'Refset' if 'refset' in t else 'Terminology'}", "Populated", []) for t in RELEASE_TABLES for form in FORMS]
    rows += [(f"empty_{i}", f"rel_empty_{i}_", f"{FORMS[i % 3].title()}/Refset/Kind{i % 14}", "Empty", [*EMPTY_COLUMNS, f"attribute{i % 5}"]) for i in range(EMPTY_SETS)]
    return [(n, e, p, c, *(cols + [None] * (13 - len(cols)))) for n, e, p, c, cols in rows]


def _release_sources(f):
    """The histories behind the eight tables; four of them are taken from one."""
    member = ["id", "effectiveTime", "active", "moduleId", "refsetId", "referencedComponentId"]
    same = {c: c for c in member}
    kinds = {"refset_simple": "100023010", "refset_drug": "100000110", "refset_other": "100099910"}
    members = [RX.Slice(name, same, F.col("refsetId").contains(kind)) for name, kind in kinds.items()]
    language = {"id": F.concat(F.lit("L"), "id"), **{c: c for c in ("effectiveTime", "active", "refsetId", "referencedComponentId")}, "acceptability": F.lit("preferred")}
    names = f.description.select(F.concat_ws("-", "conceptId", "DescriptionType").alias("id"), F.lit("20000101").alias("effectiveTime"),
                                 "active", "conceptId", "DescriptionType", "term")
    decisions = f.decision_log.select(F.col("Cluster").alias("id"), F.col("Date_Actioned").alias("effectiveTime"), F.col("Final_Decision").alias("decision"))

    def one(name, rows, dates=()):
        return RX.Source(rows, [RX.Slice(name, {c: c for c in _columns(name)})], dates=list(dates))
    # the history is dealt by id already; the others are here, over tasks that follow from their sizes (a dependency has few rows)
    return [RX.Source(f.refset_full, [*members, RX.Slice("language", language, F.col("active") == "1")]), one("concept", spread(f.concept, "id")),
            one("description", spread(names, "id")), one("module_dependency", f.module_dependency, MORE_DATES["module_dependency"]),
            one("decision", spread(decisions, "id"))]


def _export(spark, d):
    f = fx(spark, d)
    root = IO.scratch_root(spark, "release")
    man_path = os.path.join(root, "manifest")
    spark.createDataFrame(_manifest(), IO.string_schema(IO.MANIFEST_COLUMNS)).coalesce(1) \
         .write.option("header", True).csv(man_path)
    populated, empty = IO.read_manifest(spark, man_path)
    # full and snapshot files repeat most of their text, which is the bulk of a release: it is compressed
    return IO.export_history(spark, populated.unionByName(empty), _release_sources(f), CURRENT_RELEASE, os.path.join(root, "out"), CURRENT_RELEASE, "gzip")


def _datasets_sql() -> dict[str, str]:
    out = {}
    for t, sql in RELEASE_TABLES.items():
        dates = ["effectiveTime", *MORE_DATES.get(t, [])]
        stamped = (f"SELECT * REPLACE ({', '.join(f"if({c} = '{SENTINEL}', '{CURRENT_RELEASE}', {c}) AS {c}" for c in dates)}) "
                   f"FROM ({re.sub(r'[{}]', '', sql)}) b")
        out[f"{t}_full"] = f"SELECT DISTINCT * FROM ({stamped}) s"
        out[f"{t}_snapshot"] = f"SELECT DISTINCT * FROM ({stamped}) s QUALIFY effectiveTime = max(effectiveTime) OVER (PARTITION BY id)"
        out[f"{t}_delta"] = f"SELECT DISTINCT * FROM ({stamped}) s WHERE effectiveTime = '{CURRENT_RELEASE}'"
    return out


DATASETS_SQL = _datasets_sql()


def _line_sql(name: str) -> str:
    cols = _columns(name.rsplit("_", 1)[0])
    return " || '|' || ".join(f"coalesce({c}, '<null>')" for c in cols)


@query("export_release_roundtrip", " UNION ALL ".join(
    f"SELECT '{k}' AS dataset, {_line_sql(k)} AS line FROM ({v}) t{i}" for i, (k, v) in enumerate(DATASETS_SQL.items())))
def q_export_release_roundtrip(spark, d):
    # all eight tables in three forms, read back and compared value by value
    out = None
    for r in _export(spark, d).filter(F.col("content") == "Populated").collect():  # 24 file sets
        cols = _columns(r["dataset"].rsplit("_", 1)[0])
        line = F.concat_ws("|", *(F.coalesce(F.col(c), F.lit("<null>")) for c in cols))
        df = IO.read_tsv(spark, r["path"], IO.string_schema(cols)).select(F.lit(r["dataset"]).alias("dataset"), line.alias("line"))
        out = df if out is None else out.unionByName(df)
    return out


# what is expected, with one file set too many, one too few, one wrong count and one row that differs
WRONG = {"concept_full": "wrong count", "decision_delta": "extra", "not_written": "missing", "language_full": "wrong rows"}
_COUNTED = " UNION ALL ".join([f"SELECT '{k}' AS dataset, CAST(count(*) AS BIGINT) AS n FROM ({v}) t{i}" for i, (k, v) in enumerate(DATASETS_SQL.items())]
                              + [f"SELECT 'empty_' || CAST(i AS VARCHAR), CAST(0 AS BIGINT) FROM range({EMPTY_SETS}) e(i)"])


@query("export_check", f"""
SELECT dataset, if(dataset = 'decision_delta', NULL, if(dataset = 'concept_full', n + 1, n)) AS expected_rows, n AS written_rows,
       coalesce(MAP {{{', '.join(f"'{k}': '{v}'" for k, v in WRONG.items())}}}[dataset], 'ok') AS status FROM ({_COUNTED}) c
UNION ALL SELECT 'not_written', CAST(7 AS BIGINT), NULL, 'missing'""")
def q_export_check(spark, d):
    log = _export(spark, d)
    expected = log.select("dataset", F.col("rows").alias("expected_rows"), F.col("fingerprint").alias("expected_fingerprint"))
    expected = expected.filter(F.col("dataset") != "decision_delta").withColumns({
        "expected_rows": F.col("expected_rows") + (F.col("dataset") == "concept_full").cast("bigint"),
        "expected_fingerprint": F.concat(F.col("expected_fingerprint"), F.when(F.col("dataset") == "language_full", "1").otherwise(""))})
    expected = expected.unionByName(spark.createDataFrame([("not_written", 7, "0:0")], expected.schema))
    return IO.export_check(expected, IO.read_back(spark, log))


@query("export_tree", f"""
SELECT CAST({len({"/".join(p.split("/")[:k + 1]) for _, _, p, *_ in _manifest() for k in range(len(p.split("/")))})} AS BIGINT) AS folders,
       CAST({len(_manifest())} AS BIGINT) AS file_sets, 'Pass' AS outcome, CAST(sum(n) AS BIGINT) AS rows FROM ({_COUNTED}) c""")
def q_export_tree(spark, d):
    # numbers of folders and file sets, and of the rows of all of them
    log = _export(spark, d)
    root = log.select("path").first()["path"].split("/out/")[0] + "/out"
    tree = IO.export_tree(spark, log, root)
    rows = IO.read_back(spark, log).agg(F.sum("written_rows").alias("rows"))
    return tree.select("folders", "file_sets", "outcome", rows.scalar().alias("rows"))


PART_KEYS = ["Stage", "Service_ID", "Ruleset", "Ruleset_Version"]


@query("export_partitioned_roundtrip", f"""
SELECT s.Stage, c.* FROM ({ORACLE["changed_by_ruleset"]}) c
JOIN (SELECT DISTINCT Stage, Service_ID, Ruleset_ID AS Ruleset, Ruleset_Version FROM ({CHANGED_RS_SQL}) r) s USING (Service_ID, Ruleset, Ruleset_Version)""")
def q_export_partitioned_roundtrip(spark, d):
    # the staged, changed rulesets, one folder for each stage and ruleset
    f = fx(spark, d)
    diff = diff_df(f)
    changed = D.changed_rulesets(L.staged_clusters(f.cluster_ruleset, stages_df(f)), D.changed_clusters(diff))
    keys = changed.select("Stage", "Service_ID", F.col("Ruleset_ID").alias("Ruleset"), "Ruleset_Version").distinct()
    # a row for each folder: sent to the rows, which are dealt before they are copied to their rulesets, and not again to be written
    df = D.changed_by_ruleset(D.decorate_codes(diff, f.description, f.concept), f.cluster_ruleset, dealt=True).join(F.broadcast(keys), PART_KEYS[1:])
    path = IO.scratch_root(spark, "by_ruleset")
    # the rows of a list are repeated in the files of each of its rulesets: they are compressed
    IO.export_partitioned(df, PART_KEYS, path, "csv", "overwrite", "gzip", True)
    return IO.read_partitioned(spark, path, df.schema)


# Text that a writer may alter: blanks at the ends, tabs, line ends, quotes, backslashes, empty and null.
AWKWARD_SQL = """
SELECT doc_id, CASE CAST(doc_id % 10 AS INT) WHEN 0 THEN concat('  ', lang) WHEN 1 THEN concat(lang, '  ') WHEN 2 THEN ''
  WHEN 3 THEN cast(NULL AS string) WHEN 4 THEN concat(lang, chr(9), source) WHEN 5 THEN concat(lang, chr(10), source, chr(10))
  WHEN 6 THEN concat('a "', lang, '" quote') WHEN 7 THEN concat('back', chr(92), 'slash', chr(92)) WHEN 8 THEN concat('"', lang)
  ELSE concat(lang, ',', source) END AS value, text FROM {documents}"""
AWKWARD_ORACLE = AWKWARD_SQL.replace("{documents}", "documents")


def _awkward(spark, d):
    return spark.sql(AWKWARD_SQL, documents=fx(spark, d).documents)


@query("awkward_text_roundtrip", f"SELECT 'tsv' AS form, * FROM ({AWKWARD_ORACLE}) a UNION ALL SELECT 'partitioned', * FROM ({AWKWARD_ORACLE}) b")
def q_awkward_text_roundtrip(spark, d):
    df = _awkward(spark, d)
    tsv, parts = IO.scratch_root(spark, "awkward-tsv"), IO.scratch_root(spark, "awkward-parts")
    IO.write_tsv(df, tsv)
    keyed = df.withColumn("part", F.col("doc_id") % 3)
    IO.export_partitioned(keyed, ["part"], parts)
    back = IO.read_partitioned(spark, parts, keyed.schema).drop("part")
    return (IO.read_tsv(spark, tsv, df.schema).withColumn("form", F.lit("tsv"))
            .unionByName(back.withColumn("form", F.lit("partitioned"))).select("form", *df.columns))


@query("awkward_text_legacy", f"SELECT doc_id, value FROM ({AWKWARD_ORACLE}) a")
def q_awkward_text_legacy(spark, d):
    df = _awkward(spark, d).select("doc_id", "value")
    path = IO.scratch_root(spark, "awkward-legacy")
    IO.write_csv_legacy(df, path)
    return IO.read_csv_legacy(spark, path, df.schema)


@query("not_encodable", """
SELECT 'text' AS column, text AS value FROM documents WHERE list_max(list_transform(string_split(text, ''), lambda x: unicode(x))) > 255""")
def q_not_encodable(spark, d):
    return IO.not_encodable(fx(spark, d).documents.select("text"))


# ---------------------------------------------------------------- A2, A3, A5, A8, A9, A10, G7, G12, S1

@query("select_all", "SELECT * FROM refset_full")
def q_select_all(spark, d):
    return select_all(fx(spark, d).refset_full)


@query("select_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def q_select_distinct(spark, d):
    return select_distinct(fx(spark, d).part.select("p_brand", "p_type"))


@query("read_name_map", "SELECT Cluster_ID AS Cluster, min(Cluster_Description) AS Cluster_Full_Name FROM clusters GROUP BY Cluster_ID")
def q_read_name_map(spark, d):
    # the names of all code lists, as a file of labels
    names = fx(spark, d).clusters.groupBy(F.col("Cluster_ID").alias("Cluster")).agg(F.min("Cluster_Description").alias("Cluster_Full_Name"))
    path = IO.scratch_root(spark, "names")
    names.write.option("header", True).csv(path)
    return IO.read_name_map(spark, path, names.columns)


@query("write_report", "SELECT Cluster_ID, additions, removals, unchanged FROM (" + ORACLE["outcome_counts"] + ") r")
def q_write_report(spark, d):
    path = IO.scratch_root(spark, "report")
    IO.write_report(D.outcome_counts(diff_df(fx(spark, d))), path)
    return spark.read.parquet(path)


@query("create_table_as", "SELECT conceptId, term, DescriptionType, active FROM description")
def q_create_table_as(spark, d):
    # made, replaced by rows of other columns, and replaced by rows made from itself; read back as files, so that the name can go at once
    rows, name = fx(spark, d).description, "relforge_ctas_" + uuid.uuid4().hex[:12]
    root = IO.scratch_root(spark, "ctas")
    IO.create_table_as(rows.select("conceptId").limit(0), name, root)
    IO.create_table_as(rows.filter(F.col("active") == "1"), name, root)
    path = IO.create_table_as(spark.table(name).unionByName(rows.filter(F.col("active") != "1")), name, root)
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(path)


CLONED = ["description", "concept", "refset_full"]


def _cloned(spark, d):
    f, tag = fx(spark, d), uuid.uuid4().hex[:12]
    source, sandbox = f"relforge_src_{tag}", f"relforge_box_{tag}"
    root = IO.scratch_root(spark, "clones")
    spark.sql(f"CREATE DATABASE {source}")
    for n in CLONED:
        f[n].write.option("path", f"{root}/from/{n}").saveAsTable(f"{source}.{n}")
    manifest = IO.clone_tables(spark, CLONED, source, sandbox, f"{root}/to")
    clones = {n: spark.table(f"{sandbox}.{n}") for n in CLONED}  # external tables: their files stay
    for db in (source, sandbox):
        spark.sql(f"DROP DATABASE {db} CASCADE")
    return manifest, clones


@query("clone_tables", " UNION ALL ".join(f"SELECT '{n}' AS name, concat_ws('|', {', '.join(c)}) AS line FROM {n}" for n, c in (
    ("description", ["conceptId", "term", "DescriptionType", "active"]), ("concept", ["id", "effectiveTime", "active", "moduleId"]),
    ("refset_full", ["id", "effectiveTime", "active", "moduleId", "refsetId", "referencedComponentId"]))))
def q_clone_tables(spark, d):
    # the rows of the clones
    _, clones = _cloned(spark, d)
    return reduce(DataFrame.unionByName, (df.select(F.lit(n).alias("name"), F.concat_ws("|", *df.columns).alias("line")) for n, df in clones.items()))


@query("clone_manifest", " UNION ALL ".join(f"SELECT '{n}' AS name, CAST(count(*) AS BIGINT) AS rows, true AS same FROM {n}" for n in CLONED))
def q_clone_manifest(spark, d):
    # the manifest, against the fixtures' own fingerprints
    manifest, _ = _cloned(spark, d)
    f = fx(spark, d)
    own = reduce(DataFrame.unionByName, (fingerprint(f[n]).select(F.lit(n).alias("name"), F.col("fingerprint").alias("own")) for n in CLONED))
    return manifest.join(own, "name").select("name", "rows", (F.col("fingerprint") == F.col("own")).alias("same"))


@query("table_fingerprint", " UNION ALL ".join(f"""
SELECT '{n}' AS name, CAST(count(*) AS BIGINT) AS rows, CAST(sum(CAST(CAST('0x' || substr(md5({" || chr(31) || ".join(f"coalesce({c}, chr(0))" for c in cols)}), 1, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS fingerprint
FROM {n}""" for n, cols in (("description", ["conceptId", "term", "DescriptionType", "active"]), ("module_dependency", [
    "id", "effectiveTime", "active", "moduleId", "refsetId", "referencedComponentId", "sourceEffectiveTime", "targetEffectiveTime"]),
    ("refset_full", ["id", "effectiveTime", "active", "moduleId", "refsetId", "referencedComponentId"]))))
def q_table_fingerprint(spark, d):
    # the portable form, whose value another engine finds too
    f = fx(spark, d)
    return reduce(DataFrame.unionByName, (fingerprint(f[n], portable=True).select(F.lit(n).alias("name"), "rows", "fingerprint")
                                          for n in ("description", "module_dependency", "refset_full")))


@query("uk_date", "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS shown FROM orders")
def q_uk_date(spark, d):
    return fx(spark, d).orders.select("o_orderkey", T.uk_date("o_orderdate").alias("shown"))


@query("name_suffix_date", """
SELECT name, if(length(name) >= 8 AND try_strptime(right(name, 8), '%Y%m%d') IS NOT NULL, right(name, 8), NULL) AS suffix
FROM (SELECT DISTINCT concat('release_', Date_Actioned) AS name FROM decision_log) n""")
def q_name_suffix_date(spark, d):
    names = fx(spark, d).decision_log.select(F.concat(F.lit("release_"), "Date_Actioned").alias("name")).distinct()
    return names.withColumn("suffix", T.name_suffix_date("name"))


@query("collated_join", "SELECT Cluster_ID, Service_ID FROM clusters JOIN cluster_ruleset USING (Cluster_ID)")
def q_collated_join(spark, d):
    # keys that differ in case only are equal under a case-insensitive collation
    f = fx(spark, d)
    lower = f.cluster_ruleset.select(F.lower("Cluster_ID").alias("Cluster_ID"), "Service_ID")
    joined = T.collate_keys(f.clusters, ["Cluster_ID"]).join(T.collate_keys(lower, ["Cluster_ID"]).withColumnRenamed("Cluster_ID", "_key"),
                                                             F.col("Cluster_ID") == F.col("_key"))
    return joined.select(F.collate("Cluster_ID", "UTF8_BINARY").alias("Cluster_ID"), "Service_ID")


def _translit_sql(col: str) -> str:
    e = col
    for w, a in WORDS.items():
        e = f"replace({e}, '{w}', '{a}')"
    return f"{e} AS {col}"


@query("csv_legacy_roundtrip", "SELECT " + ", ".join(_translit_sql(c) for c in NC_COLS) + f" FROM ({NC_SQL}) n")
def q_csv_legacy_roundtrip(spark, d):
    df = R.transliterate(nc_df(fx(spark, d)), WORDS)
    path = IO.scratch_root(spark, "legacy_csv")
    IO.write_csv_legacy(df, path)
    return IO.read_csv_legacy(spark, path, df.schema)


@query("replace_module_roundtrip", f"""
SELECT * FROM ({snap_sql(CURRENT_RELEASE)}) n WHERE moduleId = '{LOCAL_MODULE}'
UNION ALL
SELECT * FROM ({snap_sql(PREVIOUS_RELEASE)}) o WHERE moduleId <> '{LOCAL_MODULE}'""")
def q_replace_module_roundtrip(spark, d):
    # B9 on storage: a moduleId-partitioned table; one module's partition replaced
    f = fx(spark, d)
    table, path = "relforge_sct_refset_" + uuid.uuid4().hex[:12], IO.scratch_root(spark, "sct_refset")
    (H.snapshot_as_of(f.refset_full, PREVIOUS_RELEASE).write.partitionBy("moduleId")
      .option("path", path).saveAsTable(table))
    IO.replace_module_partition(spark, table, H.snapshot_as_of(f.refset_full, CURRENT_RELEASE), LOCAL_MODULE)
    schema = spark.table(table).schema
    spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    return spark.read.schema(schema).parquet(path)


@query("replace_modules", f"""
SELECT * FROM ({snap_sql(CURRENT_RELEASE)}) n WHERE moduleId = '{LOCAL_MODULE}'
UNION ALL
SELECT * REPLACE ('M_NEW' AS moduleId) FROM ({snap_sql(CURRENT_RELEASE)}) n WHERE moduleId = 'M_EXT' AND active = '1'
UNION ALL
SELECT * REPLACE ('M_STAYS' AS moduleId) FROM ({snap_sql(PREVIOUS_RELEASE)}) o WHERE moduleId = 'M_EXT' AND active = '0'""")
def q_replace_modules(spark, d):
    # B9 for several modules in one step: one replaced, one new, one that has no rows any more, one that stays
    f = fx(spark, d)
    old, new = (H.snapshot_as_of(f.refset_full, date) for date in (PREVIOUS_RELEASE, CURRENT_RELEASE))
    table = SlicedTable(spark, IO.scratch_root(spark, "modules"), "moduleId")
    stays = old.filter("moduleId = 'M_EXT' AND active = '0'").withColumn("moduleId", F.lit("M_STAYS"))
    table.replace(old.unionByName(stays), ["M_PCD", "M_EXT", "M_STAYS"])
    fresh = new.filter(F.col("moduleId") == LOCAL_MODULE).unionByName(
        new.filter("moduleId = 'M_EXT' AND active = '1'").withColumn("moduleId", F.lit("M_NEW")))
    replace_modules(table, fresh, ["M_PCD", "M_EXT", "M_NEW"])
    return table.read()


@query("snapshot_incremental", snap_sql(CURRENT_RELEASE))
def q_snapshot_incremental(spark, d):
    # B5 as stored state, brought from the previous release to the current one, a release at a time
    history = fx(spark, d).refset_full
    stored = StoredSnapshot(spark, IO.scratch_root(spark, "snapshot"), buckets=16)
    stored.create(history, PREVIOUS_RELEASE)
    dates = H.release_dates(history).filter(F.col("release_date").between(PREVIOUS_RELEASE, CURRENT_RELEASE)).orderBy("release_date").collect()
    for r in dates[1:]:  # bounded by the calendar
        stored.advance(H.delta(history, r["release_date"]))
    return stored.read()


DATED = 4
_DATES = f"SELECT DISTINCT effectiveTime AS d FROM refset_full WHERE effectiveTime < '{CURRENT_RELEASE}' ORDER BY d DESC LIMIT {DATED}"


def _dated(spark, d, database):
    """Tables of the last releases before the current one: members of each, concepts of all but the latest."""
    f, root = fx(spark, d), IO.scratch_root(spark, "dated")
    spark.sql(f"CREATE DATABASE {database}")
    before = H.release_dates(f.refset_full).filter(F.col("release_date") < CURRENT_RELEASE)
    dates = [r["release_date"] for r in H.latest_releases(before, DATED).collect()]
    for date in dates:
        IO.create_table_as(H.delta(f.refset_full, date), f"{database}.refset_delta_{date}", f"{root}/refset_delta_{date}")
        if date != max(dates):
            IO.create_table_as(f.concept.filter(F.col("effectiveTime") <= date), f"{database}.concept_{date}", f"{root}/concept_{date}")
    IO.create_table_as(f.rulesets, f"{database}.rulesets", f"{root}/rulesets")


@query("retain_tables", f"""
SELECT name || d AS "table", d AS release_date, release_rank, if(release_rank <= 2, 'keep', 'drop') AS action, if(release_rank <= 2, 'kept', 'dropped') AS status, release_rank <= 2 AS there
FROM (SELECT d, row_number() OVER (ORDER BY d DESC) AS release_rank FROM ({_DATES}) x) r, (VALUES ('refset_delta_'), ('concept_')) n(name)
WHERE name = 'refset_delta_' OR release_rank > 1""")
def q_retain_tables(spark, d):
    # the drop log of a database of dated tables, and which of them are there afterwards
    database = f"relforge_dated_{uuid.uuid4().hex[:12]}"
    _dated(spark, d, database)
    plan = retain_tables(spark, database, 2)
    log = retain_tables(spark, database, 2, dry_run=False)
    left = {r["table"] for r in dated_tables(spark, database).collect()}
    spark.sql(f"DROP DATABASE {database} CASCADE")
    planned = plan.select("table", F.col("status").alias("_planned"))
    return (log.join(planned, "table").filter("_planned = if(status = 'dropped', 'would drop', status)")
               .select("table", "release_date", "release_rank", "action", "status", F.col("table").isin(sorted(left)).alias("there")))


@query("retained_rows", f"SELECT r.* FROM refset_full r WHERE effectiveTime IN (SELECT d FROM ({_DATES}) x ORDER BY d DESC LIMIT 2)")
def q_retained_rows(spark, d):
    # the members in the tables that are left
    database = f"relforge_dated_{uuid.uuid4().hex[:12]}"
    _dated(spark, d, database)
    retain_tables(spark, database, 2, dry_run=False)
    left = [r["table"] for r in dated_tables(spark, database).filter("base = 'refset_delta'").collect()]
    rows = reduce(DataFrame.unionByName, [spark.table(f"{database}.{t}") for t in left])  # external tables: their files stay
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return rows


@query("previous_release_with", f"""
SELECT previous_release, 'ok' AS status, (SELECT CAST(count(*) AS BIGINT) FROM refset_full WHERE effectiveTime = previous_release) AS members
FROM (SELECT min(d) AS previous_release FROM (SELECT d FROM ({_DATES}) x ORDER BY d DESC LIMIT 2) y) z""")
def q_previous_release_with(spark, d):
    # the latest release has no concept table and is passed over
    database = f"relforge_dated_{uuid.uuid4().hex[:12]}"
    _dated(spark, d, database)
    found = previous_release_with(spark, database, ["refset_delta", "concept"], CURRENT_RELEASE, 12).first()
    members = spark.table(f"{database}.refset_delta_{found['previous_release']}").count()
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.createDataFrame([(*found, members)], "previous_release string, status string, members bigint")
