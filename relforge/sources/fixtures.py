"""Test inputs in the shape of the release pipeline, derived from the driver tables.

Each fixture is one SQL body in the subset accepted by both Spark SQL and DuckDB;
``{name}`` marks a table it reads (a driver table or an earlier fixture).  Spark
binds the placeholders to DataFrames (``spark.sql(body, name=df)``, no global
views), the oracle side renders them as CTEs.  One text, two engines.

The small bridge tables are joined on derived equi-keys (``a % k = (k - b % k) % k``
is the same predicate as ``(a + b) % k = 0`` for non-negative ints), so no nested
loop / cartesian join is ever planned, even for fixtures.
"""

from __future__ import annotations

import os
import re
from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession

from relforge.sources.spread import spread
from relforge.sources.tables import DRIVER_TABLES, read_table

# Fixed values of the fixture clock.
AS_OF = "2001-07-01"
CURRENT_RELEASE = "20010601"
PREVIOUS_RELEASE = "20001201"
SENTINEL = "99999999"
LOCAL_MODULE = "M_PCD"


#: Digits of a supplier key inside a refset id: wide enough for every key, so ids are unique.
KEY_DIGITS = 10
#: A third of all members are put into this supplier's refset, the hot key of the model.
HOT_SUPPLIER = 1


def _rid(col: str) -> str:
    return (f"concat('9',lpad(cast({col} AS string),{KEY_DIGITS},'0'),CASE WHEN {col} % 4 = 0 THEN '100000110' "
            f"WHEN {col} % 4 = 3 THEN '100099910' ELSE '100023010' END,'5')")


FIXTURES: "OrderedDict[str, str]" = OrderedDict()

FIXTURES["member_rows"] = f"""
SELECT CASE WHEN l_orderkey % 3 = 0 THEN {HOT_SUPPLIER} ELSE l_suppkey END AS list_key, l_partkey AS code, l_shipdate, l_returnflag
FROM {{lineitem}}"""

FIXTURES["refset_full"] = f"""
SELECT DISTINCT
  concat(cast(list_key AS string),'-',cast(code AS string)) AS id,
  CASE WHEN l_shipdate >= timestamp '2001-08-01 00:00:00' THEN '99999999'
       ELSE concat(cast(year(l_shipdate) AS string), lpad(cast(month(l_shipdate) AS string),2,'0'),'01') END AS effectiveTime,
  CASE WHEN l_returnflag='R' THEN '0' ELSE '1' END AS active,
  CASE WHEN list_key % 4 = 0 THEN 'M_EXT' ELSE 'M_PCD' END AS moduleId,
  {_rid('list_key')} AS refsetId,
  cast(code AS string) AS referencedComponentId
FROM {{member_rows}}"""

FIXTURES["concept"] = """
SELECT cast(p_partkey AS string) AS id, CASE WHEN p_partkey % 4 = 1 THEN '20010401' ELSE '20000101' END AS effectiveTime,
  CASE WHEN p_size % 10 = 0 THEN '0' ELSE '1' END AS active,
  CASE WHEN p_partkey % 6 = 0 THEN '900000000000207008' WHEN p_partkey % 6 = 1 THEN '900000000000012004'
       WHEN p_partkey % 6 = 2 THEN '999000041000000102' WHEN p_partkey % 6 = 3 THEN '999000011000001104'
       WHEN p_partkey % 6 = 4 THEN '1326031000000103' ELSE '777' END AS moduleId
FROM {part}"""

FIXTURES["description"] = f"""
SELECT cast(p_partkey AS string) AS conceptId, concat(p_name,', ',p_brand) AS term, 'F' AS DescriptionType,
       CASE WHEN p_partkey % 17 = 0 THEN '0' ELSE '1' END AS active FROM {{part}}
UNION ALL SELECT cast(p_partkey AS string), concat(p_name,' café'), 'P', '1' FROM {{part}} WHERE p_partkey % 3 = 0
UNION ALL SELECT {_rid('s_suppkey')}, s_name, 'F', '1' FROM {{supplier}}"""

FIXTURES["clusters"] = f"""
SELECT concat(CASE WHEN s_suppkey % 13 = 0 THEN 'DEMENTIA_' ELSE 'C' END, cast(s_suppkey AS string),
              CASE WHEN s_suppkey % 9 = 8 THEN '_TXT' ELSE '_COD' END) AS Cluster_ID,
       concat('cluster ', s_name) AS Cluster_Description,
       CASE WHEN s_suppkey % 5 = 0 THEN cast(NULL AS string) ELSE concat('cat',cast(s_nationkey % 3 AS string)) END AS Cluster_Category,
       {_rid('s_suppkey')} AS Refset_ID,
       CASE WHEN s_suppkey % 7 = 6 THEN date '1999-06-01' WHEN s_suppkey % 7 = 5 THEN date '2001-03-01'
            ELSE cast(NULL AS date) END AS Cluster_Date_Inactive FROM {{supplier}}
UNION ALL
SELECT concat('C',cast(s_suppkey AS string),'_COD'), concat('old cluster ', s_name), 'cat9', {_rid('s_suppkey')}, date '2001-02-01'
FROM {{supplier}} WHERE s_suppkey % 6 = 1 AND s_suppkey % 13 <> 0 AND s_suppkey % 9 <> 8"""

FIXTURES["rulesets"] = """
SELECT r_name AS Service_ID, n_name AS Ruleset_ID,
  cast(1 + n_nationkey % 3 + 0.1*(n_nationkey % 2) AS decimal(9,1)) AS Ruleset_Version,
  CASE WHEN n_nationkey % 8 = 7 THEN date '2001-12-01' ELSE date '1998-04-01' END AS Ruleset_Date_Effective,
  CASE WHEN n_nationkey % 6 = 5 THEN date '2000-03-31' WHEN n_nationkey % 6 = 4 THEN date '2002-03-31'
       ELSE cast(NULL AS date) END AS Ruleset_Date_Inactive
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
UNION ALL
SELECT r_name, n_name, cast(2 + n_nationkey % 3 + 0.1*(n_nationkey % 2) AS decimal(9,1)), date '2001-10-01', cast(NULL AS date)
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE n_nationkey % 4 = 0
UNION ALL
SELECT 'SHARED', n_name, cast(1 + n_nationkey % 3 + 0.1*(n_nationkey % 2) AS decimal(9,1)), date '1998-04-01', cast(NULL AS date)
FROM {nation} WHERE n_nationkey % 5 = 1"""

FIXTURES["ruleset_published"] = """
SELECT Service_ID, Ruleset_ID, Ruleset_Version, date '1998-05-01' AS Ruleset_Publication_Effective,
  CASE WHEN Ruleset_Date_Inactive < date '2001-01-01' THEN Ruleset_Date_Inactive ELSE cast(NULL AS date) END AS Ruleset_Publication_Inactive
FROM {rulesets} WHERE Ruleset_Date_Effective <= date '2001-07-01'
UNION ALL
SELECT 'SHARED', concat('UNLISTED_',n_name), cast(1 AS decimal(9,1)), date '1999-05-01', cast(NULL AS date)
FROM {nation} WHERE n_nationkey % 6 = 0"""

FIXTURES["cluster_ruleset"] = """
SELECT c.Cluster_ID, r.Service_ID, r.Ruleset_ID, r.Ruleset_Version,
       CASE WHEN c.n % 10 = 3 THEN date '2001-03-01' WHEN c.n % 10 = 7 THEN date '2002-01-01'
            ELSE cast(NULL AS date) END AS Cluster_Ruleset_Date_Inactive
FROM (SELECT DISTINCT Cluster_ID, cast(substring(Refset_ID,2,10) AS bigint) AS n, cast(substring(Refset_ID,2,10) AS bigint) % 6 AS k FROM {clusters}) c
JOIN (SELECT Service_ID, Ruleset_ID, Ruleset_Version,
             (6 - (length(Service_ID) + length(Ruleset_ID) + cast(Ruleset_Version*10 AS int)) % 6) % 6 AS k FROM {rulesets}) r
ON c.k = r.k"""

FIXTURES["outputs"] = """
SELECT concat('OUT',cast(p_partkey AS string)) AS Output_ID, cast(1 + p_partkey % 2 AS decimal(9,1)) AS Output_Version,
  p_name AS Output_Description, p_type AS Output_Type FROM {part} WHERE p_partkey % 5 < 3"""

FIXTURES["output_ruleset"] = """
SELECT r.Service_ID, r.Ruleset_ID, r.Ruleset_Version, o.Output_ID, o.Output_Version
FROM (SELECT Output_ID, Output_Version, cast(substring(Output_ID,4) AS int) % 7 AS k FROM {outputs}) o
JOIN (SELECT Service_ID, Ruleset_ID, Ruleset_Version, (7 - cast(substring(Ruleset_ID,8) AS int) % 7) % 7 AS k FROM {rulesets}) r
ON o.k = r.k"""

FIXTURES["cluster_output"] = """
SELECT o.Output_ID, o.Output_Version, c.Cluster_ID
FROM (SELECT Output_ID, Output_Version, cast(floor(cast(substring(Output_ID,4) AS bigint) / 20) AS bigint) + 1 AS k FROM {outputs}) o
JOIN (SELECT DISTINCT Cluster_ID, cast(substring(Refset_ID,2,10) AS bigint) AS k FROM {clusters}) c
ON o.k = c.k"""

FIXTURES["populations"] = """
SELECT concat('POP',cast(p_partkey AS string)) AS Population_ID, cast(1 + p_partkey % 2 AS decimal(9,1)) AS Population_Version,
  p_name AS Population_Description, p_type AS Population_Type FROM {part} WHERE p_partkey % 5 >= 3"""

FIXTURES["population_ruleset"] = """
SELECT r.Service_ID, r.Ruleset_ID, r.Ruleset_Version, p.Population_ID, p.Population_Version
FROM (SELECT Population_ID, Population_Version, cast(substring(Population_ID,4) AS int) % 5 AS k FROM {populations}) p
JOIN (SELECT Service_ID, Ruleset_ID, Ruleset_Version, (5 - cast(substring(Ruleset_ID,8) AS int) % 5) % 5 AS k FROM {rulesets}) r
ON p.k = r.k"""

FIXTURES["cluster_population"] = """
SELECT p.Population_ID, p.Population_Version, c.Cluster_ID
FROM (SELECT Population_ID, Population_Version, cast(floor(cast(substring(Population_ID,4) AS bigint) / 20) AS bigint) + 2 AS k FROM {populations}) p
JOIN (SELECT DISTINCT Cluster_ID, cast(substring(Refset_ID,2,10) AS bigint) AS k FROM {clusters}) c
ON p.k = c.k"""

FIXTURES["output_population"] = """
SELECT p.Population_ID, p.Population_Version, o.Output_ID, o.Output_Version
FROM (SELECT Population_ID, Population_Version, cast(floor(cast(substring(Population_ID,4) AS bigint) / 10) AS bigint) AS k FROM {populations}) p
JOIN (SELECT Output_ID, Output_Version, cast(floor(cast(substring(Output_ID,4) AS bigint) / 10) AS bigint) AS k FROM {outputs}) o
ON p.k = o.k"""

FIXTURES["module_dependency"] = """
SELECT concat('md-',moduleId) AS id, '20010601' AS effectiveTime, '1' AS active, moduleId,
  '900000000000534007' AS refsetId, moduleId AS referencedComponentId,
  CASE WHEN moduleId = '900000000000012004' THEN cast(NULL AS string) ELSE '20010401' END AS sourceEffectiveTime,
  '20010401' AS targetEffectiveTime
FROM (SELECT DISTINCT moduleId FROM {concept}) m
UNION ALL SELECT 'md-777','20010601','1','777','900000000000534007','777','20010401','20010401'
UNION ALL SELECT 'md-pcd','20010601','1','M_PCD','900000000000534007','900000000000207008','20010601','20010401'
UNION ALL SELECT 'md-new','99999999','1','M_PCD','900000000000534007','900000000000012004','99999999','20010401'"""

FIXTURES["decision_log"] = """
SELECT concat('C',cast(user_id AS string),'_COD') AS Cluster,
  CASE WHEN event_type='signup' THEN 'Retire' WHEN event_type='click' THEN 'add' WHEN event_type='view' THEN 'remove' ELSE 'retain' END AS Final_Decision,
  CASE WHEN user_id % 50 = 7 THEN '20240231' WHEN user_id % 50 = 9 THEN 'soon'
       ELSE concat(cast(year(ts) AS string),lpad(cast(month(ts) AS string),2,'0'),lpad(cast(day(ts) AS string),2,'0')) END AS Date_Actioned
FROM {events}"""

FIXTURES["id_table"] = """
SELECT DISTINCT concat('gen-',moduleId) AS Unique_ID_Generated, 'M_PCD' AS moduleId,
  '900000000000534007' AS refsetId, moduleId AS conceptId FROM {concept}"""

FIXTURES["ruleset_names"] = """
SELECT n_name AS Ruleset, concat('Full ',n_name) AS Ruleset_Full_Name FROM {nation} WHERE n_nationkey <> 3
UNION ALL SELECT 'RETIRED_RS','Full retired'"""

FIXTURES["service_names"] = """
SELECT r_name AS Service, concat('Full ',r_name) AS Service_Full_Name, r_regionkey AS Display_Order FROM {region} WHERE r_regionkey <> 2
UNION ALL SELECT 'RETIRED_SVC','Full retired',99"""

_PLACEHOLDER = re.compile(r"\{(\w+)\}")
_DISTINCT = re.compile(r"\A\s*SELECT DISTINCT\b", re.I)


def deps(name: str) -> list[str]:
    return list(OrderedDict.fromkeys(_PLACEHOLDER.findall(FIXTURES[name])))


def closure(names) -> list[str]:
    """Fixtures needed by ``names`` (transitively), in definition order."""
    need: set[str] = set()

    def visit(n):
        if n in need or n not in FIXTURES:
            return
        need.add(n)
        for d in deps(n):
            visit(d)

    for n in names:
        visit(n)
    return [n for n in FIXTURES if n in need]


def oracle_with(sql: str) -> str:
    """Prefix an oracle query with the fixture CTEs it references."""
    used = [n for n in FIXTURES if re.search(rf"\b{n}\b", sql)]
    names = closure(used)
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({_PLACEHOLDER.sub(lambda m: m.group(1), FIXTURES[n])})" for n in names)
    body = sql.lstrip()
    if re.match(r"(?i)with\s", body):
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


# History tables can be stored bucketed (and sorted) by the member id: every snapshot
# window and the diff's first stage then read co-partitioned data, no exchange.
BUCKETED = {"refset_full": "id"}
#: Bytes of source data for each bucket of a stored history (a bucket is one task).
BUCKET_BYTES = 256_000_000


class Fixtures:
    """Lazily built fixture DataFrames over one driver-data folder.

    Nothing is computed or written when a table is asked for. ``store`` writes the derived
    tables once, as a release pipeline reads its stored tables, and ``drop`` removes them.
    """

    _cache: dict = {}

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir
        self._dfs: dict[str, DataFrame] = {}
        self._stored: list[str] = []

    @classmethod
    def of(cls, spark: SparkSession, base_dir: str) -> "Fixtures":
        key = (id(spark), base_dir)
        fx = cls._cache.get(key)
        if fx is None or fx.spark is not spark:
            fx = cls._cache[key] = cls(spark, base_dir)
        return fx

    def store(self, source_bytes: int, bucketed: bool = True) -> None:
        """Write every fixture under the shared folder and read it from there from now on.

        ``source_bytes``: size of the history's source; the bucket count follows from it.
        """
        import uuid

        from relforge.session import checkpoint_dir
        root = os.path.join(checkpoint_dir(self.spark), "relforge-fixtures", uuid.uuid4().hex)
        for name in FIXTURES:
            df, path, key = self[name], os.path.join(root, name), BUCKETED.get(name)
            if key is not None and bucketed:
                table = f"relforge_fx_{name}_{uuid.uuid4().hex[:12]}"
                n = max(8, -(-source_bytes // BUCKET_BYTES))
                (df.write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table))
                self._stored.append(table)
                self._dfs[name] = self.spark.table(table)
            else:
                df.write.parquet(path)
                self._dfs[name] = self.spark.read.parquet(path)

    def drop(self) -> None:
        """Forget stored tables; their catalog entries go (the files are in the shared scratch folder)."""
        for table in self._stored:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._stored, self._dfs = [], {}

    def __getitem__(self, name: str) -> DataFrame:
        df = self._dfs.get(name)
        if df is None:
            if name in BUCKETED:
                # dealt by the member id before equal rows are removed: one exchange serves the DISTINCT and every window by id
                every = self.spark.sql(_DISTINCT.sub("SELECT", FIXTURES[name], count=1), **{d: self[d] for d in deps(name)})
                df = spread(every, BUCKETED[name]).distinct()
            elif name in FIXTURES:
                df = self.spark.sql(FIXTURES[name], **{d: self[d] for d in deps(name)})
            elif name in DRIVER_TABLES:
                df = read_table(self.spark, self.base_dir, name)
            else:
                raise KeyError(name)
            self._dfs[name] = df
        return df

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "base_dir"):
            raise AttributeError(name)
        return self[name]
