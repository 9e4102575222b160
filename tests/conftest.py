import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4]").appName("relforge-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="relforge-test-wh-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):  # tests only: the cluster sets its own
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="relforge-test-ckpt-"))
    yield spark


@pytest.fixture(scope="session")
def fx(spark):
    from relforge.sources.fixtures import Fixtures
    return Fixtures.of(spark, SF_SMALL)


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from relforge.sources.tables import DRIVER_TABLES
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con
