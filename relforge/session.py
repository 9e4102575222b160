"""SparkSession helpers.

On a cluster the session is created by the platform; these helpers only fill in
settings that are unset, so cluster-level configuration always wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# What we want where nobody has said otherwise. The first can change in a running session; the second belong to its start
# and are ours to choose only where we start a local one.
_SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
_LOCAL_DEFAULTS = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "relforge") -> SparkSession:
    """Return the active session, or build one; settings that were submitted or configured stay as they are.

    ``master`` is for tests and benches: a local session, with ``RELFORGE_DRIVER_MEMORY`` (16g) for its one process.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        memory = os.environ.get("RELFORGE_DRIVER_MEMORY", "16g")
        own = _LOCAL_DEFAULTS if "driver-memory" in os.environ.get("PYSPARK_SUBMIT_ARGS", "") else _LOCAL_DEFAULTS | {"spark.driver.memory": memory}
        for k, v in own.items():
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for k, v in _SQL_DEFAULTS.items():
        if not given.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only on a local master (tests) a scratch folder is created where it is unset; elsewhere
    a machine-local folder would not be seen by the executors, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="relforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d

