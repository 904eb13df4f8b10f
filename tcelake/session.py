"""Session construction and shared-folder helpers.

On a cluster the session is created by the platform; these helpers only fill in what is unset, so tests and the bench
get a sensible local configuration without overriding the cluster's choices.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans in this package. AQE re-plans joins with runtime sizes (broadcast conversion,
# skew split, partition coalescing); the UI stays off because no server may be opened.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # remove reliable-checkpoint files (ranked dimensions) once the DataFrame that owns them is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "tcelake",
                extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and the bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    b = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("TCELAKE_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when nothing is configured (local tests, the bench) a private folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="tcelake-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder under the shared checkpoint folder for written intermediate tables."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/tcelake-{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session setting ``key`` is ``value`` while it holds, and as before after."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a fresh folder below the shared checkpoint folder and read back: what follows reads it as often as it
    likes without computing it again, and a lost executor re-reads files."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
