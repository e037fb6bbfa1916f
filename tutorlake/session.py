"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# No table is broadcast by hint. Below this size Spark broadcasts on its own, beyond it it shuffles.
BROADCAST_LIMIT = "64MB"
# A join reuses the partitions of a join before it whose keys are some of its own.
REUSE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tutorlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    The shuffle partition count is left to the cluster's own default; AQE merges small partitions
    and splits skewed ones. Pass ``spark_sql_shuffle_partitions="8"`` and the like to override.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", BROADCAST_LIMIT)
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .config(map=REUSE)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


@cache
def local_dir() -> str:
    return tempfile.mkdtemp(prefix="tutorlake-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may go without that setting, since a temporary folder is then reachable by
    every task.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return local_dir()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def reusing_session(spark: SparkSession) -> SparkSession:
    """A sibling session for queries of several joins, for sessions that others have set up."""
    sibling = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions"):
        sibling.conf.set(key, spark.conf.get(key))
    for key, value in REUSE.items():
        sibling.conf.set(key, value)
    return sibling


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for one streaming job: same context, own SQL settings.

    The number of state partitions is fixed when a checkpoint is first written, so it is an explicit
    choice here. Without one it follows the context's parallelism, which grows with the cluster.
    """
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    parts = state_partitions or spark.sparkContext.defaultParallelism
    sibling.conf.set("spark.sql.shuffle.partitions", str(parts))
    return sibling
