"""Spark session set-up and the shared folder for cut lineages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


# A trigger stores its changes, not whole tables, and looks up no key just to count
# the rows that are there; both sides of a join share one store a partition.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


# Lookups by (session, chunk, value) reuse the (session, chunk) partitioning.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def build_session(
    app: str = "clickloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Session with the settings the operators rely on (UTC, AQE)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        CO_PARTITION: "false",
        **STATE,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(CO_PARTITION, "false")
    for name, value in STATE.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    A folder of our own is used only where the setting is absent and the
    session runs on one machine.
    """
    context = spark.sparkContext
    active = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not active:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if active:
        return active.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    context.setCheckpointDir(own)
    return own


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/clickloom-{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def stage_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the tables that operators store in the block, when it ends.

    Results must be written or read inside it: they may hang on those tables.
    Outside any such block the tables stay until the folder is cleaned up.
    """
    _SCOPES.append([])
    try:
        yield _SCOPES[-1]
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for name in _SCOPES.pop():
            target = path(name)
            target.getFileSystem(conf).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and go on from that table.

    Used where a later step must see exactly the rows of an earlier run
    (partition numbers, sampled range bounds), also after an executor is lost.
    A table is columnar, so later steps read only the columns they need.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
