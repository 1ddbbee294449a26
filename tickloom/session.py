"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SHARED_DIR = "spark.checkpoint.dir"

# Ids are remembered for ever in exact dedup, so state is kept in RocksDB by default; it
# ships change logs rather than whole snapshots to the checkpoint.
ROCKSDB_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Day truncation, JSON times and aggregate keys are all defined in UTC.
BATCH_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

STREAM_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def sibling(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session with the caller's runtime settings and some of its own; the caller's stays as it is."""
    session = spark.newSession()
    for name, value in {**dict(spark.conf.getAll), **settings}.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            session.conf.set(name, value)
    return session


def prepare(spark: SparkSession) -> SparkSession:
    """The session itself if it has the batch settings, else a sibling that has them."""
    if all(spark.conf.get(name, None) == value for name, value in BATCH_CONF.items()):
        return spark
    return sibling(spark, BATCH_CONF)


def stream_session(
    spark: SparkSession,
    state_partitions: int | None = None,
    state_store: str = ROCKSDB_STORE,
) -> SparkSession:
    """A sibling session with streaming settings; ``state_store`` names a provider class.

    The number of state partitions is fixed by the first run of a checkpoint. Without one, the
    session's own ``spark.sql.shuffle.partitions`` holds, never the cores that happen to be present.
    """
    settings = {**STREAM_CONF, "spark.sql.streaming.stateStore.providerClass": state_store}
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    return sibling(spark, settings)


@cache
def _temporary_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tickloom-{application}-")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local master may go without ``spark.checkpoint.dir``: there driver and
    executors are one process, so a temporary folder is visible to all of them.
    """
    root = spark.conf.get(SHARED_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SHARED_DIR} must name a folder all executors can reach")
        root = _temporary_root(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
