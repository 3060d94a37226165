"""Session settings the jobs rely on, and the folder they share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def pin_utc(spark: SparkSession) -> SparkSession:
    """Window bounds, labels and landing paths are all defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session with the settings a stateful query needs.

    The number of state partitions is the session's number of shuffle
    partitions unless one is given. The first run of a checkpoint fixes it, so it
    must be set for the largest load to come.
    """
    partitions = state_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    sibling = pin_utc(spark.newSession())
    sibling.conf.set("spark.sql.shuffle.partitions", str(partitions))
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    # A hot key's events are merged into sessions before they are shuffled.
    sibling.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"
    )
    return sibling


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new path under the folder every executor can reach.

    ``spark.checkpoint.dir`` names that folder. A machine-local folder is used
    only where driver and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="streamrank-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
