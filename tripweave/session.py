"""Session settings shared by jobs, tests and bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import tripweave

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows of one vehicle that a window keeps as they are before it moves them to spillable pages.
    "spark.sql.windowExec.buffer.in.memory.threshold": "32768",
    # Stretches of a vehicle are merged in each task before they are exchanged.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    **STATE_STORE,
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, as named by the session.

    Only a local session without the setting gets a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = spark.conf.get("tripweave.local.checkpoint.dir", None)
        if not path:
            path = tempfile.mkdtemp(prefix="tripweave-")
            spark.conf.set("tripweave.local.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name under the shared folder, for tables that one run writes and reads."""
    return f"{checkpoint_dir(spark)}/tripweave/{uuid.uuid4().hex}"


def use_state_store(spark: SparkSession) -> None:
    """State on local disk with incremental checkpoints, which keyed timers need."""
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)


def ship_helpers() -> None:
    """Sends the package's functions with the tasks, so that executors need no copy of it."""
    cloudpickle.register_pickle_by_value(tripweave)
