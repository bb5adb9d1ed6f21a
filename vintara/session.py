"""Session settings the library expects, and where it may keep cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # lists of keys reach row groups as lists, and instants keep their statistics
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(master: str | None = None, app: str = "vintara", **extra: str) -> SparkSession:
    """A session with the library's settings; a cluster's own settings win where given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir`` and that all executors reach.

    A session on one machine without that setting, as in tests, gets a folder of its own; a
    cluster without it is an error, never a reason to use a machine's local folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            named = tempfile.mkdtemp(prefix="vintara-checkpoint-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Materialise ``frame`` in the shared folder so lost executors cost no replay."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Keyed state of streams that start from now on lives in RocksDB, which arbitrary state needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
