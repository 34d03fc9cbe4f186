"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for these jobs at any size. Partition counts are left to the cluster: AQE
# coalesces or splits them from measured sizes. Broadcasts are never hinted anywhere in this package;
# spark.sql.autoBroadcastJoinThreshold decides from measured sizes and falls back to a shuffle join.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_folder: str | None = None


def build_session(app: str = "salesloom", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for checkpoints, ledgers and streamed results.

    It lies under ``spark.checkpoint.dir``, the folder all executors share. A machine-local folder is
    used only when that setting is missing and the session itself is local.
    """
    global _local_folder
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        _local_folder = _local_folder or tempfile.mkdtemp(prefix="salesloom-")
        base = _local_folder
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The result written to the work folder and read back.

    For a small table that several later steps use: its inputs are passed over once, and a lost
    executor costs nothing but the unfinished tasks.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
