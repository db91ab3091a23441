"""Session settings this library is tuned for, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Pages are wide: small Arrow batches keep a Python worker's memory flat.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Settings that only count when the session is made.
STARTUP_SETTINGS = {
    # Plans here hold thousands of expressions; recording a call site for each is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pagefacts")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PAGEFACTS_MEMORY", "6g"))
    )
    for key, value in {**SETTINGS, **STARTUP_SETTINGS}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session, which has no other machines, may fall back to a temporary folder.
    """
    conf = spark.sparkContext.getConf()
    folder = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix="pagefacts-")
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
