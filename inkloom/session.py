"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on; all can be changed at run time.
RUNTIME_CONF = {
    # timestamps in payloads and logs are UTC
    "spark.sql.session.timeZone": "UTC",
    # a repeated JSON key keeps its last value
    "spark.sql.variant.allowDuplicateKeys": "true",
    # sizes are checked by the planner at run time: joins become broadcast
    # joins only below the threshold, skewed join partitions are split
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # keyed state of streams is kept and changed entry by entry
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", app: str = "inkloom", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # recording a call site for every column expression slows plan building
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="inkloom-")


def shared_root(spark: SparkSession) -> str:
    """Folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset a
    temporary folder is used, but only by a single-machine session: on a
    cluster a machine-local folder would be lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):  # "local-cluster" has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def through_storage(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, for a narrow result that several steps need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
