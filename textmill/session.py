"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Run-time SQL settings the operators are tuned for; cluster sizing is left to the submitter.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Word tables are small in bytes but costly per row: keep every core busy rather than merge to 1 MB.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    # A row may be a whole document.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    # State of keys beyond memory; transformWithState needs it.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Partitions that input tables are dealt to right after the scan, since a table may be one file with one row group, which
# no split size can divide. Not set, it is the number of shuffle partitions, or of cores if there are more of them.
DEAL = "spark.textmill.dealPartitions"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", partitions: str = "8", memory: str = "16g") -> SparkSession:
    """A session for tests and the bench; on a cluster use the one you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("textmill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config(DEAL, cores)
        # Test tables are one small file each: small splits keep all cores busy.
        .config("spark.sql.files.maxPartitionBytes", "2m")
        .config("spark.sql.files.openCostInBytes", "64k")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a fresh one only where none is named and all runs on one machine."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir", None)
    if named is None and context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if named is None:
        named = tempfile.mkdtemp(prefix="textmill-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, name: str) -> str:
    """A path not used before under the shared folder, for tables written between jobs."""
    unique = os.urandom(8).hex()
    return f"{shared_folder(spark).rstrip('/')}/textmill-{name}-{unique}"
