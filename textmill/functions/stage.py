"""Tables written between jobs, in the folder shared by the cluster."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from textmill.session import new_folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the plan, outlives a lost executor, and gives Catalyst the
    real size, so that it broadcasts the table only when it is small."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    let_go(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of what is written. It does so once the driver collects its garbage, which a
    driver with room to spare may not do before the disks are full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
