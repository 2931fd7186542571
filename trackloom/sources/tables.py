"""Access to the input tables, and rows that are computed once."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` under `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(rows: DataFrame) -> DataFrame:
    """rows, computed once: written to the folder in spark.checkpoint.dir where the session names one, which ends their
    lineage, else held in memory and on the executors' disks."""
    named = rows.sparkSession.conf.get("spark.checkpoint.dir", None) or rows.sparkSession.sparkContext.getCheckpointDir()
    return rows.checkpoint() if named else rows.persist(StorageLevel.MEMORY_AND_DISK)
