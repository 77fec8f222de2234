"""Tables that an operator keeps in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`. A session on one machine that has none gets a
    temporary folder; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        found = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df written as Parquet and read back, and its path."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """df over twice as many partitions as there are cores, by its key. A Parquet
    file is read by as many tasks as it has row groups, which may be one or two
    for millions of rows; what is scanned again and again goes through this first."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, *([key] if key else []))


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
