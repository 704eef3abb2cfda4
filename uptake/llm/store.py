"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from uptake.session import ensure_checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; the driver's JVM deletes it when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as zstd Parquet and return the table read back.

    Cuts lineage: a lost executor rereads the files, nothing upstream runs
    again, and values that depend on the task layout (partition numbers, batch
    ids) are fixed from here on.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
