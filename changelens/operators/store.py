"""Intermediate tables, written once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that spark.checkpoint.dir names; in a temporary one where that is unset and Spark runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-changelens-")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """The rows in at least as many partitions as there are cores, where each row is much work and a small file is one partition."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, computed once and read from there by all that follows."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
