"""Where intermediate tables live.

A fitted table that later jobs read many times is written once to the folder
the cluster names in ``spark.checkpoint.dir`` and read back.  That cuts the
lineage, survives the loss of executors, and gives Catalyst a real size for
the table, so that it decides about broadcasting from a measured number.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one on local masters only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="scorestream-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/scratch/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the copy."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal out a plain scan whose splits are fewer than the cores, by no key.

    Text work is CPU-bound, so one unsplittable input file would keep one core
    busy and the rest idle.  Inputs with enough splits pass through unshuffled.
    No later operator gains a partitioning by it, so plans are alike at any size.
    Only call it on a scan with narrow operators: asking for the partition
    count of a plan with shuffles would run them.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted)
