"""Stages that several results share: written once, read by all."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; in local mode, where it is
    unset, a temporary one."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(found := f"file://{tempfile.mkdtemp(prefix='gleanery-')}")
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: its plan ends there, and a lost executor
    takes nothing with it. What is left there belongs to the job."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df's rows dealt over all tasks, for work that is heavy by the row on files of few row groups."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def numbered(df: DataFrame, array: Column, pos: str, item: str) -> DataFrame:
    """df's columns, pos (from 0) and item of each element of the array. Spark derives a filter on an inner
    explode's array and reckons it twice more for it; on an outer one it does not."""
    return df.select("*", F.posexplode_outer(array).alias(pos, item)).where(F.col(pos).isNotNull())


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """df, marked for broadcast if it has no more than so many (narrow) rows; else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
