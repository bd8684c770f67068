"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from itertools import chain, count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a
    temporary one where it is unset (local mode, tests)."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(found := f"file://{tempfile.mkdtemp(prefix='gleanery-')}")
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df, cut from its lineage: written once as Parquet to the shared folder and read back."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def bounded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """df, marked for broadcast if it has no more than `rows` (narrow) rows; else as
    it is, for Spark to shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def unused(columns: Iterable[str], name: str) -> str:
    """`name`, with a number if columns (whose case does not tell them apart) have it already."""
    taken = {c.lower() for c in columns}
    return next(n for n in chain([name], (f"{name}_{i}" for i in count(1))) if n.lower() not in taken)
