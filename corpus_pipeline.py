"""Documents to training shards: toxicity, near-duplicates, benchmarks, mixing, sharding.

Every stage takes the documents that the one before kept, written and read again, and
returns them with the same columns; the last writes the shards and returns their manifest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanery.llm import decontam, mixing, near_dup, sharding, toxicity
from gleanery.llm.common import shared_dir, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; fitted on the labelled ones among them."""
    return toxicity.keep_ordinary(docs, table(spark, sf_dir, "labels"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that of the least doc_id."""
    return near_dup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it, a fraction rounded to whole copies."""
    return mixing.mixed_rows(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes each shard's documents to a folder of its own under the shared one; doc_id, n_bytes,
    shard (name, depth, documents, bytes) and folder of each row."""
    return sharding.write_shards(docs, f"{shared_dir(spark)}/shards-{spark.sparkContext.applicationId}")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: A classifier trained here and sketches of texts are not SQL; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
