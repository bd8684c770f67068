"""Signals of pages as they arrive: each batch of new files is read once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleanery.operators.blocks import blocks, signals
from gleanery.sources.pages import page_lines


def signals_of_new_pages(spark: SparkSession, pages: str, out: str, checkpoint: str) -> StreamingQuery:
    """Appends the signals of HTML files that have not been seen to Parquet at `out`; one
    folder a batch, written anew if the batch is run again. Ends when all are done."""
    files = spark.readStream.format("text").option("wholetext", True).load(pages)
    arrived = files.select(F.col("_metadata.file_path").alias("page_id"), F.col("value").alias("html"))

    def add(batch: DataFrame, n: int) -> None:
        signals(blocks(page_lines(batch)), batch).write.mode("overwrite").parquet(f"{out}/batch={n}")

    return arrived.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
