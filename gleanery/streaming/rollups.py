"""Running roll-ups of events by windows of their own time: what changed is told with every batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

WINDOW, LATE = "1 hour", "2 hours"


def rolled(events: DataFrame, keys: list[str], value: str, window: str = WINDOW, late: str = LATE) -> DataFrame:
    """begins, keys, n, total: counts and sums of a stream of events (ts, keys, value) by window. State is kept for windows that
    ended no more than `late` before the latest event seen; events of older windows are dropped. Null values add nothing."""
    seen = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", window), *keys)
    return seen.agg(F.count("*").alias("n"), F.coalesce(F.sum(value), F.lit(0)).alias("total")).select(F.col("window.start").alias("begins"), *keys, "n", "total")


def keep_rollups(events: DataFrame, out: str, checkpoint: str, keys: list[str], value: str, window: str = WINDOW, late: str = LATE) -> StreamingQuery:
    """Writes the windows that a batch changed, as they are after it, to a folder of that batch: written anew, with
    the same rows, if the batch is run again. Ends when all that has arrived is read; started again with the same
    checkpoint it goes on with the state that it had."""

    def put(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}")

    return rolled(events, keys, value, window, late).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """begins, keys, n, total: each window as the last batch that changed it left it."""
    rows = spark.read.parquet(out)
    return rows.groupBy("begins", *keys).agg(F.max_by(F.struct("n", "total"), "batch").alias("r")).select("begins", *keys, "r.*")
