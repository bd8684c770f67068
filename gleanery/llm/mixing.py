"""Mixing sources to target weights by capped water-filling; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.common import table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the seeded hash that cut each source into buckets for prefix sums.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(by_source: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Water-filling over one row per source (source, source_size).

    Sources in code-point order, null last, take the weights in turn. A common
    level times its weight is a source's target, unless that is above max_epochs
    times its size: then it is clamped there and its excess raises the level of
    the rest. Sources sorted by the level at which they clamp are clamped from the
    front until the level of the rest is feasible for all of them, so the
    clamp-and-redistribute rounds need two running sums only.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = by_source.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    clamp = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = clamp.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    clamped = F.col("level") > F.col("cap") / F.col("weight")
    filled = ranked.withColumn("level", level).withColumn("clamped", clamped).withColumn("final", F.max(F.when(~F.col("clamped"), F.col("level"))).over(every))
    return filled.select("source", "source_size", "weight", F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(F.col("final") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, keep: Sequence[str] = ("doc_id",), weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc (a struct of the columns in `keep`), size, source_size, target, copies, extra, taken.

    A source with target t and size n is repeated t div n times whole. The rest of
    its target is a fractional repetition: its documents in the order of a seeded
    hash, until the rest is used up; the last of them only gives what is left
    (`extra` of its words). So each source's words meet its target to within half
    a word, and no document is taken more than max_epochs times.

    The running sum within a source is split over the hash's buckets: bucket sums
    are added up first, then each bucket runs on its own, so that a source with a
    third of all rows still spreads over thousands of tasks.

    Null or empty text: size 0, taken 0. Null sources form a source of their own,
    the last. The hash is of doc_id (null: the empty string) and text, so that one id, or none, on any part
    of the rows spreads over the buckets. Equal rows tie, in any order, with equal results as a set. Empty table: empty result. Other columns, whatever
    their names, only travel inside `doc`.
    """
    rank = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")))))
    sized = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("doc"), F.col("doc_id").alias("id"), F.col("source"), word_count(F.col("text")).alias("size"), rank.alias("rank"))
    sized = sized.withColumn("bucket", F.substring("rank", 1, BUCKET_DIGITS))
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    by_source = targets(buckets.groupBy("source").agg(F.sum("in_bucket").alias("source_size")), weights, max_epochs)
    quota = by_source.withColumn("quota", F.floor(F.col("target") + 0.5)).withColumn("copies", F.expr("if(source_size > 0, quota div source_size, 0L)")).withColumn("rest", F.col("quota") - F.col("copies") * F.col("source_size"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("offset", F.coalesce(F.sum("in_bucket").over(running), F.lit(0)))
    offsets = offsets.alias("b").join(quota.alias("q"), F.col("b.source").eqNullSafe(F.col("q.source"))).select("b.source", "b.bucket", "b.offset", "q.source_size", "q.target", "q.copies", "q.rest")
    within = Window.partitionBy("bucket", "source").orderBy("rank", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(within), F.lit(0))
    joined = sized.withColumn("before", before).alias("d").join(offsets.alias("o"), F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.bucket") == F.col("o.bucket")))
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("offset") - F.col("before"))).cast("long")
    return joined.select("doc", "size", "source_size", "target", "copies", extra.alias("extra")).withColumn("taken", F.col("copies") * F.col("size") + F.col("extra"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of docs' own columns, whatever they are named: each document as often as it is taken,
    a fractional repetition of half a document or more as a whole one.

    Null and empty texts stay once. Null ids and sources as in mix(). Repeated rows are documents of their own. Texts
    are taken whole. Empty table: empty result.
    """
    rows = mix(docs, keep=docs.columns, **options)
    times = F.col("copies") + F.when((F.col("extra") > 0) & (F.col("extra") * 2 >= F.col("size")), 1).otherwise(0)
    # Documents without words take part in no source's words; they stay once.
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(times)
    return rows.withColumn("times", times.cast("int")).where("times > 0").select(F.explode(F.array_repeat("doc", F.col("times"))).alias("doc")).select("doc.*")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc.doc_id", "size", "source_size", "target", "taken")


OP6_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS rank
  FROM documents),
by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 3 * source_size AS cap,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0))::DOUBLE
           / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM by_source
  WINDOW w AS (ORDER BY (3 * source_size)::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, level > cap::DOUBLE / weight AS clamped FROM levels),
filled AS (
  SELECT source, source_size,
         CASE WHEN clamped THEN cap::DOUBLE ELSE max(level) FILTER (NOT clamped) OVER () * weight END AS target
  FROM marked),
quota AS (
  SELECT *, floor(target + 0.5)::BIGINT AS quota,
         CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS copies
  FROM filled),
runs AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized)
SELECT r.doc_id, r.size, q.source_size, q.target,
       (q.copies * r.size + greatest(0, least(r.size, q.quota - q.copies * q.source_size - r.before)))::BIGINT AS taken
FROM runs r JOIN quota q ON r.source IS NOT DISTINCT FROM q.source
"""
