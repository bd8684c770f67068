"""Joins on containment: which texts hold which others, both sides of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.sources.stored import stored

#: Buckets of keys' hashes; what is broadcast is a row for each at most.
BUCKETS = 1 << 20
#: Keys of a needle that a text must have before it is searched.
PROBES = 3
GRAM = 3


def _words(text: Column) -> Column:
    return F.split(text, r"\s+", -1)


def _grams(text: Column, size: int) -> Column:
    n = F.length(text) - size + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(text, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def _marked(kind: str, keys: Column) -> Column:
    return F.transform(keys, lambda x: F.concat(F.lit(kind), x))


def _needle_keys(text: Column) -> Column:
    """What any text that holds this one has too: the words with white space on both sides here,
    whole there as well; of texts without such words, their runs of three characters, or of what they have."""
    words = _words(text)
    inner = F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0)))
    short = F.when(F.length(text) >= GRAM, _marked("3", _grams(text, 3))).when(F.length(text) == 2, _marked("2", F.array(text))).when(F.length(text) == 1, _marked("1", F.array(text))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.when(F.size(inner) > 0, _marked("w", inner)).otherwise(short))


def containing(texts: DataFrame, needles: DataFrame, text_key: str, needle_key: str, text: str = "text", needle: str = "text") -> DataFrame:
    """text_key, needle_key of each pair of rows in which the text holds the needle, letter for letter.

    Keys identify rows. A needle is looked for where its rarest keys (words, or letters of
    short needles) stand, as counted over all texts; the pairs that have them are then compared. What is moved: the
    texts' keys that some needle may have, narrow candidate pairs, and the texts of those. Null and empty needles are
    in no text; null texts hold nothing.
    """
    own = needles.select(F.col(needle_key).alias("n"), F.col(needle).alias("needle")).where("needle <> ''")
    keyed = own.select("n", F.explode(_needle_keys(F.col("needle"))).alias("key"))
    bucket = F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).alias("bucket")
    # Which kinds of keys are asked for at all: texts are not cut into runs of letters if no needle is that short.
    kinds = {r.kind for r in keyed.select(F.left("key", F.lit(1)).alias("kind")).distinct().collect()}  # four at most
    if not kinds:
        return own.join(texts.select(text_key), F.lit(False)).select(text_key, F.col("n").alias(needle_key))
    body = F.col("body")
    parts = [_marked("w", _words(body))] * ("w" in kinds) + [_marked(str(k), _grams(body, k)) for k in (1, 2, 3) if str(k) in kinds]
    held = texts.select(F.col(text_key).alias("t"), F.coalesce(F.col(text), F.lit("")).alias("body")).select("t", F.explode(F.array_distinct(F.concat(*parts))).alias("key"))
    asked = F.broadcast(keyed.select(bucket).distinct())  # BUCKETS rows of a number at most
    posted = stored(held.withColumn("bucket", bucket).join(asked, "bucket", "left_semi").select("t", "key"), "posted-keys")
    spread = posted.groupBy("key").agg(F.count("*").alias("df"))
    rarest = F.row_number().over(Window.partitionBy("n").orderBy("df", "key"))
    # A key that no text has leaves its needle out, as it should.
    probes = keyed.join(spread, "key", "left").withColumn("df", F.coalesce("df", F.lit(0))).withColumn("nth", rarest).where(F.col("nth") <= PROBES)
    probes = probes.withColumn("needed", F.count("*").over(Window.partitionBy("n"))).where("df > 0")
    met = posted.join(probes.select("n", "key", "needed"), "key").groupBy("t", "n", "needed").agg(F.count("*").alias("found")).where("found = needed")
    likely = met.select("t", "n").join(own, "n")
    bodies = texts.select(F.col(text_key).alias("t"), F.col(text).alias("body"))
    return likely.join(bodies, "t").where(F.contains("body", F.col("needle"))).select(F.col("t").alias(text_key), F.col("n").alias(needle_key))
