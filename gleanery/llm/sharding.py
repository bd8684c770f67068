"""Sharding by extendible hashing; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import bounded_broadcast, table, unused, written

#: Bytes of a shard at most, and those of the query, which shows the directory on smaller tables too.
SHARD_BYTES, QUERY_BYTES = 64 << 20, 1 << 20
#: Bits of the first pass beyond those that would do for buckets of one size, and those by which each later one deepens.
SPARE, STEP = 4, 4
#: Rows of a directory level up to which it is broadcast (under 100 bytes a row).
SMALL_DIRECTORY = 100_000
#: Hex digits of a row's hash, and those turned into bits at once.
DIGITS, CHUNK = 48, 12


def _prefix(n: int):
    """The first n bits of a row's key, as text."""
    chunks = [F.lpad(F.conv(F.substring("key", i, CHUNK), 16, 2), 4 * CHUNK, "0") for i in range(1, (n + 3) // 4 + 1, CHUNK)]
    return F.substring(F.concat(*chunks), 1, n)


def shard(docs: DataFrame, limit: int = SHARD_BYTES, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_bytes, shard, shard_depth, shard_docs, shard_bytes: one row per row of docs; and
    doc, a struct of the columns in `keep`, if there are any.

    The directory is indexed by the leading bits of md5(doc_id). A bucket with more
    than `limit` bytes of text (UTF-8) splits on the next bit, no other does, until
    all fit; a shard's name is its bit prefix ('' if the whole table fits). Bytes
    are summed by hash prefix before anything is shuffled: in the first pass by
    prefixes so long that buckets of usual tables fit, 16 to 32 for each shard that
    the bytes alone ask for; only rows of buckets still too large take part in the
    next ones, of four bits each, and meet only the directory's last level.

    A single document larger than the limit ends alone in a shard of its own. Rows
    that share a doc_id share 64 hash bits; beyond these a row number's hash splits
    them, so a repeated id may hold any part of the table. Null doc_id: hashed as
    the empty string. Null text: 0 bytes. Empty table: empty result. Other columns
    are not looked at.
    """
    number = F.monotonically_increasing_id()
    own = [F.struct(*(F.col(f"`{c}`") for c in keep)).alias("doc")] if keep else []
    names = ["doc_id", "n_bytes", *(["doc"] if keep else [])]
    rows = written(docs.select(*own, F.col("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("h"), number.alias("n")), "shard-rows")
    rows = rows.select(*names, F.concat(F.substring("h", 1, 16), F.md5(F.col("n").cast("string"))).alias("key"))
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b"), F.count("*").alias("c")).first()
    if total.b <= limit or total.c <= 1:
        return rows.select(*names, F.lit("").alias("shard"), F.lit(0).alias("shard_depth"), F.lit(total.c).alias("shard_docs"), F.lit(total.b).alias("shard_bytes"))
    done, live = None, rows
    above, to = 0, min(((total.b - 1) // max(limit, 1)).bit_length() + SPARE, 4 * CHUNK)
    while above < 4 * DIGITS:
        at = _prefix(to)
        cells = live.groupBy(at.alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs"))
        cells = written(cells, "shard-cells")
        nodes = cells.select("cell", "bytes", "docs", F.explode(F.transform(F.sequence(F.lit(above + 1), F.lit(to)), lambda j: F.substring("cell", F.lit(1), j))).alias("node"))
        sums = nodes.groupBy("node").agg(F.sum("bytes").alias("b"), F.sum("docs").alias("c")).withColumn("full", (F.col("b") > limit) & (F.col("c") > 1))
        # A bucket's parents are full if it is full: the leaf of a cell is its first node that is not.
        leaves = nodes.join(sums, "node").where(~F.col("full")).groupBy("cell").agg(F.min_by(F.struct("node", "b", "c"), F.length("node")).alias("leaf"))
        leaves = written(cells.join(leaves, "cell", "left").select("cell", "leaf"), "shard-directory")
        closed = leaves.where("leaf is not null").select("cell", F.col("leaf.node").alias("shard"), F.col("leaf.c").alias("shard_docs"), F.col("leaf.b").alias("shard_bytes"))
        placed = live.withColumn("cell", at).join(bounded_broadcast(closed, SMALL_DIRECTORY), "cell")
        placed = placed.select(*names, "shard", F.length("shard").alias("shard_depth"), "shard_docs", "shard_bytes")
        done = placed if done is None else done.unionByName(placed)
        still = leaves.where("leaf is null").select(F.col("cell").alias("open"))
        if still.isEmpty():
            return done
        # Who is in a bucket of this level was in one of each level before.
        live = rows.join(bounded_broadcast(still, SMALL_DIRECTORY), F.col("open") == at, "left_semi")
        above, to = to, min(to + STEP, 4 * DIGITS)
    raise AssertionError("192 hash bits do not tell two rows apart")


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> DataFrame:
    """Writes docs' rows, all columns, to a folder a shard (name=s and its bits), and returns the
    manifest: what shard() returns, and the folder. One shuffle of texts; a task holds whole shards, each
    within the limit. Replaces what is at path.

    Null ids and texts, repeated rows and very long texts as in shard(). The folders' column has a name that no column of
    docs has, in whatever case. Empty table: no folders, an empty manifest.
    """
    placed = shard(docs, limit, docs.columns)
    name = unused(docs.columns, "name")
    folder = F.concat(F.lit("s"), F.col("shard"))
    rows = placed.select(folder.alias(name), "doc.*")
    rows.repartition(name).write.mode("overwrite").partitionBy(name).parquet(path)
    return placed.drop("doc").withColumn("folder", F.concat(F.lit(f"{path}/{name}="), folder))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), QUERY_BYTES)


def op2_sql(limit: int = QUERY_BYTES) -> str:
    """Doc ids are unique in the tables, so 32 bits and no row numbers do here."""
    return f"""
WITH rows_ AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM documents),
nodes AS (
  SELECT d::INTEGER AS depth, h >> (32 - d)::BIGINT AS node, sum(n_bytes)::BIGINT AS b, count(*) AS c
  FROM rows_, range(0, 33) t(d) GROUP BY ALL),
leaf AS (
  SELECT r.doc_id, r.n_bytes, r.h, min(n.depth) AS depth
  FROM rows_ r JOIN nodes n ON n.node = r.h >> (32 - n.depth)::BIGINT
  WHERE n.b <= {limit} OR n.c <= 1 GROUP BY ALL)
SELECT l.doc_id, l.n_bytes, CASE WHEN l.depth = 0 THEN '' ELSE right(lpad(bin(n.node), 32, '0'), l.depth) END AS shard,
       l.depth AS shard_depth, n.c AS shard_docs, n.b AS shard_bytes
FROM leaf l JOIN nodes n ON n.depth = l.depth AND n.node = l.h >> (32 - l.depth)::BIGINT
"""
