"""The prefix trie of conversations in preorder, by joins, sorts and prefix sums.

A node, a sequence of turns, is named by the running XOR of hashes of its turns with
their places, so any number of tasks can name the nodes of one conversation. Distinct
conversations are ranked lexicographically, by the digests of the turns that they share with others
and one more; a node spans the ranks from the first to the last that goes through it. Nodes in
order of (first rank, depth) are in preorder: a subtree is the stretch from its top to the last
node of the last rank, so its leaves and savings are differences of prefix sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import table, written
from gleanery.llm.prefix_sums import NTH, running
from gleanery.llm.repair import CRC32_SQL

#: A conversation takes over fewer turns than this of the first one of its block of ids.
HEADS, BLOCK = 6, 100
NODE = ("x1", "x2", "depth")


def _heads(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % HEADS


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id of each conversation; conv_id, depth (from 1), t (digest of role and text), chars
    of each rebuilt turn)."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    own = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("t"),
        F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row"),
    )
    placed = running(own, ["conv_id"], ["turn", "t", "row"], ["t", "chars"], name="placed-turns")
    few = F.collect_list(F.when(F.col(NTH) < HEADS, F.struct(NTH, "t", "chars")))
    convs = placed.groupBy("conv_id").agg(F.count("*").alias("n"), F.sort_array(few).alias("head")).withColumn("h", _heads(F.col("conv_id")))
    bases = convs.where(F.col("conv_id") % BLOCK == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("head").alias("base_head"))
    met = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % BLOCK).join(bases, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))))
    met = written(met.select("conv_id", "h", "k", F.when(F.col("k") > 0, F.slice("base_head", F.lit(1), F.col("k").cast("int"))).alias("taken")), "conversations")
    taken = met.select("conv_id", F.explode("taken").alias("x")).select("conv_id", F.col(f"x.{NTH}").alias("depth"), "x.t", "x.chars")
    rest = placed.join(met.select("conv_id", "h", "k"), "conv_id").where(F.col(NTH) > F.col("h")).select("conv_id", (F.col("k") + F.col(NTH) - F.col("h")).alias("depth"), "t", "chars")
    return met.select("conv_id"), taken.unionByName(rest)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ids in order, by node, to the digest of each node's list; a list is never held."""
    node, sha = None, None
    for b in batches:
        out = []
        for *key, conv_id in zip(*(b[c].tolist() for c in (*NODE, "conv_id"))):
            if key != node:
                if node:
                    out.append((*node, sha.hexdigest()))
                node, sha = key, hashlib.sha256(str(conv_id).encode())
            else:
                sha.update(b",%d" % conv_id)
        yield pd.DataFrame(out, columns=[*NODE, "ends_sha256"])
    if node:
        yield pd.DataFrame([(*node, sha.hexdigest())], columns=[*NODE, "ends_sha256"])


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, preorder, end:
    one row per node, the root (depth 0) included; its subtree is what has preorder (from 0) in [preorder, end).

    convs: conv_id, without repeats; turns: conv_id, depth, t, chars, the depths of a
    conversation from 1 on without gaps. A conversation without turns ends at the root. No conversations: no
    nodes. Two turns are the same if their digests (MD5 of role and text) are.
    """
    salted = lambda n: F.xxhash64(F.lit(n), "depth", "t")
    rows = turns.withColumn("x1", salted(1)).withColumn("x2", salted(2)).withColumn("a1", F.col("x1")).withColumn("a2", F.col("x2"))
    rows = running(rows, ["conv_id"], ["depth"], ["depth", "t", "chars", "a1", "a2"], xors=["x1", "x2"], name="named-turns").drop(NTH)
    # Copies of a conversation are one path from here on, that of the least id.
    last = rows.groupBy("conv_id").agg(F.max_by(F.struct("x1", "x2", "depth"), "depth").alias("e"))
    zero = lambda c: F.coalesce(F.col(f"e.{c}"), F.lit(0).cast("long")).alias(c)
    ends = written(convs.join(last, "conv_id", "left").select("conv_id", *map(zero, NODE)), "conversation-ends")
    paths = written(ends.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies")), "paths")
    root = paths.select("conv_id", "copies", *(F.lit(0).cast("long").alias(c) for c in (*NODE, "chars", "a1", "a2")), F.lit(None).cast("binary").alias("t"))
    rows = written(rows.join(paths.select("conv_id", "copies"), "conv_id").unionByName(root), "path-turns")
    any_ = lambda c: F.max(c).alias(c)  # noqa: E731  the same in all rows of a node
    nodes = written(rows.groupBy(*NODE).agg(F.sum("copies").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_paths"), *map(any_, ("chars", "a1", "a2"))), "nodes")

    shared = nodes.where("n_paths > 1 AND depth > 0").select(*NODE, F.lit(True).alias("shared"))
    met = rows.where("depth > 0").join(shared, [*NODE], "left").groupBy("conv_id")
    met = met.agg(F.sort_array(F.collect_list(F.when(F.col("shared"), F.struct("depth", "t")))).alias("s"), F.min_by("t", F.when(F.col("shared").isNull(), F.col("depth"))).alias("u"), F.count_if(F.col("shared").isNull()).alias("own"))
    path = F.concat(F.transform("s", lambda x: x["t"]), F.when(F.col("own") > 0, F.array("u")).otherwise(F.array().cast("array<binary>")))
    ranks = paths.select("conv_id").join(met.select("conv_id", path.alias("path")), "conv_id", "left").withColumn("path", F.coalesce("path", F.array().cast("array<binary>")))
    ranks = running(ranks, [], ["path"], ["conv_id"], name="ranked-paths").withColumnRenamed(NTH, "rank")
    spans = rows.select("conv_id", *NODE).join(ranks, "conv_id").groupBy(*NODE).agg(F.min("rank").alias("first"), F.max("rank").alias("last"))

    parent = {"p1": F.col("x1").bitwiseXOR(F.col("a1")), "p2": F.col("x2").bitwiseXOR(F.col("a2")), "above": F.col("depth") - 1}
    nodes = nodes.withColumns(parent)
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2"), F.col("above").alias("depth")).agg(F.count("*").alias("n_children"))
    full = nodes.join(spans, [*NODE]).join(children, [*NODE], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    full = full.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("saving", (F.col("n_convs") - 1) * F.col("chars"))
    full = full.withColumn("leaves", F.col("leaf")).withColumn("savings", F.col("saving"))
    keep = ["x1", "x2", "depth", "conv_id", "n_convs", "p1", "p2", "above", "n_children", "first", "last", "leaf", "saving"]
    placed = running(full, [], ["first", "depth"], keep, sums=["leaves", "savings"], name="preorder")
    # The last node of a rank ends the subtrees whose last rank it is.
    stops = placed.groupBy(F.col("first").alias("last")).agg(F.max_by(F.struct(F.col(NTH).alias("end"), F.col("leaves").alias("to_leaves"), F.col("savings").alias("to_savings")), NTH).alias("stop"))
    up = nodes.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("depth").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    members = ends.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    digests = members.mapInPandas(_digests, "x1 long, x2 long, depth long, ends_sha256 string")
    out = placed.join(stops, "last").join(up, ["p1", "p2", "above"], "left").join(digests, [*NODE], "left")
    return out.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children", (F.col("stop.to_leaves") - F.col("leaves") + F.col("leaf")).alias("n_leaves"),
        (F.col("stop.to_savings") - F.col("savings") + F.col("saving")).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), (F.col(NTH) - 1).alias("preorder"), F.col("stop.end").alias("end"),
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of rebuilt conversations. Rows without conv_id belong to none and are left out; rows of
    equal turn come by a digest of role and text; a null turn comes first; null role or text is empty; equal rows
    are turns of their own. Extra columns are not read."""
    return trie(*rebuilt(table(spark, sf_dir, "conversations")))


OP12_SQL = f"""
WITH turns AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t, length(coalesce(text, '')) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, list(t ORDER BY n) AS seq, {CRC32_SQL.format("conv_id::VARCHAR")} % {HEADS} AS h FROM turns GROUP BY conv_id),
made AS (
  SELECT c.conv_id, list_concat(coalesce(b.seq[1:c.h], []::VARCHAR[]), c.seq[c.h + 1:]) AS seq
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % {BLOCK}),
prefixes AS (SELECT conv_id, len(seq) AS size, d, seq[1:d] AS node FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM made)),
nodes AS (
  SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256
  FROM prefixes GROUP BY node),
kids AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
costs AS (
  SELECT a.*, p.conv_id AS parent_conv_id, coalesce(k.n, 0) AS n_children, (a.n_convs - 1) * coalesce(c.chars, 0) AS saving
  FROM nodes a LEFT JOIN nodes p ON a.depth > 0 AND p.node = a.node[1:a.depth - 1] LEFT JOIN kids k ON k.node = a.node
  LEFT JOIN (SELECT t, any_value(chars) AS chars FROM turns GROUP BY t) c ON a.depth > 0 AND c.t = a.node[-1]),
below AS (
  SELECT node[1:d] AS top, sum(saving)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves, count(*) AS size
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM costs) GROUP BY top),
placed AS (SELECT *, row_number() OVER (ORDER BY node) - 1 AS preorder FROM costs)
SELECT a.conv_id, a.depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, preorder, preorder + size AS "end"
FROM placed a JOIN below b ON b.top = a.node
"""
