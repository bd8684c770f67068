"""One-to-one alignment of source blocks with extracted questions, by similarity.

Pairs are made where they can matter. Years and numbers are counted first: in a plain chapter, all
blocks have a question of their own year and number. Such blocks meet these by an equi-join and are
settled where it brings them together, each year and number for itself. In the other, mixed chapters
a block that these may not suffice for meets all questions of its chapter, and blocks are settled in
their chapter's order. What is settled comes as a sorted stream, of which a task holds one block's
rows at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleanery.functions.similarity import ratio, sequence_ratio
from gleanery.functions.text import normal
from gleanery.sources.stored import broadcast_if_small, stored

MATCHED = 0.55
#: Rows of keys of mixed chapters up to which they are broadcast.
SMALL = 100_000


def _choice(rows: list[tuple], used: set[int]) -> tuple:
    """scraped_index, score, matched, starved of a block: of the questions with its number and year that are
    left the best, if none is, of all; of equals the first. Starved: it would need pairs that were not made."""
    left = [r for r in rows if r[0] is not None and r[0] not in used]
    keyed = [r for r in left if r[1]]
    if keyed:
        best = max(keyed, key=lambda r: (r[2], -r[0]))
        score = best[2]
    elif any(r[3] is None for r in rows):
        return None, 0.0, False, True
    elif left:
        best = max(left, key=lambda r: (r[3], -r[0]))
        score = best[3]
    else:
        return None, 0.0, False, False
    used.add(best[0])
    return best[0], round(score, 4), score >= MATCHED, False


def _settled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    unit, block, rows, used = None, None, [], set()
    names = ["id", "scraped_index", "score", "matched", "starved"]
    for b in batches:
        out = []
        scraped = [None if x != x or x is None else int(x) for x in b.scraped_index.tolist()]
        free = [None if x != x else x for x in b.free_score.tolist()]
        for u, i, *row in zip(b.unit.tolist(), b.id.tolist(), scraped, b.keyed.tolist(), b.keyed_score.tolist(), free):
            if (u, i) != (unit, block):
                if rows:
                    out.append((block, *_choice(rows, used)))
                if u != unit:
                    used = set()
                unit, block, rows = u, i, []
            rows.append(tuple(row))
        yield pd.DataFrame(out, columns=names).astype({"scraped_index": "Int32"})
    if rows:
        yield pd.DataFrame([(block, *_choice(rows, used))], columns=names).astype({"scraped_index": "Int32"})


def _clean(c: str) -> Column:
    return normal(F.col(c))


def _held() -> Column:
    return F.size(F.filter("options", lambda v: (v != "") & F.contains("whole", v))) / F.greatest(F.size("options"), F.lit(1))


def _forms(blocks: DataFrame, questions: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(blocks, questions) with their texts in normal form, and the keys by which they meet."""
    b = blocks.select(F.col(key).alias("k"), "source_index", F.col("number").cast("int").alias("number"), F.col("year").alias("year"), _clean("year").alias("year_key"), _clean("stem").alias("stem"), normal(F.array_join("lines", " ")).alias("whole"))
    q = questions.select(
        F.col(key).alias("of"), "scraped_index", F.col("number").cast("int").alias("q_number"), F.col("year").alias("q_year"), _clean("year").alias("q_year_key"), _clean("text").alias("text"),
        F.transform(F.coalesce("options", F.array().cast("array<string>")), normal).alias("options"), (F.coalesce("answer", F.lit("")) != "").cast("double").alias("answered"),
    )
    return b, q


def _pairs(b: DataFrame, q: DataFrame) -> DataFrame:
    """Scored pairs: b's id, k, unit, order, needy with scraped_index and scores, those of all questions
    for needy blocks, those of the same year and number for others."""
    here = F.col("k").eqNullSafe(F.col("of"))
    keyed = F.coalesce((F.col("number") == F.col("q_number")) & (F.col("year_key") == F.col("q_year_key")), F.lit(False))
    rows = b.where("needy").join(q, here, "left").unionByName(b.where("NOT needy").join(q, here & (F.col("number") == F.col("q_number")) & (F.col("year_key") == F.col("q_year_key"))))
    same_year = F.when((F.coalesce("year", F.lit("")) != "") & (F.col("year") == F.col("q_year")), 1.0).otherwise(0.0)
    rows = rows.select("id", "unit", "source_index", "scraped_index", "needy", keyed.alias("keyed"), ratio("stem", "text").alias("t"), _held().alias("o"), same_year.alias("y"), "answered")
    keyed_score = 0.8 * F.col("t") + 0.15 * F.col("o") + 0.05 * F.col("answered")
    free_score = 0.6 * F.col("t") + 0.15 * F.col("y") + 0.15 * F.col("o") + 0.1 * F.col("answered")
    score = lambda c: F.coalesce(c, F.lit(-1.0))  # noqa: E731  a block without questions has one row, without scores
    return rows.select("id", "unit", "source_index", "scraped_index", "keyed", score(keyed_score).alias("keyed_score"), F.when(F.col("needy"), score(free_score)).alias("free_score"))


def pairs_of(blocks: DataFrame, questions: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(blocks, questions) in the form in which they are paired. A block is needy if fewer questions have its year and
    number than blocks before and with it; its chapter is mixed then."""
    b, q = _forms(blocks, questions, key)
    q = stored(q, "questions")
    counts = q.where("q_number IS NOT NULL").groupBy("of", "q_number", "q_year_key").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy("k", "number", "year_key").orderBy("source_index"))
    met = b.withColumn("nth", nth).join(counts, F.col("k").eqNullSafe(F.col("of")) & (F.col("number") == F.col("q_number")) & (F.col("year_key") == F.col("q_year_key")), "left")
    needy = stored(met.drop("of", "q_number", "q_year_key").withColumn("needy", F.coalesce(F.col("nth") > F.col("n"), F.lit(True))).drop("nth", "n"), "needy")
    keys = broadcast_if_small(needy.where("needy").select(F.col("k").alias("of")).distinct().withColumn("mixed", F.lit(True)), SMALL)
    needy = needy.join(keys, F.col("k").eqNullSafe(F.col("of")), "left").drop("of").withColumn("mixed", F.col("mixed").isNotNull())
    unit = F.when(F.col("mixed"), F.struct("k", F.lit(None).cast("int").alias("number"), F.lit(None).cast("string").alias("year_key"))).otherwise(F.struct("k", "number", "year_key"))
    made = needy.withColumn("unit", F.to_json(unit)).withColumn("id", F.to_json(F.struct("k", "source_index")))
    return stored(made, "blocks"), q


def _of_chapters(blocks: DataFrame, questions: DataFrame, key: str) -> DataFrame:
    """k, mixed: the chapters that have blocks; mixed ones have a block for which the questions of its year and number
    may not suffice, or no key to meet by. Only keys are read."""
    keys = lambda rows, n: rows.select(F.col(key).alias("k"), F.col("number").cast("int").alias("number"), _clean("year").alias("year_key"), F.lit(n).alias("n"))
    both = keys(blocks, 1).unionByName(keys(questions, -1).where("number IS NOT NULL"))
    groups = both.groupBy("k", "number", "year_key").agg(F.sum("n").alias("left"), F.max("n").alias("n"))
    return groups.where("n = 1").groupBy("k").agg((F.max("left") > 0).alias("mixed")).withColumn("mixed", F.col("mixed") | F.col("k").isNull())


def _best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The choices of plain chapters' blocks: the rows of a year and number follow each other, sorted."""
    unit, block, rows, used = None, None, [], set()
    names = ["k", "source_index", "scraped_index", "score", "matched"]
    for b in batches:
        out = []
        for k, number, year, at, scraped, stem, text, held, answered in zip(*(b[c].tolist() for c in b.columns)):
            if (k, number, year) != unit or at != block:
                if rows:
                    out.append((unit[0], block, *_choice(rows, used)[:3]))
                if (k, number, year) != unit:
                    unit, used = (k, number, year), set()
                block, rows = at, []
            rows.append((scraped, True, 0.8 * sequence_ratio(stem, text) + 0.15 * held + 0.05 * answered, None))
        yield pd.DataFrame(out, columns=names)
    if rows:
        yield pd.DataFrame([(unit[0], block, *_choice(rows, used)[:3])], columns=names)


def _plain(blocks: DataFrame, questions: DataFrame, key: str) -> DataFrame:
    """align() of plain chapters. The window is over what the join meets by: it keeps the rows of a year and number in
    one task, and shuffles nothing."""
    b, q = _forms(blocks, questions, key)
    unit = ["k", "number", "year_key"]
    rows = b.join(q, (F.col("k") == F.col("of")) & (F.col("number") == F.col("q_number")) & (F.col("year_key") == F.col("q_year_key")))
    rows = rows.select(*unit, "source_index", "scraped_index", "stem", "text", _held().alias("o"), "answered")
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy(*unit).orderBy("source_index", "scraped_index"))).where("n > 0").drop("n")
    made = StructType([b.schema["k"], b.schema["source_index"]]).add("scraped_index", "integer").add("score", "double").add("matched", "boolean")
    return rows.sortWithinPartitions(*unit, "source_index", "scraped_index").mapInPandas(_best, made).withColumnRenamed("k", key)


def align(blocks: DataFrame, questions: DataFrame, key: str) -> DataFrame:
    """key, source_index, scraped_index, score, matched: one row per block.

    blocks: key, source_index (distinct in a key), year, number, stem, lines; questions: key, scraped_index,
    year, number, text, options, answer. Blocks in order each take the best question that is left, also if
    it is no match; of those with their number and year, if any is left. Pairs that are made: see the module;
    should an earlier block take the last question with a later one's number, that chapter is done over
    with all its pairs.
    """
    chapters = stored(_of_chapters(blocks, questions, key), "chapters")
    kinds = {r.mixed for r in chapters.select("mixed").distinct().collect()}
    if True not in kinds:
        return _plain(blocks, questions, key)
    if False not in kinds:
        return _mixed(blocks, questions, key)
    keys = {which: broadcast_if_small(chapters.where(F.col("mixed") == which).select(F.col("k").alias("__k")), SMALL) for which in kinds}
    own = lambda which: [x.join(keys[which], F.col(key).eqNullSafe(F.col("__k")), "left_semi") for x in (blocks, questions)]
    return _plain(*own(False), key).unionByName(_mixed(*own(True), key))


def _mixed(blocks: DataFrame, questions: DataFrame, key: str) -> DataFrame:
    """align() of chapters of any kind."""
    b, q = pairs_of(blocks, questions, key)

    def settle(own: DataFrame) -> DataFrame:
        rows = _pairs(own, q).repartition("unit").sortWithinPartitions("unit", "source_index", "scraped_index").drop("source_index")
        return stored(rows.mapInPandas(_settled, "id string, scraped_index int, score double, matched boolean, starved boolean"), "aligned")

    found = settle(b)
    starved = found.where("starved").select("id")
    if not starved.isEmpty():
        again = b.join(starved, "id", "left_semi").select(F.col("k").alias("again")).distinct()
        over = b.join(again, b.k.eqNullSafe(again.again), "left_semi")
        found = found.join(over.select("id"), "id", "left_anti").unionByName(settle(over.withColumn("needy", F.lit(True))))
    rows = b.select("id", F.col("k").alias(key), "source_index").join(found, "id", "left")
    return rows.select(key, "source_index", "scraped_index", F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("matched", F.lit(False)).alias("matched"))
