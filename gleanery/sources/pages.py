"""Pages and their lines; chapter files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.text import collapsed, stem_of_path
from gleanery.sources.stored import broadcast_if_small, numbered

QUESTION = (
    "id string, text string, options map<string,string>, answer string, explanation string, year string, chapter string, class string, "
    "images array<string>, tables array<array<array<string>>>, optionExtraction struct<source:string,status:string,imageTokenCount:int,nonEmptyOptionCount:int>, parserWarnings array<string>"
)

#: A part of a page has fewer than 2 to this power lines.
PART_BITS = 24

#: Rows of a table of subjects and classes up to which it is broadcast.
SMALL_CONFIG = 10_000


def html_files(spark: SparkSession, path: str) -> DataFrame:
    """page_id (the path), url, html: one row per file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("page_id"), F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def kept_lines(html: Column) -> Column:
    """array of what stands between tags, if anything. White space is collapsed in the whole page at once: none goes across a tag."""
    return F.filter(F.transform(F.split(collapsed(html), "(?:<[^>]+>)+"), lambda x: F.trim(x)), lambda x: x != "")


def page_lines(pages: DataFrame) -> DataFrame:
    """page_id, pos (0-based, of the lines kept), line: what stands between tags, if anything. A page may come in several
    rows with a `part` each (from 0), cut between tags; pos is in order then, with gaps."""
    kept = kept_lines(F.col("html"))
    if "part" not in pages.columns:
        return numbered(pages.select("page_id", "html"), kept, "pos", "line").drop("html")
    rows = numbered(pages.select("page_id", "part", "html"), kept, "n", "line")
    return rows.select("page_id", (F.shiftleft(F.col("part").cast("long"), PART_BITS) + F.col("n")).alias("pos"), "line")


def chapter_files(spark: SparkSession, path: str) -> DataFrame:
    """slug, n (0-based), and a question's columns, from JSON arrays of questions."""
    rows = spark.read.schema(QUESTION).option("multiLine", True).json(path)
    return rows.select(stem_of_path(F.col("_metadata.file_path")).alias("slug"), "*")


def chapter_roots(spark: SparkSession, path: str) -> DataFrame:
    """json_path, slug, root: chapter files as they are, whatever their types (variants)."""
    rows = spark.read.option("multiLine", True).option("singleVariantColumn", "root").json(path)
    return rows.select(F.col("_metadata.file_path").alias("json_path"), stem_of_path(F.col("_metadata.file_path")).alias("slug"), "root")


def write_chapters(questions: DataFrame, path: str) -> None:
    """Questions (subject, class and more) as JSON lines in a folder a subject and class."""
    questions.repartition("subject", "class").write.mode("overwrite").partitionBy("subject", "class").json(path)


def chosen_chapters(spark: SparkSession, path: str, schema: str, config: DataFrame) -> DataFrame:
    """Questions of `write_chapters` whose subject and class `config` has. Only those folders are read: what is
    broadcast of a filtered config prunes them while the query runs. A config of more than SMALL_CONFIG rows is joined without."""
    rows = spark.read.schema(f"{schema}, subject string, class string").json(path)
    return rows.join(broadcast_if_small(config.select("subject", "class").distinct(), SMALL_CONFIG), ["subject", "class"])


def json_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON arrays or lines at path; if nothing is there, a table without rows. Broken files fail."""
    try:
        return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def last_wins(*maps: DataFrame, key: list[str]) -> DataFrame:
    """Rows of several keyed tables of one schema; a later table's row replaces an earlier one's."""
    ranked = None
    for n, m in enumerate(maps):
        m = m.withColumn("__rank", F.lit(n))
        ranked = m if ranked is None else ranked.unionByName(m)
    rest = [c for c in maps[0].columns if c not in key]
    return ranked.groupBy(*key).agg(F.max_by(F.struct(*rest), "__rank").alias("r")).select(*key, "r.*")


def tables(html: Column) -> Column:
    """array<array<array<string>>>: the cells' text of each table that has rows, for markup whose tables do not nest;
    `markup.node_tables` takes any."""
    inner = lambda x, tag: F.regexp_extract_all(x, F.lit(rf"(?is)<(?:{tag})\b[^>]*>(.*?)</(?:{tag})>"), F.lit(1))
    text = lambda c: collapsed(F.regexp_replace(c, "<[^>]+>", " "))
    rows = lambda t: F.filter(F.transform(inner(t, "tr"), lambda r: F.transform(inner(r, "th|td"), lambda c: text(c))), lambda r: F.size(r) > 0)
    return F.filter(F.transform(inner(html, "table"), rows), lambda t: F.size(t) > 0)
