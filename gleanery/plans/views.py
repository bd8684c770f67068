"""Adapter views: the driver's tables in the shapes that the operators take, each with
the SQL of the same view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.sources.stored import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as pages' lines: a system turn is a header, a user's starts a block."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question record per order: its first four parts are the options, returned lines its
    images, its customer's nation the chapter, that nation's region the class."""
    first = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    lines = table(spark, sf_dir, "lineitem").withColumn("n", F.row_number().over(first))
    option = lambda i: F.coalesce(F.max(F.when(F.col("n") == i, F.col("l_partkey"))).cast("string"), F.lit(""))
    made = lines.groupBy("l_orderkey").agg(F.array(*map(option, range(1, 5))).alias("options"), F.count_if(F.col("l_returnflag") == "R").alias("images"), F.count_if(F.col("l_linestatus") == "F").alias("tables"), F.count_if(F.col("l_discount") > 0.095).alias("warnings"))
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    none = F.array(*[F.lit("")] * 4)
    return orders.join(made, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("n_regionkey").alias("class"),
        F.col("n_name").alias("chapter"),
        F.col("o_orderkey").alias("id"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.coalesce("options", none).alias("options"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("answer"),
        F.when(F.col("o_orderpriority").startswith("1"), "").otherwise(F.col("o_orderpriority")).alias("explanation"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("images", "tables", "warnings")),
    )


RECORDS_SQL = """
lines_ AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n FROM lineitem),
made AS (
  SELECT l_orderkey, coalesce(max(l_partkey::VARCHAR) FILTER (n = 1), '') AS a, coalesce(max(l_partkey::VARCHAR) FILTER (n = 2), '') AS b,
         coalesce(max(l_partkey::VARCHAR) FILTER (n = 3), '') AS c, coalesce(max(l_partkey::VARCHAR) FILTER (n = 4), '') AS d,
         count(*) FILTER (l_returnflag = 'R') AS images, count(*) FILTER (l_linestatus = 'F') AS tables, count(*) FILTER (l_discount > 0.095) AS warnings
  FROM lines_ GROUP BY 1),
records AS (
  SELECT n_regionkey AS class, n_name AS chapter, o_orderkey AS id, year(o_orderdate)::VARCHAR AS year,
         [coalesce(a, ''), coalesce(b, ''), coalesce(c, ''), coalesce(d, '')] AS options,
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS answer,
         CASE WHEN starts_with(o_orderpriority, '1') THEN '' ELSE o_orderpriority END AS explanation,
         coalesce(images, 0) AS images, coalesce(tables, 0) AS tables, coalesce(warnings, 0) AS warnings
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN made ON l_orderkey = o_orderkey)"""


def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as question texts, in a format by their size's range, with what they say."""
    p = table(spark, sf_dir, "part")
    kind = F.when(F.col("p_size") <= 10, "lower").when(F.col("p_size") <= 20, "numbered").when(F.col("p_size") <= 30, "upper").when(F.col("p_size") <= 40, "lines").otherwise("none")
    options = F.array("p_brand", "p_type", F.concat(F.lit("size "), F.col("p_size").cast("string")), F.lit("no such part"))
    stem = F.concat(F.lit("Which holds for part "), F.col("p_partkey").cast("string"), F.lit("?"))

    def text(labels: str, before: str, after: str, gap: str):
        return F.concat(stem, *(x for i, c in enumerate(labels) for x in (F.lit(f"{gap}{before}{c}{after} "), options[i])))

    shown = F.when(kind == "lower", text("abcd", "(", ")", " ")).when(kind == "numbered", text("1234", "(", ")", " ")).when(kind == "upper", text("ABCD", "", ".", " ")).when(kind == "lines", text("abcd", "(", ")", "\n")).otherwise(stem)
    return p.select("p_partkey", kind.alias("kind"), stem.alias("stem"), options.alias("options"), shown.alias("text"))


def audit_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(chapter files, their sources, pages): a nation's orders as a chapter, ten years later. The page shows them
    by year, numbered within it; the file holds them by id. A nation in five has no source. Of ten
    orders one has no explanation in the file, one tells of the interface, one has none on the page; of fifty
    one lacks a field. Files and pages come in parts, of ids and of numbers."""
    own = Window.partitionBy("class", "chapter", "y").orderBy("id")
    r = records(spark, sf_dir).withColumn("y", (F.col("year").cast("int") + 10).cast("string")).withColumn("n", F.row_number().over(own))
    id_, tenth = F.col("id").cast("string"), F.col("id") % 10
    asked, why = F.concat(F.lit("which parts has order "), id_), F.concat(F.lit("order "), id_, F.lit(" was shipped in parts"))
    shown = F.array_join(F.transform("options", lambda v, i: F.concat(F.lit("<p>("), F.substring(F.lit("abcd"), (i + 1).cast("int"), F.lit(1)), F.lit(") "), v, F.lit("</p>"))), "")
    block = F.concat(F.when(F.col("n") == 1, F.concat(F.lit("<h2>"), F.col("y"), F.lit("</h2>"))).otherwise(""), F.lit("<p>Q"), F.col("n").cast("string"), F.lit(": "), asked, F.lit("</p>"), shown, F.lit("<p>Ans: (a) "), F.when(tenth == 3, "").otherwise(why), F.lit("</p>"))
    said = F.when(tenth == 0, "").when(tenth == 2, F.concat(F.lit("View Answer "), why)).otherwise(why)
    options = F.struct(*(F.col("options")[i].alias(k) for i, k in enumerate("ABCD")))
    answer = F.when(F.col("answer") == "F", "a").when(F.col("answer") == "O", "b").otherwise("")
    none = F.array().cast("array<string>")
    question = F.struct(
        F.concat(F.lit("Q"), id_).alias("id"), asked.alias("text"), options.alias("options"), answer.alias("answer"), said.alias("explanation"), F.col("y").alias("year"), F.col("chapter"),
        F.concat(F.lit("B"), F.col("class").cast("string")).alias("class"), none.alias("images"), F.when(F.col("id") % 50 != 7, F.array().cast("array<array<array<string>>>")).alias("tables"), F.col("n").cast("string").alias("sourceQuestionNumber"),
    )
    made = stored(r.select("class", "chapter", "id", "y", "n", F.to_json(question).alias("j"), block.alias("b")), "audit-orders")
    slug = F.lower(F.replace("chapter", F.lit("_"), F.lit("-")))
    joined = lambda c, *by: F.sort_array(F.collect_list(F.struct(*by, c)))[c]
    file_part, page_part = F.floor(F.col("id") / 20_000).alias("part"), (F.shiftleft(F.col("y").cast("long"), 24) + F.floor(F.col("n") / 1_000)).alias("part")
    lists = made.groupBy("class", "chapter", file_part).agg(F.concat(F.lit("["), F.array_join(joined("j", "id"), ","), F.lit("]")).alias("j"))
    pages = made.groupBy("class", "chapter", page_part).agg(F.array_join(joined("b", "n"), "").alias("html"))
    code, address = F.concat(F.lit("B"), F.col("class").cast("string")), F.concat(F.lit("https://site.test/t/"), slug)
    files = lists.select(F.lit("biology").alias("subject"), code.alias("class_code"), slug.alias("slug"), F.concat(F.lit("/"), slug, F.lit(".json")).alias("json_path"), F.col("j").alias("root"), "part")
    covered = made.select("class", "chapter").distinct().where(~F.col("chapter").rlike("[49]$"))
    return files, covered.select(code.alias("class_code"), slug.alias("slug"), address.alias("source_url"), F.lit("paper").alias("source_label")), pages.select(address.alias("url"), "html", "part")


CHAPTERS_SQL = RECORDS_SQL + """,
asked AS (
  SELECT *, 'B' || class AS class_code, lower(replace(chapter, '_', '-')) AS slug, (year::INT + 10)::VARCHAR AS y, NOT regexp_matches(chapter, '[49]$') AS covered,
         row_number() OVER (PARTITION BY class, chapter, year ORDER BY id) AS n, row_number() OVER (PARTITION BY class, chapter ORDER BY id) - 1 AS scraped_index,
         len(list_filter(options, lambda x: x <> '')) AS filled, 'order ' || id || ' was shipped in parts' AS why FROM records),
placed AS (SELECT *, row_number() OVER (PARTITION BY class, chapter ORDER BY y, n) - 1 AS source_index FROM asked)"""
