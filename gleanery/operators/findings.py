"""Option anomalies and explanation findings, their roll-ups, and report and dashboard rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.similarity import explanation_similarity
from gleanery.functions.text import UI_LEAK, truthy

ANOMALIES = ("all_options_empty", "partial_options", "answer_without_full_options", "image_backed_option_gap", "parser_warning")
FINDINGS = ("missing_in_json", "missing_from_source", "mismatch", "ui_leak")
MISMATCH = 0.32


def _named(rules: dict[str, Column]) -> Column:
    return F.filter(F.array(*(F.when(c, k) for k, c in rules.items())), lambda x: x.isNotNull())


def anomaly_types() -> Column:
    """Of a question with options (array), answer, images (count), warnings (count)."""
    n = F.size(F.filter("options", lambda v: F.trim(F.coalesce(v, F.lit(""))) != ""))
    short = n < 4
    return _named({"all_options_empty": n == 0, "partial_options": (n > 0) & short, "answer_without_full_options": truthy(F.col("answer")) & short, "image_backed_option_gap": (F.col("images") > 0) & short, "parser_warning": F.col("warnings") > 0})


def anomaly_rollup(questions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """By keys (none: the corpus), question and anomaly counts; chapters without any stay."""
    t = questions.withColumn("types", anomaly_types())
    has = lambda k: F.count_if(F.array_contains("types", k))
    return t.groupBy(*keys).agg(F.count("*").alias("question_count"), F.count_if(F.size("types") > 0).alias("anomaly_count"), has("all_options_empty").alias("all_empty_option_count"), has("partial_options").alias("partial_option_count"), has("image_backed_option_gap").alias("image_backed_gap_count"))


def anomaly_levels(questions: DataFrame, *keys: str) -> DataFrame:
    """The same by all keys, by each shorter list of them, and over the corpus, from one reading: level is the
    number of keys that count; the others are null there."""
    t = questions.withColumn("types", anomaly_types())
    has = lambda k: F.count_if(F.array_contains("types", k))
    levels = t.groupingSets([[F.col(k) for k in keys[:n]] for n in range(len(keys), -1, -1)], *keys)
    counted = levels.agg(F.grouping_id(*keys).alias("unset"), F.count("*").alias("question_count"), F.count_if(F.size("types") > 0).alias("anomaly_count"), has("all_options_empty").alias("all_empty_option_count"), has("partial_options").alias("partial_option_count"), has("image_backed_option_gap").alias("image_backed_gap_count"))
    return counted.withColumn("level", (F.lit(len(keys)) - F.bit_count("unset")).cast("int")).drop("unset")


def explanation_findings(pairs: DataFrame) -> DataFrame:
    """pairs (key columns, source_explanation, json_explanation) as one row a finding, with its
    category and, for a mismatch, the similarity."""
    a, b = F.col("source_explanation"), F.col("json_explanation")
    rows = pairs.withColumn("similarity", F.when((a != "") & (b != ""), explanation_similarity(a, b)))
    found = _named({"missing_in_json": (a != "") & (b == ""), "missing_from_source": (a == "") & (b != ""), "mismatch": F.col("similarity") < MISMATCH, "ui_leak": F.rlike(b, F.lit(UI_LEAK))})
    out = rows.select(*pairs.columns, "similarity", F.explode(found).alias("category"))
    return out.withColumn("similarity", F.when(F.col("category") == "mismatch", F.round("similarity", 3)))


def finding_counts(findings: DataFrame, key: str) -> DataFrame:
    counted = findings.groupBy(key).pivot("category", list(FINDINGS)).count().na.fill(0)
    return counted.withColumn("total", sum((F.col(c) for c in FINDINGS[1:]), F.col(FINDINGS[0])))


def weak(matches: DataFrame, below: float = 0.6) -> DataFrame:
    return matches.where(~F.col("matched") | (F.col("score") < below))


def top_per(rows: DataFrame, key: str, order: Sequence[Column], n: int = 8) -> DataFrame:
    """The first n rows of each key."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("place") <= n)


def search(rows: DataFrame, text: Column, asked: str) -> DataFrame:
    """Rows whose text has what is asked for; all if nothing is."""
    return rows.where(F.contains(F.lower(text), F.lit(asked.strip().lower())))
