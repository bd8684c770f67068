"""Question and chapter records of the dashboard, and its overview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.text import collapsed, slug, told_explanation
from gleanery.operators.findings import weak


def question_summaries(questions: DataFrame) -> DataFrame:
    """Questions (class, slug and a chapter file's columns) as the dashboard shows them, with the text that
    its search looks through."""
    text = lambda c: collapsed(F.col(c))
    explanation = collapsed(told_explanation(F.col("explanation")))
    images = F.coalesce("images", F.array().cast("array<string>"))
    warnings = F.coalesce("parserWarnings", F.array().cast("array<string>"))
    picture = lambda x, i: F.struct(F.concat_ws("-", F.coalesce(F.nullif("class", F.lit("")), F.lit("BIOLOGY")), "slug", "id", F.lit("image"), (i + 1).cast("string")).alias("id"), x.alias("path"), F.concat(F.lit("../data/assets/"), x).alias("url"))
    words = F.array("id", "year", "text", F.array_join(F.map_values("options"), " "), explanation, F.array_join(warnings, " "), "optionExtraction.status")
    return questions.select(
        "class",
        "slug",
        "id",
        text("year").alias("year"),
        text("text").alias("text"),
        F.upper(text("answer")).alias("answer"),
        text("chapter").alias("chapter"),
        "options",
        "optionExtraction",
        warnings.alias("parserWarnings"),
        explanation.alias("explanation"),
        F.transform(images, picture).alias("images"),
        F.coalesce("tables", F.array().cast("array<array<array<string>>>")).alias("tables"),
        (explanation != "").alias("hasExplanation"),
        F.lower(F.array_join(F.filter(words, lambda x: F.coalesce(x, F.lit("")) != ""), " ")).alias("searchText"),
    )


def matching(summaries: DataFrame, asked: str = "", year: str = "") -> DataFrame:
    """Summaries whose text has what is asked for, of one year; what is empty asks for nothing."""
    rows = summaries.where(F.contains("searchText", F.lit(asked))) if asked else summaries
    return rows.where(F.col("year") == year) if year else rows


def last_of(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row, by `order`, of each key."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def chapter_records(summaries: DataFrame, papers: DataFrame, audited: DataFrame, residuals: DataFrame, alignments: DataFrame, failures: DataFrame) -> DataFrame:
    """One row a chapter: its counts, its papers, and its audit or null.

    summaries: of question_summaries. papers: class, title, pyq_links (a chapter may have none in
    summaries: then it is listed as not scraped). audited, residuals, alignments (slug, source_index,
    scraped_index, score, matched) and failures meet chapters by slug alone, of equal slugs the last (by
    place, a number); papers by class and slug.
    """
    n = F.col("optionExtraction.status")
    own = summaries.groupBy("class", "slug").agg(
        F.min_by("chapter", F.length("id")).alias("title"),
        F.count("*").alias("questionCount"),
        F.sum(F.size("images")).alias("imageCount"),
        F.sum(F.size("tables")).alias("tableCount"),
        F.count_if(n.isNotNull() & (n != "parsed")).alias("optionAnomalyCount"),
        F.sort_array(F.collect_set(F.when(F.col("year") != "", F.col("year"))), False).alias("years"),
    )
    linked = papers.select(F.col("class"), slug(F.col("title")).alias("slug"), F.col("title").alias("paper_title"), F.col("pyq_links").alias("pyqLinks"))
    every = own.withColumn("scraped", F.lit(True)).join(linked, ["class", "slug"], "full")
    found = last_of(audited, "slug", "place").select("slug", F.struct(*(c for c in audited.columns if c not in ("slug", "place"))).alias("audit"))
    left = last_of(residuals, "slug", "place").select("slug", F.struct("missing_question_ratio", "residual_block_ratio", "schema_gap_risk").alias("residual"))
    poor = weak(alignments).groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("source_index", "scraped_index", "score", "matched"))).alias("weakMatches"))
    failed = failures.groupBy("slug").agg(F.count("*").alias("schemaFailureCount"))
    rows = every.join(found, "slug", "left").join(left, "slug", "left").join(poor, "slug", "left").join(failed, "slug", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.select(
        F.concat_ws(":", "class", "slug").alias("key"),
        "class",
        "slug",
        F.coalesce(F.nullif("title", F.lit("")), "paper_title", "slug").alias("title"),
        count("questionCount"),
        count("imageCount"),
        count("tableCount"),
        count("optionAnomalyCount"),
        F.coalesce("years", F.array().cast("array<string>")).alias("years"),
        F.when(F.size("years") > 0, F.concat_ws("-", F.array_min("years"), F.array_max("years"))).alias("yearRange"),
        "pyqLinks",
        F.coalesce("scraped", F.lit(False)).alias("scraped"),
        (F.col("audit").isNotNull() & F.coalesce("scraped", F.lit(False))).alias("audited"),
        F.coalesce("audit.risk", F.lit("unknown")).alias("risk"),
        "audit",
        "residual",
        F.coalesce("weakMatches", F.array().cast("array<struct<source_index:int,scraped_index:int,score:double,matched:boolean>>")).alias("weakMatches"),
        count("schemaFailureCount"),
    )


def overview(chapters: DataFrame) -> DataFrame:
    """One row: counts and sums over chapter records, and their shares as text."""
    is_ = lambda c: F.count_if(c)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    k = chapters.agg(
        F.count("*").alias("chapterCount"),
        is_(F.col("pyqLinks").isNotNull()).alias("pyqChapterCount"),
        is_(F.col("scraped")).alias("scrapedChapterCount"),
        is_(F.col("audited")).alias("auditedChapterCount"),
        total("questionCount").alias("totalQuestions"),
        total("imageCount").alias("totalImages"),
        total("tableCount").alias("totalTables"),
        is_(F.col("risk") == "high").alias("highRiskCount"),
        is_(F.col("risk") == "medium").alias("mediumRiskCount"),
        total("schemaFailureCount").alias("schemaFailureCount"),
        is_(F.col("audit").isNotNull()).alias("benchmarkCoverage"),
    )
    of = lambda c: F.concat_ws("/", F.col(c).cast("string"), F.col("chapterCount").cast("string"))
    return k.withColumn("riskyCount", F.col("highRiskCount") + F.col("mediumRiskCount")).withColumn("auditedShare", of("auditedChapterCount")).withColumn("scrapedShare", of("scrapedChapterCount"))


def listed(chapters: DataFrame) -> DataFrame:
    """Chapters by class and title, as readers sort them."""
    return chapters.orderBy(F.collate(F.concat_ws(":", "class", "title"), "UNICODE"))


def audit_summary(chapters: DataFrame) -> DataFrame:
    """Audited chapters with their scores under the dashboard's names."""
    names = {"expected_question_count": "expectedQuestionCount", "scraped_question_count": "scrapedQuestionCount", "structural_accuracy": "structuralAccuracy", "completeness_accuracy": "completenessAccuracy", "semantic_accuracy": "semanticAccuracy", "schema_gap_risk": "schemaGapRisk", "anomaly_score": "anomalyScore", "final_accuracy": "finalAccuracy"}
    rows = chapters.where("audited").select("slug", "title", "audit.*", F.size("weakMatches").alias("weakMatchCount"), F.col("residual.missing_question_ratio").alias("missingQuestionRatio"), F.col("residual.residual_block_ratio").alias("residualBlockRatio"))
    return rows.withColumnsRenamed(names).select("slug", "title", "risk", *names.values(), "weakMatchCount", "missingQuestionRatio", "residualBlockRatio")


def orphans(papers: DataFrame, summaries: DataFrame) -> DataFrame:
    """Papers of chapters, by class and slug, that have no questions."""
    return papers.withColumn("slug", slug(F.col("title"))).join(summaries.select("class", "slug").distinct(), ["class", "slug"], "left_anti")


def selected(chapters: DataFrame, key: str) -> DataFrame:
    """The chapter of a key, or the first in order."""
    return chapters.orderBy(F.col("key") != key, F.collate(F.concat_ws(":", "class", "title"), "UNICODE")).limit(1)


def total_order(counts: DataFrame) -> list[Column]:
    """How chapters' findings are listed: covered ones first, those with the most findings first."""
    return [(~F.col("covered")).asc(), F.col("total").desc(), F.col("subject"), F.col("class_code"), F.col("chapter")]
