"""The audit from end to end: targets, source pages and chapter files to the reports."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gleanery.functions.text import collapsed, number_of, stated_explanation, told_explanation, truncated
from gleanery.operators import align, findings, schema_rules, scoring
from gleanery.operators.blocks import blocks, blocks_of_parts, signals, with_keys
from gleanery.operators.dashboard import total_order
from gleanery.sources.pages import QUESTION, page_lines
from gleanery.sources.reports import write_csv, write_json
from gleanery.sources.stored import broadcast_if_small, numbered, stored

WHO = ("subject", "class_code", "chapter", "slug")
NUMBER = "sourceQuestionNumber"
NO_SOURCE = "no_source_mapping_for_chapter"
#: Covered chapters up to which they are broadcast to their pages.
SMALL = 100_000


def targets_of(files: DataFrame, sources: DataFrame, classes: str = "", subjects: str = "") -> DataFrame:
    """Chapter files (subject, class_code, slug, json_path, root) by their records, with the source of their class and
    slug, if `sources` (class_code, slug, source_url, source_label) has one. classes and subjects: comma-separated lists,
    empty ones ask for all. A file may come in several rows with a `part` each, stretches of its list in order: no task
    need hold a chapter. first_index is the place of a row's first record in the file, 0 in the chapter's leading row.
    root: a variant, or the file's text. It is taken apart once, into records (JSON texts; null if it is no list)."""
    asked = lambda s: [x.strip().lower() for x in s.split(",") if x.strip()]
    for column, wanted in (("class_code", asked(classes)), ("subject", asked(subjects))):
        if wanted:
            files = files.where(F.lower(column).isin(wanted))
    files = files.withColumn("records", schema_rules.record_texts(F.col("root"), files.schema["root"].dataType == StringType())).drop("root")
    if "part" in files.columns:
        files = stored(files, "audit-files")
    first = F.nullif(collapsed(F.try_variant_get(F.try_parse_json(F.try_element_at("records", F.lit(1))), "$.chapter", "string")), F.lit(""))
    count = F.coalesce(F.size("records"), F.lit(0))
    spelled = F.initcap(F.replace("slug", F.lit("-"), F.lit(" ")))
    if "part" in files.columns:
        whole = Window.partitionBy("class_code", "slug")
        earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sizes = files.select("class_code", "slug", "part", first.alias("first"), F.greatest(count, F.lit(0)).alias("n"))
        sizes = sizes.select(
            "class_code", "slug", "part", F.min_by("first", "part").over(whole).alias("chapter"), F.sum("n").over(whole).cast("int").alias("question_count"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("int").alias("first_index"), (F.col("part") == F.min("part").over(whole)).alias("leading")
        )
        rows = files.join(sizes, ["class_code", "slug", "part"]).drop("part").withColumn("chapter", F.coalesce("chapter", spelled))
    else:
        rows = files.withColumn("chapter", F.coalesce(first, spelled)).withColumn("question_count", count).withColumn("first_index", F.lit(0)).withColumn("leading", F.lit(True))
    found = sources.select("class_code", "slug", "source_url", "source_label")
    rows = rows.join(found, ["class_code", "slug"], "left").withColumn("covered", F.col("source_url").isNotNull())
    return rows.withColumn("coverage_reason", F.when(~F.col("covered"), F.lit(NO_SOURCE)))


def _records(targets: DataFrame) -> DataFrame:
    """page_id, index, j, whole: the records of the chapter files as JSON texts; a root that is no list is a whole one, null."""
    rows = numbered(targets.select("page_id", "first_index", "records"), F.coalesce("records", F.array(F.lit(None).cast("string"))), "n", "j")
    return rows.select("page_id", (F.col("first_index") + F.col("n")).alias("index"), "j", F.col("records").isNull().alias("whole"))


def _questions(targets: DataFrame) -> DataFrame:
    """page_id, scraped_index and a question's columns, of every record that is an object."""
    rows = _records(targets).where(F.col("j").startswith("{")).withColumnRenamed("index", "scraped_index")
    # A field that is not of its type counts as absent; the schema report has it.
    record = F.from_json("j", f"{QUESTION}, {NUMBER} string")
    rows = rows.select("page_id", "scraped_index", "j", record.alias("q")).select("page_id", "scraped_index", "j", "q.*")
    # 5.0 is a number and "5.0" none; what may be either is looked at with its type.
    typed = F.try_variant_get(F.try_parse_json(F.when(F.rlike(NUMBER, F.lit("[.eE]")), F.col("j"))), f"$.{NUMBER}", "string")
    number = F.when(F.rlike(NUMBER, F.lit("[.eE]")), number_of(typed)).otherwise(number_of(F.col(NUMBER)))
    return rows.withColumn("number", number).drop("j", NUMBER)


def _size(c: str) -> Column:
    return F.greatest(F.size(F.coalesce(F.col(c), F.array())), F.lit(0))


def _filled() -> Column:
    return F.filter(F.map_values(F.coalesce("options", F.create_map().cast("map<string,string>"))), lambda v: F.coalesce(v, F.lit("")) != "")


class Audit:
    """The stages of an audit and its reports; a stage that several reports read is stored once, when the
    first of them asks for it.

    targets: of targets_of. pages: url, html, and part, where pages come in parts; a source without a page counts as an empty one.
    Chapters meet their page, blocks and questions by class and slug; each is aligned within itself,
    and chapters, in the parts they come in, spread over all tasks.
    """

    def __init__(self, targets: DataFrame, pages: DataFrame):
        self.targets = targets.withColumn("page_id", F.concat_ws(":", "class_code", "slug"))
        self.pages = pages.select("url", "html", *(c for c in pages.columns if c == "part"))

    @cached_property
    def who(self) -> DataFrame:
        return stored(self.targets.where("leading").select("page_id", *WHO, "json_path", "source_url", "covered", "coverage_reason", "question_count"), "audit-chapters")

    @property
    def covered(self) -> DataFrame:
        return self.targets.where("covered")

    @cached_property
    def source(self) -> DataFrame:
        own = self.who.where("covered").select("page_id", F.col("source_url").alias("url"))
        if "part" not in self.pages.columns:
            return own.join(self.pages, "url", "left").select("page_id", F.coalesce("html", F.lit("")).alias("html"))
        there = self.pages.join(broadcast_if_small(own, SMALL), "url").select("page_id", "html", "part")
        gone = own.join(self.pages.select("url"), "url", "left_anti").select("page_id", F.lit("").alias("html"), F.lit(0).alias("part"))
        return stored(there.unionByName(gone), "audit-source")

    @cached_property
    def blocks(self) -> DataFrame:
        found = blocks_of_parts(self.source) if "part" in self.pages.columns else blocks(page_lines(self.source))
        return stored(with_keys(found), "audit-blocks")

    @cached_property
    def questions(self) -> DataFrame:
        return stored(_questions(self.targets), "audit-questions")

    @cached_property
    def aligned(self) -> DataFrame:
        covered = self.who.where("covered").select("page_id")
        own = self.questions.join(covered, "page_id", "left_semi").withColumn("options", F.map_values("options"))
        return stored(align.align(self.blocks, own, "page_id"), "audit-aligned")

    @cached_property
    def errors(self) -> DataFrame:
        return stored(schema_rules.records_errors(_records(self.covered).withColumn("v", F.try_parse_json("j")).drop("j")), "audit-errors")

    @cached_property
    def scored(self) -> DataFrame:
        """A row a covered chapter: what its page lets one expect, what its questions show, and the scores."""
        explanation = told_explanation(F.col("explanation"))
        counted = self.questions.groupBy("page_id").agg(
            F.count_if(F.coalesce("answer", F.lit("")) != "").alias("answers"),
            F.sum(F.size(_filled())).alias("options"),
            F.sum(_size("images")).alias("images"),
            F.sum(_size("tables")).alias("tables"),
            F.count_if(F.coalesce(explanation, F.lit("")) == "").alias("empty_explanations"),
            F.count_if(F.size(F.array_distinct(F.map_values("options"))) < 4).alias("duplicate_options"),
        )
        meaning = self.aligned.groupBy("page_id").agg(F.avg(F.when(F.col("matched"), F.col("score")).otherwise(0.0)).alias("mean_alignment"))
        faults = self.errors.groupBy("page_id").agg(F.count("*").alias("schema_errors"))
        chapters = self.who.where("covered").select("page_id", F.col("question_count").cast("long").alias("questions")).join(signals(self.blocks, self.source), "page_id", "left")
        for side in (counted, meaning, faults):
            chapters = chapters.join(side, "page_id", "left")
        zero = [c for c in chapters.columns if c not in ("page_id", "mean_alignment")]
        return stored(scoring.scored(chapters.na.fill(0, zero)).join(self.who, "page_id"), "audit-scores")

    @cached_property
    def anomalies(self) -> DataFrame:
        return stored(_anomalies(self.questions, self.who), "audit-anomalies")

    @cached_property
    def told(self) -> DataFrame:
        return stored(_explanations(self.aligned, self.blocks, self.questions, self.who), "audit-explanations")

    def chapter_summary(self) -> DataFrame:
        return self.scored.select(
            "page_id", *WHO, "source_url", "json_path", "expected_question_count", F.col("questions").alias("scraped_question_count"), F.col("schema_errors").alias("schema_error_count"), "structural_accuracy",
            "completeness_accuracy", "semantic_accuracy", "schema_gap_risk", "anomaly_score", "final_accuracy", "risk", "dominant_failures",
        )

    def high_risk_chapters(self) -> DataFrame:
        return self.chapter_summary().where("risk <> 'low'")

    def schema_failures(self) -> DataFrame:
        return self.errors.join(self.who, "page_id").select("page_id", *WHO, "json_path", "index", "field", "type", "expected", "actual")

    def residual_text_report(self) -> DataFrame:
        return self.scored.select("page_id", *WHO, "json_path", "missing_question_ratio", "residual_block_ratio", "schema_gap_risk")

    def question_alignment(self) -> DataFrame:
        return self.aligned.join(self.who, "page_id").select("page_id", *WHO, "json_path", "source_index", "scraped_index", "score", "matched")

    def uncovered_chapters(self) -> DataFrame:
        return self.who.where("not covered").select("page_id", *WHO, "json_path", "question_count", "coverage_reason")

    def option_anomalies(self) -> DataFrame:
        return self.anomalies.where(F.size("types") > 0).select("page_id", *WHO, F.col("id").alias("question_id"), "year", "text", "answer", "images", "tables", "non_empty_option_count", F.col("types").alias("anomaly_types"))

    def option_anomaly_chapters(self) -> DataFrame:
        return _anomaly_counts(self.anomalies, self.who)

    def explanation_accuracy_scan(self) -> DataFrame:
        return self.told

    def explanation_chapters(self) -> DataFrame:
        return _explanation_counts(self.told, self.blocks, self.who)


#: Reports of a row a chapter or finding, by name, and those that are made of others.
OF_CHAPTERS = (
    "chapter_summary", "high_risk_chapters", "schema_failures", "residual_text_report", "question_alignment", "uncovered_chapters", "option_anomalies", "option_anomaly_chapters", "explanation_accuracy_scan", "explanation_chapters",
)


def _overall(reports: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The reports without their chapters' keys, the totals added, chapters of findings in their order."""
    sums = reports["option_anomaly_chapters"].agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ANOMALY_COUNTS), F.count("*").alias("chapter_count"))
    out = {k: v.drop("page_id") for k, v in reports.items()} | {"option_anomaly_totals": sums}
    listed = out["explanation_chapters"]
    return out | {"explanation_chapters": listed.orderBy(*total_order(listed))}


def audit(targets: DataFrame, pages: DataFrame) -> dict[str, DataFrame]:
    """The reports by name, a row a finding where a report has lists."""
    a = Audit(targets, pages)
    return _overall({name: getattr(a, name)() for name in OF_CHAPTERS})


def content(targets: DataFrame, pages: DataFrame) -> DataFrame:
    """page_id, content: a digest of all that a chapter's audit depends on."""
    key = F.concat_ws(":", "class_code", "slug").alias("page_id")
    part = F.col("part") if "part" in pages.columns else F.lit(0)
    digests = lambda rows, by, at, told: rows.select(by, F.struct(at.alias("at"), F.sha2(F.to_json(told), 256).alias("d")).alias("x")).groupBy(by).agg(F.to_json(F.array_sort(F.collect_list("x"))).alias("x"))
    files = digests(targets.withColumn("page_id", key), F.col("page_id"), F.col("first_index"), F.array(F.to_json(F.struct("records")), *(F.col(c) for c in (*WHO, "json_path", "source_url", "coverage_reason"))))
    html = digests(pages, F.col("url"), part, F.array("html")).select(F.col("url").alias("source_url"), F.col("x").alias("html"))
    rows = files.join(targets.where("leading").select(key, "source_url"), "page_id").join(html, "source_url", "left")
    return rows.select("page_id", F.sha2(F.to_json(F.array("x", "html")), 256).alias("content"))


def refresh(targets: DataFrame, pages: DataFrame, folder: str, previous: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """(reports; page_id of the chapters that were audited): as audit(), kept as Parquet under `folder`. Chapters whose
    content is as it was when `previous` was written are taken from there; only the others are audited."""
    spark = targets.sparkSession
    now = stored(content(targets, pages), "audit-content")
    if previous is None:
        same = now.select("page_id").limit(0)
    else:
        same = stored(now.join(spark.read.parquet(f"{previous}/content"), ["page_id", "content"], "left_semi").select("page_id"), "audit-unchanged")
    changed = now.select("page_id").join(same, "page_id", "left_anti")
    key = F.concat_ws(":", "class_code", "slug")
    a = Audit(targets.join(changed.withColumnRenamed("page_id", "changed"), key == F.col("changed"), "left_semi"), pages)
    reports = {}
    for name in OF_CHAPTERS:
        rows = getattr(a, name)()
        if previous is not None:
            rows = rows.unionByName(spark.read.parquet(f"{previous}/{name}").join(same, "page_id", "left_semi"))
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
        reports[name] = spark.read.parquet(f"{folder}/{name}")
    now.write.mode("overwrite").parquet(f"{folder}/content")
    return _overall(reports), changed


def _anomalies(questions: DataFrame, who: DataFrame) -> DataFrame:
    four = F.array(*(F.coalesce(F.col("options")[k], F.lit("")) for k in "ABCD"))
    rows = questions.withColumn("options", four).withColumn("images", _size("images")).withColumn("tables", _size("tables")).withColumn("warnings", _size("parserWarnings"))
    filled = F.size(F.filter("options", lambda v: F.trim(v) != ""))
    return rows.withColumn("types", findings.anomaly_types()).withColumn("non_empty_option_count", filled).drop("chapter").join(who.select("page_id", *WHO), "page_id")


ANOMALY_COUNTS = ("anomaly_count", "all_empty_option_count", "partial_option_count", "image_backed_gap_count")


def _anomaly_counts(anomalies: DataFrame, who: DataFrame) -> DataFrame:
    """By chapter, those without any included."""
    has = lambda k: F.count_if(F.array_contains("types", k))
    n = (F.count_if(F.size("types") > 0), has("all_options_empty"), has("partial_options"), has("image_backed_option_gap"))
    counts = anomalies.groupBy("page_id").agg(*(c.alias(k) for c, k in zip(n, ANOMALY_COUNTS)))
    return who.join(counts, "page_id", "left").select("page_id", *WHO, "question_count", *(F.coalesce(k, F.lit(0)).alias(k) for k in ANOMALY_COUNTS))


def _explanations(aligned: DataFrame, own_blocks: DataFrame, questions: DataFrame, who: DataFrame) -> DataFrame:
    """A row a finding about the explanations of matched questions."""
    b = own_blocks.select("page_id", "source_index", stated_explanation(F.col("lines")).alias("source_explanation"), F.col("number").alias("source_number"))
    q = questions.select("page_id", "scraped_index", "id", "year", "text", told_explanation(F.coalesce("explanation", F.lit(""))).alias("json_explanation"))
    pairs = aligned.where("matched").join(b, ["page_id", "source_index"]).join(q, ["page_id", "scraped_index"])
    found = findings.explanation_findings(pairs.select("page_id", "id", "year", "text", "source_number", "source_explanation", "json_explanation"))
    snippet = lambda c, *not_in: F.when(~F.col("category").isin("ui_leak", *not_in), truncated(F.col(c)))
    return found.join(who, "page_id").select(
        "page_id",
        *WHO,
        "category",
        F.col("id").alias("json_id"),
        F.concat(F.lit("Q"), F.col("source_number").cast("string")).alias("source_q"),
        "year",
        truncated(F.col("text")).alias("text"),
        "similarity",
        snippet("source_explanation", "missing_from_source").alias("source_snippet"),
        snippet("json_explanation", "missing_in_json").alias("json_snippet"),
    )


def _explanation_counts(told: DataFrame, own_blocks: DataFrame, who: DataFrame) -> DataFrame:
    """By chapter: whether it is covered, and its findings by category."""
    counts = told.groupBy("page_id").pivot("category", list(findings.FINDINGS)).count()
    sources = own_blocks.groupBy("page_id").agg(F.count("*").alias("source_question_count"))
    rows = who.join(sources, "page_id", "left").join(counts, "page_id", "left")
    n = {c: F.coalesce(c, F.lit(0)) for c in ("source_question_count", *findings.FINDINGS)}
    total = sum((n[c] for c in findings.FINDINGS[1:]), n[findings.FINDINGS[0]])
    return rows.select("page_id", *WHO, "source_url", "covered", "coverage_reason", F.col("question_count").alias("json_question_count"), *(v.alias(c) for c, v in n.items()), total.alias("total"))


def write_reports(reports: dict[str, DataFrame], folder: str) -> None:
    """Each report as JSON lines, the summary also as CSV."""
    for name, rows in reports.items():
        write_json(rows, f"{folder}/{name}.json")
    write_csv(reports["chapter_summary"], f"{folder}/chapter_summary.csv")


def run(files: DataFrame, sources: DataFrame, pages: DataFrame, folder: str, classes: str = "", subjects: str = "") -> dict[str, DataFrame]:
    """Builds and writes the reports of the chapters asked for."""
    reports = audit(targets_of(files, sources, classes, subjects), pages)
    write_reports(reports, folder)
    return reports
