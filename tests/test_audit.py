"""The audit from end to end, on hand-made pages and chapter files."""

import json

import pytest
from pyspark.sql import functions as F

from gleanery.operators import dashboard
from gleanery.plans import audit
from gleanery.sources import links, pages as P

BASE = "https://site.test"
ASKED = ["", "which gas do green leaves give off", "how many bones has the middle ear", "who drew the first map of stars", "when does ice float on cold water", "why do rivers bend near the sea"]


def question(n, **other):
    q = {"id": f"Q{n}", "text": ASKED[n], "options": dict(zip("ABCD", ("red", "green", "blue", "grey"))), "answer": "a", "explanation": "because it is so", "year": "2020", "chapter": "The Cell", "class": "B11", "images": [], "tables": []}
    return q | other


def block(n, explanation="because it is so"):
    return f"<p>Q{n}: {ASKED[n]}</p><p>(a) red</p><p>(b) green</p><p>(c) blue</p><p>(d) grey</p><p>Ans: (a) {explanation}</p>"


@pytest.fixture(scope="module")
def reports(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("audit")
    files = {
        "the-cell": [question(1), question(2, explanation=""), question(3, options=dict(zip("ABCD", ("red", "", "", ""))), images=["x.png"]), question(4, explanation="quite another story, View Answer zzz")],
        "tides": [question(1, chapter="Tides"), 5, question(2, chapter="Tides", year=2020)],
        "not-a-list": {"a": 1},
    }
    for slug, content in files.items():
        (folder / f"{slug}.json").write_text(json.dumps(content))
    roots = P.chapter_roots(spark, str(folder / "*.json")).select(F.lit("biology").alias("subject"), F.lit("B11").alias("class_code"), "slug", "json_path", "root")
    sources = spark.createDataFrame([("B11", "the-cell", f"{BASE}/t/1", "Cell"), ("B11", "not-a-list", f"{BASE}/t/2", "None")], "class_code string, slug string, source_url string, source_label string")
    html = "<h2>2020</h2>" + "".join(block(n) for n in (1, 2, 3, 4, 5))
    pages = spark.createDataFrame([(f"{BASE}/t/1", html)], "url string, html string")
    return {k: v.collect() for k, v in audit.run(roots, sources, pages, str(folder / "out"), classes=" b11, ").items()}, str(folder / "out")


def test_summary(reports):
    rows = {r.slug: r for r in reports[0]["chapter_summary"]}
    assert set(rows) == {"the-cell", "not-a-list"}
    cell = rows["the-cell"]
    assert (cell.chapter, cell.expected_question_count, cell.scraped_question_count, cell.schema_error_count, cell.structural_accuracy) == ("The Cell", 5, 4, 0, 1.0)
    # 4 of 5 questions and answers, 13 of 20 options, one picture where one at least is expected, no table.
    assert cell.completeness_accuracy == round(0.35 * 0.8 + 0.2 * 0.8 + 0.2 * 13 / 20 + 0.15, 4)
    assert cell.schema_gap_risk == round(0.7 * 0.2, 4) and "missing_questions" in cell.dominant_failures
    assert rows["not-a-list"].risk == "high" and rows["not-a-list"].scraped_question_count == 0
    assert {r.slug for r in reports[0]["high_risk_chapters"]} == {s for s, r in rows.items() if r.risk != "low"}


def test_schema_and_coverage(reports):
    assert [(r.slug, r["index"], r.type) for r in reports[0]["schema_failures"]] == [("not-a-list", None, "root_not_list")]
    assert [(r.slug, r.question_count, r.coverage_reason) for r in reports[0]["uncovered_chapters"]] == [("tides", 3, "no_source_mapping_for_chapter")]


def test_alignment_and_explanations(reports):
    aligned = sorted((r.source_index, r.scraped_index) for r in reports[0]["question_alignment"] if r.matched)
    assert aligned == [(i, i) for i in range(4)]
    found = sorted((r.json_id, r.category) for r in reports[0]["explanation_accuracy_scan"])
    assert found == [("Q2", "missing_in_json"), ("Q4", "mismatch"), ("Q4", "ui_leak")]
    counts = [(r.slug, r.covered, r.total) for r in reports[0]["explanation_chapters"]]
    assert counts == [("the-cell", True, 3), ("not-a-list", True, 0), ("tides", False, 0)]


def test_anomalies(reports):
    (only,) = reports[0]["option_anomalies"]
    assert (only.question_id, only.anomaly_types) == ("Q3", ["partial_options", "answer_without_full_options", "image_backed_option_gap"])
    chapters = {r.slug: (r.question_count, r.anomaly_count) for r in reports[0]["option_anomaly_chapters"]}
    assert chapters == {"the-cell": (4, 1), "tides": (3, 0), "not-a-list": (0, 0)}
    (total,) = reports[0]["option_anomaly_totals"]
    assert (total.chapter_count, total.anomaly_count) == (3, 1)


def test_reports_are_written(spark, reports):
    assert spark.read.json(f"{reports[1]}/question_alignment.json").count() == 5
    assert spark.read.csv(f"{reports[1]}/chapter_summary.csv", header=True).count() == 2


def chapter_files(spark, chapters):
    rows = [("biology", "B11", slug, f"/{slug}.json", json.dumps(content)) for slug, content in chapters.items()]
    return spark.createDataFrame(rows, "subject string, class_code string, slug string, json_path string, j string").select("subject", "class_code", "slug", "json_path", F.parse_json("j").alias("root"))


def test_only_changed_chapters_are_done_again(spark, tmp_path):
    chapters = {"the-cell": [question(1), question(2)], "tides": [question(3, chapter="Tides"), question(4, chapter="Tides", explanation="")], "gone": [question(5)]}
    sources = spark.createDataFrame([("B11", s, f"{BASE}/t/{s}", s) for s in ("the-cell", "tides", "new")], "class_code string, slug string, source_url string, source_label string")
    html = "<h2>2020</h2>" + "".join(block(n) for n in (1, 2, 3, 4))
    pages = [(f"{BASE}/t/{s}", html) for s in ("the-cell", "tides", "new")]

    def run(folder, previous):
        p = spark.createDataFrame(pages, "url string, html string")
        targets = audit.targets_of(chapter_files(spark, chapters), sources)
        reports, done = audit.refresh(targets, p, f"{tmp_path}/{folder}", previous and f"{tmp_path}/{previous}")
        whole = audit.audit(targets, p) if folder == "files" else {}
        assert whole.keys() <= reports.keys()
        for name in whole:
            assert sorted(map(str, reports[name].collect())) == sorted(map(str, whole[name].collect())), name
        return {r.page_id for r in done.collect()}

    assert run("first", None) == {"B11:the-cell", "B11:tides", "B11:gone"}
    assert run("same", "first") == set()
    chapters["tides"] = [question(3, chapter="Tides", answer="")]
    chapters["new"] = [question(1, chapter="New")]
    del chapters["gone"]
    assert run("files", "same") == {"B11:tides", "B11:new"}
    pages[0] = (pages[0][0], html + block(5))
    assert run("page", "files") == {"B11:the-cell"}


def test_alignment_is_made_once(spark, tmp_path, monkeypatch):
    calls = []
    real = audit.align.align
    monkeypatch.setattr(audit.align, "align", lambda *a: calls.append(1) or real(*a))
    sources = spark.createDataFrame([("B11", "the-cell", f"{BASE}/t/1", "x")], "class_code string, slug string, source_url string, source_label string")
    targets = audit.targets_of(chapter_files(spark, {"the-cell": [question(1)]}), sources)
    a = audit.Audit(targets, spark.createDataFrame([(f"{BASE}/t/1", "<h2>2020</h2>" + block(1))], "url string, html string"))
    rows = [getattr(a, n)() for n in audit.OF_CHAPTERS]
    assert len(calls) == 1
    assert "ArrowEvalPython" not in "".join(r._jdf.queryExecution().optimizedPlan().toString() for r in (rows[0], rows[4], rows[9]))


def test_dashboard(spark):
    rows = [("B11", "the-cell", question(1, images=["a.png", "b.png"], optionExtraction={"source": "s", "status": "partial", "imageTokenCount": 0, "nonEmptyOptionCount": 2})), ("B11", "the-cell", question(2, year="2022")), ("B12", "tides", question(1))]
    raw = spark.createDataFrame([(c, s, json.dumps(q)) for c, s, q in rows], "class string, slug string, j string")
    q = raw.select("class", "slug", F.from_json("j", P.QUESTION).alias("q")).select("class", "slug", *(f"q.{c}" for c in ("id text options answer explanation year chapter images tables optionExtraction parserWarnings".split())))
    s = dashboard.question_summaries(q)
    first = s.where("slug = 'the-cell' and id = 'Q1'").first()
    assert first.answer == "A" and [i.id for i in first.images] == ["B11-the-cell-Q1-image-1", "B11-the-cell-Q1-image-2"] and "partial" in first.searchText
    assert dashboard.matching(s, "green", "2022").count() == 1 and dashboard.matching(s).count() == 3
    papers = spark.createDataFrame([("B11", "The Cell", ["u"]), ("B12", "Only Linked", ["v"])], "class string, title string, pyq_links array<string>")
    audited = spark.createDataFrame([("the-cell", 1, 0.5, "low"), ("the-cell", 2, 0.7, "high")], "slug string, place int, final_accuracy double, risk string")
    residuals = spark.createDataFrame([("the-cell", 1, 0.1, 0.2, 0.3)], "slug string, place int, missing_question_ratio double, residual_block_ratio double, schema_gap_risk double")
    alignments = spark.createDataFrame([("the-cell", 0, 0, 0.9, True), ("the-cell", 1, 1, 0.58, True), ("the-cell", 2, None, 0.0, False)], "slug string, source_index int, scraped_index int, score double, matched boolean")
    failures = spark.createDataFrame([("tides",)], "slug string")
    c = dashboard.chapter_records(s, papers, audited, residuals, alignments, failures)
    got = {r.key: r for r in c.collect()}
    assert {k: (r.questionCount, r.imageCount, r.yearRange, r.scraped, r.audited, r.risk, len(r.weakMatches)) for k, r in got.items()} == {
        "B11:the-cell": (2, 2, "2020-2022", True, True, "high", 2), "B12:tides": (1, 0, "2020-2020", True, False, "unknown", 0), "B12:only-linked": (0, 0, None, False, False, "unknown", 0),
    }
    o = dashboard.overview(c).first()
    assert (o.chapterCount, o.pyqChapterCount, o.scrapedChapterCount, o.totalQuestions, o.highRiskCount, o.riskyCount, o.auditedShare) == (3, 2, 2, 3, 1, 1, "1/3")
    assert [r.slug for r in dashboard.orphans(papers, s).collect()] == ["only-linked"]
    assert dashboard.selected(c, "B12:tides").first().slug == "tides" and dashboard.selected(c, "none").first().key == "B11:the-cell"


COURSE = """<a class=crs_chptr title=x href=/chapter/12_The-Cell><h2 class=subcoursetitle>The <b>Cell</b> &amp; Life</h2></a>
<a href='/chapter/12_The-Cell' class="big crs_chptr"><h2 class="subcoursetitle">again</h2></a>
<a class="crs_chptr" data-x="1" href="/topic/13_Tides">Tides Biology Class 11 - Notes</a><a class=crs_chptr href=/chapter/14_Mind>Mindmaps</a><a href="/chapter/15_x">no chapter</a>"""
CHAPTER = """<script>{"name":"NEET Previous Year Questions: Tides","url":"https://site.test/t/7/tides"}</script>
<a rel=x href=/t/9/the-cell><b class=subcoursetitle>x</b></a><a href="/t/8/cell#top" class=c>NEET Previous Year Questions: The Cell and Life Doc | 9 pages</a>
<a href=/t/8/cell>NEET Previous Year Questions: The Cell and Life</a><a href=/t/6/c>CBSE Previous Year Questions, NEET Previous Year Questions: The Cell and Life</a>"""


def test_links(spark):
    course = spark.createDataFrame([(1, f"{BASE}/courses/1", COURSE, "99", "Biology Class 11")], "page_id int, url string, html string, course_id string, course_title string")
    assert [tuple(r)[1:] for r in links.chapter_links(course).orderBy("index").collect()] == [(1, "12", "The Cell & Life", f"{BASE}/chapter/12_The-Cell", "The-Cell"), (2, "14", "Mindmaps", f"{BASE}/chapter/14_Mind", "Mind")]
    assert {r.slug for r in links.course_chapters(course).collect()} == {"the-cell-and-life", "again", "mindmaps"}
    topics = links.topic_links(course).orderBy("index").collect()
    assert [(r.id, r.title, r.class_code, r.subject) for r in topics][0] == ("12", "The Cell & Life", "B11", "biology") and "Mindmaps" not in {r.title for r in topics}
    assert {r.title for r in topics} == {"The Cell & Life", "again", "Tides"}
    page = spark.createDataFrame([(1, f"{BASE}/chapter/12", CHAPTER, "The Cell & Life")], "page_id int, url string, html string, chapter_title string")
    got = links.document_links(page, page.select("page_id", F.col("chapter_title").alias("title"))).collect()
    assert sorted((r.document_id, r.slug, r.url) for r in got) == [("8", "cell", f"{BASE}/t/8/cell"), ("8", "cell", f"{BASE}/t/8/cell#top")]
    assert links.document_of(page).first().source_url == f"{BASE}/t/8/cell"
    other = page.withColumn("chapter_title", F.lit("Genes"))
    assert links.document_of(other).first().source_url == "https://site.test/t/7/tides"  # the first, where none holds the title
    assert links.document_of(page.withColumn("html", F.lit("<p>"))).count() == 0
    chapters = spark.createDataFrame([("a", "The Cell & Life", f"{BASE}/chapter/12"), ("b", "Gone", f"{BASE}/chapter/13")], "slug string, chapter_title string, chapter_url string")
    assert [(r.class_code, r.slug) for r in links.source_map(chapters, page, F.lit("B11")).collect()] == [("B11", "a")]


def test_metadata_and_verification(spark):
    html = """<title>NEET Previous Year Questions: The Cell | Biology Class 11 PDF</title><link href="https://c" rel=canonical>
    <div class="x brdcrmb_cntnr"><a href="/home">Home</a><a href=https://s/courses/1>Biology Class 11</a></div><input value="Hidden  Title" id="leftSideCourseTitleHidden">"""
    m = links.page_metadata(spark.createDataFrame([(1, html)], "page_id int, html string"))
    assert tuple(m.first())[2:] == ("https://c", "Biology Class 11", "Hidden Title")
    rows = spark.createDataFrame([("NEET Previous Year Questions: The Cell", c, "The Cell", k) for c, k in (("Biology Class 11", "B11"), ("", "B11"), ("Biology Class 12", "B11"), ("Physics Class 12", "P12"))], "page_title string, course_title string, title string, class_code string")
    assert [r.v for r in rows.select(links.verified(rows).alias("v")).collect()] == [True, True, False, True]


def test_a_page_without_html_has_empty_metadata(spark):
    pages = spark.createDataFrame([(1, None), (2, "")], "page_id int, html string")
    assert sorted(map(tuple, links.page_metadata(pages).collect())) == [(1, "", "", "", ""), (2, "", "", "", "")]


@pytest.mark.parametrize(("href", "base", "want"), [("/a/b", "https://h.t/x/y?q", "https://h.t/a/b"), ("//o.t/z", "https://h.t/x", "https://o.t/z"), ("https://o/z", "https://h.t/x", "https://o/z"), ("c.html", "https://h.t/x/y.html", "https://h.t/x/c.html"), ("../c", "https://h.t/x/y/z", "https://h.t/x/c"), ("?p=2", "https://h.t/x?p=1", "https://h.t/x?p=2"), ("#f", "https://h.t/x#e", "https://h.t/x#f"), ("c", "https://h.t", "https://h.t/c"), ("mailto:a@b", "https://h.t", "mailto:a@b")])
def test_absolute(spark, href, base, want):
    assert spark.createDataFrame([(href, base)], "h string, b string").select(links.absolute(F.col("h"), F.col("b")).alias("v")).first().v == want
