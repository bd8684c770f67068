"""Work that must not be done more than once a row, and steps that must be the same in pieces."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gleanery.functions import similarity, text
from gleanery.functions.text import told_explanation
from gleanery.operators import align, schema_rules
from gleanery.operators.blocks import blocks, blocks_of_parts, runs
from gleanery.plans import audit, catalogue
from gleanery.sources import links, markup
from gleanery.sources.pages import PART_BITS, page_lines
from tests.test_operators import brute_alignment


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_records_are_taken_apart_once(spark):
    rows = spark.createDataFrame([(json.dumps({"id": "Q1"}),)], "json string")
    found = schema_rules.record_errors(rows)
    # Each of a record's fields was looked up and typed for each rule, and all rules thrice.
    assert plan(found).count("schema_of_variant") < 20
    assert found.count() == 15
    assert found.where("field = 'text'").first().type == "missing_key"


def test_titles_have_all_references_decoded(spark):
    page = spark.createDataFrame([(1, "<title>A&amp;&ampB &copy; &quotC&amp</title>")], "page_id int, html string")
    assert links.page_metadata(page).first().page_title == 'A&&B © "C&'


def test_an_option_that_looks_like_a_year_heads_nothing(spark):
    html = "<h2>2020</h2><p>Q1: when</p><p>(a) 2015</p><p>(b) 2016</p><p>Ans: (a)</p><p>Q2: who</p>"
    rows = blocks(page_lines(spark.createDataFrame([(1, html)], "page_id int, html string"))).orderBy("source_index").collect()
    assert [(r.year, r.lines) for r in rows] == [("2020", ["Q1: when", "(a) 2015", "(b) 2016", "Ans: (a)"]), ("2020", ["Q2: who"])]


def test_siblings_are_run_through_once(spark):
    tags = spark.createDataFrame([(1, "<ul><li>a<li>b<li>c</ul>")], "page_id int, html string")
    found = markup.nodes(markup.tokens(tags))
    # A frame that ends with the last row is summed from its first one for every row.
    assert "unboundedfollowing" not in plan(found).lower()
    assert [(r.open, r.close) for r in found.orderBy("open").collect()] == [(0, 7), (1, 3), (3, 5), (5, 7)]


@pytest.mark.parametrize("name", ["k_assertion_defaults", "k_cascade", "k_option_forms"])
def test_texts_are_dealt_over_all_tasks(spark, name):
    # The table's file has one row group, which one task read and took through all stages.
    assert "Repartition" in plan(catalogue.QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_chapters_in_parts_are_audited_as_whole_ones(spark):
    ask = lambda n, **other: {"id": f"Q{n}", "text": f"what is {n}", "options": dict.fromkeys("ABCD", str(n)), "answer": "a", "explanation": "so", "year": "2020", "chapter": "The Cell", "class": "B11", "images": [], "sourceQuestionNumber": str(n)} | other
    lists = [[ask(1), 5], [ask(2, tables=[]), ask(3)], [ask(4)]]
    pieces = ["<h2>2020</h2><p>Q1: what is 1</p>", "<p>(a) 1</p><p>Q2: what is 2</p><img><p>Ans: (a) so</p>", "<p>tail</p>", "<h2>2021</h2><p>Q3: what is 3</p>"]

    def reports(parts):
        rows = list(enumerate(lists)) if parts else [(0, sum(lists, []))]
        files = spark.createDataFrame([("biology", "B11", s, f"/{s}", n, json.dumps(x)) for s in ("cell", "gone") for n, x in rows], "subject string, class_code string, slug string, json_path string, part int, j string")
        pages = spark.createDataFrame([("/cell", n, x) for n, x in (enumerate(pieces) if parts else [(0, "".join(pieces))])], "url string, part int, html string")
        files = files.withColumn("root", F.parse_json("j")).drop("j")
        sources = spark.createDataFrame([("B11", "cell", "/cell", "x"), ("B11", "gone", "/gone", "x")], "class_code string, slug string, source_url string, source_label string")
        if not parts:
            files, pages = files.drop("part"), pages.drop("part")
        a = audit.Audit(audit.targets_of(files, sources), pages)
        return {n: sorted(map(str, getattr(a, n)().collect())) for n in ("chapter_summary", "schema_failures", "question_alignment", "option_anomaly_chapters", "explanation_chapters")}

    assert reports(True) == reports(False)


def test_files_are_taken_apart_once_whatever_they_hold(spark):
    records = ['{"id": "Q1", "sourceQuestionNumber": 50.0, "text": "a \\" b"}', '"{\\"id\\": 1}"', "5", "null", '[{"a": 1}]', '{"sourceQuestionNumber": "5.0", "id": 7}']
    rows = [("one", "[" + ", ".join(records) + "]", 0), ("two", '{"a": 1}', 0), ("three", "[]", 0)]
    files = spark.createDataFrame(rows, "slug string, root string, part int").select(F.lit("biology").alias("subject"), F.lit("B11").alias("class_code"), "slug", F.lit("/x").alias("json_path"), "root", "part")
    sources = spark.createDataFrame([("B11", s, f"/{s}", "x") for s in ("one", "two", "three")], "class_code string, slug string, source_url string, source_label string")
    pages = spark.createDataFrame([], "url string, html string")

    def found(files):
        a = audit.Audit(audit.targets_of(files, sources), pages)
        # A stored variant was cut into columns and put together again by each reader.
        assert "variant" not in [t for _, t in a.targets.dtypes]
        return [sorted(map(str, x.collect())) for x in (a.who, a.questions, a.errors)]

    text = found(files)
    assert text == found(files.withColumn("root", F.parse_json("root"))) == found(files.withColumn("root", F.parse_json("root")).drop("part"))
    a = audit.Audit(audit.targets_of(files, sources), pages)
    assert [(r.scraped_index, r.number, r.id) for r in a.questions.orderBy("scraped_index").collect()] == [(0, 50, "Q1"), (5, None, "7")]
    odd = a.errors.where("type IN ('question_not_object', 'root_not_list')").orderBy("page_id", "index").collect()
    assert [(r.page_id[4:], r["index"], r.actual) for r in odd] == [("one", 1, "str"), ("one", 2, "int"), ("one", 3, "NoneType"), ("one", 4, "list"), ("two", None, None)]


def test_equal_texts_are_not_compared(monkeypatch):
    monkeypatch.setattr(similarity.difflib, "SequenceMatcher", None)
    assert similarity.sequence_ratio("which part", "which part") == similarity.sequence_ratio("", "") == 1.0


def test_only_what_begins_like_an_object_is_parsed_as_one(spark):
    told = ['{"correct": "a", "others": "b"}', "{'correct': 'a'}", '{"correct": broken', '{"others": "b"}', "plain", None]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(told)], "n int, t string")
    assert [r.x for r in rows.orderBy("n").select(told_explanation(F.col("t")).alias("x")).collect()] == ["a", "a", '{"correct": broken', '{"others": "b"}', "plain", ""]


def test_steps_on_rows_dealt_by_page_shuffle_nothing(spark):
    points = spark.createDataFrame([(1, 3, "x"), (1, 9, "y")], "page_id int, pos int, text string")
    elements = spark.createDataFrame([(1, 0, 8), (1, 2, 5)], "page_id int, open int, close int")
    found = markup.held(markup.dealt(points), markup.dealt(elements), innermost=True)
    # Those that deal the elements (read twice) and the points.
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 3
    assert [(r.text, r.depth, r.node and r.node.open) for r in found.orderBy("pos").collect()] == [("x", 2, 2), ("y", 0, None)]


def chapters(spark, blocks_, questions_):
    b = spark.createDataFrame([(k, i, y, n, t, [t]) for k, rows in blocks_.items() for i, (y, n, t) in enumerate(rows)], "k long, source_index int, year string, number int, stem string, lines array<string>")
    q = spark.createDataFrame([(k, i, y, n, t, [], "a") for k, rows in questions_.items() for i, (y, n, t) in enumerate(rows)], "k long, scraped_index int, year string, number int, text string, options array<string>, answer string")
    return b, q


def test_plain_chapters_texts_are_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(align, "_mixed", None)
    monkeypatch.setattr(align, "_pairs", None)
    rows = [("2020", n, f"text {n}") for n in range(5)]
    found = align.align(*chapters(spark, {1: rows, 2: rows[:2]}, {1: rows[::-1], 2: rows, 3: rows}), "k")
    # Blocks and questions, by year and number.
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2
    assert sorted(map(tuple, found.collect())) == [(1, n, 4 - n, 0.85, True) for n in range(5)] + [(2, n, n, 0.85, True) for n in range(2)]


def test_plain_and_mixed_chapters_against_the_definition(spark, monkeypatch):
    monkeypatch.setattr(align, "_plain", lambda *a, real=align._plain: asked.append(1) or real(*a))
    asked, r = [], random.Random(7)
    say = lambda: " ".join(r.choice("alpha beta gamma delta tide leaf stone".split()) for _ in range(r.randint(2, 6)))
    # Of chapters 0 to 3 each block has a question of its year and number, of some more than one.
    keys = [("2020", 1), ("2020", 1), ("2020", 2), ("2021", 1), ("", 3)]
    blocks_ = {k: [(*x, say()) for x in r.sample(keys, 5)] for k in range(4)}
    questions_ = {k: [(*x, say()) for x in r.sample([*keys, *keys, ("2021", None)], 11)] for k in range(4)}
    for k in (4, 5, None):
        blocks_[k] = [(r.choice(["2020", "2021", ""]), r.choice([None, 1, 2]), say()) for _ in range(6)]
        questions_[k] = [(r.choice(["2020", "2021", ""]), r.choice([None, 1, 2]), say()) for _ in range(5)]
    questions_.pop(5)
    got = [tuple(x) for x in align.align(*chapters(spark, blocks_, questions_), "k").collect()]
    want = [(k, *x) for k, rows in blocks_.items() for x in brute_alignment(rows, questions_.get(k, []))]
    assert asked and sorted(got, key=str) == sorted(want, key=str)


def test_blocks_across_parts_are_those_of_the_whole_page(spark):
    said = ["x", "2024", "Q1: a", "b", "Q2. c", "2023", "e", "f", "Q3: long enough text of (2019)", "g", "2022", "h", "Q4 \t d", "(a) 2015", "i"]
    pages = [(k, i, f"<p>{x}</p>") for k in (1, 2) for i, x in enumerate(said[k - 1 :])]
    whole = [(k, "".join(x for own, _, x in pages if own == k)) for k in (1, 2)]
    want = sorted(map(tuple, blocks(page_lines(spark.createDataFrame(whole, "page_id int, html string"))).collect()))
    assert [x[1:] for x in want[:4]] == [(0, "2024", ["Q1: a", "b"]), (1, "2024", ["Q2. c", "e", "f"]), (2, "2023", ["Q3: long enough text of (2019)", "g", "h"]), (3, "2022", ["Q4 d", "(a) 2015", "i"])]
    for length in (1, 2, 3, 4, 100):
        parts = spark.createDataFrame(pages, "page_id int, pos int, html string").groupBy("page_id", F.floor(F.col("pos") / length).alias("part")).agg(F.array_join(F.sort_array(F.collect_list(F.struct("pos", "html")))["html"], "").alias("html"))
        assert sorted(map(tuple, blocks_of_parts(parts).collect())) == want
        lines = page_lines(parts).withColumn("part", F.shiftright("pos", PART_BITS))
        assert sorted(map(tuple, blocks(lines, stretch=F.col("part")).collect())) == want


def test_pages_in_parts_are_run_through_by_blocks_not_lines(spark):
    html = "<h2>2024</h2>" + "".join(f"<p>Q{n}: which</p><p>(a) x</p><p>(b) y</p><p>Ans: (a)</p>" for n in range(20))
    assert runs(spark.createDataFrame([(1, 0, html)], "page_id int, part int, html string")).count() == 21


def test_only_white_space_that_is_no_single_blank_is_replaced(spark):
    texts = ["a b", " a  b ", "a\tb", "a  b", " a  b\n", "a\u0085 \tb  c d", "", None, "a&b"]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string").select("n", text.collapsed(F.col("t")).alias("x"), F.trim(F.regexp_replace(F.coalesce("t", F.lit("")), text.SPACE + "+", " ")).alias("y"))
    assert all(r.x == r.y for r in rows.collect())
