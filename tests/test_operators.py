"""Operators on small hand-made inputs."""

import difflib
import html
import json
import random

import pytest
from pyspark.sql import functions as F

from gleanery.functions import similarity as S
from gleanery.functions import text as T
from gleanery.operators import align, findings, options, schema_rules, scoring
from gleanery.operators.blocks import blocks, element_blocks, picture_suffixes, rebuilt_explanation, signals, stem
from gleanery.plans import catalogue
from gleanery.sources import links
from gleanery.sources import pages as P
from gleanery.sources import reports


def values(spark, column, *texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return [r.v for r in spark.createDataFrame(rows, "i int, x string").select("i", column(F.col("x")).alias("v")).orderBy("i").collect()]


def page(*lines):
    return "".join(f"<p>{x}</p>" for x in lines)


def test_blocks_and_headers(spark):
    pages = spark.createDataFrame([(1, page("x", "2024", "Q1: a", "b", "Q2. c", "2023", "Q3 d (2021)", "e", "Q4: long enough stem (2019) text", "f")), (2, "")], "page_id long, html string")
    got = [(r.source_index, r.year, r.lines) for r in blocks(P.page_lines(pages)).orderBy("source_index").collect()]
    # A short line with a year is a header, even where it looks like a question.
    assert got == [(0, "2024", ["Q1: a", "b"]), (1, "2024", ["Q2. c", "e"]), (2, "2021", ["Q4: long enough stem (2019) text", "f"])]
    assert blocks(P.page_lines(pages.where("page_id = 1 and false"))).count() == 0


def test_signals(spark):
    pages = spark.createDataFrame([(1, page("Q1: a", "(a) one", "(b) two", "Ans: a") + "<img src=x><table></table>" + page("Q2: humans eat", "only")), (2, "")], "page_id long, html string")
    got = {r.page_id: tuple(r)[1:] for r in signals(blocks(P.page_lines(pages)), pages).collect()}
    assert got == {1: (2, 2, 2, 1, 1, 1), 2: (0, 0, 0, 0, 0, 0)}


def test_stem(spark):
    df = spark.createDataFrame([(["Q3: what is", "View Answer", "it?", "(a) x", "tail"],), (["Q4. no options", "Ans: b"],)], "lines array<string>")
    assert [r.s for r in df.select(stem(F.col("lines")).alias("s")).collect()] == ["what is it?", "no options"]


def test_cleaning(spark):
    assert values(spark, T.collapsed, "a b", "\ta  \n b ", None) == ["a b", "a b", ""]
    assert values(spark, T.without_zero_width, "a​b c") == ["ab c"]
    assert values(spark, T.slug, "Cell & Life - 2", "-x-", "Über uns") == ["cell-and-life-2", "x", "ber-uns"]
    assert values(spark, lambda c: T.slug(c, trim=False), "-x-") == ["-x-"]
    assert values(spark, T.title_from_slug, "cell-and-life") == ["Cell And Life"]
    assert values(spark, lambda c: T.truncated(c, 3), "abcd", "abc") == ["abc…", "abc"]
    assert values(spark, T.answer_letter, "Ans: (B) x", "Correct Answer - c", "none") == ["b", "c", ""]
    assert values(spark, S.unescaped, "&eacute;&amp &#65;", None) == [html.unescape("&eacute;&amp &#65;"), ""]
    assert values(spark, T.told_explanation, '{"correct": "x", "others": "y"}', '{"correct": "", "others": "y"}', "plain  text") == ["x", "y", "plain text"]
    quoted = ("{'correct': 'x  y', 'others': 'z'}", "{'correct': '', 'others': 'z'}", "{'correct': 'it's', 'others': ''}", "{'correct': '', 'others': ''}", "{'correct': ", '{"correct": "it\'s"}', None)
    assert values(spark, T.told_explanation, *quoted) == ["x y", "z", quoted[2], quoted[3], "{'correct':", "it's", ""]


def test_ratio_is_the_librarys(spark):
    r = random.Random(1)
    pairs = [("", ""), ("tide", "diet"), ("ab" * 120, "ba" * 120)] + [("".join(r.choice("abc d") for _ in range(r.randint(0, 300))), "".join(r.choice("abc d") for _ in range(r.randint(0, 300)))) for _ in range(30)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [x.v for x in df.select("i", S.ratio("a", "b").alias("v")).orderBy("i").collect()]
    assert got == [1.0 if not a and not b else difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs] and got[2] == 0.0
    near = df.limit(1).select(S.explanation_similarity(F.lit("the cell wall"), F.lit("Cell")).alias("v")).first().v
    assert near == 0.98


CASES = [
    ("What is it? (a) one (b) two (c) three (d) four", "What is it?", ["one", "two", "three", "four"], "lower_markers"),
    ("What is it?\n(a) one\n(b) two\n(c) three\n(d) four", "What is it?", ["one", "two", "three", "four"], "inline_lower_option_lines"),
    ("What is it? a) one b) two c) three d) four", "What is it?", ["one", "two", "three", "four"], "compact_lower_markers"),
    ("What? (1) one (2) two (3) three (4) four", "What?", ["one", "two", "three", "four"], "numbered_paren_options"),
    ("What? (a) one (b) two (c) three D four", "What?", ["one", "two", "three", "four"], "three_lower_plus_terminal_upper"),
    ("What? A: one B: two C: three D: four", "What?", ["one", "two", "three", "four"], "mixed_option_markers"),
    ("Which value? A12 B34 C56 D78", "Which value?", ["12", "34", "56", "78"], "ordered_upper_labels"),
    ("Which value A12 B34 C56 D78", "Which value", ["12", "34", "56", "78"], "compact_upper_numeric_labels"),
    ("Which? (a) one (b) two (c) three (d", "Which? (a) one (b) two (c) three (d", [""] * 4, "fallback"),
    ("What? (a one (b two (c three (d four", "What?", ["one", "two", "three", "four"], "sequential_lower_markers"),
    ("What? (a one (c two (b three (d four", "What? (a one (c two (b three (d four", [""] * 4, "fallback"),
    ("What? (a) one (a) two (b) three (c) four (b) five", "What?", ["one", "two", "three", "four"], "loose_lower_sequence"),
    # The first value of a label that is not empty; capitals count as well.
    ("What? (A) (a) one (B) two (c) three (D) four", "What?", ["one", "two", "three", "four"], "lower_markers"),
    # Of two runs the later, if its values are filled and as long; the last value runs to the end of the text.
    ("Match (1) pp (2) qq (3) rr (4) ss (NEET 2019) Choose (1) pq (2) qr (3) rs (4) sp", "Match (1) pp (2) qq (3) rr (4) ss Choose", ["pq", "qr", "rs", "sp"], "numbered_paren_options"),
    ("Match (1) alpha (2) beta (3) gamma (4) theta iota (1) p", "Match", ["alpha", "beta", "gamma", "theta iota (1) p"], "numbered_paren_options"),
    ("Match (1) x (2) y (3) z (4) w (5) v", "Match", ["x", "y", "z", "w (5) v"], "numbered_paren_options"),
    ("Is it ?ADNA]BRNA]CATP]DADP", "Is it ?", ["DNA]", "RNA]", "ATP]", "ADP"], "packed_upper_labels"),
    ("Pick oneATwo xBThree yCFour zDFive", "Pick one", ["Two x", "Three y", "Four z", "Five"], "packed_upper_labels"),
    ("Say ATwo BThree CFour DFive", "Say", ["Two", "Three", "Four", "Five"], "compact_upper_tight_labels"),
    ("Which is it: one (b) two (c) three (d) four", "Which is it", ["one", "two", "three", "four"], "implicit_a_lower_bcd"),
    ("Ratio of A-1 B-2 C-3 D-4", "Ratio of", ["1", "2", "3", "4"], "mixed_option_markers"),
    ("Ratio A/x B/y C/z D/w", "Ratio", ["/x", "/y", "/z", "/w"], "compact_upper_tight_labels"),
    ("Pick A.one B.two C.three E.five", "Pick", ["one", "two", "three", ""], "upper_markers"),
    ("Say A Cell B Wall C Core D Skin", "Say", ["Cell", "Wall", "Core", "Skin"], "compact_upper_markers"),
    ("Which? (a) one (b) two (D) x (c) three D: four (d", "Which?", ["one", "two", "three D: four (d", "x"], "lower_markers"),
    ("Which?\n(a) one\n(b) two\n(c) three\nmore of it\n(d) four\n(a) uno", "Which?", ["uno", "two", "three", "four"], "inline_lower_option_lines"),
    ("Ask\nChoose the correct answer from the options given below:\n(a) i\n(b) ii\n(c) iii\n(d) iv", "Ask", ["i", "ii", "iii", "iv"], "lower_option_lines"),
    ("Assertion (A): it floats. Reason (R): it is light", "Assertion (A): it floats. Reason (R): it is light", list(options.STATEMENT_OPTIONS), "fallback"),
    ("Statement I: x\nStatement II: y", "Statement I: x Statement II: y", list(options.STATEMENT_OPTIONS), "fallback"),
    ("No options here", "No options here", [""] * 4, "fallback"),
    ("(a) x (b) y", "(a) x (b) y", [""] * 4, "fallback"),
    (None, "", [""] * 4, "fallback"),
]


def test_option_cascade(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, t string")
    got = df.select("i", options.parse_options(F.coalesce("t", F.lit(""))).alias("r")).orderBy("i").collect()
    assert [(r.r.stem, r.r.options, r.r.source) for r in got] == [c[1:] for c in CASES]


GOOD = {"id": "Q1", "text": "t", "options": dict.fromkeys("ABCD", "x"), "answer": "a", "explanation": "e", "year": "2020", "chapter": "c", "class": "B11", "images": [], "tables": []}


def test_schema_errors(spark):
    def errors(record):
        df = spark.createDataFrame([(json.dumps(record),)], "json string")
        return [(r.field, r.type) for r in schema_rules.record_errors(df).orderBy("n_error").collect()]

    without = lambda k: {a: b for a, b in GOOD.items() if a != k}
    assert errors(GOOD) == []
    assert errors(without("explanation")) == [("explanation", "missing_key"), ("explanation.correct", "missing_explanation_key"), ("explanation.others", "missing_explanation_key")]
    assert errors(without("options")) == [("options", "missing_key")] + [(f"options.{x}", "missing_option") for x in "ABCD"]
    assert errors(GOOD | {"optionExtraction": {"source": "s", "status": "t", "imageTokenCount": True, "nonEmptyOptionCount": 1}}) == []
    assert errors(GOOD | {"optionExtraction": {"source": 1}}) == [("optionExtraction.source", "wrong_type")] + [(f"optionExtraction.{x}", "missing_key") for x in ("status", "imageTokenCount", "nonEmptyOptionCount")]
    assert errors(GOOD | {"year": None}) == [("year", "wrong_type")]
    assert errors(GOOD | {"explanation": 5}) == [("explanation", "wrong_type"), ("explanation", "wrong_explanation_type")]
    assert errors(GOOD | {"explanation": {"correct": "x", "others": 1}}) == [("explanation.others", "wrong_explanation_type")]
    assert errors(GOOD | {"options": dict.fromkeys("ABC", "x") | {"D": 4}}) == [("options.D", "wrong_option_type")]
    assert errors(GOOD | {"parserWarnings": ["w", 1, 2]}) == [("parserWarnings", "wrong_warning_type")]
    assert errors([1]) == [("question", "question_not_object")]


def test_scores_without_questions(spark):
    names = "expected_question_count expected_answer_markers expected_option_markers expected_images expected_tables residual_blocks questions answers options images tables schema_errors empty_explanations duplicate_options".split()
    df = spark.createDataFrame([(5, 5, 20, 0, 0, 0, *[0] * 8, None), (2, 2, 8, 0, 0, 0, 2, 2, 8, 0, 0, 0, 0, 0, 1.0)], ", ".join(f"{n} long" for n in names) + ", mean_alignment double")
    a, b = scoring.scored(df).orderBy("questions").collect()
    assert (a.structural_accuracy, a.anomaly_score, a.schema_gap_risk, a.risk) == (0.0, 1.0, 0.7, "high")
    # Nothing expected and nothing found counts 0 for that part.
    assert (b.completeness_accuracy, b.structural_accuracy, b.final_accuracy, b.risk) == (0.75, 1.0, 0.9125, "low")
    assert b.dominant_failures == ["completeness_drop"]


def frames(spark, blocks_, questions_):
    b = spark.createDataFrame([(1, i, y, n, t, [t]) for i, (y, n, t) in enumerate(blocks_)], "k long, source_index int, year string, number int, stem string, lines array<string>")
    q = spark.createDataFrame([(1, i, y, n, t, [], "a") for i, (y, n, t) in enumerate(questions_)], "k long, scraped_index int, year string, number int, text string, options array<string>, answer string")
    return b, q


def sides(spark, blocks_, questions_):
    return [tuple(r)[1:] for r in align.align(*frames(spark, blocks_, questions_), "k").orderBy("source_index").collect()]


def test_alignment(spark):
    assert [x[1] for x in sides(spark, [("2020", None, "same")], [("2020", None, "same"), ("2020", None, "same")])] == [0]
    # A rejected match still uses up its question.
    got = sides(spark, [("", None, "zzzz"), ("", None, "alpha beta")], [("", None, "alpha beta")])
    assert [(g[1], g[3]) for g in got] == [(0, False), (None, False)]
    keyed = sides(spark, [("2020", 7, "first"), ("2021", 7, "second")], [("2021", 7, "second"), ("2020", 7, "first")])
    assert [(g[1], g[2], g[3]) for g in keyed] == [(1, 0.85, True), (0, 0.85, True)]
    assert sides(spark, [("2020", None, "x")], []) == [(0, None, 0.0, False)]


def test_option_anomalies(spark):
    df = spark.createDataFrame([("c", ["x", "", "", ""], "a", 1, 0), ("c", ["", "", "", ""], "", 0, 0), ("d", list("abcd"), "a", 2, 0), ("e", list("abcd"), "a", 0, 1)], "chapter string, options array<string>, answer string, images int, warnings int")
    types = [r.t for r in df.select(findings.anomaly_types().alias("t")).collect()]
    assert types == [["partial_options", "answer_without_full_options", "image_backed_option_gap"], ["all_options_empty"], [], ["parser_warning"]]
    roll = {r.chapter: tuple(r)[1:] for r in findings.anomaly_rollup(df, ["chapter"]).collect()}
    assert roll == {"c": (2, 2, 1, 1, 1), "d": (1, 0, 0, 0, 0), "e": (1, 1, 0, 0, 0)}


def test_explanations(spark):
    df = spark.createDataFrame([(1, "why", ""), (2, "", "why"), (3, "aaaa", "zzzz"), (4, "same", "Same View Answer"), (5, "", "")], "k int, source_explanation string, json_explanation string")
    f = findings.explanation_findings(df)
    assert sorted((r.k, r.category) for r in f.collect()) == [(1, "missing_in_json"), (2, "missing_from_source"), (3, "mismatch"), (4, "ui_leak")]
    assert findings.finding_counts(f, "k").where("k = 3").first().total == 1


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "cells.json").write_text(json.dumps([GOOD | {"tables": [[["a", "b"]]]}, GOOD]))
    rows = P.chapter_files(spark, str(tmp_path / "*.json")).collect()
    assert [(r.slug, r.id, r.options["A"]) for r in rows] == [("cells", "Q1", "x")] * 2 and rows[0].tables == [[["a", "b"]]]
    (tmp_path / "p.html").write_text("<a href='x'>y</a>")
    assert P.html_files(spark, str(tmp_path / "p.html")).first().html == "<a href='x'>y</a>"
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "i int, xs array<string>")
    reports.write_csv(df, str(tmp_path / "csv"))
    assert sorted(r.xs for r in spark.read.csv(str(tmp_path / "csv"), header=True).collect()) == ["['a', 'b']", "[]"]
    reports.write_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_links_first_wins(spark):
    pages = spark.createDataFrame([(1, '<a href="/a">A</a><a href="/b"> B </a><a href="/a">again</a>')], "page_id long, html string")
    assert [tuple(r)[1:] for r in links.links(pages).orderBy("idx").collect()] == [(1, "/a", "A"), (2, "/b", "B")]


def test_last_wins(spark):
    a, b = (spark.createDataFrame(x, "k string, v int") for x in ([("x", 1), ("y", 2)], [("y", 3)]))
    assert sorted(map(tuple, P.last_wins(a, b, key=["k"]).collect())) == [("x", 1), ("y", 3)]


def brute_alignment(blocks_, questions_):
    """The definition, block by block: (source, scraped, score, matched)."""
    left, out = list(range(len(questions_))), []
    for i, (y, n, t) in enumerate(blocks_):
        keyed = [q for q in left if n is not None and questions_[q][1] == n and questions_[q][0].strip().lower() == y.strip().lower()]
        best, score = None, -1.0
        for q in keyed or left:
            r = S.sequence_ratio(norm(t), norm(questions_[q][2]))
            same = 1.0 if y and y == questions_[q][0] else 0.0
            s = 0.8 * r + 0.15 * 0.0 + 0.05 * 1.0 if keyed else 0.6 * r + 0.15 * same + 0.15 * 0.0 + 0.1 * 1.0
            if s > score:
                best, score = q, s
        out.append((i, best, round(score, 4) if best is not None else 0.0, best is not None and score >= 0.55))
        if best is not None:
            left.remove(best)
    return out


def norm(t):
    return " ".join(t.replace("&", " and ").split()).lower()


def test_an_earlier_block_takes_a_later_ones_question(spark):
    blocks_ = [("2020", None, "alpha beta"), ("2020", 1, "zzz"), ("2020", 1, "gamma"), ("2021", 7, "delta")]
    questions_ = [("2020", 1, "alpha beta"), ("2020", 2, "gamma"), ("2021", 7, "delta")]
    assert sides(spark, blocks_, questions_) == brute_alignment(blocks_, questions_)
    made = align._pairs(*align.pairs_of(*frames(spark, blocks_[3:], questions_), "k"))
    assert made.count() == 1  # of three


def test_alignment_against_its_definition(spark):
    r = random.Random(5)
    say = lambda: " ".join(r.choice("alpha beta gamma delta tide leaf stone".split()) for _ in range(r.randint(2, 6)))
    for _ in range(4):
        b = [(r.choice(["2020", "2021", ""]), r.choice([None, 1, 2, 3]), say()) for _ in range(9)]
        q = [(r.choice(["2020", "2021", ""]), r.choice([None, 1, 2, 3]), say()) for _ in range(7)]
        assert sides(spark, b, q) == brute_alignment(b, q)


def test_element_blocks_and_pictures(spark):
    rows = [(1, 0, "p", "Q1: before any year"), (1, 1, "h3", "Questions of the exam held in 2019 and more"), (1, 2, "p", "Q 12: which"), (1, 3, "p", "a line of the year 2018 that is long"), (1, 4, "p", "2017"), (1, 5, "p", "Q13. what"), (2, 0, "p", "no question")]
    got = element_blocks(spark.createDataFrame(rows, "page_id int, pos int, tag string, text string")).orderBy("source_index").collect()
    assert [(r.year, len(r.lines)) for r in got] == [("2022", 1), ("2019", 2), ("2017", 1)]
    p = [(1, 0, "http://a", False), (1, 1, "http://Vector.png", False), (1, 2, "data:x", False), (1, 3, "http://b", False), (1, 4, "http://c", True), (1, 5, "http://d", True)]
    got = picture_suffixes(spark.createDataFrame(p, "q int, pos int, src string, after_answer boolean"), ["q"]).orderBy("pos").collect()
    assert [r.suffix for r in got] == ["-main", "-main2", "-explanation1", "-explanation2"]


def test_rebuilt_explanation(spark):
    rows = [("it is so", ["Q1: x", "Ans: (a) it is so", "first", "Other options:", "Ans - (b) second"]), ("it  is so", ["Q1: x", "Ans: (a)"]), ("b", ["Incorrect options", "no answer here"])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, b string, ls array<string>")
    got = [r.v for r in df.select("i", rebuilt_explanation(F.col("b"), F.col("ls")).alias("v")).orderBy("i").collect()]
    assert got == ["it is so Other options: first second", "it is so", "b Incorrect options:"]


def test_small_functions(spark):
    assert values(spark, T.asset_extension, "https://x/a.JPEG?y", "https://x/a") == [".jpeg", ".png"]
    assert values(spark, T.asset_prefix, "human-reproduction", "cell-cycle") == ["reproduction-", "CELL_CYCLE-"]
    assert values(spark, T.badge, "High", "odd", "", None) == ["high", "neutral", "neutral", "neutral"]
    assert values(spark, T.number_of, "12", "x", None) == [12, None, None]
    assert values(spark, lambda c: T.shown_score(c.cast("double")), "0.5", None) == ["0.5000", "—"]
    assert values(spark, lambda c: T.has_any_prefix(c, F.array(F.lit("ab"), F.lit("c"))), "abc", "cd", "d") == [True, True, False]
    assert values(spark, T.title_from_slug, "a" * 1500 + "-b") == ["A" + "a" * 1499 + " B"]
    assert values(spark, options.inferred_answer, "Both A and R are true", "statement i is correct but statement ii is incorrect", "") == ["a", "c", ""]


def test_json_or_none(spark, tmp_path):
    assert P.json_or_none(spark, str(tmp_path / "absent.json"), "a int").count() == 0
    (tmp_path / "there.json").write_text('[{"a": 1}, {"a": 2}]')
    assert P.json_or_none(spark, str(tmp_path / "there.json"), "a int").count() == 2
    (tmp_path / "broken.json").write_text('[{"a": ')
    with pytest.raises(Exception, match="(?i)malformed|parse|FAILED_READ"):
        P.json_or_none(spark, str(tmp_path / "broken.json"), "a int").collect()


def test_queries_without_sql(spark):
    """Whole pages against the standard library and a plain loop; real turns against the definition."""
    import hashlib

    sf = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r.page_id: r.plain for r in catalogue.QUERIES["j_unescape"](spark, sf).collect()}
    assert got == {p.page_id: hashlib.md5(html.unescape(p.html or "").encode()).hexdigest() for p in pages}

    turns = spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect()
    for name, numbered in (("n_align_keyed", True), ("n_align_greedy", False)):
        want = []
        for conv in {t.conv_id for t in turns}:
            mine = [[("", i if numbered else None, t.text or "") for i, t in enumerate(t for t in turns if t.conv_id == conv and t.role == role)] for role in ("user", "assistant")]
            want += [(conv, *x) for x in brute_alignment(*mine)]
        assert sorted(map(tuple, catalogue.QUERIES[name](spark, sf).collect())) == sorted(want)
