"""Answer options from a question's text: a cascade of stages, the first that fits wins.

A stage finds its markers, places with a label; which markers it takes follows from their
labels and places alone. Texts are cut and cleaned only for the markers taken. The stages are lambdas over the
text, so that a row is tried by one after the other until a stage fits, and no further.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import CHOOSER, collapsed, option_value, question_text

# The stages in order, by name, pattern of a marker (its label is the group that is not empty), and
# how its markers are read. "labels": four or more markers, the first value of each label that is not empty. "window":
# the best run of A, B, C, D. "first": the first four, whatever their labels. The flag: only if all four values say something.
LOWER = r"(?i)\(([a-d])\)\s*"
STAGES = (
    ("lower_markers", LOWER, "labels", True),
    ("compact_lower_markers", r"(?i)\b([a-d])\)\s*", "labels", True),
    ("sequential_lower_markers", r"(?i)\(([a-d])\)?\s*", "window", True),
    ("loose_lower_sequence", LOWER, "first", True),
    ("numbered_paren_options", r"\(([1-4])\)\s*", "window", True),
    ("three_lower_plus_terminal_upper", LOWER, "three", True),
    ("mixed_option_markers", r"(?i)\(([a-d])\)\s*|\b([A-D])\b\s*[:.)-]\s*", "window", True),
    ("implicit_a_lower_bcd", r"(?i)\(([b-d])\)\s*", "implicit", True),
    ("packed_upper_labels", r"(?:^|(?<=[\]?]))([A-D])(?=[A-Z])|(?<=[a-z0-9\]])([A-D])(?=[A-Z][a-z])", "window", True),
    ("ordered_upper_labels", r"", "ordered", True),
    ("compact_upper_numeric_labels", r"(?<![A-Za-z])([A-D])(?=[0-9(\-−])", "window", True),
    ("compact_upper_tight_labels", r"(?:^|(?<=[?:)\]0-9/\s\-−]))([A-D])(?=\S)", "window", True),
    ("upper_punct_markers", r"\b([A-D])\b\s*[:.)-]\s*", "window", True),
    ("upper_markers", r"([A-E])\.\s*", "labels", False),
    ("compact_upper_markers", r"([A-D])(?=(?:[A-Z][a-z]|\s+[A-Z][a-z]))", "window", False),
)
OPTION_LINE = r"(?i)^\(([a-d])\)\s*(.*)$"
TERMINAL_D = r"(?s)^(.*?)\bD\b\s*[:.)-]?\s*(.*)$"
#: Upper-case labels in order, each before something that is no space, the first after : or ?.
ORDERED = r"(?s)^(.*?[?:])\s*A(?=\S)(.*?)B(?=\S)(.*?)C(?=\S)(.*?)D(?=\S)(.*)$"
#: What a filled value counts against its length, where runs of markers compete.
FILLED = 10_000


def meaningful(v: Column) -> Column:
    """An option that has a picture, a letter or a digit."""
    return F.coalesce(F.rlike(v, F.lit(r"(?i)\[diagram\]|\[img")) | F.rlike(v, F.lit(r"[\p{L}\p{N}]")), F.lit(False))


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def _cut(text: Column, start: Column, end: Column) -> Column:
    return text.substr(start + 1, F.greatest(end - start, F.lit(0)))


def _value(text: Column, start: Column, end: Column) -> Column:
    return option_value(_cut(text, start, end))


def markers(text: Column, pattern: str) -> Column:
    """array<struct<label, at, end>>: the matches of a pattern, labels as A to E (1 to 4 count as such), places
    in code points from 0."""
    found = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))
    groups = [found(g) for g in range(1, re.compile(pattern).groups + 1)]
    pieces = F.split(text, pattern, -1)
    label = lambda x: F.translate(F.upper(F.concat(*(x[f"g{i}"] for i in range(len(groups))))), "1234", "ABCD")
    zipped = F.arrays_zip(found(0).alias("m"), pieces.alias("p"), *(g.alias(f"g{i}") for i, g in enumerate(groups)))
    zipped = F.filter(zipped, lambda x: x["m"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<label:string,at:int,end:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + F.length(x["p"])
        end = at + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(label(x).alias("label"), at.alias("at"), end.alias("end")))).alias("out"))

    return F.aggregate(zipped, start, step, lambda acc: acc["out"])


def _starts(marks: Column, labels: str) -> Column:
    """Places (from 0) at which markers of these labels follow one another."""
    k = len(labels)
    run = lambda i: F.array_join(F.transform(F.slice(marks, i + 1, F.lit(k)), lambda m: m["label"]), "") == labels
    return F.when(F.size(marks) >= k, F.filter(F.sequence(F.lit(0), F.size(marks) - k), run)).otherwise(F.array().cast("array<int>"))


def _of(stem_end: Column, values: Column) -> Column:
    return F.struct(stem_end.alias("cut"), values.alias("options"))


def _between(text: Column, marks: Column, i: Column, k: int) -> list[Column]:
    """The values of k markers from the i-th on, the last one up to the end of the text."""
    ends = [marks[i + j + 1]["at"] for j in range(k - 1)] + [F.length(text)]
    return [_value(text, marks[i + j]["end"], ends[j]) for j in range(k)]


def _labels(text: Column, marks: Column) -> Column:
    end = lambda i: F.coalesce(F.try_element_at(marks, i + 2)["at"], F.length(text))
    pairs = F.transform(marks, lambda m, i: F.struct(m["label"].alias("label"), _value(text, m["end"], end(i)).alias("value")))
    first = lambda p, x: F.coalesce(F.try_element_at(F.filter(p, lambda y: (y["label"] == x) & (y["value"] != "")), F.lit(1))["value"], F.lit(""))
    return F.when(F.size(marks) >= 4, _of(marks[0]["at"], _let(pairs, lambda p: F.array(*(first(p, x) for x in "ABCD")))))


def _window(text: Column, marks: Column) -> Column:
    """Of several runs, the one with the most filled values; then the more text and the later it begins; the first of equals."""
    filled = lambda o: F.aggregate(o, F.lit(0), lambda s, v: s + F.when(v != "", FILLED).otherwise(0) + F.length(v))
    scored = F.transform(_starts(marks, "ABCD"), lambda i: _let(F.array(*_between(text, marks, i, 4)), lambda o: F.struct((filled(o) + marks[i]["at"]).alias("score"), (-i).alias("first"), marks[i]["at"].alias("at"), o.alias("o"))))
    return _let(F.array_max(scored), lambda b: F.when(b.isNotNull(), _of(b["at"], b["o"])))


def _first_four(text: Column, marks: Column) -> Column:
    end = lambda i: F.coalesce(F.try_element_at(marks, F.lit(i + 2))["at"], F.length(text))
    return F.when(F.size(marks) >= 4, _of(marks[0]["at"], F.array(*(_value(text, marks[i]["end"], end(i)) for i in range(4)))))


def _usable_first(found: Column) -> Column:
    return F.try_element_at(F.filter(found, lambda r: r.isNotNull() & F.forall(r["options"], meaningful)), F.lit(1))


def _three(text: Column, marks: Column) -> Column:
    """(a), (b) and (c), and after them a D of its own."""

    def of(i: Column) -> Column:
        after = marks[i + 2]["end"]
        tail = _cut(text, after, F.length(text))
        c, d = (option_value(F.regexp_extract(tail, TERMINAL_D, g)) for g in (1, 2))
        a, b = (_value(text, marks[i + j]["end"], marks[i + j + 1]["at"]) for j in range(2))
        return F.when(F.rlike(tail, F.lit(TERMINAL_D)), _of(marks[i]["at"], F.array(a, b, c, d)))

    return _usable_first(F.transform(_starts(marks, "ABC"), of))


def _implicit(text: Column, marks: Column) -> Column:
    """The first option has no label of its own: it stands between the question's last : or ? and (b)."""

    def of(i: Column) -> Column:
        before = F.left(text, marks[i]["at"])
        cut = F.length(F.regexp_extract(before, r"(?s)^(.*[:?])", 1))
        return F.when(cut > 0, _of(cut, F.array(_value(text, cut, marks[i]["at"]), *_between(text, marks, i, 3))))

    return _usable_first(F.transform(_starts(marks, "BCD"), of))


def _ordered(text: Column) -> Column:
    stem, *found = (F.regexp_extract(text, ORDERED, i) for i in range(1, 6))
    return F.when(F.rlike(text, F.lit(ORDERED)), _of(F.length(stem), F.array(*map(option_value, found))))


READ = {"labels": _labels, "window": _window, "first": _first_four, "three": _three, "implicit": _implicit}


def stage(text: Column, name: str, pattern: str, how: str, usable: bool) -> Column:
    """struct<stem, options, source>, or null where the stage does not fit."""
    # A text without any marker is told by one search, before all are taken.
    found = _ordered(text) if how == "ordered" else F.when(F.rlike(text, F.lit(pattern)), _let(markers(text, pattern), lambda m: READ[how](text, m)))

    def result(r: Column) -> Column:
        ok = r.isNotNull() & F.forall(r["options"], meaningful) if usable else r.isNotNull()
        return F.when(ok, F.struct(question_text(F.left(text, r["cut"])).alias("stem"), r["options"].alias("options"), F.lit(name).alias("source")))

    return _let(found, result)


def _of_lines(lines: Column, stem: Column, name: str) -> Column:
    """Options that are lines of their own; of a label the last line counts."""
    own = F.filter(lines, lambda x: F.rlike(x, F.lit(OPTION_LINE)))
    last = lambda o, k: F.coalesce(F.try_element_at(F.filter(o, lambda x: F.upper(F.regexp_extract(x, OPTION_LINE, 1)) == k), F.lit(-1)), F.lit(""))
    values = _let(own, lambda o: F.array(*(option_value(F.regexp_extract(last(o, k), OPTION_LINE, 2)) for k in "ABCD")))
    return F.when(F.size(own) >= 4, _let(values, lambda v: F.when(F.forall(v, meaningful), F.struct(question_text(stem).alias("stem"), v.alias("options"), F.lit(name).alias("source")))))


def line_stages(text: Column) -> list[Column]:
    """Options after a line that asks to choose, as lines or anywhere; then options as lines of their own."""
    lines = F.split(text, "\n", -1)
    asks = F.array_position(F.transform(lines, lambda x: F.rlike(x, F.lit(f"(?i){CHOOSER}"))), True).cast("int")
    after = F.when(asks > 0, F.slice(lines, asks + 1, F.size(lines))).otherwise(F.array().cast("array<string>"))
    chooser = _of_lines(after, F.array_join(F.slice(lines, F.lit(1), F.greatest(asks, F.lit(0))), " "), "lower_option_lines")
    head = F.regexp_extract(text, f"(?is)^(.*?(?:{CHOOSER}))", 1)
    anywhere = _let(_cut(text, F.length(head), F.length(text)), lambda t: _let(_labels_of(t), lambda r: F.when((asks > 0) & r.isNotNull() & F.forall(r["options"], meaningful), F.struct(question_text(head).alias("stem"), r["options"].alias("options"), F.lit("chooser_lower_markers").alias("source")))))
    first = F.array_position(F.transform(lines, lambda x: F.rlike(x, F.lit(OPTION_LINE))), True).cast("int")
    inline = _of_lines(lines, F.array_join(F.slice(lines, F.lit(1), F.greatest(first - 1, F.lit(0))), " "), "inline_lower_option_lines")
    return [chooser, anywhere, inline]


def _labels_of(text: Column) -> Column:
    return _let(markers(text, LOWER), lambda m: _labels(text, m))


def table_options(tables: Column) -> Column:
    """Options that stand in a table (array<array<array<string>>>), a label and a value a row;
    null if no table has all four."""
    def of_table(rows: Column) -> Column:
        labelled = F.transform(F.filter(rows, lambda r: F.size(r) >= 2), lambda r: F.struct(F.upper(F.regexp_extract(collapsed(r[0]), r"(?i)^\(?\s*([a-d])\s*\)?\s*[:.)-]*\s*$", 1)).alias("label"), option_value(F.array_join(F.slice(r, F.lit(2), F.size(r)), " ")).alias("value")))
        return F.array(*(F.coalesce(F.try_element_at(F.transform(F.filter(labelled, lambda x: (x["label"] == k) & (x["value"] != "")), lambda x: x["value"]), F.lit(1)), F.lit("")) for k in "ABCD"))

    return F.try_element_at(F.filter(F.transform(tables, of_table), lambda o: F.forall(o, meaningful)), F.lit(1))


def parse_options(text: Column, tables: Column | None = None) -> Column:
    """struct<stem, options (four, '' where unresolved), source>; source is 'fallback' if no stage fits."""

    def cascade(t: Column) -> Column:
        stages = [*line_stages(t), *(stage(t, *x) for x in STAGES)]
        if tables is not None:
            stages.insert(0, _let(table_options(tables), lambda found: F.when(found.isNotNull(), F.struct(question_text(t).alias("stem"), found.alias("options"), F.lit("table").alias("source")))))
        # The chooser stage is not tried again after the lettered ones: on the same text it cannot fit then.
        fallback = F.struct(question_text(t).alias("stem"), F.array(*[F.lit("")] * 4).alias("options"), F.lit("fallback").alias("source"))
        return F.coalesce(*stages, fallback)

    return _let(_let(text, cascade), with_defaults)


# The options of questions that print none, and how such questions are told.
STATEMENT_OPTIONS = (
    "Both Statement I and Statement II are true.",
    "Both Statement I and Statement II are false.",
    "Statement I is true but Statement II is false.",
    "Statement I is false but Statement II is true.",
)
ASSERTION = r"(?i)\bAssertion\s*\(\s*A\s*\)|\bReason\s*\(\s*R\s*\)"
STATEMENT_PAIR = r"(?is)\bStatement\s*I\b.*\bStatement\s*II\b"
WARNINGS = {
    "image_backed_unresolved": "Option content appears to be image-backed and could not be extracted as text.",
    "missing": "Option content could not be extracted from the source block.",
    "partial": "Only part of the option set was extracted from the source block.",
}


def needs_defaults(text: Column, options: Column) -> Column:
    """Whether a question has no option and is of assertion and reason, or of two statements."""
    return ~F.exists(options, lambda v: collapsed(v) != "") & (F.rlike(text, F.lit(ASSERTION)) | F.rlike(text, F.lit(STATEMENT_PAIR)))


def with_defaults(parsed: Column) -> Column:
    """A parsed question, with the usual options where it needs them."""
    options = F.when(needs_defaults(parsed["stem"], parsed["options"]), F.array(*map(F.lit, STATEMENT_OPTIONS))).otherwise(parsed["options"])
    return F.struct(parsed["stem"].alias("stem"), options.alias("options"), parsed["source"].alias("source"))


def diagnostics(options: Column, text: Column, source: Column) -> Column:
    """struct<source, status, imageTokenCount, nonEmptyOptionCount, warnings> of a parsed question."""
    state = status(options, text)
    warning = F.coalesce(*(F.when(state == k, w) for k, w in WARNINGS.items()))
    return F.struct(
        source.alias("source"),
        state.alias("status"),
        F.regexp_count(text, F.lit(r"(?i)\[IMG(?::[^\]]+)?\]")).alias("imageTokenCount"),
        F.size(F.filter(options, lambda v: v != "")).alias("nonEmptyOptionCount"),
        F.filter(F.array(warning), lambda w: w.isNotNull()).alias("warnings"),
    )


def status(options: Column, text: Column) -> Column:
    """parsed, partial, missing, or image_backed_unresolved if there are only pictures."""
    n = F.size(F.filter(options, lambda v: v != ""))
    images = F.regexp_count(text, F.lit(r"(?i)\[IMG"))
    return F.when(n == 4, "parsed").when(n > 0, "partial").when(images > 0, "image_backed_unresolved").otherwise("missing")


# What explanations of such questions say, in order, and the letter it amounts to.
VERDICTS = (
    (r"both\s+(?:statement\s*i|a)\s+and\s+(?:statement\s*ii|r)\s+are\s+true", "a"),
    (r"both\s+(?:statement\s*i|a)\s+and\s+(?:statement\s*ii|r)\s+are\s+false", "b"),
    (r"(?:statement\s*i|assertion|a)\s+is\s+true\s+but\s+(?:statement\s*ii|reason|r)\s+is\s+false", "c"),
    (r"(?:statement\s*i|assertion|a)\s+is\s+false\s+but\s+(?:statement\s*ii|reason|r)\s+is\s+true", "d"),
    (r"statement\s*i\s+is\s+incorrect\s+but\s+statement\s*ii\s+is\s+correct", "d"),
    (r"statement\s*i\s+is\s+correct\s+but\s+statement\s*ii\s+is\s+incorrect", "c"),
)


def inferred_answer(explanation: Column) -> Column:
    """The letter that an explanation of two statements amounts to; '' if it says nothing."""
    told = F.lower(collapsed(explanation))
    return F.coalesce(*(F.when(F.rlike(told, F.lit(p)), a) for p, a in VERDICTS), F.lit(""))
