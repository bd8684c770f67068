"""Question blocks from ordered lines: forward fill and sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.text import collapsed, first_number, matches
from gleanery.sources.pages import kept_lines
from gleanery.sources.stored import numbered, stored

# The grammar of the pages' lines.
YEAR = r"\b(20\d{2})\b"
START = r"(?i)^Q\d+[:\s.]"
ANSWER_LINE = r"(?i)Ans[:\s-]+"
OPTION_LINE = r"(?i)^\([a-d]\)\s*"
INTERFACE_LINE = r"(?i)^(Type\s*Your\s*Answer|View\s*Answer|Solution:?)$"


def is_year_header(line: Column) -> Column:
    """A short line with a year; an option that is one belongs to its question."""
    return (F.length(line) < 20) & F.contains(line, F.lit("20")) & F.rlike(line, F.lit(YEAR)) & ~F.rlike(line, F.lit(OPTION_LINE))


def _numbered(rows: DataFrame, key: Sequence[str], order: Sequence[str], header: Column, value: Column, start: Column, stretch: Column | None) -> DataFrame:
    """All rows given to `sessions`, with __header, __start, `block` (-1 before the first start) and __value, the value of the last header."""
    marked = rows.withColumn("__header", header).withColumn("__start", ~F.col("__header") & start)
    told, own = F.when(F.col("__header"), value), list(key)
    if stretch is not None:
        marked, own = marked.withColumn("__stretch", stretch), [*key, "__stretch"]
    running = Window.partitionBy(*own).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = marked.withColumn("__value", F.last(told, ignorenulls=True).over(running)).withColumn("block", (F.sum(F.col("__start").cast("int")).over(running) - 1).cast("int"))
    if stretch is not None:
        each = marked.groupBy(*own).agg(F.count_if("__start").alias("__starts"), F.max_by(told, F.when(told.isNotNull(), F.struct(*order))).alias("__last"))
        earlier = Window.partitionBy(*key).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
        sums = each.select(*own, F.coalesce(F.sum("__starts").over(earlier), F.lit(0)).alias("__starts"), F.last("__last", ignorenulls=True).over(earlier).alias("__last"))
        filled = filled.join(sums, own).withColumn("block", (F.col("block") + F.col("__starts")).cast("int")).withColumn("__value", F.coalesce("__value", "__last")).drop("__stretch", "__starts", "__last")
    return filled


def sessions(rows: DataFrame, key: Sequence[str], order: Sequence[str], header: Column, value: Column, start: Column, initial: str = "", stretch: Column | None = None) -> DataFrame:
    """rows with `block` (0-based) and `carried`: the value of the last header at the block's
    start, or `initial`. Headers belong to no block and are never starts; rows before the
    first start go. stretch: ascends with the order; stretches of a key are run through apart then, each
    beginning with the sums of those before it."""
    kept = _numbered(rows, key, order, header, value, start, stretch).where("not __header and block >= 0")
    own = Window.partitionBy(*key, "block")
    return kept.withColumn("carried", F.coalesce(F.max(F.when(F.col("__start"), F.col("__value"))).over(own), F.lit(initial))).drop("__header", "__start", "__value")


def blocks(lines: DataFrame, key: str = "page_id", initial: str = "", stretch: Column | None = None) -> DataFrame:
    """key, source_index, year, lines: the question blocks of pages given by their lines; stretch as in `sessions`."""
    rows = sessions(lines, [key], ["pos"], is_year_header(F.col("line")), F.regexp_extract("line", YEAR, 1), F.rlike("line", F.lit(START)), initial, stretch)
    grouped = rows.groupBy(key, "block").agg(F.max("carried").alias("year"), F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("ls"))
    return grouped.select(key, F.col("block").alias("source_index"), "year", F.transform("ls", lambda x: x["line"]).alias("lines"))


def runs(pages: DataFrame) -> DataFrame:
    """page_id, part, n (from 0), told, begins, lines: pages' parts cut before each header and start. told: the header's
    year, whose line is left out; begins: whether it is a start. Neither holds for lines before a part's first."""
    marked = lambda x: is_year_header(x) | matches(x, "Qq", START)
    rows = pages.select("page_id", "part", kept_lines(F.col("html")).alias("ls"))
    rows = rows.withColumn("at", F.filter(F.transform("ls", lambda x, i: F.when(marked(x), i)), lambda i: i.isNotNull()))
    cut = F.zip_with(F.concat(F.array(F.lit(0)), "at"), F.concat("at", F.array(F.size("ls"))), lambda a, z: F.slice("ls", a + 1, z - a))
    rows = numbered(rows, cut, "n", "lines").where(F.size("lines") > 0).drop("ls", "at")
    first, inner = F.col("lines")[0], F.col("n") > 0
    rows = rows.withColumn("told", F.when(inner & is_year_header(first), F.regexp_extract(first, YEAR, 1)))
    begins = inner & F.col("told").isNull()
    return rows.select("page_id", "part", "n", "told", begins.alias("begins"), F.when(F.col("told").isNull(), F.col("lines")).otherwise(F.slice("lines", 2, F.size("lines"))).alias("lines"))


def blocks_of_parts(pages: DataFrame, initial: str = "") -> DataFrame:
    """As `blocks`, of pages (page_id, part, html) in parts. What is run through are not lines but their runs, each from a
    header or start to the next; parts are gone through apart, as stretches in `sessions`."""
    rows = stored(runs(pages), "block-runs")  # they are read for what a part hands on, too
    rows = _numbered(rows, ["page_id"], ["part", "n"], F.col("told").isNotNull(), F.col("told"), F.col("begins"), F.col("part")).where("block >= 0")
    year = F.max(F.when(F.col("__start"), F.col("__value")))
    grouped = rows.groupBy("page_id", "block").agg(F.coalesce(year, F.lit(initial)).alias("year"), F.sort_array(F.collect_list(F.struct("part", "n", "lines"))).alias("ls"))
    return grouped.select("page_id", F.col("block").alias("source_index"), "year", F.flatten(F.transform("ls", lambda x: x["lines"])).alias("lines"))


#: The same on elements of a page instead of lines: headings are headers however long they
#: are, and the year before the first header is this one.
ELEMENT_START, FIRST_YEAR = r"(?i)^Q\s*\d+[:\s.]", "2022"


def element_blocks(elements: DataFrame, key: str = "page_id") -> DataFrame:
    """key, source_index, year, lines: the question blocks of pages given by their elements (key, pos, tag, text)."""
    t = F.col("text")
    header = F.rlike(t, F.lit(YEAR)) & (F.col("tag").isin("h1", "h2", "h3", "h4") | (F.length(t) < 20))
    rows = sessions(elements, [key], ["pos"], header, F.regexp_extract(t, YEAR, 1), F.rlike(t, F.lit(ELEMENT_START)), FIRST_YEAR)
    grouped = rows.groupBy(key, "block").agg(F.max("carried").alias("year"), F.sort_array(F.collect_list(F.struct("pos", "text"))).alias("ls"))
    return grouped.select(key, F.col("block").alias("source_index"), "year", F.transform("ls", lambda x: x["text"]).alias("lines"))


def is_picture(src: Column) -> Column:
    """Whether a picture belongs to a question: not the page's own ornaments."""
    return src.startswith("http") & ~F.contains(src, F.lit("Vector.png"))


def picture_suffixes(pictures: DataFrame, key: Sequence[str]) -> DataFrame:
    """pictures (key, pos, src, after_answer) that belong to questions, with suffix: -main, -main2, ...
    before the answer, -explanation1, ... after it."""
    n = F.row_number().over(Window.partitionBy(*key, "after_answer").orderBy("pos"))
    own = pictures.where(is_picture(F.col("src"))).withColumn("__n", n)
    suffix = F.when(F.col("after_answer"), F.concat(F.lit("-explanation"), F.col("__n").cast("string"))).when(F.col("__n") == 1, "-main").otherwise(F.concat(F.lit("-main"), F.col("__n").cast("string")))
    return own.withColumn("suffix", suffix).drop("__n")


# The headings above what is said of the other options, and what leads an answer.
OTHER_OPTIONS = r"(?i)^(other options|explanation of incorrect options|incorrect options|why other options)"
ANSWER_LEAD = r"(?i)^Ans[:\s-]+[\s(]*[a-d][)\s.]*"


def rebuilt_explanation(body: Column, lines: Column) -> Column:
    """An explanation's body, and under the heading of the other options, if the block has one, what
    stands after its answer."""
    heading = F.try_element_at(F.filter(lines, lambda x: (F.length(x) < 60) & F.rlike(x, F.lit(OTHER_OPTIONS))), F.lit(1))
    answers = F.transform(lines, lambda x: F.contains(F.lower(x), F.lit("ans:")))
    first = F.array_position(answers, True).cast("int")
    after = F.when(first > 0, F.slice(lines, first, F.size(lines))).otherwise(F.array().cast("array<string>"))
    parts = F.filter(F.transform(F.filter(after, lambda x: ~F.contains(F.lower(x), F.lit("ans:")) & (x != heading)), lambda x: F.trim(F.regexp_replace(x, ANSWER_LEAD, ""))), lambda x: x != "")
    whole = F.filter(F.array(collapsed(body), F.concat(F.trim(F.regexp_replace(heading, ":+$", "")), F.lit(":")), F.array_join(parts, " ")), lambda x: x != "")
    return F.when(heading.isNull(), collapsed(body)).otherwise(collapsed(F.array_join(whole, " ")))


def signals(of: DataFrame, pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key and what its page leads one to expect: questions, answers, options, images, tables,
    blocks left short. A page may come in rows with a `part` each."""
    has_answer = F.exists("lines", lambda x: F.rlike(x, F.lit(ANSWER_LINE)))
    options = F.size(F.filter("lines", lambda x: F.rlike(x, F.lit(OPTION_LINE))))
    counts = of.groupBy(key).agg(F.count("*").alias("q"), F.count_if(has_answer).alias("a"), F.sum(options).alias("o"), F.count_if(F.size("lines") < 3).alias("r"))
    marks = {"__images": F.regexp_count("html", F.lit("<img")), "__tables": F.regexp_count("html", F.lit("<table"))}
    if "part" in pages.columns:
        pages = pages.groupBy(key).agg(*(F.sum(c).alias(k) for k, c in marks.items()))
    else:
        pages = pages.withColumns(marks)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return pages.join(counts, key, "left").select(
        key,
        zero(F.col("q")).alias("expected_question_count"),
        zero(F.col("a")).alias("expected_answer_markers"),
        zero(F.col("o")).alias("expected_option_markers"),
        zero(F.col("__images")).alias("expected_images"),
        zero(F.col("__tables")).alias("expected_tables"),
        zero(F.col("r")).alias("residual_blocks"),
    )


def stem(lines: Column) -> Column:
    """A block's lines up to its first answer or option, without interface lines and its number."""
    shown = F.filter(lines, lambda x: (x != "") & ~matches(x, "TtVvSs", INTERFACE_LINE))
    stops = lambda ls: F.array_position(F.transform(ls, lambda x: matches(x, "Aa(", r"(?i)^Ans\s*[:.-]?|^\([a-d]\)\s*")), True)
    until = lambda ls, n: F.when(n > 0, F.slice(ls, F.lit(1), (n - 1).cast("int"))).otherwise(ls)
    # As values of lambdas, the lines shown and the place of the first stop are reckoned once.
    before = F.transform(F.array(shown), lambda ls: F.transform(F.array(stops(ls)), lambda n: until(ls, n))[0])[0]
    return F.trim(F.array_join(F.filter(F.transform(before, lambda x: F.regexp_replace(x, r"(?i)^Q\d+[:\s.]\s*", "")), lambda x: x != ""), " "))


def with_keys(of: DataFrame) -> DataFrame:
    return of.withColumn("stem", stem(F.col("lines"))).withColumn("number", first_number(F.col("lines")))
