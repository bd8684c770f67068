"""Pages as node tables: tags as rows, elements as intervals of places, containment by levels.

An element spans the places [open, close) of its tags among the page's tokens. Depth is a
running sum over opening and closing tags; what holds a place is, at each level, the last
element opened there. So no step compares a page's places with all of its elements, and
none is a loop over a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.similarity import unescaped
from gleanery.functions.text import attribute, collapsed
from gleanery.sources.stored import stored

#: Comments, scripts and styles whole; tags, whose quoted attributes may hold ">"; text.
TOKEN = (
    r"(?is)<!--.*?-->|<script\b[^>]*+>.*?</script\s*>|<style\b[^>]*+>.*?</style\s*>"
    r"""|</?[a-z][^\s/>]*+(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|<[!?][^>]*+>|[^<]++|<"""
)
# Fixed values of HTML: elements without content, and those whose end tags may be left out, with the
# start tags that end them.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
PARAGRAPH_ENDS = (
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul",
)
ENDED_BY = {
    "li": ("li",),
    "dt dd": ("dt", "dd"),
    "p": PARAGRAPH_ENDS,
    "td th": ("td", "th", "tr", "tbody", "tfoot"),
    "tr": ("tr", "tbody", "tfoot"),
    "thead tbody": ("tbody", "tfoot"),
    "option": ("option", "optgroup"),
}
OPTIONAL = tuple(n for names in ENDED_BY for n in names.split())


def tokens(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, pos (from 0), kind (open, close, void, text or other), name (lower case), token: what a page
    is made of, in order. Null html has no tokens; joined, a page's tokens are its html."""
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))).alias("pos", "token"))
    name = F.lower(F.regexp_extract("token", r"^</?([a-zA-Z][^\s/>]*)", 1))
    whole = name.isin("script", "style") & F.rlike("token", F.lit(r"(?s)^<[^/].*</[^<]*>$"))
    kind = F.when(~F.col("token").startswith("<") | (F.col("token") == "<"), "text").when((name == "") | whole, "other").when(F.col("token").startswith("</"), "close").when(name.isin(*VOID), "void").otherwise("open")
    return rows.select("page_id", "pos", kind.alias("kind"), name.alias("name"), "token")


def dealt(rows: DataFrame) -> DataFrame:
    """rows by page_id: steps on a page's rows, and unions and joins of them, shuffle nothing from there on."""
    return rows.repartition("page_id")


def held(points: DataFrame, nodes: DataFrame, innermost: bool = False) -> DataFrame:
    """points' columns, depth, and node, the struct of `nodes`' columns besides page_id, for each node with
    open < pos < close: one row per pair, the outermost first in depth (1); or, if `innermost`, one per point,
    node null where none holds it.

    points: page_id, pos and more; nodes: page_id, open, close and more, properly nested or apart. Where both are
    dealt by page_id (`dealt`), so is what comes out, and nothing is shuffled.
    """
    of_point, of_node = F.struct(*(c for c in points.columns if c != "page_id")), F.struct(*(c for c in nodes.columns if c != "page_id"))
    no_point, no_node = (F.lit(None).cast(d.select(s.alias("s")).schema["s"].dataType) for d, s in ((points, of_point), (nodes, of_node)))
    row = lambda d, at, v, p, n: d.select("page_id", F.col(at).alias("at"), F.lit(v).alias("v"), p.alias("p"), n.alias("n"))
    events = row(nodes, "open", 1, no_point, of_node).unionByName(row(nodes, "close", -1, no_point, no_node)).unionByName(row(points, "pos", 0, of_point, no_node))
    # At one place, what closes there does so before, and what opens there after, the points.
    depth = F.sum("v").over(Window.partitionBy("page_id").orderBy("at", "v").rowsBetween(Window.unboundedPreceding, 0))
    events = events.withColumn("depth", depth.cast("int")).where("v >= 0")
    levels = F.when((F.col("v") == 1) | (F.col("depth") == 0) | F.lit(innermost), F.array("depth")).otherwise(F.sequence(F.lit(1), F.greatest("depth", F.lit(1))))
    by_level = events.select("page_id", "at", "v", "p", "n", "depth", F.explode(levels).alias("level"))
    last = F.last("n", ignorenulls=True).over(Window.partitionBy("page_id", "level").orderBy("at", "v").rowsBetween(Window.unboundedPreceding, 0))
    found = by_level.withColumn("node", last).where("p IS NOT NULL")
    own = [F.col("page_id") if c == "page_id" else F.col("p")[c].alias(c) for c in points.columns]
    inside = (F.col("depth") > 0) & (F.col("node.close") > F.col("at"))
    if innermost:
        return found.select(*own, F.when(inside, F.col("depth")).otherwise(0).alias("depth"), F.when(inside, F.col("node")).alias("node"))
    return found.where(inside).select(*own, F.col("level").alias("depth"), "node")


def _paired(tags: DataFrame, *scope: str) -> DataFrame:
    """page_id, open, name, token, close: opening tags with their own closing tag, or null. A closing tag takes the
    last open tag of its name (and scope) that has none yet; one without any is passed over."""
    by_name = Window.partitionBy("page_id", *scope, "name").orderBy("pos")
    so_far = by_name.rowsBetween(Window.unboundedPreceding, 0)
    rows = tags.withColumn("s", F.sum(F.when(F.col("kind") == "open", 1).otherwise(-1)).over(so_far))
    rows = rows.withColumn("e", F.col("s") - F.least(F.lit(0), F.min("s").over(so_far)))  # how many are open
    rows = rows.withColumn("before", F.coalesce(F.lag("e").over(by_name), F.lit(0)))
    rows = rows.where("kind = 'open' OR before > 0").withColumn("level", F.greatest("e", "before"))
    after = F.lead(F.struct("kind", "pos")).over(Window.partitionBy("page_id", *scope, "name", "level").orderBy("pos"))
    rows = rows.withColumn("after", after).where("kind = 'open'")
    return rows.select("page_id", F.col("pos").alias("open"), "name", "token", F.when(F.col("after.kind") == "close", F.col("after.pos")).alias("close"))


def nodes(tags: DataFrame) -> DataFrame:
    """page_id, open, close, depth (from 1), parent (its open, null at the top), name, token (the start tag), one row per element.

    tags: of `tokens`. Elements end at their end tags; where those may be left out, an end tag counts for an
    element in the same parent only. Without one, such an element ends before the next start tag that ends it there,
    and any at the latest with the element around it. Void elements are empty: they close right after they open.
    """
    optional, tags = F.col("name").isin(*OPTIONAL), dealt(tags)
    pairs = tags.where("kind IN ('open', 'close')")
    # Each step reads the one before it several times: it is stored, else all before would be done as often.
    kept = lambda rows, name: dealt(stored(rows, name))
    firm = kept(_paired(pairs.where(~optional)), "firm")
    scoped = held(pairs.where(optional), firm.where("close IS NOT NULL").select("page_id", "open", "close"), innermost=True).withColumn("scope", F.coalesce("node.open", F.lit(-1)))
    paired = kept(firm.unionByName(_paired(scoped, "scope")), "paired")
    sure = paired.where("close IS NOT NULL")
    end = tags.groupBy("page_id").agg((F.max("pos") + 1).alias("end"))
    around = held(paired.select("page_id", F.col("open").alias("pos"), "name", "token", "close"), sure.select("page_id", "open", "close"), innermost=True)
    # Those after it, run through backwards: a frame up to the last row would be summed anew for each row.
    siblings = Window.partitionBy("page_id", "node").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    stop = None
    for names, by in ENDED_BY.items():
        here = F.col("name").isin(*names.split())
        found = F.min(F.when(F.col("name").isin(*by), F.col("pos"))).over(siblings)
        stop = F.when(here, found) if stop is None else stop.when(here, found)
    bounded = around.withColumn("stop", stop).where("close IS NULL").join(end, "page_id")
    bounded = kept(bounded.select("page_id", F.col("pos").alias("open"), "name", "token", F.least("stop", F.coalesce("node.close", "end")).alias("close")), "bounded")
    firm = sure.unionByName(bounded.where(optional).select(*sure.columns))
    rest = held(bounded.where(~optional).withColumnRenamed("open", "pos"), firm.select("page_id", "open", "close"), innermost=True)
    rest = rest.select("page_id", F.col("pos").alias("open"), "name", "token", F.least("close", F.coalesce("node.close", "close")).alias("close"))
    void = tags.where("kind = 'void'").select("page_id", F.col("pos").alias("open"), "name", "token", (F.col("pos") + 1).alias("close"))
    every = kept(firm.unionByName(rest), "elements")
    placed = held(every.unionByName(void).withColumnRenamed("open", "pos"), every.select("page_id", "open", "close"), innermost=True)
    return placed.select("page_id", F.col("pos").alias("open"), "close", (F.col("depth") + 1).alias("depth"), F.col("node.open").alias("parent"), "name", "token")


def parsed(pages: DataFrame, html: str = "html") -> tuple[DataFrame, DataFrame]:
    """(tokens, nodes) of pages, both stored: all that is asked of the pages reads them."""
    tags = stored(tokens(pages, html), "tokens")
    return tags, stored(nodes(tags), "nodes")


def has_class(*classes: str) -> Column:
    """Whether a node's start tag has one of these classes."""
    own = F.split(collapsed(attribute(F.col("token"), "class")), " ")
    return F.arrays_overlap(own, F.array(*map(F.lit, classes)))


def text_of(pieces: DataFrame, of: DataFrame, without: DataFrame | None = None, separator: str = "") -> DataFrame:
    """page_id, open, text: the pieces (page_id, pos, text) in each node of `of`, joined in order. A piece inside an
    element of `without` that stands in the node does not count. Nodes without pieces have no row."""
    own = pieces.select("page_id", "pos", "text")
    if without is None:
        own = own.withColumn("hidden", F.lit(-1))
    else:
        own = held(own, without.select("page_id", "open", "close"), innermost=True).select("page_id", "pos", "text", F.coalesce("node.open", F.lit(-1)).alias("hidden"))
    met = held(own, of.select("page_id", "open", "close")).where(F.col("hidden") <= F.col("node.open"))
    parts = F.array_sort(F.collect_list(F.struct("pos", "text")))
    return met.groupBy("page_id", F.col("node.open").alias("open")).agg(F.array_join(F.transform(parts, lambda x: x["text"]), separator).alias("text"))


def texts(tags: DataFrame) -> DataFrame:
    """page_id, pos, text: text tokens, references decoded."""
    return tags.where("kind = 'text'").select("page_id", "pos", unescaped(F.col("token")).alias("text"))


# What is no text of an element, and the parts of question widgets.
HIDDEN = ("script", "style", "noscript")
WIDGETS = ("nq2_question_block", "nq2_card", "nq2_report_row", "nq2_report_form", "nq2_sol_panel")
NOT_STEM = ("nq2_options_grid", "nq2_sol_panel", "nq2_report_row", "nq2_report_form", "nq2_type_label_wrap")


def element_lines(tags: DataFrame, tree: DataFrame, of: DataFrame) -> DataFrame:
    """page_id, open, lines: the lines of each element of `of` (rows of `tree`) that has any. Tables, scripts and
    widgets inside it are left out; <br> ends a line; a picture is [IMG:address]. Widgets of `of` have the lines that
    `widget_lines` gives."""
    tree, words = dealt(tree), dealt(stored(texts(tags), "texts"))
    own = dealt(of.select("page_id", "open", "close", "name", "token"))
    cards = tree.where(has_class("nq2_card")).select("page_id", F.col("open").alias("pos"))
    with_card = held(cards, own).select("page_id", F.col("node.open").alias("open"))
    widgets = own.where(has_class("nq2_question_block")).select("page_id", "open").unionByName(with_card).distinct().withColumn("widget", F.lit(True))
    own = stored(own.join(widgets, ["page_id", "open"], "left").withColumn("widget", F.col("widget").isNotNull()).where(F.col("widget") | ~F.col("name").isin(*HIDDEN)), "elements")
    plain, widgets = dealt(own.where("NOT widget")), dealt(own.where("widget"))
    # What there are none of is not looked for in all texts.
    if plain.isEmpty():
        return _widget_lines(words, tree, widgets).where(F.size("lines") > 0)
    source = attribute(F.col("token"), "src")
    marks = tags.where("name IN ('br', 'img') AND kind = 'void'").select("page_id", "pos", F.when(F.col("name") == "br", "\n").when(source != "", F.concat(F.lit(" [IMG:"), source, F.lit("] "))).otherwise(" [IMG] ").alias("text"))
    without = tree.where(F.col("name").isin("table", *HIDDEN) | has_class(*WIDGETS))
    shown = text_of(words.unionByName(dealt(marks)), plain, without)
    rows = shown.select("page_id", "open", F.filter(F.transform(F.split("text", "\n"), collapsed), lambda x: x != "").alias("lines"))
    if not widgets.isEmpty():
        rows = rows.unionByName(_widget_lines(words, tree, widgets))
    return rows.where(F.size("lines") > 0)


def _first(rows: DataFrame) -> DataFrame:
    """Of each widget (page_id, widget) or part of one, the row that comes first."""
    keys = [c for c in rows.columns if c not in ("at", "text")]
    return rows.groupBy(*keys).agg(F.min_by("text", "at").alias("text"))


def widget_lines(tags: DataFrame, tree: DataFrame, widgets: DataFrame) -> DataFrame:
    """page_id, open, lines of question widgets: the stem; "(a) value" for each option; "Ans: (a)"; the points of the
    solution. What a widget lacks has no line."""
    return _widget_lines(dealt(stored(texts(tags), "texts")), dealt(tree), dealt(widgets))


def _widget_lines(words: DataFrame, tree: DataFrame, widgets: DataFrame) -> DataFrame:
    """widget_lines by the pages' texts, all dealt by page."""
    own = widgets.select("page_id", "open", "close")
    lead = F.regexp_replace(collapsed(F.regexp_replace("text", r"(?i)^\s*Try yourself:\s*", "")), r"^\s+", "")
    stem = text_of(words, own, tree.where(has_class(*NOT_STEM) | F.col("name").isin(*HIDDEN))).select("page_id", "open", F.lit(0).alias("part"), F.lit(0).alias("at"), lead.alias("line"))

    labelled, is_item = ("nq2_opt_letter", "nq2_opt_text", "nq2_sol_label"), F.col("name") == "li"
    told_by = dealt(stored(text_of(words, tree.where(has_class(*labelled) | is_item)).withColumnRenamed("open", "at"), "widget-texts"))

    def parts(of: DataFrame, *classes: str) -> DataFrame:
        """page_id, widget (open of the node of `of`), at, text of the elements of these classes inside it."""
        found = tree.where(has_class(*classes))
        inside = held(found.select("page_id", F.col("open").alias("pos")), of).select("page_id", F.col("node.open").alias("widget"), F.col("pos").alias("at"))
        return inside.join(told_by, ["page_id", "at"], "left").withColumn("text", collapsed(F.col("text")))

    options = tree.where(has_class("nq2_option")).select("page_id", "open", "close")
    in_widget = held(options.select("page_id", F.col("open").alias("pos")), own).select("page_id", F.col("node.open").alias("open"), F.col("pos").alias("option"))
    letter, value = (_first(parts(options, c)).select("page_id", F.col("widget").alias("option"), F.col("text").alias(n)) for c, n in (("nq2_opt_letter", "letter"), ("nq2_opt_text", "value")))
    listed = in_widget.join(letter, ["page_id", "option"]).join(value, ["page_id", "option"]).where("letter <> '' AND value <> ''")
    listed = listed.select("page_id", "open", F.lit(1).alias("part"), F.col("option").alias("at"), F.concat(F.lit("("), F.lower("letter"), F.lit(") "), "value").alias("line"))
    told = F.regexp_extract("text", r"(?i)Correct\s*Answer\s*:\s*([a-d])", 1)
    answer = _first(parts(own, "nq2_sol_label")).where(told != "").select("page_id", F.col("widget").alias("open"), F.lit(2).alias("part"), F.lit(0).alias("at"), F.concat(F.lit("Ans: ("), F.lower(told), F.lit(")")).alias("line"))
    bodies = tree.where(has_class("nq2_sol_body")).select("page_id", "open", "close")
    items = tree.where(is_item)
    in_body = held(items.select("page_id", F.col("open").alias("pos")), bodies).select("page_id", "pos").distinct()
    points = held(in_body, own).select("page_id", F.col("node.open").alias("open"), F.col("pos").alias("at")).join(told_by, ["page_id", "at"])
    points = points.select("page_id", "open", F.lit(3).alias("part"), "at", collapsed(F.col("text")).alias("line"))
    rows = stem.unionByName(listed).unionByName(answer).unionByName(points).where("line <> ''")
    return rows.groupBy("page_id", "open").agg(F.transform(F.array_sort(F.collect_list(F.struct("part", "at", "line"))), lambda x: x["line"]).alias("lines"))


def node_tables(tags: DataFrame, tree: DataFrame) -> DataFrame:
    """page_id, open, rows (array<array<string>>): the tables that have rows with cells. All rows and cells inside a
    table count, also those of tables within it, which have rows of this kind of their own."""
    of = lambda *names: tree.where(F.col("name").isin(*names)).select("page_id", "open", "close")
    cells, rows = of("td", "th"), of("tr")
    words = text_of(texts(tags), cells, tree.where(F.col("name").isin(*HIDDEN)))
    cells = cells.join(words, ["page_id", "open"], "left").select("page_id", F.col("open").alias("pos"), collapsed(F.col("text")).alias("text"))
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("pos", c))), lambda x: x[c])
    filled = held(cells, rows).groupBy("page_id", F.col("node.open").alias("pos")).agg(ordered("text").alias("cells"))
    return held(filled, of("table")).groupBy("page_id", F.col("node.open").alias("open")).agg(ordered("cells").alias("rows"))


def node_anchors(tags: DataFrame, tree: DataFrame, headings: str | None = None, spans: bool = True) -> DataFrame:
    """page_id, open, href, classes, text, heading of each anchor with an address: the text of the first
    subcoursetitle inside (of elements named `headings`, or any), without that of <span> unless `spans`; '' if there is none."""
    found = tree.where("name = 'a'").withColumn("href", attribute(F.col("token"), "href")).where("href <> ''").withColumn("classes", attribute(F.col("token"), "class"))
    words, bare = texts(tags), found.select("page_id", "open", "close")
    titles = tree.where(has_class("subcoursetitle") & (F.col("name") == headings if headings else F.lit(True)))
    inside = held(titles.select("page_id", F.col("open").alias("pos")), bare).groupBy("page_id", F.col("node.open").alias("open")).agg(F.min("pos").alias("title"))
    heading = text_of(words, titles, None if spans else tree.where("name = 'span'")).select("page_id", F.col("open").alias("title"), collapsed(F.col("text")).alias("heading"))
    inside = inside.join(heading, ["page_id", "title"], "left").select("page_id", "open", "heading")
    shown = text_of(words, bare).select("page_id", "open", collapsed(F.col("text")).alias("text"))
    return found.join(shown, ["page_id", "open"], "left").join(inside, ["page_id", "open"], "left").select("page_id", "open", "href", "classes", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("heading", F.lit("")).alias("heading"))


def widest(tree: DataFrame, *classes: str) -> DataFrame:
    """page_id, open, close, children: each page's element of one of these classes that has the most child elements; of
    equal ones the first. Pages without such an element have no row."""
    own = tree.where(has_class(*classes))
    count = tree.where("parent IS NOT NULL").groupBy("page_id", F.col("parent").alias("open")).agg(F.count("*").alias("children"))
    met = own.join(count, ["page_id", "open"], "left").withColumn("children", F.coalesce("children", F.lit(0)))
    best = F.max_by(F.struct("open", "close", "children"), F.struct("children", -F.col("open")))
    return met.groupBy("page_id").agg(best.alias("b")).select("page_id", "b.*")
