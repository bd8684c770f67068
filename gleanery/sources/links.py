"""Links of course, chapter and document pages: attributes in any order, quoted or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.similarity import unescaped
from gleanery.functions.text import attribute, collapsed, normal, slug
from gleanery.functions.titles import chapter_title, class_code, is_chapter, is_paper, subject, topic_key
from gleanery.sources.markup import node_anchors, parsed

ANCHOR = r"(?is)<a\b([^>]*)>(.*?)</a>"
# The forms of the sites' links, and what their document pages are called.
CHAPTER_HREF = r"^/(?:chapter|topic)/(\d+)_([^/?#\s]+)"
DOCUMENT_HREF = r"^/t/([^/?#\s]+)(?:/([^?#\s]*))?"
CHAPTER_CLASS = r"(?:^|\s)crs_chptr(?:\s|$)"
CHAPTER_HEADING = r"(?is)<h2\b[^>]*\bsubcoursetitle\b[^>]*>(.*?)</h2>"
PAPER = "NEET Previous Year Questions"
LISTED_PAPER = rf'(?i)"name":"([^"]*{PAPER}[^"]*)","url":"(https://[^"/]+/t/[^"]+)"'


def decoded(c: Column) -> Column:
    """The character references that titles have; `similarity.unescaped` takes all."""
    for name, by in (("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(by))
    return c


def shown(inner: Column) -> Column:
    return collapsed(decoded(F.regexp_replace(inner, "<[^>]+>", " ")))


def without_dots(path: Column) -> Column:
    """A path without its . and .. segments; .. at the top stays there."""
    segments = F.split(path, "/", -1)
    none = F.array().cast("array<string>")
    up = lambda kept: F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
    kept = F.aggregate(segments, none, lambda k, x: F.when(x == "..", up(k)).when(x == ".", k).otherwise(F.concat(k, F.array(x))))
    return F.concat(F.array_join(kept, "/"), F.when(F.element_at(segments, -1).isin(".", ".."), "/").otherwise(""))


#: The parts of a reference: scheme (1, 2), authority (3), path (4), query (5), fragment (6).
REFERENCE = r"(?s)^(([^:/?#]+):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def absolute(href: Column, base: Column) -> Column:
    """The address that a reference means on a page at `base`, by the general rules for references: full
    ones stay but for dot segments, //host takes the scheme, /path the host, ?query and #part the page,
    anything else the page's folder."""
    part = lambda c, i: F.coalesce(F.regexp_extract(c, REFERENCE, i), F.lit(""))
    host, own = part(base, 3), part(base, 4)
    scheme, at, path, query, fragment = (part(href, i) for i in (1, 3, 4, 5, 6))
    folder = F.when(own == "", "/").otherwise(F.regexp_replace(own, "[^/]*$", ""))
    merged = F.when(path == "", own).when(path.startswith("/"), without_dots(path)).otherwise(without_dots(F.concat(folder, path)))
    asked = F.when((path == "") & (query == ""), part(base, 5)).otherwise(query)
    return (
        F.when((scheme != "") & (at == ""), href).when(scheme != "", F.concat(scheme, at, without_dots(path), query, fragment))
        .when(at != "", F.concat(part(base, 1), at, without_dots(path), query, fragment)).otherwise(F.concat(part(base, 1), host, merged, asked, fragment))
    )


def anchors(pages: DataFrame, *keep: str | Column) -> DataFrame:
    """The columns in `keep` and pos, href, classes, inner, text of each anchor with an address."""
    found = F.arrays_zip(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1)).alias("attrs"), F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(2)).alias("inner"))
    rows = pages.select(*keep, F.posexplode(found).alias("pos", "a"))
    attrs, kept = F.col("a.attrs"), rows.columns[:-2]
    return rows.select(*kept, "pos", attribute(attrs, "href").alias("href"), attribute(attrs, "class").alias("classes"), "a.inner", shown(F.col("a.inner")).alias("text")).where("href != ''")


def first_of(rows: DataFrame, key: list[str], by: str) -> DataFrame:
    """The first row, by pos, of each key and value of `by`, with its place (1-based) among the key's."""
    nth = F.row_number().over(Window.partitionBy(*key, by).orderBy("pos"))
    return rows.withColumn("__nth", nth).where("__nth = 1").withColumn("index", F.row_number().over(Window.partitionBy(*key).orderBy("pos"))).drop("__nth")


def links(pages: DataFrame) -> DataFrame:
    """page_id, idx (1-based), href, title: a page's links, the first of each address."""
    return first_of(anchors(pages, "page_id"), ["page_id"], "href").select("page_id", F.col("index").alias("idx"), "href", F.col("text").alias("title"))


def _titled(pages: DataFrame, *keep: str | Column) -> DataFrame:
    """The columns in `keep` and pos, href, title, id, href_slug of a page's chapter anchors, by
    regular expressions as the sites' plain listings allow."""
    rows = anchors(pages, *keep).where(F.rlike("classes", F.lit(CHAPTER_CLASS)) & F.rlike("href", F.lit(CHAPTER_HREF)))
    heading = shown(F.regexp_extract("inner", CHAPTER_HEADING, 1))
    return rows.select(*rows.columns[: len(keep)], "pos", "href", F.coalesce(F.nullif(heading, F.lit("")), "text").alias("title"), F.regexp_extract("href", CHAPTER_HREF, 1).alias("id"), F.regexp_extract("href", CHAPTER_HREF, 2).alias("href_slug")).where("title != ''")


def _found(pages: DataFrame, headings: str | None, spans: bool) -> DataFrame:
    """pages' columns but html, and pos, href, classes, text, heading of each anchor in the node table."""
    found = node_anchors(*parsed(pages.select("page_id", "html")), headings, spans).withColumnRenamed("open", "pos")
    return pages.drop("html").join(found, "page_id")


def _chapters(pages: DataFrame) -> DataFrame:
    rows = _found(pages, "h2", True).where(F.rlike("classes", F.lit(CHAPTER_CLASS)) & F.rlike("href", F.lit(CHAPTER_HREF)))
    rows = rows.withColumn("title", F.coalesce(F.nullif("heading", F.lit("")), "text")).where("title != ''")
    return rows.withColumn("id", F.regexp_extract("href", CHAPTER_HREF, 1)).withColumn("href_slug", F.regexp_extract("href", CHAPTER_HREF, 2)).withColumn("address", absolute(F.col("href"), F.col("url")))


def chapter_links(pages: DataFrame) -> DataFrame:
    """page_id, index, id, title, url, slug: the chapters that a course page (page_id, url, html)
    lists, wherever in its markup; the first of each address."""
    rows = _chapters(pages.select("page_id", "url", "html")).where(F.col("href").startswith("/chapter/"))
    return first_of(rows, ["page_id"], "address").select("page_id", "index", "id", "title", F.col("address").alias("url"), F.col("href_slug").alias("slug"))


def course_chapters(pages: DataFrame) -> DataFrame:
    """page_id, chapter_id, href_slug, chapter_title, slug (of the title), chapter_url: the first
    chapter of each slug."""
    rows = _titled(pages, "page_id", F.col("url").alias("__base")).where(F.col("href").startswith("/chapter/")).withColumn("slug", slug(F.col("title")))
    rows = rows.withColumn("chapter_url", absolute(F.col("href"), F.col("__base")))
    return first_of(rows, ["page_id"], "slug").select("page_id", F.col("id").alias("chapter_id"), "href_slug", F.col("title").alias("chapter_title"), "slug", "chapter_url")


def topic_links(pages: DataFrame) -> DataFrame:
    """page_id, index, id, title, url, slug, class_code, subject: chapters and topics on a course
    page (page_id, url, html, course_id, course_title), without the course itself and what is no
    chapter; the first of each topic key."""
    title = F.coalesce("course_title", F.lit(""))
    rows = _chapters(pages.select("page_id", "url", "html", F.coalesce("course_id", F.lit("")).alias("course"), title.alias("course_title"))).withColumn("key", topic_key(F.col("title")))
    rows = rows.where((F.col("id") != F.col("course")) & is_chapter(F.col("title")) & (F.col("key") != "") & (F.col("key") != topic_key(F.col("course_title"))))
    code = class_code(F.col("course_title"))
    return first_of(rows, ["page_id"], "key").select("page_id", "index", "id", chapter_title(F.col("title")).alias("title"), F.col("address").alias("url"), F.col("href_slug").alias("slug"), code.alias("class_code"), subject(code).alias("subject"))


def document_links(pages: DataFrame, chapters: DataFrame) -> DataFrame:
    """chapter columns (page_id, title) and document_id, document_title, url, slug: the papers
    on a chapter's page whose topic key is the chapter's; the first of each address."""
    rows = _found(pages.select("page_id", "url", "html"), None, False).where(F.rlike("href", F.lit(DOCUMENT_HREF)))
    title = F.coalesce(F.nullif("heading", F.lit("")), F.trim(F.regexp_replace("text", r"(?i) Doc\s*\|.*$", "")))
    title = F.regexp_replace(title, r"^•\s*", "")
    rows = rows.withColumn("document_title", title).where(is_paper(F.col("document_title"))).withColumn("key", topic_key(F.col("document_title"))).withColumn("at", absolute(F.col("href"), F.col("url")))
    met = rows.join(chapters.select("page_id", "title", topic_key(F.col("title")).alias("key")), ["page_id", "key"])
    return first_of(met, ["page_id", "title"], "at").select("page_id", "title", F.regexp_extract("href", DOCUMENT_HREF, 1).alias("document_id"), "document_title", F.col("at").alias("url"), F.regexp_extract("href", DOCUMENT_HREF, 2).alias("slug"))


def document_of(pages: DataFrame) -> DataFrame:
    """page_id, source_label, source_url: the paper that a chapter's page (page_id, url, html,
    chapter_title) leads to. Candidates are those listed in its JSON-LD, then its anchors, the first of each address;
    of them the first whose title holds the chapter's, else the first. Pages without any have no row."""
    listed = F.arrays_zip(F.regexp_extract_all("html", F.lit(LISTED_PAPER), F.lit(1)).alias("t"), F.regexp_extract_all("html", F.lit(LISTED_PAPER), F.lit(2)).alias("u"))
    of_list = pages.select("page_id", "chapter_title", F.posexplode(listed).alias("n", "x")).select("page_id", "chapter_title", F.col("n").alias("pos"), collapsed(decoded(F.col("x.t"))).alias("label"), F.col("x.u").alias("at"))
    own = anchors(pages, "page_id", "chapter_title", F.col("url").alias("__base")).where(F.col("href").startswith("/t/") & F.contains("text", F.lit(PAPER)))
    of_anchor = own.select("page_id", "chapter_title", (F.col("pos") + (1 << 20)).alias("pos"), F.col("text").alias("label"), absolute(F.regexp_replace("href", "#.*$", ""), F.col("__base")).alias("at"))
    rows = first_of(of_list.unionByName(of_anchor), ["page_id"], "at")
    held = F.contains(normal(F.col("label")), normal(F.col("chapter_title")))
    best = F.min_by(F.struct("label", "at"), F.struct(~held, "pos")).alias("b")
    return rows.groupBy("page_id").agg(best).select("page_id", F.col("b.label").alias("source_label"), F.col("b.at").alias("source_url"))


def page_metadata(pages: DataFrame) -> DataFrame:
    """page_id, page_title, canonical_url, course_title (of the breadcrumb), hidden_title; '' where a page has none, or no html."""
    pages = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html"))
    tag = lambda pattern: F.regexp_extract("html", pattern, 0)
    told = lambda inner: collapsed(unescaped(F.regexp_replace(inner, "<[^>]+>", " ")))
    crumb = F.regexp_extract("html", r"""(?is)<[^>]*class=["']?[^"'>]*(?:brdcrmb_cntnr|breadcrumbspn)[^>]*>.*?(<a\b[^>]*href=["']?[^"'\s>]*/courses/[^>]*>.*?)</a>""", 1)
    return pages.select(
        "page_id",
        told(F.regexp_extract("html", r"(?is)<title\b[^>]*>(.*?)</title>", 1)).alias("page_title"),
        attribute(tag(r"""(?is)<link\b[^>]*rel=["']?canonical[^>]*>"""), "href").alias("canonical_url"),
        told(crumb).alias("course_title"),
        collapsed(attribute(tag(r"""(?is)<input\b[^>]*id=["']?leftSideCourseTitleHidden[^>]*>"""), "value")).alias("hidden_title"),
    )


def verified(rows: DataFrame) -> Column:
    """Whether a document's page (page_title, course_title) is the chapter's (title, class_code) paper."""
    name = F.initcap(subject(F.col("class_code")))
    course = F.concat(F.lit("(?i)"), name, F.lit(r"\s*Class\s*"), F.when(F.col("class_code").endswith("11"), "11").otherwise("12"))
    return F.contains(topic_key(F.col("page_title")), topic_key(F.col("title"))) & F.rlike("page_title", F.lit(f"(?i){PAPER}")) & ((F.col("course_title") == "") | F.rlike("course_title", course))


def source_map(chapters: DataFrame, pages: DataFrame, class_code: Column) -> DataFrame:
    """class_code, slug, source_url, source_label, source_type, chapter_url: chapters (slug, chapter_title,
    chapter_url) whose page (url, html) is there and leads to a paper; the others have no row."""
    own = chapters.join(pages.select(F.col("url").alias("chapter_url"), "html"), "chapter_url").withColumn("page_id", F.struct("slug", "chapter_url"))
    found = document_of(own.select("page_id", F.col("chapter_url").alias("url"), "html", "chapter_title"))
    return found.select(class_code.alias("class_code"), "page_id.slug", "source_url", "source_label", F.lit("remote_url").alias("source_type"), "page_id.chapter_url")
