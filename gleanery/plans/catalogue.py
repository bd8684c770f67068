"""Queries over the driver's tables and their SQL."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.functions import titles
from gleanery.functions.similarity import option_share, ratio, unescaped
from gleanery.operators import align, findings, options, schema_rules, scoring
from gleanery.operators import dashboard
from gleanery.operators.containment import containing
from gleanery.operators.blocks import blocks, element_blocks, picture_suffixes, sessions, signals
from gleanery.plans.audit import Audit, targets_of
from gleanery.plans.views import CHAPTERS_SQL, RECORDS_SQL, audit_tables, records, rendered, table, turns
from gleanery.sources import links as L
from gleanery.sources import markup as M
from gleanery.sources import pages as P
from gleanery.sources.reports import list_cell
from gleanery.sources.stored import broadcast_if_small, shared_folder, spread
from gleanery.streaming import rollups

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SPACES = r"[\t-\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def clean_sql(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{SPACES}+', ' ', 'g'))"


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL of the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# Sources


@query(f"""
SELECT page_id, i - 1 AS pos, ls[i] AS line FROM (
  SELECT page_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (
    SELECT page_id, list_filter(list_transform(string_split_regex(html, '<[^>]+>'), lambda x: {clean_sql('x')}), lambda x: x <> '') AS ls FROM pages))""")
def a_page_lines(spark, d):
    return P.page_lines(table(spark, d, "pages"))


_HREF = r"""(?i)(?:^|\s)href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
_ATTR = " || ".join(f"regexp_extract(attrs, '{_HREF}', {i})" for i in (1, 2, 3))
_TEXT = "regexp_replace(body, '<[^>]+>', ' ', 'g')"
for _name, _by in (("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
    _TEXT = f"replace({_TEXT}, '{_name}', '{_by}')"
ANCHORS_SQL = rf"""
raw AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\b([^>]*)>(.*?)</a>', 1)) AS attrs, unnest(regexp_extract_all(html, '(?is)<a\b([^>]*)>(.*?)</a>', 2)) AS body,
         unnest(range(len(regexp_extract_all(html, '(?is)<a\b([^>]*)>(.*?)</a>')))) AS pos FROM pages),
anchors AS (SELECT page_id, url, pos, {_ATTR} AS href, {clean_sql(_TEXT)} AS text FROM raw WHERE {_ATTR} <> '')"""


@query(f"""
WITH {ANCHORS_SQL},
firsts AS (SELECT page_id, href, min(pos) AS pos, arg_min(text, pos) AS title FROM anchors GROUP BY 1, 2)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS idx, href, title FROM firsts""")
def a_link_scan(spark, d):
    return L.links(table(spark, d, "pages"))


@query(rf"""
SELECT page_id, {clean_sql("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title,
       {clean_sql("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS heading,
       coalesce(nullif({clean_sql("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}, ''), nullif({clean_sql("regexp_extract(html, '<title>([^<]*)</title>', 1)")}, ''), regexp_extract(url, '([^/]+?)(\.[^./]*)?$', 1)) AS chosen FROM pages""")
def a_title_metadata(spark, d):
    title, heading = (T.collapsed(F.regexp_extract("html", f"<{t}>([^<]*)</{t}>", 1)) for t in ("title", "h1"))
    chosen = F.coalesce(F.nullif(heading, F.lit("")), F.nullif(title, F.lit("")), T.stem_of_path(F.col("url")))
    return table(spark, d, "pages").select("page_id", title.alias("title"), heading.alias("heading"), chosen.alias("chosen"))


@query("""
SELECT key, CASE WHEN c.c_custkey IS NULL THEN s.s_name ELSE c.c_name END AS name, CASE WHEN c.c_custkey IS NULL THEN 'supplier' ELSE 'customer' END AS origin
FROM (SELECT s_suppkey AS key FROM supplier UNION SELECT c_custkey FROM customer) k
LEFT JOIN supplier s ON s.s_suppkey = key LEFT JOIN customer c ON c.c_custkey = key""")
def a_source_map_lastwins(spark, d):
    older = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit("supplier").alias("origin"))
    newer = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.lit("customer").alias("origin"))
    return P.last_wins(older, newer, key=["key"])


@query(f"""
WITH {ANCHORS_SQL}
SELECT p.page_id, coalesce(arg_min(a.href, (NOT contains(lower(a.href), 'th'), a.pos)), '') AS picked FROM pages p LEFT JOIN anchors a USING (page_id) GROUP BY 1""")
def a_doc_pick(spark, d):
    pages = table(spark, d, "pages")
    best = L.anchors(pages, "page_id").groupBy("page_id").agg(F.min_by("href", F.struct(~F.contains(F.lower("href"), F.lit("th")), "pos")).alias("picked"))
    return pages.select("page_id").join(best, "page_id", "left").select("page_id", F.coalesce("picked", F.lit("")).alias("picked"))


@query("""
SELECT r_regionkey AS page_id, row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey) AS index, n_nationkey::VARCHAR AS id, n_name || ' & Life' AS title,
       'https://site.test/chapter/' || n_nationkey || '_' || n_name AS url, n_name AS slug FROM nation JOIN region ON n_regionkey = r_regionkey""")
def a_chapter_links(spark, d):
    """A region's page lists its nations as chapters, in the forms that such pages have."""
    name, key = F.col("n_name"), F.col("n_nationkey").cast("string")
    quote = F.when(F.col("n_nationkey") % 2 == 0, '"').otherwise("")
    head = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("<a class="), quote, F.lit("crs_chptr"), quote, F.lit(" title='x' href="), quote)).otherwise(F.concat(F.lit("<a data-n=1 href="), quote))
    tail = F.when(F.col("n_nationkey") % 3 == 0, quote).otherwise(F.concat(quote, F.lit(" class='big crs_chptr'")))
    link = F.concat(head, F.lit("/chapter/"), key, F.lit("_"), name, tail, F.lit("><h2 class=subcoursetitle><b>"), name, F.lit("</b> &amp; Life</h2></a><a href=/about>About</a>"))
    html = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", link.alias("a")))), lambda x: x["a"]), "").alias("html"))
    return L.chapter_links(html.select(F.col("n_regionkey").alias("page_id"), F.lit("https://site.test/courses/1").alias("url"), "html"))


def course_page(spark, d, first: str):
    """A region's page as a course: its nations as chapters or topics, each twice, with the course itself and
    what is no chapter; `first` is a link's text."""
    k, name = F.col("n_nationkey"), F.col("n_name")
    kind = F.when(k % 2 == 0, "chapter").otherwise("topic")
    title = F.when(k % 5 == 4, F.concat(name, F.lit(" Mindmaps"))).otherwise(F.concat(name, F.lit(" &amp; Diseases")))
    link = F.concat(F.lit('<li><a class="crs_chptr x" href="/'), kind, F.lit("/"), k.cast("string"), F.lit("_"), name, F.lit('"><div><h2 class="a subcoursetitle">'), title, F.lit(f"</h2></div>{first}</a>"))
    again = F.concat(F.lit('<li><a href="/chapter/9'), k.cast("string"), F.lit('_again" class=crs_chptr>'), name, F.lit(" and disease NEET Notes</a>"))
    own = F.concat(F.lit('<ul><li><a class="crs_chptr" href="/chapter/7000_own">Own course</a><li><a class=crs_chptr href=/other/1_x>Other</a>'), F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", link.alias("a"), again.alias("b")))), lambda x: F.array(x["a"], x["b"]))), ""), F.lit("</ul>"))
    pages = table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("page_id")).agg(own.alias("html"))
    return pages.select("page_id", F.lit("https://site.test/courses/b/c").alias("url"), "html", F.lit("7000").alias("course_id"), F.lit("Biology Class 11").alias("course_title"))


@query("""
SELECT n_regionkey AS page_id, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS index, CASE WHEN n_nationkey % 5 = 4 THEN '9' || n_nationkey ELSE n_nationkey::VARCHAR END AS id,
       CASE WHEN n_nationkey % 5 = 4 THEN n_name || ' and disease' ELSE n_name || ' & Diseases' END AS title,
       CASE WHEN n_nationkey % 5 = 4 THEN 'https://site.test/chapter/9' || n_nationkey || '_again' ELSE 'https://site.test/' || CASE n_nationkey % 2 WHEN 0 THEN 'chapter/' ELSE 'topic/' END || n_nationkey || '_' || n_name END AS url, 'B11' AS class_code FROM nation""")
def a_topic_links(spark, d):
    """Chapters and topics by topic key: a mind map is none, so the second link of its nation is the first chapter."""
    return L.topic_links(course_page(spark, d, "zz")).select("page_id", "index", "id", "title", "url", "class_code")


@query("""
WITH a AS (
  SELECT n_regionkey AS page_id, n_nationkey, 0 AS second, n_nationkey::VARCHAR AS id, CASE WHEN n_nationkey % 5 = 4 THEN n_name || ' Mindmaps' ELSE n_name || ' & Diseases' END AS title FROM nation WHERE n_nationkey % 2 = 0
  UNION ALL SELECT n_regionkey, n_nationkey, 1, '9' || n_nationkey, n_name || ' and disease NEET Notes' FROM nation
  UNION ALL SELECT r_regionkey, -1, 0, '7000', 'Own course' FROM region)
SELECT page_id, id AS chapter_id, title AS chapter_title, lower(replace(replace(replace(title, '&', 'and'), ' ', '-'), '_', '')) AS slug FROM a""")
def a_course_chapters(spark, d):
    """Chapters by the slug of their title, as a plain listing gives them."""
    return L.course_chapters(course_page(spark, d, "")).select("page_id", "chapter_id", "chapter_title", "slug")


@query("""
SELECT n_nationkey AS page_id, n_name || ' & Diseases' AS title, 'd' || n_nationkey AS document_id, 'NEET Previous Year Questions (2014-24): ' || n_name || ' and Disease' AS document_title, 'https://site.test/t/d' || n_nationkey || '/q' AS url
FROM nation WHERE n_nationkey % 4 <> 3 UNION ALL
SELECT n_nationkey, n_name || ' & Diseases', 'e' || n_nationkey, 'NEET Previous Year Questions: ' || n_name || ' & Diseases', 'https://site.test/t/e' || n_nationkey || '/' FROM nation WHERE n_nationkey % 2 = 0""")
def a_document_links(spark, d):
    """Papers on a nation's page that are about it: by nested titles without their spans, or by text; others are not."""
    k, name, paper = F.col("n_nationkey"), F.col("n_name"), "NEET Previous Year Questions"
    own = F.concat(F.lit("<a href=/t/d"), k.cast("string"), F.lit('/q><div class="subcoursetitle">• '), F.lit(f"{paper} (2014-24): "), F.when(k % 4 == 3, "Else").otherwise(name), F.lit(" and Disease<span> new</span></div>12 pages</a>"))
    second = F.when(k % 2 == 0, F.concat(F.lit("<a href='/t/e"), k.cast("string"), F.lit(f"/#x'><b>{paper}</b>: "), name, F.lit(" &amp; Diseases Doc | 3 Pages</a>"))).otherwise("")
    html = F.concat(own, own, second, F.lit(f"<a href=/t/f>CBSE Previous Year Questions {paper}</a><a href=/u/g>{paper}: "), name, F.lit(" and Diseases</a>"))
    pages = table(spark, d, "nation").select(k.alias("page_id"), F.lit("https://site.test/chapter/1").alias("url"), html.alias("html"), F.concat(name, F.lit(" & Diseases")).alias("title"))
    found = L.document_links(pages, pages.select("page_id", "title"))
    return found.select("page_id", "title", "document_id", "document_title", F.regexp_replace("url", "#.*$", "").alias("url"))


@query("""
SELECT n_nationkey AS page_id, CASE WHEN n_nationkey % 3 = 0 THEN 'https://site.test/t/own' WHEN n_nationkey % 3 = 1 THEN 'https://site.test/t/listed' ELSE 'https://site.test/t/first' END AS source_url
FROM nation WHERE n_nationkey % 5 <> 4""")
def a_document_of(spark, d):
    """Of the papers on a nation's page: an anchor whose title holds the nation's, one so listed, else the first."""
    k, paper = F.col("n_nationkey"), "NEET Previous Year Questions"
    listed = F.concat(F.lit(f'<script>{{"name":"{paper}: '), F.when(k % 3 == 1, F.col("n_name")).otherwise("Else"), F.lit('","url":"https://site.test/t/'), F.when(k % 3 == 1, "listed").otherwise("first"), F.lit('"}</script>'))
    anchor = F.concat(F.lit(f"<a rel=x href=/t/own><i>{paper}</i>: "), F.when(k % 3 == 0, F.lower("n_name")).otherwise("other"), F.lit("</a>"))
    html = F.when(k % 5 == 4, "<p>none</p>").otherwise(F.concat(listed, anchor))
    pages = table(spark, d, "nation").select(k.alias("page_id"), F.lit("https://site.test/chapter/1").alias("url"), html.alias("html"), F.col("n_name").alias("chapter_title"))
    return L.document_of(pages).select("page_id", "source_url")


@query(f"""WITH {RECORDS_SQL}
SELECT id, CASE WHEN len(kept) = 0 THEN '[]' ELSE '[''' || array_to_string(kept, ''', ''') || ''']' END AS cell
FROM (SELECT id, list_filter(options, lambda x: x <> '') AS kept FROM records)""")
def b_csv_list_cells(spark, d):
    return records(spark, d).select("id", list_cell(F.filter("options", lambda x: x != "")).alias("cell"))


# Filters and joins


@query("""
SELECT n_nationkey, n_name, r_name, upper(trim(r_name)) AS class_code FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE lower(r_name) IN ('asia', 'europe') ORDER BY 1""")
def c_class_filter(spark, d):
    asked = F.transform(F.split(F.lit(" Asia, ,EUROPE "), ","), lambda x: F.lower(F.trim(x)))
    r = table(spark, d, "region").where(F.array_contains(F.filter(asked, lambda x: x != ""), F.lower("r_name")))
    n = table(spark, d, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select("n_nationkey", "n_name", "r_name", F.upper(F.trim("r_name")).alias("class_code"))


@query("""
SELECT c_custkey, count(o_orderkey) AS orders, count(o_orderkey) > 0 AS covered, CASE WHEN count(o_orderkey) > 0 THEN '' ELSE 'missing_source' END AS coverage_reason
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""")
def c_coverage_split(spark, d):
    n = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    j = table(spark, d, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"), "left")
    orders = F.coalesce("orders", F.lit(0))
    return j.select("c_custkey", orders.alias("orders"), (orders > 0).alias("covered"), F.when(orders > 0, "").otherwise("missing_source").alias("coverage_reason"))


@query(r"""
SELECT p_partkey, regexp_matches(p_name, '(?i)(steel|brass|ring|bolt)') AS wanted, regexp_matches(p_type, '(?i)(small|promo)') AS excluded,
       regexp_matches(p_name, '(?i)(steel|brass|ring|bolt)') AND NOT regexp_matches(p_type, '(?i)(small|promo)') AS taken FROM part""")
def c_title_predicates(spark, d):
    a, b = F.rlike("p_name", F.lit("(?i)(steel|brass|ring|bolt)")), F.rlike("p_type", F.lit("(?i)(small|promo)"))
    return table(spark, d, "part").select("p_partkey", a.alias("wanted"), b.alias("excluded"), (a & ~b).alias("taken"))


@query(r"""
SELECT doc_id, regexp_matches(coalesce(text, '') || CASE lang WHEN 'de' THEN ' View  Answer' WHEN 'fr' THEN ' solution' ELSE '' END, '(?i)Type\s*Your\s*Answer|View\s*Answer|Solution:?') AS leaks,
       regexp_matches(coalesce(text, ''), '(?i)all rights reserved|copyright|license') AS notice FROM documents""")
def c_ui_leak(spark, d):
    t = F.coalesce("text", F.lit(""))
    shown = F.concat(t, F.when(F.col("lang") == "de", " View  Answer").when(F.col("lang") == "fr", " solution").otherwise(""))
    return table(spark, d, "documents").select("doc_id", F.rlike(shown, F.lit(T.UI_LEAK)).alias("leaks"), F.rlike(t, F.lit("(?i)all rights reserved|copyright|license")).alias("notice"))


_FOLD = "list_reduce(list_concat([[]::VARCHAR[]], list_transform(string_split(path, '/'), lambda x: [x])), lambda k, x: CASE x[1] WHEN '..' THEN CASE WHEN len(k) > 1 THEN k[:-2] ELSE k END WHEN '.' THEN k ELSE list_concat(k, x) END)"


@query(rf"""
WITH {ANCHORS_SQL}, refs AS (SELECT page_id, pos, url, CASE pos % 5 WHEN 0 THEN '' WHEN 1 THEN '../x/.' WHEN 2 THEN '../../../y/./z/..' WHEN 3 THEN '/u/v/../w/../..' ELSE './a/b/..' END || href AS href FROM anchors),
parts AS (SELECT *, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS host, regexp_replace(url, '[?#].*$', '') AS bare FROM refs),
paths AS (SELECT *, CASE WHEN starts_with(href, '/') THEN href ELSE regexp_replace(CASE WHEN bare = host THEN '/' ELSE bare[len(host) + 1:] END, '[^/]*$', '') || href END AS path FROM parts)
SELECT page_id, pos, host || array_to_string({_FOLD}, '/') || CASE WHEN regexp_matches(path, '(^|/)\.\.?$') THEN '/' ELSE '' END AS url FROM paths""")
def d_explode_links(spark, d):
    """The addresses that a page's links mean, with dot segments of all kinds ahead of them."""
    n = F.col("pos") % 5
    href = F.concat(F.when(n == 0, "").when(n == 1, "../x/.").when(n == 2, "../../../y/./z/..").when(n == 3, "/u/v/../w/../..").otherwise("./a/b/.."), "href")
    return L.anchors(table(spark, d, "pages"), "page_id", "url").select("page_id", "pos", L.absolute(href, F.col("url")).alias("url"))


@query("""
SELECT p_partkey, i - 1 AS pos, trim(parts[i]) AS piece FROM (
  SELECT p_partkey, parts, unnest(range(1, len(parts) + 1)) AS i FROM (
    SELECT p_partkey, list_filter(string_split(regexp_replace(p_name || ' Q1: ' || p_brand || ' q2 : ' || p_type, '(?i)(Q\\s*\\d+\\s*:)', '\x1f\\1', 'g'), '\x1f'), lambda x: trim(x) <> '') AS parts FROM part))""".replace("\\\\", "\\").replace("\x1f", "|#|"))
def d_tag_split_nodes(spark, d):
    text = F.concat("p_name", F.lit(" Q1: "), "p_brand", F.lit(" q2 : "), "p_type")
    parts = F.filter(F.split(text, r"(?i)(?=Q\s*\d+\s*:)", -1), lambda x: F.trim(x) != "")
    return table(spark, d, "part").select("p_partkey", F.posexplode(F.transform(parts, lambda x: F.trim(x))).alias("pos", "piece"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus = 'P')")
def e_anti_orphans(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("""
SELECT s_suppkey, s_name, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def e_left_hash(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", "s_name", "n_name", "r_name")


@query("""
SELECT o_orderkey, count(l_orderkey) AS failures, coalesce(string_agg(l_linenumber::VARCHAR || ':' || l_shipdate::DATE::VARCHAR, ',' ORDER BY l_linenumber, l_shipdate::DATE), '') AS listed
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate < o_orderdate GROUP BY 1""")
def e_collect_failures(spark, d):
    late = table(spark, d, "lineitem").join(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") < F.col("o_orderdate")))
    rows = late.groupBy("l_orderkey").agg(F.count("*").alias("failures"), F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_shipdate").cast("date").alias("s")))).alias("xs"))
    listed = F.array_join(F.transform("xs", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["s"].cast("string"))), ",")
    return table(spark, d, "orders").join(rows, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("failures", F.lit(0)).alias("failures"), F.coalesce(listed, F.lit("")).alias("listed"))


@query("""
SELECT l_partkey, l_suppkey, count(*) AS candidates, min(l_orderkey) AS first_order FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
GROUP BY 1, 2""")
def e_candidate_key(spark, d):
    j = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return j.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("candidates"), F.min("l_orderkey").alias("first_order"))


# Aggregates


@query(f"""WITH {RECORDS_SQL}
SELECT class, chapter, count(*) AS questions, count(*) FILTER (answer <> '') AS answers, sum(len(list_filter(options, lambda v: v <> '')))::BIGINT AS options,
       sum(images)::BIGINT AS images, sum(tables)::BIGINT AS tables, count(*) FILTER (explanation = '')::DOUBLE / count(*) AS empty_explanation_rate,
       sum(images)::DOUBLE / count(*) AS image_density, count(*) FILTER (len(list_distinct(options)) < 4)::DOUBLE / count(*) AS duplicate_option_rate,
       array_to_string(list_reverse_sort(list_distinct(list(year))), ',') AS years, min(year) || '-' || max(year) AS year_range
FROM records GROUP BY 1, 2""")
def f_chapter_totals(spark, d):
    n = F.count("*")
    return records(spark, d).groupBy("class", "chapter").agg(
        n.alias("questions"), F.count_if(F.col("answer") != "").alias("answers"), F.sum(F.size(F.filter("options", lambda v: v != ""))).alias("options"), F.sum("images").alias("images"), F.sum("tables").alias("tables"),
        (F.count_if(F.col("explanation") == "") / n).alias("empty_explanation_rate"), (F.sum("images") / n).alias("image_density"), (F.count_if(F.size(F.array_distinct("options")) < 4) / n).alias("duplicate_option_rate"),
        F.array_join(F.sort_array(F.collect_set("year"), False), ",").alias("years"), F.concat_ws("-", F.min("year"), F.max("year")).alias("year_range"),
    )


ANOMALY_SQL = """
t AS (SELECT *, len(list_filter(options, lambda v: v <> '')) AS n FROM records),
typed AS (SELECT *, n = 0 AS e, n > 0 AND n < 4 AS p, answer <> '' AND n < 4 AS a, images > 0 AND n < 4 AS i, warnings > 0 AS w FROM t)"""


@query(f"""WITH {RECORDS_SQL}, {ANOMALY_SQL}
SELECT chapter, id, n::INTEGER AS filled, array_to_string(list_filter([CASE WHEN e THEN 'all_options_empty' END, CASE WHEN p THEN 'partial_options' END, CASE WHEN a THEN 'answer_without_full_options' END,
  CASE WHEN i THEN 'image_backed_option_gap' END, CASE WHEN w THEN 'parser_warning' END], lambda x: x IS NOT NULL), ',') AS types FROM typed WHERE e OR p OR a OR i OR w""")
def p_option_anomalies(spark, d):
    r = records(spark, d).withColumn("types", findings.anomaly_types()).where(F.size("types") > 0)
    return r.select("chapter", "id", F.size(F.filter("options", lambda v: v != "")).alias("filled"), F.array_join("types", ",").alias("types"))


_ROLLUP = "count(*) AS question_count, count(*) FILTER (e OR p OR a OR i OR w) AS anomaly_count, count(*) FILTER (e) AS all_empty_option_count, count(*) FILTER (p) AS partial_option_count, count(*) FILTER (i) AS image_backed_gap_count FROM typed"


@query(f"WITH {RECORDS_SQL}, {ANOMALY_SQL} SELECT class, chapter, {_ROLLUP} GROUP BY 1, 2")
def f_anomaly_rollup(spark, d):
    return findings.anomaly_rollup(records(spark, d), ["class", "chapter"])


@query(f"WITH {RECORDS_SQL}, {ANOMALY_SQL} SELECT {_ROLLUP}")
def f_corpus_totals(spark, d):
    return findings.anomaly_rollup(records(spark, d), [])


@query(f"WITH {RECORDS_SQL}, {ANOMALY_SQL} SELECT class, chapter, (2 - (GROUPING(class) + GROUPING(chapter)))::INTEGER AS level, {_ROLLUP} GROUP BY GROUPING SETS ((class, chapter), (class), ())")
def f_anomaly_levels(spark, d):
    """Chapters, classes and the corpus at once."""
    return findings.anomaly_levels(records(spark, d), "class", "chapter")


@query("""
SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view, count(*) FILTER (event_type = 'purchase') AS purchase,
       count(*) FILTER (event_type = 'signup') AS signup, count(*) FILTER (event_type IN ('click', 'view', 'purchase', 'signup')) AS total FROM events GROUP BY 1""")
def f_category_pivot(spark, d):
    kinds = ["click", "view", "purchase", "signup"]
    p = table(spark, d, "events").groupBy("user_id").pivot("event_type", kinds).count().na.fill(0)
    return p.withColumn("total", sum((F.col(k) for k in kinds[1:]), F.col(kinds[0])))


@query("SELECT year(o_orderdate)::VARCHAR AS year, count(*) AS orders FROM orders GROUP BY 1")
def f_year_facet(spark, d):
    return table(spark, d, "orders").groupBy(F.year("o_orderdate").cast("string").alias("year")).agg(F.count("*").alias("orders"))


@query(f"""WITH {RECORDS_SQL}
SELECT count(DISTINCT chapter) AS chapters, count(*) AS questions, sum(images)::BIGINT AS images, sum(tables)::BIGINT AS tables, count(*) FILTER (explanation = '') AS unexplained,
       count(DISTINCT chapter) FILTER (images > 2) AS illustrated_chapters FROM records""")
def f_overview_kpis(spark, d):
    return records(spark, d).agg(F.count_distinct("chapter").alias("chapters"), F.count("*").alias("questions"), F.sum("images").alias("images"), F.sum("tables").alias("tables"), F.count_if(F.col("explanation") == "").alias("unexplained"), F.count_distinct(F.when(F.col("images") > 2, F.col("chapter"))).alias("illustrated_chapters"))


# Ordered operators


@query("""
WITH marked AS (
  SELECT *, last_value(CASE WHEN event_type = 'signup' THEN event_id::VARCHAR END IGNORE NULLS) OVER w AS v,
         sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER w - 1 AS block FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT user_id, block::INTEGER AS source_index, coalesce(max(v) FILTER (event_type = 'click'), '') AS carried, count(*) AS lines, min(event_id) AS first_event
FROM marked WHERE block >= 0 AND event_type <> 'signup' GROUP BY 1, 2""")
def g_blocks(spark, d):
    e = table(spark, d, "events")
    s = sessions(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", F.col("event_id").cast("string"), F.col("event_type") == "click")
    return s.groupBy("user_id", F.col("block").alias("source_index")).agg(F.max("carried").alias("carried"), F.count("*").alias("lines"), F.min("event_id").alias("first_event"))


@query("""
WITH marked AS (SELECT conv_id, turn, role, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS block,
  first_value(CASE WHEN role = 'system' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS sys, coalesce(text, '') AS text FROM conversations)
SELECT conv_id, block::INTEGER AS source_index, count(*) AS lines, sum(length(text))::BIGINT AS chars FROM marked WHERE block >= 0 AND role <> 'system' GROUP BY 1, 2""")
def g_turn_blocks(spark, d):
    s = sessions(turns(spark, d), ["conv_id"], ["turn"], F.col("role") == "system", F.col("text"), F.col("role") == "user")
    return s.groupBy("conv_id", F.col("block").alias("source_index")).agg(F.count("*").alias("lines"), F.sum(F.length("text")).alias("chars"))


@query("""
SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS carried FROM events""")
def g_forward_fill(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table(spark, d, "events").select("event_id", F.coalesce(F.last(F.when(F.col("event_type") == "signup", F.col("event_id")), ignorenulls=True).over(w), F.lit(-1)).alias("carried"))


@query("""
SELECT event_id, CASE WHEN max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER w = 1 THEN 'explanation' ELSE 'question' END AS phase,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ordinal FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def g_latch(spark, d):
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    seen = F.max((F.col("event_type") == "purchase").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return table(spark, d, "events").select("event_id", F.when(seen == 1, "explanation").otherwise("question").alias("phase"), F.row_number().over(by).alias("ordinal"))


@query("SELECT user_id, event_id, value, place FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS place FROM events) WHERE place <= 8")
def g_top8(spark, d):
    return findings.top_per(table(spark, d, "events"), "user_id", [F.col("value").desc(), F.col("event_id")]).select("user_id", "event_id", "value", "place")


@query("SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE before IS DISTINCT FROM event_type")
def g_adjacent_duplicates(spark, d):
    before = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, d, "events").withColumn("b", before).where(~F.col("b").eqNullSafe(F.col("event_type"))).select("event_id", "user_id", "event_type")


@query("SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1 ORDER BY customers DESC, c_nationkey LIMIT 6")
def h_topk_chapters(spark, d):
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers")).orderBy(F.desc("customers"), "c_nationkey").limit(6)


@query("SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS best, max(o_totalprice) AS price FROM (SELECT o_custkey, o_orderkey, o_totalprice FROM orders) GROUP BY 1")
def h_argmax_tie(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("best"), F.max("o_totalprice").alias("price"))


@query("SELECT n_name, row_number() OVER (ORDER BY lower(n_name), n_name) AS place FROM nation")
def h_collated_sort(spark, d):
    return table(spark, d, "nation").select("n_name", F.row_number().over(Window.orderBy(F.collate("n_name", "UNICODE"))).alias("place"))


@query("SELECT DISTINCT name FROM (SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT c_mktsegment FROM customer)")
def i_union_distinct(spark, d):
    one = lambda t, c: table(spark, d, t).select(F.col(c).alias("name"))
    return one("nation", "n_name").unionByName(one("region", "r_name")).unionByName(one("customer", "c_mktsegment")).distinct()


# Scalar functions


@query(f"""
SELECT doc_id, md5({clean_sql('text')}) AS cleaned, md5(lower({clean_sql("replace(coalesce(text, ''), '&', ' and ')")})) AS normal, length({clean_sql('text')}) AS n FROM documents""")
def j_clean(spark, d):
    c = T.collapsed(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.md5(c).alias("cleaned"), F.md5(T.normal(F.col("text"))).alias("normal"), F.length(c).cast("long").alias("n"))


def _slug_sql(x: str) -> str:
    hyphened = f"regexp_replace(regexp_replace(regexp_replace(lower({clean_sql(f'''replace(coalesce({x}, ''), '&', ' and ')''')}), ' +', '-', 'g'), '[^a-z0-9-]', '', 'g'), '-+', '-', 'g')"
    return f"regexp_replace({hyphened}, '^-+|-+$', '', 'g')"


@query(f"""
SELECT p_partkey, {_slug_sql("p_name || ' & ' || p_type")} AS slug, lower(replace(replace({clean_sql("p_name")}, '&', ' and '), '-', ' ')) AS title_key,
       CASE WHEN length(p_type) > 12 THEN left(p_type, 12) || '…' ELSE p_type END AS short FROM part""")
def j_slugify(spark, d):
    return table(spark, d, "part").select("p_partkey", T.slug(F.concat("p_name", F.lit(" & "), "p_type")).alias("slug"), T.title_key(F.col("p_name")).alias("title_key"), T.truncated(F.col("p_type"), 12).alias("short"))


@query(r"""
SELECT page_id, regexp_extract(url, '([^/]+?)(\.[^./]*)?$', 1) AS stem, regexp_extract(url, '^https?://([^/]+)', 1) AS host, coalesce(try_cast(regexp_extract(url, '/(\d+)', 1) AS INTEGER), -1) AS number FROM pages""")
def j_url_parts(spark, d):
    return table(spark, d, "pages").select("page_id", T.stem_of_path(F.col("url")).alias("stem"), F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.coalesce(F.regexp_extract("url", r"/(\d+)", 1).try_cast("int"), F.lit(-1)).alias("number"))


@query()
def j_unescape(spark, d):
    """All references of the whole page; no SQL knows them, tests hold it against the standard library."""
    return table(spark, d, "pages").select("page_id", F.md5(unescaped(F.col("html"))).alias("plain"))


@query(r"""
SELECT p_partkey, p_partkey::INTEGER AS number, substr('abcd', 1 + p_size // 13, 1) AS letter, 'because of ' || p_brand AS explanation FROM part""")
def j_answer_parts(spark, d):
    letter = F.substring(F.lit("abcd"), 1 + F.floor(F.col("p_size") / 13).cast("int"), F.lit(1))
    lines = F.array(F.concat(F.lit("Q"), F.col("p_partkey").cast("string"), F.lit(": what is it?")), F.concat(F.lit("Ans: ("), letter, F.lit(") because of "), F.col("p_brand")))
    return table(spark, d, "part").withColumn("lines", lines).select("p_partkey", T.first_number(F.col("lines")).alias("number"), T.answer_letter(F.array_join("lines", " ")).alias("letter"), T.stated_explanation(F.col("lines")).alias("explanation"))


@query("""
SELECT p_partkey, CASE WHEN p_size <= 25 THEN p_brand WHEN p_size <= 30 THEN p_name WHEN p_size <= 35 THEN '{''correct'': ''it''s ' || p_name || '''}' ELSE p_type END AS told FROM part""")
def j_explanation_union(spark, d):
    """Objects in JSON, objects in single quotes, what such quotes break, and text."""
    s, name = F.col("p_size"), F.col("p_name")
    of_json = F.when(s <= 25, F.to_json(F.struct(F.col("p_brand").alias("correct"), F.lit("x").alias("others"))))
    quoted = F.when((s > 25) & (s <= 30), F.concat(F.lit("{'correct': '', 'others': ' "), name, F.lit("'}"))).when((s > 30) & (s <= 35), F.concat(F.lit("{'correct': 'it's "), name, F.lit("'}")))
    return table(spark, d, "part").select("p_partkey", T.told_explanation(F.coalesce(of_json, quoted, "p_type")).alias("told"))


@query("""
SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'a' WHEN p_size <= 20 THEN 'b' WHEN p_size <= 30 THEN 'c' WHEN p_size <= 40 THEN 'd' ELSE '' END AS answer FROM part""")
def j_infer_answer(spark, d):
    s = F.col("p_size")
    says = (
        F.when(s <= 5, "Both A and R are  true and R explains A.").when(s <= 10, "Here both Statement I and Statement II are true.").when(s <= 20, "Both statement I and statement II are false")
        .when(s <= 25, "Assertion is true but Reason is false").when(s <= 30, "Statement I is correct but Statement II is incorrect").when(s <= 35, "A is false but R is true")
        .when(s <= 40, "Statement I is incorrect but Statement II is correct").otherwise("Nothing follows")
    )
    return table(spark, d, "part").select("p_partkey", options.inferred_answer(says).alias("answer"))


@query()
def j_ratio(spark, d):
    """No SQL has this similarity; tests hold it against the standard library."""
    p = table(spark, d, "part")
    return p.select("p_partkey", F.round(ratio(T.normal(F.col("p_name")), T.normal(F.col("p_type"))), 4).alias("ratio"))


@query("""
SELECT p_partkey, (CASE WHEN contains(lower(p_name), lower(p_brand)) THEN 1 ELSE 0 END + CASE WHEN contains(lower(p_name), lower(split_part(p_name, ' ', 1))) THEN 1 ELSE 0 END) / 2.0::DOUBLE AS share FROM part""")
def j_option_containment(spark, d):
    return table(spark, d, "part").select("p_partkey", option_share(F.col("p_name"), F.array("p_brand", F.split_part("p_name", F.lit(" "), F.lit(1)))).alias("share"))


@query("""
SELECT p_partkey, lower(p_name) || ' and process' AS topic, lower(p_name) || ' and process' AS chapter, p_size > 10 AS chapter_like,
       CASE WHEN p_size <= 25 THEN 'P11' ELSE 'C12' END AS code, CASE WHEN p_size <= 25 THEN 'physics' ELSE 'chemistry' END AS subject FROM part""")
def j_topic_key(spark, d):
    s = F.col("p_size")
    topic = F.concat(F.lit("• "), "p_name", F.lit(" & Processes  NEET 2020 | 12 pages"))
    title = F.concat("p_name", F.lit(" and  Processes "))
    kind = F.when(s <= 10, F.concat("p_name", F.lit(" Flashcards"))).otherwise(F.col("p_name"))
    code = titles.class_code(F.when(s <= 25, "Physics Class 11").otherwise("Chemistry Class XII"))
    return table(spark, d, "part").select("p_partkey", titles.topic_key(topic).alias("topic"), titles.chapter_key(title).alias("chapter"), titles.is_chapter(kind).alias("chapter_like"), code.alias("code"), titles.subject(code).alias("subject"))


@query("""
SELECT p_partkey, p_name || ' is what' AS question, p_brand AS option_, 'because' AS before, '(b) ' || p_brand AS after FROM part""")
def j_question_clean(spark, d):
    question = F.concat(F.lit("Q12: "), "p_name", F.lit(" [IMG:x.png] is View Answer what (NEET 2019) Choose the correct answer from the options given below :"))
    option = F.concat(F.lit(": "), "p_brand", F.lit(" Hide Explanation Report it and more"))
    parts = T.answer_parts(F.concat(F.lit("because Ans: (b) "), "p_brand"))
    return table(spark, d, "part").select("p_partkey", T.question_text(question).alias("question"), T.option_value(option).alias("option_"), parts["before"].alias("before"), parts["after"].alias("after"))


# Parsing


@query("""
SELECT p_partkey, 'Which holds for part ' || p_partkey || '?' AS stem,
       CASE WHEN p_size > 40 THEN '|||' ELSE p_brand || '|' || p_type || '|size ' || p_size || '|no such part' END AS options,
       CASE WHEN p_size <= 10 THEN 'lower_markers' WHEN p_size <= 20 THEN 'numbered_paren_options' WHEN p_size <= 30 THEN 'mixed_option_markers' WHEN p_size <= 40 THEN 'inline_lower_option_lines' ELSE 'fallback' END AS source,
       CASE WHEN p_size > 40 THEN 'missing' ELSE 'parsed' END AS status FROM part""")
def k_cascade(spark, d):
    r = spread(rendered(spark, d)).withColumn("r", options.parse_options(F.col("text")))
    return r.select("p_partkey", F.col("r.stem").alias("stem"), F.array_join("r.options", "|").alias("options"), F.col("r.source").alias("source"), options.status(F.col("r.options"), F.col("text")).alias("status"))


# By the remainder of a part's key: stem, the four values, the stage, and the text, of "name" and "size" in SQL and columns.
_FORMS = (
    ("Sort", "{n}|cc|dd|ee. (5) ff", "numbered_paren_options", "Sort (1) {n} (2) cc (3) dd (4) ee. (5) ff"),
    ("Match (1) pp (2) qq (3) rr (4) ss Choose", "{n}|qr|rs|sp", "numbered_paren_options", "Match (1) pp (2) qq (3) rr (4) ss (NEET 2019 and before) Choose (1) {n} (2) qr (3) rs (4) sp"),
    ("Which", "{n}|two|three|four", "compact_lower_markers", "Which a) {n} b) two c) three D) four"),
    ("Which", "{n}|two|three|four", "sequential_lower_markers", "Which (a {n} (b two (c three (d four"),
    ("Which", "{n}|two|three|four", "loose_lower_sequence", "Which (a) {n} (a) two (b) three (c) four (b) five"),
    ("Which", "{n}|two|three|four {s}", "three_lower_plus_terminal_upper", "Which (a) {n} (b) two (c) three D. four {s}"),
    ("Which is it", "{n}|two|three|four", "implicit_a_lower_bcd", "Which is it: {n} (b) two (c) three (d) four"),
    ("Is it ?", "DNA]|RNA]|ATP]|ADP {n}", "packed_upper_labels", "Is it ?ADNA]BRNA]CATP]DADP {n}"),
    ("Which value?", "1{s}|34|56|78", "ordered_upper_labels", "Which value? A1{s} B34 C56 D78"),
    ("Which value", "1{s}|34|56|78", "compact_upper_numeric_labels", "Which value A1{s} B34 C56 D78"),
    ("Ratio {s}", "/{n}|/y|/z|/w", "compact_upper_tight_labels", "Ratio {s} A/{n} B/y C/z D/w"),
    ("Pick", "{n}|two|three|", "upper_markers", "Pick A.{n} B.two C.three E.five"),
    ("Say", "Cell {s}|Wall|Core|Skin", "compact_upper_markers", "Say A Cell {s} B Wall C Core D Skin"),
)
_FORM = "p_partkey % " + str(len(_FORMS))


def _forms_sql(i: int) -> str:
    return "CASE " + _FORM + " " + " ".join(f"WHEN {k} THEN replace(replace('{f[i]}', '{{n}}', p_name), '{{s}}', p_size::VARCHAR)" for k, f in enumerate(_FORMS)) + " END"


@query(f"SELECT p_partkey, {_forms_sql(0)} AS stem, {_forms_sql(1)} AS options, {_forms_sql(2)} AS source FROM part")
def k_option_forms(spark, d):
    """A form for each of the cascade's rarer stages, and texts in which several runs of markers compete."""
    shown = F.lit(None)
    for k, f in enumerate(_FORMS):
        shown = F.when(F.expr(_FORM) == k, F.replace(F.replace(F.lit(f[3]), F.lit("{n}"), F.col("p_name")), F.lit("{s}"), F.col("p_size").cast("string"))).otherwise(shown)
    r = spread(table(spark, d, "part")).withColumn("r", options.parse_options(shown))
    return r.select("p_partkey", F.col("r.stem").alias("stem"), F.array_join("r.options", "|").alias("options"), F.col("r.source").alias("source"))


@query("""
SELECT p_partkey, 'Which one is ' || p_name AS stem, p_brand || '|' || p_type || '|size ' || p_size || '|none' AS options,
       CASE WHEN p_size <= 10 THEN 'table' WHEN p_size <= 20 THEN 'lower_option_lines' WHEN p_size <= 30 THEN 'chooser_lower_markers' ELSE 'implicit_a_lower_bcd' END AS source FROM part""")
def k_tables_and_choosers(spark, d):
    s, stem = F.col("p_size"), F.concat(F.lit("Which one is "), "p_name")
    values = [F.col("p_brand"), F.col("p_type"), F.concat(F.lit("size "), s.cast("string")), F.lit("none")]
    shown = lambda before, gap: F.concat(*(x for k, v in zip("abcd", values) for x in (F.lit(f"{gap}({k}) "), v)))
    ask = F.lit("\nChoose the correct answer from the options given below:")
    text = F.when(s <= 10, stem).when(s <= 20, F.concat(stem, ask, shown("", "\n"))).when(s <= 30, F.concat(stem, ask, shown("", " "))).otherwise(F.concat(stem, F.lit(": "), values[0], *(x for k, v in zip("bcd", values[1:]) for x in (F.lit(f" ({k}) "), v))))
    html = F.concat(F.lit("<table>"), *(x for k, v in zip("abcd", values) for x in (F.lit(f"<tr><td>({k})</td><td><b>"), v, F.lit("</b></td></tr>"))), F.lit("</table>"))
    found = spread(table(spark, d, "part")).select("p_partkey", options.parse_options(text, P.tables(F.when(s <= 10, html).otherwise(""))).alias("r"))
    return found.select("p_partkey", F.col("r.stem").alias("stem"), F.array_join("r.options", "|").alias("options"), F.col("r.source").alias("source"))


# Markup as node tables


def decoded_sql(x: str) -> str:
    """The character references that the given pages have."""
    return f"regexp_replace(replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;?', '&', 'g')"


def lines_sql(rows: str) -> str:
    """page_id, pos, line of `rows` (page_id, html without scripts, styles and comments)."""
    text = decoded_sql("regexp_replace(regexp_replace(html, '<br ?/?>', chr(10), 'g'), '<[^>]+>', '', 'g')")
    return f"""
SELECT page_id, i - 1 AS pos, ls[i] AS line FROM (
  SELECT page_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (
    SELECT page_id, list_filter(list_transform(string_split({text}, chr(10)), lambda x: {clean_sql('x')}), lambda x: x <> '') AS ls FROM ({rows})))"""


_PLAIN = "regexp_replace(html, '(?s)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'g')"


@query(lines_sql(f"SELECT page_id, {_PLAIN} AS html FROM pages"))
def d_element_lines(spark, d):
    """Lines of whole pages, from the top element of each."""
    tags, tree = M.parsed(table(spark, d, "pages"))
    return M.element_lines(tags, tree, tree.where("name = 'html' AND depth = 1")).select("page_id", F.posexplode("lines").alias("pos", "line"))


@query(lines_sql(f"SELECT page_id, regexp_extract({_PLAIN}, '(?s)<article>(.*)</article>', 1) AS html FROM pages"))
def d_nested_lines(spark, d):
    """Lines of articles whose paragraphs are followed by nested tables and rows of widgets, which are not theirs."""
    more = '</p><table><tr><td>t<table><tr><td>u</table>v</table><div class="x nq2_report_row"><p>w<br>w</div><script>if (a<b) "<p>"</script>'
    tags, tree = M.parsed(table(spark, d, "pages").select("page_id", F.replace("html", F.lit("</p>"), F.lit(more)).alias("html")))
    return M.element_lines(tags, tree, tree.where("name = 'article'")).select("page_id", F.posexplode("lines").alias("pos", "line"))


def supplier_pages(spark, d):
    """A page per region: a div per nation, its suppliers in a table inside a cell of the nation's, end
    tags left out where they may be."""
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("s"))
    n = table(spark, d, "nation").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left").withColumn("s", F.coalesce("s", F.array().cast("array<struct<s_suppkey:bigint,s_name:string>>")))
    inner = F.array_join(F.transform("s", lambda x: F.concat(F.lit("<tr><td><b>"), x["s_name"], F.lit("</b>"))), "")
    items = F.array_join(F.transform("s", lambda x: F.concat(F.lit("<p>see <i>"), x["s_name"], F.lit("</i>"))), "")
    div = F.concat(F.lit('<div title="a > b" class="wide contenttextdiv">'), items, F.lit("<table><tbody><tr><th>"), F.col("n_name"), F.lit("<td> has <table>"), inner, F.lit("</table> all</td></table></div>"))
    return n.groupBy(F.col("n_regionkey").alias("page_id")).agg(F.concat(F.lit("<html><body>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", div.alias("h")))), lambda x: x["h"]), "\n"), F.lit("</body></html>")).alias("html"))


_SUPPLIERS_SQL = "s AS (SELECT n_regionkey AS page_id, n_nationkey, n_name, coalesce(list(s_name ORDER BY s_suppkey) FILTER (s_suppkey IS NOT NULL), []) AS names FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL)"


@query(f"""
WITH {_SUPPLIERS_SQL},
t AS (
  SELECT page_id, n_nationkey, 0 AS inner_, list_concat([list_concat([n_name, CASE WHEN len(names) = 0 THEN 'has all' ELSE 'has ' || array_to_string(names, '') || ' all' END], names)], list_transform(names, lambda x: [x])) AS rows FROM s
  UNION ALL SELECT page_id, n_nationkey, 1, list_transform(names, lambda x: [x]) FROM s WHERE len(names) > 0)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY n_nationkey, inner_) AS n, list_transform(rows, lambda r: array_to_string(r, '|')) AS rows FROM t""")
def d_node_tables(spark, d):
    """Tables in tables: all rows and cells inside a table are its own, an inner table's also that one's."""
    found = M.node_tables(*M.parsed(supplier_pages(spark, d)))
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("open"))
    return found.select("page_id", nth.alias("n"), F.transform("rows", lambda r: F.array_join(r, "|")).alias("rows"))


@query(f"""
WITH {_SUPPLIERS_SQL}
SELECT page_id, arg_max(n_name, (len(names), -n_nationkey)) AS nation, max(len(names)) + 1 AS children FROM s GROUP BY 1""")
def h_widest_container(spark, d):
    """The nation whose container has the most children, its paragraphs and the table; what is deeper does not count."""
    tags, tree = M.parsed(supplier_pages(spark, d))
    best = M.widest(tree, "contenttextdiv")
    head = M.text_of(M.texts(tags), tree.where("name = 'th'"))
    first = M.held(head.withColumnRenamed("open", "pos"), best.select("page_id", "open", "close", "children"))
    return first.select("page_id", F.trim("text").alias("nation"), F.col("node.children").alias("children"))


@query("""
SELECT p_partkey, list_concat(CASE WHEN p_size % 5 = 0 THEN [] ELSE ['Which is ' || p_name || '?'] END, ['(a) ' || p_brand, '(b) ' || p_type], CASE WHEN p_size % 3 = 0 THEN [] ELSE ['(c) size ' || p_size] END,
       CASE WHEN p_size % 4 = 0 THEN [] ELSE ['Ans: (b)'] END, CASE WHEN p_size % 2 = 0 THEN ['It is ' || p_brand || ' by ' || p_type, 'so'] ELSE [] END) AS lines FROM part""")
def d_widget_lines(spark, d):
    """A question widget per part: its stem, options, answer and points, with what is none of these around them."""
    s, text = F.col("p_size"), lambda *x: F.concat(*(F.lit(y) if isinstance(y, str) else y for y in x))
    option = lambda letter, value: text('<div class="nq2_option"><span class="nq2_opt_letter"> ', letter, ' </span><span class="nq2_opt_text"><b>', value, "</b></span></div>")
    stem = F.when(s % 5 == 0, "").otherwise(text("<p>Try yourself: Which is <i>", F.col("p_name"), "</i>?"))
    body = F.when(s % 2 == 0, text('<div class="nq2_sol_body">Why<ul><li>It is ', F.col("p_brand"), " by <b>", F.col("p_type"), "</b><li>so</ul></div>")).otherwise("")
    label = F.when(s % 4 == 0, '<p class="nq2_sol_label">Solution</p>').otherwise('<p class="nq2_sol_label">Correct  answer : <b>B</b></p>')
    html = text(
        '<div class="nq2_question_block q"><div class="nq2_type_label_wrap">MCQ</div>', stem, '<div class="nq2_options_grid">', option("A", F.col("p_brand")), option("B", F.col("p_type")),
        option("C", F.when(s % 3 == 0, "").otherwise(text("size ", s.cast("string")))), '</div><div class="nq2_report_row"><a href=#>Report</a></div><div class="nq2_sol_panel">', label, body, "</div></div>",
    )
    tags, tree = M.parsed(table(spark, d, "part").select(F.col("p_partkey").alias("page_id"), html.alias("html")))
    return M.element_lines(tags, tree, tree.where("depth = 1")).select(F.col("page_id").alias("p_partkey"), "lines")


@query("""
SELECT p_partkey, CASE WHEN p_size <= 30 THEN '4' WHEN p_size <= 40 THEN '0' ELSE '3' END::INTEGER AS filled, CASE WHEN p_size <= 30 THEN 'parsed' WHEN p_size <= 35 THEN 'image_backed_unresolved' WHEN p_size <= 40 THEN 'missing' ELSE 'partial' END AS status,
       CASE WHEN p_size <= 30 THEN 'Both Statement I and Statement II are true.' WHEN p_size <= 40 THEN '' ELSE 'x' END AS first FROM part""")
def k_assertion_defaults(spark, d):
    """Questions of two statements get the usual options; others that print none stay without."""
    s = F.col("p_size")
    text = F.when(s <= 15, "Assertion (A): it floats. Reason (R): it is light").when(s <= 30, "Statement I: it floats. Statement II: it is light").when(s <= 35, "Which shows it? [IMG:a.png]").when(s <= 40, "Nothing is said").otherwise("Which? (a) x (b) y (c) z (d)")
    found = spread(table(spark, d, "part")).select("p_partkey", "p_size", text.alias("t"), options.parse_options(text).alias("r"))
    some = F.when(s <= 40, F.col("r.options")).otherwise(F.array(*map(F.lit, ("x", "y", "z", ""))))
    di = options.diagnostics(some, F.col("t"), F.col("r.source"))
    return found.select("p_partkey", di["nonEmptyOptionCount"].alias("filled"), di["status"].alias("status"), some[0].alias("first"))


@query("""
SELECT p_size AS slug, CASE WHEN p_size % 3 = 0 THEN NULL ELSE 1 END::INTEGER AS index, CASE WHEN p_size % 3 = 0 THEN 'root_not_list' ELSE 'question_not_object' END AS type FROM (SELECT DISTINCT p_size FROM part) WHERE p_size % 3 < 2""")
def l_chapter_errors(spark, d):
    k = F.col("p_size")
    good = json.dumps({"id": "Q1", "text": "t", "options": dict.fromkeys("ABCD", "x"), "answer": "a", "explanation": "e", "year": "2020", "chapter": "c", "class": "B11", "images": [], "tables": []})
    files = F.when(k % 3 == 0, '{"a": 1}').when(k % 3 == 1, f"[{good}, 5]").otherwise(f"[{good}]")
    rows = table(spark, d, "part").select(k.alias("slug")).distinct().withColumn("p_size", F.col("slug")).select("slug", F.parse_json(files).alias("root"))
    return schema_rules.chapter_errors(rows).select("slug", "index", "type")


@query("""
SELECT p_partkey, n AS n_error, field, type FROM (
  SELECT p_partkey, 0 AS n, 'year' AS field, 'missing_key' AS type FROM part WHERE p_size <= 10
  UNION ALL SELECT p_partkey, 0, 'options.D', 'missing_option' FROM part WHERE p_size > 10 AND p_size <= 20
  UNION ALL SELECT p_partkey, 0, 'images', 'wrong_type' FROM part WHERE p_size > 20 AND p_size <= 30
  UNION ALL SELECT p_partkey, 0, 'parserWarnings', 'wrong_warning_type' FROM part WHERE p_size > 30 AND p_size <= 40)""")
def l_schema_errors(spark, d):
    s = F.col("p_size")
    parts = F.concat(
        F.lit('{"id":"Q1","text":"t","answer":"a","explanation":"e","chapter":"c","class":"B11","tables":[]'),
        F.when(s <= 10, "").otherwise(',"year":"2020"'),
        F.when((s > 10) & (s <= 20), ',"options":{"A":"1","B":"2","C":"3"}').otherwise(',"options":{"A":"1","B":"2","C":"3","D":"4"}'),
        F.when((s > 20) & (s <= 30), ',"images":{}').otherwise(',"images":["x"]'),
        F.when((s > 30) & (s <= 40), ',"parserWarnings":["w",1]').otherwise(""),
        F.lit("}"),
    )
    rows = table(spark, d, "part").select("p_partkey", parts.alias("json"))
    return schema_rules.record_errors(rows).select("p_partkey", F.col("n_error").cast("int").alias("n_error"), "field", "type")


# Scores and reports


def audited(spark: SparkSession, d: str) -> DataFrame:
    """Chapters (nations) with their scores: all orders are what the source leads to expect,
    those that are settled are what was extracted."""
    r = records(spark, d)
    filled = F.size(F.filter("options", lambda v: v != ""))
    # Regions differ in how much was extracted, so that all risks occur.
    got = F.when(F.col("class") == 0, F.col("answer") == "").when(F.col("class") == 1, F.lit(True)).otherwise(F.col("answer") != "")
    number = lambda c: F.sum(F.when(got, c).otherwise(0))
    chapters = r.groupBy("class", "chapter").agg(
        F.count("*").alias("expected_question_count"), F.count("*").alias("expected_answer_markers"), (F.count("*") * 4).alias("expected_option_markers"), F.sum("images").alias("expected_images"), F.sum("tables").alias("expected_tables"),
        F.count_if(filled < 2).alias("residual_blocks"), F.count_if(got).alias("questions"), F.count_if(got).alias("answers"), number(filled).alias("options"), number(F.col("images")).alias("images"), number(F.col("tables")).alias("tables"),
        F.count_if(got & (filled == 0)).alias("schema_errors"), F.count_if(got & (F.col("explanation") == "")).alias("empty_explanations"), F.count_if(got & (F.size(F.array_distinct("options")) < 4)).alias("duplicate_options"),
        F.avg(F.when(got & (filled >= 3), filled / 4).otherwise(0.0)).alias("mean_alignment"),
    )
    return scoring.scored(chapters)


AUDITED_SQL = f"""{RECORDS_SQL},
r AS (SELECT *, len(list_filter(options, lambda v: v <> '')) AS filled, CASE class WHEN 0 THEN answer = '' WHEN 1 THEN true ELSE answer <> '' END AS got FROM records),
chapters AS (
  SELECT class, chapter, count(*) AS eq, 4 * count(*) AS eo, sum(images)::BIGINT AS ei, sum(tables)::BIGINT AS et, count(*) FILTER (filled < 2) AS residual, count(*) FILTER (got) AS q,
         coalesce(sum(filled) FILTER (got), 0)::BIGINT AS o, coalesce(sum(images) FILTER (got), 0)::BIGINT AS i, coalesce(sum(tables) FILTER (got), 0)::BIGINT AS t,
         count(*) FILTER (got AND filled = 0) AS errors, count(*) FILTER (got AND explanation = '') AS empty_, count(*) FILTER (got AND len(list_distinct(options)) < 4) AS dup,
         avg(CASE WHEN got AND filled >= 3 THEN filled / 4.0::DOUBLE ELSE 0.0::DOUBLE END) AS al
  FROM r GROUP BY 1, 2),
s1 AS (
  SELECT *, CASE WHEN q = 0 THEN 0.0 ELSE round(greatest(0.0::DOUBLE, 1.0::DOUBLE - least(1.0::DOUBLE, errors::DOUBLE / q)), 4) END AS structural,
         round(0.35::DOUBLE * least(q::DOUBLE / greatest(eq, 1), 1) + 0.2::DOUBLE * least(q::DOUBLE / greatest(eq, 1), 1) + 0.2::DOUBLE * least(o::DOUBLE / greatest(eo, 1), 1) + 0.15::DOUBLE * least(i::DOUBLE / greatest(ei, 1), 1) + 0.1::DOUBLE * least(t::DOUBLE / greatest(et, 1), 1), 4) AS complete,
         round(al, 4) AS semantic, round(greatest(eq - q, 0)::DOUBLE / greatest(eq, 1), 4) AS missing, round(residual::DOUBLE / greatest(eq, 1), 4) AS resid,
         round(least(1.0::DOUBLE, 0.7::DOUBLE * (greatest(eq - q, 0)::DOUBLE / greatest(eq, 1)) + 0.3::DOUBLE * (residual::DOUBLE / greatest(eq, 1))), 4) AS gap
  FROM chapters),
s2 AS (
  SELECT *, CASE WHEN q = 0 THEN 1.0 ELSE round(least(1.0::DOUBLE, 0.4::DOUBLE * gap + 0.25::DOUBLE * (empty_::DOUBLE / q) + 0.2::DOUBLE * (dup::DOUBLE / q) + 0.15::DOUBLE * CASE WHEN i::DOUBLE / q > 2.5 THEN 1.0 ELSE 0.0 END), 4) END AS anomaly,
         round(0.25::DOUBLE * structural + 0.35::DOUBLE * complete + 0.4::DOUBLE * semantic, 4) AS final FROM s1),
audited AS (SELECT *, CASE WHEN anomaly >= 0.6 OR gap >= 0.5 THEN 'high' WHEN anomaly >= 0.3 OR final < 0.75 THEN 'medium' ELSE 'low' END AS risk FROM s2)"""
_SUMMARY = """class, chapter, eq AS expected_question_count, q AS scraped_question_count, errors AS schema_error_count, structural AS structural_accuracy, complete AS completeness_accuracy,
  semantic AS semantic_accuracy, gap AS schema_gap_risk, anomaly AS anomaly_score, final AS final_accuracy, risk"""
_FAILURES = """array_to_string(list_filter([CASE WHEN errors > 0 THEN 'schema_errors' END, CASE WHEN eq > q THEN 'missing_questions' END, CASE WHEN resid > 0.1 THEN 'alignment_residuals' END,
  CASE WHEN complete < 0.95 THEN 'completeness_drop' END, CASE WHEN semantic < 0.95 THEN 'semantic_mismatch' END, CASE WHEN anomaly >= 0.3 THEN 'content_anomalies' END], lambda x: x IS NOT NULL), ',')"""


@query(f"WITH {AUDITED_SQL} SELECT {_SUMMARY}, {_FAILURES} AS dominant_failures FROM audited")
def q_chapter_summary(spark, d):
    a = audited(spark, d)
    return a.select(
        "class", "chapter", "expected_question_count", F.col("questions").alias("scraped_question_count"), F.col("schema_errors").alias("schema_error_count"), "structural_accuracy", "completeness_accuracy",
        "semantic_accuracy", "schema_gap_risk", "anomaly_score", "final_accuracy", "risk", F.array_join("dominant_failures", ",").alias("dominant_failures"),
    )


@query(f"WITH {AUDITED_SQL} SELECT class, chapter, risk, final AS final_accuracy FROM audited WHERE risk <> 'low'")
def q_high_risk(spark, d):
    return audited(spark, d).where("risk <> 'low'").select("class", "chapter", "risk", "final_accuracy")


@query(f"WITH {AUDITED_SQL} SELECT class, chapter, missing AS missing_question_ratio, resid AS residual_block_ratio, gap AS schema_gap_risk FROM audited")
def q_residual(spark, d):
    return audited(spark, d).select("class", "chapter", "missing_question_ratio", "residual_block_ratio", "schema_gap_risk")


@query(f"WITH {AUDITED_SQL} SELECT class, chapter, final AS final_accuracy, row_number() OVER (PARTITION BY class ORDER BY final, chapter) AS place FROM audited QUALIFY place <= 8")
def r_watchlist(spark, d):
    return findings.top_per(audited(spark, d), "class", [F.col("final_accuracy"), F.col("chapter")]).select("class", "chapter", "final_accuracy", "place")


@query(f"""WITH {AUDITED_SQL} SELECT class, chapter FROM audited WHERE contains(lower(concat_ws(' ', chapter, risk, eq::VARCHAR)), 'medium')""")
def r_filter(spark, d):
    return findings.search(audited(spark, d), F.concat_ws(" ", "chapter", "risk", F.col("expected_question_count").cast("string")), " Medium ").select("class", "chapter")


# Alignment and explanations


def _conversation_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A conversation's user turns as source blocks, its assistant turns as questions."""
    t = turns(spark, d)
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    blocks = t.where("role = 'user'").select("conv_id", n.cast("int").alias("source_index"), F.lit("").alias("year"), F.lit(None).cast("int").alias("number"), F.col("text").alias("stem"), F.array("text").alias("lines"))
    questions = t.where("role = 'assistant'").select("conv_id", n.cast("int").alias("scraped_index"), F.lit("").alias("year"), F.lit(None).cast("int").alias("number"), "text", F.array().cast("array<string>").alias("options"), F.lit("a").alias("answer"))
    return blocks, questions


@query()
def n_align_greedy(spark, d):
    """The fold depends on an order and on a similarity that SQL lacks; tests hold it against its definition."""
    return align.align(*_conversation_sides(spark, d), "conv_id")


@query()
def n_align_keyed(spark, d):
    """The real turns of both sides, numbered by their exchange; tests hold it against its definition."""
    sides = (x.withColumn("number", F.col(i)) for x, i in zip(_conversation_sides(spark, d), ("source_index", "scraped_index")))
    return align.align(*sides, "conv_id")


@query("""
SELECT l_suppkey AS chapter, l_orderkey, l_linenumber, l_discount AS score, place FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_discount, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS place FROM lineitem WHERE l_returnflag = 'R' OR l_discount < 0.02) WHERE place <= 8""")
def r_weak_matches(spark, d):
    """Of a chapter's (supplier's) matches the eight worst: unmatched ones and those of a low score."""
    rows = table(spark, d, "lineitem").withColumn("matched", F.col("l_returnflag") != "R").withColumn("score", F.col("l_discount"))
    order = [F.col(c) for c in ("l_discount", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")]
    return findings.top_per(findings.weak(rows, 0.02), "l_suppkey", order).select(F.col("l_suppkey").alias("chapter"), "l_orderkey", "l_linenumber", "score", "place")


@query("""
SELECT n_name AS chapter, row_number() OVER (ORDER BY NOT (n_nationkey % 3 > 0), total DESC, r_name, n_nationkey % 2, n_name) AS place
FROM nation JOIN region ON n_regionkey = r_regionkey JOIN (SELECT c_nationkey, count(*) AS total FROM customer GROUP BY 1) ON c_nationkey = n_nationkey""")
def h_multi_key_sort(spark, d):
    total = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("total"))
    rows = table(spark, d, "nation").join(total, "n_nationkey").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select((F.col("n_nationkey") % 3 > 0).alias("covered"), "total", F.col("r_name").alias("subject"), (F.col("n_nationkey") % 2).alias("class_code"), F.col("n_name").alias("chapter"))
    return rows.select("chapter", F.row_number().over(Window.orderBy(*dashboard.total_order(rows))).alias("place"))


@query("""
SELECT event_id, CASE WHEN after_ THEN '-explanation' || n WHEN n = 1 THEN '-main' ELSE '-main' || n END AS suffix FROM (
  SELECT event_id, after_, row_number() OVER (PARTITION BY user_id, after_ ORDER BY ts, event_id) AS n FROM (SELECT *, event_type IN ('purchase', 'error') AS after_ FROM events WHERE event_type <> 'signup'))""")
def g_ordinals(spark, d):
    e = table(spark, d, "events")
    src = F.when(F.col("event_type") == "signup", "https://x/Vector.png").otherwise("https://x/a.png")
    pictures = e.select("user_id", "event_id", F.struct("ts", "event_id").alias("pos"), src.alias("src"), F.col("event_type").isin("purchase", "error").alias("after_answer"))
    return picture_suffixes(pictures, ["user_id"]).select("event_id", "suffix")


@query("""
WITH marked AS (
  SELECT *, last_value(CASE WHEN event_type = 'signup' THEN year(ts)::VARCHAR END IGNORE NULLS) OVER w AS v, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER w - 1 AS block FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT user_id AS page_id, block::INTEGER AS source_index, coalesce(max(v) FILTER (event_type = 'click'), '2022') AS year, count(*)::INTEGER AS n FROM marked WHERE block >= 0 AND event_type <> 'signup' GROUP BY 1, 2""")
def g_element_blocks(spark, d):
    """Events as a page's elements: signups are headings with a year, clicks begin questions."""
    kind = F.col("event_type")
    text = F.when(kind == "signup", F.concat(F.lit("All the questions that were asked in "), F.year("ts").cast("string"))).when(kind == "click", "Q 12: which").otherwise("more text")
    elements = table(spark, d, "events").select(F.col("user_id").alias("page_id"), F.struct("ts", "event_id").alias("pos"), F.when(kind == "signup", "h2").otherwise("p").alias("tag"), text.alias("text"))
    return element_blocks(elements).select("page_id", "source_index", "year", F.size("lines").alias("n"))


@query("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text) AND b.text <> ''")
def e_contained_items(spark, d):
    """Test items that stand in documents, letter for letter."""
    return containing(table(spark, d, "documents"), table(spark, d, "benchmark"), "doc_id", "item_id")


@query("""
SELECT p_partkey, n_nationkey FROM part JOIN (
  SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN '#' || n_nationkey WHEN 1 THEN chr(97 + n_nationkey) ELSE ' ' || chr(97 + n_nationkey) END AS needle FROM nation) ON contains(p_name || ' ' || p_brand, needle)""")
def e_contained_short(spark, d):
    """Short needles, of one character to three, by the runs of characters in the texts."""
    k = F.col("n_nationkey").cast("int")
    needle = F.when(k % 3 == 0, F.concat(F.lit("#"), k.cast("string"))).when(k % 3 == 1, F.chr(k + 97)).otherwise(F.concat(F.lit(" "), F.chr(k + 97)))
    texts = table(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("text"))
    return containing(texts, table(spark, d, "nation").select("n_nationkey", needle.alias("text")), "p_partkey", "n_nationkey")


@query("SELECT p_partkey, r_name FROM part JOIN region ON contains(upper(p_type), left(r_name, 1))")
def e_theta_contains(spark, d):
    """A join on containment of one letter, which is in nearly all texts; a small side goes to every task.
    `e_contained_items` is the join of two large sides."""
    return table(spark, d, "part").join(broadcast_if_small(table(spark, d, "region"), 1_000), F.contains(F.upper("p_type"), F.left("r_name", F.lit(1)))).select("p_partkey", "r_name")


@query("SELECT c_custkey AS slug, c_name AS chapter, 0::BIGINT AS question_count, 'no_source_mapping_for_chapter' AS coverage_reason FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def q_uncovered(spark, d):
    sources = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"), F.lit("u").alias("source_url")).distinct()
    rows = table(spark, d, "customer").join(sources, "c_custkey", "left").where("source_url is null")
    return rows.select(F.col("c_custkey").alias("slug"), F.col("c_name").alias("chapter"), F.lit(0).cast("long").alias("question_count"), F.lit("no_source_mapping_for_chapter").alias("coverage_reason"))


@query(f"""WITH {AUDITED_SQL}
SELECT count(*) FILTER (risk = 'high') AS high, count(*) FILTER (risk = 'medium') AS medium, count(*) FILTER (risk = 'low') AS low, count(*) FILTER (risk <> 'low') AS risky FROM audited""")
def m_risk_bands(spark, d):
    n = lambda r: F.count_if(F.col("risk") == r).alias(r)
    return audited(spark, d).agg(n("high"), n("medium"), n("low"), F.count_if(F.col("risk") != "low").alias("risky"))


@query(f"WITH {AUDITED_SQL} SELECT class, chapter, printf('%.4f', final) AS shown, CASE WHEN risk IN ('high', 'medium', 'low') THEN risk ELSE 'neutral' END AS badge FROM audited")
def r_score_cards(spark, d):
    return audited(spark, d).select("class", "chapter", T.shown_score(F.col("final_accuracy")).alias("shown"), T.badge(F.col("risk")).alias("badge"))


@query("""
SELECT p_partkey, category FROM (
  SELECT p_partkey, 'missing_in_json' AS category FROM part WHERE p_size <= 10
  UNION ALL SELECT p_partkey, 'missing_from_source' FROM part WHERE p_size > 10 AND p_size <= 20
  UNION ALL SELECT p_partkey, 'ui_leak' FROM part WHERE p_size > 20 AND p_size <= 30)""")
def o_explanation_scan(spark, d):
    s = F.col("p_size")
    source = F.when((s > 10) & (s <= 20), "").otherwise(F.col("p_name"))
    told = F.when(s <= 10, "").when((s > 20) & (s <= 30), F.concat("p_name", F.lit(" View Answer"))).otherwise(F.col("p_name"))
    pairs = table(spark, d, "part").select("p_partkey", source.alias("source_explanation"), told.alias("json_explanation"))
    return findings.explanation_findings(pairs).select("p_partkey", "category")


@query("""
SELECT p_partkey AS page_id, 2::BIGINT AS expected_question_count, CASE WHEN p_size <= 25 THEN 2 ELSE 1 END::BIGINT AS expected_answer_markers, CASE WHEN p_size <= 25 THEN 6 ELSE 4 END::BIGINT AS expected_option_markers,
       CASE WHEN p_size <= 10 THEN 1 ELSE 0 END::BIGINT AS expected_images, CASE WHEN p_size > 40 THEN 1 ELSE 0 END::BIGINT AS expected_tables, CASE WHEN p_size <= 25 THEN 0 ELSE 1 END::BIGINT AS residual_blocks FROM part""")
def f_source_signals(spark, d):
    """A page a part, with two questions: the second is cut short on some."""
    s = F.col("p_size")
    first = "<h2>2021</h2><p>Q1: what</p><p>(a) w</p><p>(b) x</p><p>(c) y</p><p>(d) z</p><p>Ans: (a) so</p><p>Q2: who</p>"
    html = F.concat(F.lit(first), F.when(s <= 25, "<p>(a) v</p><p>(b) u</p><p>Ans: (b)</p>").otherwise("<p>cut</p>"), F.when(s <= 10, '<img src="x">').otherwise(""), F.when(s > 40, "<table></table>").otherwise(""))
    pages = table(spark, d, "part").select(F.col("p_partkey").alias("page_id"), html.alias("html"))
    return signals(blocks(P.page_lines(pages)), pages)


# The audit's reports, each from the stages that it needs


def audit_of(spark, d, classes: str = "") -> Audit:
    files, sources, pages = audit_tables(spark, d)
    return Audit(targets_of(files, sources, classes), pages)


@query(f"""WITH {CHAPTERS_SQL}
SELECT class_code, slug, source_index::INTEGER AS source_index, scraped_index::INTEGER AS scraped_index, round(0.8 + 0.15 * (filled / 4.0) + 0.05 * (answer <> '')::INT, 4)::DOUBLE AS score, true AS matched FROM placed WHERE covered""")
def q_report_alignment(spark, d):
    """Blocks of a page by year, questions of a file by id: each block meets the one of its year and number."""
    return audit_of(spark, d).question_alignment().select("class_code", "slug", "source_index", "scraped_index", "score", "matched")


@query(f"""WITH {CHAPTERS_SQL}
SELECT class_code, slug, scraped_index::INTEGER AS index, 'tables' AS field, 'missing_key' AS type FROM placed WHERE covered AND id % 50 = 7""")
def q_report_schema(spark, d):
    return audit_of(spark, d).schema_failures().select("class_code", "slug", "index", "field", "type")


@query(f"""WITH {CHAPTERS_SQL}
SELECT class_code, slug, any_value(chapter) AS chapter, count(*)::INTEGER AS question_count, 'no_source_mapping_for_chapter' AS coverage_reason FROM placed WHERE NOT covered AND class_code IN ('B1', 'B4') GROUP BY ALL""")
def q_report_uncovered(spark, d):
    """Of the classes asked for, the chapters that no source covers."""
    return audit_of(spark, d, " b4,,B1 ").uncovered_chapters().select("class_code", "slug", "chapter", "question_count", "coverage_reason")


@query(f"""WITH {CHAPTERS_SQL}
SELECT class_code, slug, count(*) AS expected_question_count, count(*) AS scraped_question_count, count(*) FILTER (id % 50 = 7) AS schema_error_count, round(1 - count(*) FILTER (id % 50 = 7) / count(*), 4) AS structural_accuracy, 0.0::DOUBLE AS schema_gap_risk
FROM placed WHERE covered GROUP BY ALL""")
def q_report_summary(spark, d):
    return audit_of(spark, d).chapter_summary().select("class_code", "slug", "expected_question_count", "scraped_question_count", "schema_error_count", "structural_accuracy", "schema_gap_risk")


@query(f"""WITH {CHAPTERS_SQL}
SELECT class_code, slug, category, 'Q' || id AS json_id, 'Q' || n AS source_q, y AS year, CASE WHEN category = 'missing_in_json' THEN why END AS source_snippet, CASE WHEN category = 'missing_from_source' THEN why END AS json_snippet
FROM (SELECT *, CASE id % 10 WHEN 0 THEN 'missing_in_json' WHEN 2 THEN 'ui_leak' WHEN 3 THEN 'missing_from_source' END AS category FROM placed) WHERE covered AND category IS NOT NULL""")
def o_report_explanations(spark, d):
    """Explanations of matched pairs that are missing on a side, or tell of the interface."""
    return audit_of(spark, d).explanation_accuracy_scan().select("class_code", "slug", "category", "json_id", "source_q", "year", F.nullif("source_snippet", F.lit("")).alias("source_snippet"), F.nullif("json_snippet", F.lit("")).alias("json_snippet"))


@query(f"""WITH {CHAPTERS_SQL}
SELECT class_code, slug, covered, count(*) FILTER (covered) AS source_question_count, count(*) FILTER (covered AND id % 10 = 0) AS missing_in_json, count(*) FILTER (covered AND id % 10 = 3) AS missing_from_source,
       0::BIGINT AS mismatch, count(*) FILTER (covered AND id % 10 = 2) AS ui_leak, count(*) FILTER (covered AND id % 10 IN (0, 2, 3)) AS total FROM placed GROUP BY ALL""")
def o_report_chapters(spark, d):
    return audit_of(spark, d).explanation_chapters().select("class_code", "slug", "covered", "source_question_count", "missing_in_json", "missing_from_source", "mismatch", "ui_leak", "total")


@query(f"""WITH {CHAPTERS_SQL}
SELECT class_code, slug, count(*)::INTEGER AS question_count, count(*) FILTER (filled < 4) AS anomaly_count, count(*) FILTER (filled = 0) AS all_empty_option_count, count(*) FILTER (filled > 0 AND filled < 4) AS partial_option_count, 0::BIGINT AS image_backed_gap_count FROM placed GROUP BY ALL""")
def p_report_chapters(spark, d):
    return audit_of(spark, d).option_anomaly_chapters().select("class_code", "slug", "question_count", "anomaly_count", "all_empty_option_count", "partial_option_count", "image_backed_gap_count")


# The dashboard's records, from the audit's stages


def question_summaries_of(a: Audit) -> DataFrame:
    """The questions of the chapter files, as the dashboard shows them."""
    return dashboard.question_summaries(a.questions.drop("class").join(a.who.select("page_id", F.col("class_code").alias("class"), "slug"), "page_id"))


def papers_of(spark, d) -> DataFrame:
    """A paper for each nation, and one without a chapter for each region."""
    code = lambda c: F.concat(F.lit("B"), F.col(c).cast("string")).alias("class")
    nations = table(spark, d, "nation").select(code("n_regionkey"), F.replace("n_name", F.lit("_"), F.lit("-")).alias("title"), F.array(F.concat(F.lit("/t/"), "n_name")).alias("pyq_links"))
    regions = table(spark, d, "region").select(code("r_regionkey"), F.concat(F.lit("Region "), "r_name").alias("title"), F.array(F.lit("/t/r")).alias("pyq_links"))
    return nations.unionByName(regions)


def dashboard_of(spark, d) -> DataFrame:
    """The chapters' records."""
    a, place = audit_of(spark, d), F.xxhash64("class_code", "slug")
    audited = a.chapter_summary().withColumn("place", place).drop("page_id", "chapter", "subject", "json_path", "source_url")
    residuals = a.residual_text_report().withColumn("place", place)
    return dashboard.chapter_records(question_summaries_of(a), papers_of(spark, d), audited, residuals, a.question_alignment(), a.schema_failures())


_DASHBOARD_SQL = CHAPTERS_SQL + """,
own AS (
  SELECT class_code AS class, slug, covered, count(*) AS n, count(*) FILTER (covered AND id % 50 = 7) AS failures, list_reverse(list_sort(list(DISTINCT y))) AS years, any_value(lower(replace(chapter, '_', '-'))) AS s FROM placed GROUP BY ALL),
linked AS (SELECT 'B' || n_regionkey AS class, lower(replace(n_name, '_', '-')) AS slug, false AS region FROM nation UNION ALL SELECT 'B' || r_regionkey, 'region-' || lower(regexp_replace(replace(r_name, ' ', '-'), '[^a-zA-Z0-9-]', '', 'g')), true FROM region)"""


@query(f"""WITH {_DASHBOARD_SQL}
SELECT l.class || ':' || l.slug AS key, coalesce(n, 0) AS "questionCount", coalesce(years, []) AS years, years[-1] || '-' || years[1] AS "yearRange", n IS NOT NULL AS scraped, coalesce(covered, false) AS audited, coalesce(failures, 0) AS "schemaFailureCount", 0 AS weak
FROM linked l LEFT JOIN own o ON o.class = l.class AND o.slug = l.slug""")
def r_chapters(spark, d):
    """A record a chapter or paper: counts, years, what was scraped and audited, and the faults found."""
    return dashboard_of(spark, d).select("key", "questionCount", "years", "yearRange", "scraped", "audited", "schemaFailureCount", F.size("weakMatches").alias("weak"))


@query(f"""WITH {_DASHBOARD_SQL}
SELECT count(*) AS "chapterCount", count(*) AS "pyqChapterCount", count(n) AS "scrapedChapterCount", count(*) FILTER (covered) AS "auditedChapterCount", coalesce(sum(n), 0)::BIGINT AS "totalQuestions", coalesce(sum(failures), 0)::BIGINT AS "schemaFailureCount",
       count(*) FILTER (covered) || '/' || count(*) AS "auditedShare", count(n) || '/' || count(*) AS "scrapedShare" FROM linked l LEFT JOIN own o ON o.class = l.class AND o.slug = l.slug""")
def r_overview(spark, d):
    names = ("chapterCount", "pyqChapterCount", "scrapedChapterCount", "auditedChapterCount", "totalQuestions", "schemaFailureCount", "auditedShare", "scrapedShare")
    return dashboard.overview(dashboard_of(spark, d)).select(*names)


@query(f"""WITH {CHAPTERS_SQL}
SELECT class_code AS class, slug, 'Q' || id AS id, upper(CASE answer WHEN 'F' THEN 'a' WHEN 'O' THEN 'b' ELSE '' END) AS answer, id % 10 <> 0 AS "hasExplanation" FROM placed WHERE y = '2009' AND contains('q' || id || ' which parts has order ' || id, '12')""")
def r_question_search(spark, d):
    """Questions of one year whose number has these digits."""
    summaries = question_summaries_of(audit_of(spark, d))
    found = dashboard.matching(summaries.withColumn("searchText", F.concat_ws(" ", F.lower("id"), F.lower("text"))), "12", "2009")
    return found.select("class", "slug", "id", "answer", "hasExplanation")


@query("SELECT 'B' || r_regionkey AS class, 'Region ' || r_name AS title FROM region")
def e_paper_orphans(spark, d):
    """Papers whose chapter has no questions."""
    return dashboard.orphans(papers_of(spark, d), question_summaries_of(audit_of(spark, d))).select("class", "title")


@query(f"""WITH {CHAPTERS_SQL}
SELECT slug, count(*) AS "expectedQuestionCount", count(*) AS "scrapedQuestionCount", 0.0::DOUBLE AS "schemaGapRisk", 0 AS "weakMatchCount" FROM placed WHERE covered GROUP BY slug""")
def r_audit_summary(spark, d):
    """Audited chapters under the names that readers see."""
    return dashboard.audit_summary(dashboard_of(spark, d)).select("slug", "expectedQuestionCount", "scrapedQuestionCount", "schemaGapRisk", "weakMatchCount")


# Titles


@query(f"""
SELECT page_id, {clean_sql(decoded_sql("regexp_extract(html, '<title>([^<]*)</title>', 1)"))} AS page_title, '' AS canonical_url, '' AS course_title, '' AS hidden_title FROM pages""")
def a_page_metadata(spark, d):
    return L.page_metadata(table(spark, d, "pages"))


@query("""
SELECT n_nationkey, n_nationkey % 3 <> 2 AS paper, n_nationkey % 3 = 0 AND CASE WHEN n_nationkey % 2 = 1 THEN n_nationkey % 5 = 0 WHEN n_nationkey % 4 = 0 THEN n_nationkey % 5 <> 0 ELSE true END AS same FROM nation""")
def c_paper_titles(spark, d):
    """Whether a page's title is a paper's of this exam, and whether it is the chapter's own: by its topic, and by its course if it tells one."""
    k, name = F.col("n_nationkey"), F.col("n_name")
    title = F.concat(F.when(k % 3 == 2, "CBSE Previous Year Questions, ").otherwise(""), F.when(k % 3 == 1, "neet previous year questions").otherwise("NEET Previous Year Questions"), F.lit(" (2014-24): "), F.when(k % 3 == 1, "Else").otherwise(name), F.lit(" and Diseases"))
    rows = table(spark, d, "nation").select(k, title.alias("page_title"), F.concat(name, F.lit(" & disease")).alias("title"), F.when(k % 2 == 1, "Physics Class 11").when(k % 4 == 0, "Chemistry  Class 12").otherwise("").alias("course_title"), F.when(k % 5 == 0, "P11").otherwise("C12").alias("class_code"))
    return rows.select(k, titles.is_paper(F.col("page_title")).alias("paper"), (L.verified(rows) & titles.is_paper(F.col("page_title"))).alias("same"))


@query(f"WITH {RECORDS_SQL} SELECT 'C' || class AS class, chapter, count(*) AS questions, min(id) AS first FROM records JOIN region ON class = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE') GROUP BY ALL")
def c_chosen_folders(spark, d):
    """Questions written by class, of which the classes that a table names are read."""
    path = f"{shared_folder(spark)}/questions-{uuid.uuid4().hex}"
    code = lambda c: F.concat(F.lit("C"), F.col(c).cast("string")).alias("class")
    P.write_chapters(records(spark, d).select(F.lit("biology").alias("subject"), code("class"), "id", "chapter"), path)
    asked = table(spark, d, "region").where("r_name IN ('ASIA', 'EUROPE')").select(F.lit("biology").alias("subject"), code("r_regionkey"))
    return P.chosen_chapters(spark, path, "id long, chapter string", asked).groupBy("class", "chapter").agg(F.count("*").alias("questions"), F.min("id").alias("first"))


@query("""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS begins, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL""")
def s_event_rollups(spark, d):
    """The events as a stream, rolled up by the hour to its end."""
    out, state = (f"{shared_folder(spark)}/{n}-{uuid.uuid4().hex}" for n in ("rollups", "rollup-state"))
    stream = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*")
    rollups.keep_rollups(stream, out, state, ["event_type"], "value").awaitTermination()
    return rollups.latest(spark, out, ["event_type"]).select(F.date_format("begins", "yyyy-MM-dd HH").alias("begins"), "event_type", "n", F.round("total", 2).alias("total"))


@query("""
SELECT c_custkey, o_orderkey, (n - 1)::INTEGER AS place FROM (SELECT c_custkey, o_orderkey, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) AS n FROM customer JOIN orders ON c_custkey = o_custkey)""")
def d_chapter_papers(spark, d):
    """A row for each paper (order) in the list of its chapter (customer), in the list's order; chapters without papers have none."""
    papers = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("papers"))
    chapters = table(spark, d, "customer").join(papers, F.col("c_custkey") == F.col("o_custkey"), "left")
    return chapters.select("c_custkey", F.posexplode("papers").alias("place", "o_orderkey"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["q_chapter_summary"](spark, sf_dir)
