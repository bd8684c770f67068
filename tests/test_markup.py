"""The node table against a parser of its own, the standard library's, with a stack."""

import random
from html.parser import HTMLParser

import pytest

from gleanery.sources import links
from gleanery.sources import markup as m

CASES = [
    None,
    "",
    "no tags & <",
    "<p>a<p>b</p>c<br>d</div>",
    "<table><tr><td>a<td>b<tr><td>c<table><tr><th>in<td>x</table>tail<td>y</table><p>z",
    "<ul><li>one<li>two<ul><li>deep</ul><li>three</ul>after",
    '<div title="a > b" class=\'x y\'><a href="/q?a=1&amp;b=2">l<h2 class="subcoursetitle">T <span>s</span></h2></a></div>',
    "<div><!-- <p> --><script>if (a<b) '</p><div>'</script><style>p>a{}</style><noscript>n</noscript>t</div>",
    "<dl><dt>a<dd>b<dt>c<dd>d</dl><select><option>1<option>2</select>",
    "<div><b>bold<p>para</div>rest</b>",
    "<table><tr><td>a<table><tr><td><b>in</b></table> tail</td><td>b</table><ul><li>x<ul><li>y</ul> z</li></ul><div><p>q</div></p>r",
    "<DIV><P>Upper<IMG SRC=a.png></P></DIV>",
]


class Stack(HTMLParser):
    """(name, text) of each element by the stack of what is open, in order of their start tags."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.stack, self.out = [], []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        for names, by in m.ENDED_BY.items():
            if tag in by:
                # The nearest open element of these names, if nothing with an end tag of its own is open inside it.
                for k in range(len(self.stack) - 1, -1, -1):
                    name = self.out[self.stack[k]][0]
                    if name in names.split():
                        del self.stack[k:]
                        break
                    if name not in m.OPTIONAL and name not in ("b", "i"):
                        break
        self.out.append([tag, "", len(self.stack) + 1])
        if tag not in m.VOID:
            self.stack.append(len(self.out) - 1)

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, -1, -1):
            if self.out[self.stack[k]][0] == tag:
                del self.stack[k:]
                return

    def handle_data(self, data):
        if self.stack and self.out[self.stack[-1]][0] in ("script", "style"):
            return
        for k in self.stack:
            self.out[k][1] += data


def expected(html):
    return [(n, t, d) for n, t, d in Stack(html or "").out if n not in ("script", "style")]


def found(spark, pages):
    tags, tree = m.parsed(spark.createDataFrame(pages, "page_id long, html string"))
    words = m.text_of(m.texts(tags), tree)
    rows = tree.join(words, ["page_id", "open"], "left").orderBy("page_id", "open").collect()
    out = {i: [] for i, _ in pages}
    for r in rows:
        assert r.open < r.close
        out[r.page_id].append((r.name, r.text or "", r.depth))
    return out


def test_against_a_stack(spark):
    pages = list(enumerate(CASES))
    got = found(spark, pages)
    for i, html in pages:
        if html and "<b>bold<p>" in html:
            continue  # a tag across another's end: here the end tags of one's own count
        assert got[i] == expected(html), html


def test_real_pages_against_a_stack(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    got = found(spark, pages)
    for i, html in pages:
        # A page that was cut off within a tag has one more text token here.
        if html and html.rstrip().endswith(">"):
            assert got[i] == expected(html), i


def test_tokens_are_the_page(spark):
    tags = m.tokens(spark.createDataFrame([x for x in enumerate(CASES)], "page_id long, html string"))
    joined = {}
    for r in tags.orderBy("page_id", "pos").collect():
        joined[r.page_id] = joined.get(r.page_id, "") + r.token
    assert joined == {i: x for i, x in enumerate(CASES) if x}


def test_tables_in_tables(spark):
    html = "<table><tr><td>a<td>b<tr><td>c <table><tr><th>in<td>x</td></tr></table> tail<td>y</table><table></table><table><tr></table>"
    got = m.node_tables(*m.parsed(spark.createDataFrame([(1, html)], "page_id long, html string"))).orderBy("open").collect()
    assert [r.rows for r in got] == [[["a", "b"], ["c inx tail", "in", "x", "y"], ["in", "x"]], [["in", "x"]]]


def test_element_lines(spark):
    html = '<div id=a>one<br>two <img src="p.png"><img> <table><tr><td>no</table><div class="nq2_report_row">no</div> &amp;&nbsp;x<div>in<script>no</script></div></div><p></p><script>no</script>'
    tags, tree = m.parsed(spark.createDataFrame([(1, html)], "page_id long, html string"))
    got = {r.open: r.lines for r in m.element_lines(tags, tree, tree.where("depth = 1")).collect()}
    assert list(got.values()) == [["one", "two [IMG:p.png] [IMG] & xin"]]


def test_widgets(spark):
    html = (
        '<div><div class="nq2_card"><div class=nq2_type_label_wrap>MCQ</div><p>Try yourself:  Which?</p><div class=nq2_options_grid><div class="nq2_option"><b class=nq2_opt_letter>A</b><i class=nq2_opt_text>one</i></div>'
        '<div class=nq2_option><b class=nq2_opt_letter>b</b><i class=nq2_opt_text></i></div></div><div class=nq2_sol_panel><p class=nq2_sol_label>Correct Answer: C</p><div class=nq2_sol_body><ul><li>why<li> <li>so</ul></div></div></div></div><p>plain</p>'
    )
    tags, tree = m.parsed(spark.createDataFrame([(1, html)], "page_id long, html string"))
    got = {r.open: r.lines for r in m.element_lines(tags, tree, tree.where("depth = 1")).collect()}
    assert [got[k] for k in sorted(got)] == [["Which?", "(a) one", "Ans: (c)", "why", "so"], ["plain"]]


def test_widest_takes_the_first_of_equals(spark):
    html = '<div class="c"><p>1<p>2</div><div class="c"><p>1<p>2<div><p>3<p>4</div></div><div class="c"><b>x</b><i>y</i><u>z</u></div><div class="c"></div>'
    got = m.widest(m.nodes(m.tokens(spark.createDataFrame([(1, html), (2, "<p class=d>")], "page_id long, html string"))), "c").collect()
    assert [(r.page_id, r.open, r.children) for r in got] == [(1, 6, 3)]


@pytest.mark.parametrize("seed", [1, 2])
def test_held_by_comparing_all(spark, seed):
    r = random.Random(seed)

    def spans(lo, hi):
        out = []
        while lo < hi:
            a, b = lo + r.randrange(3), lo + r.randrange(3, 12)
            if b <= hi and a < b:
                out += [(a, b), *spans(a + 1, b)]
            lo = b
        return out

    nodes = [(page, a, b) for page in (1, 2) for a, b in set(spans(0, 60))]
    points = [(page, p) for page in (1, 2, 3) for p in range(62)]
    n, p = spark.createDataFrame(nodes, "page_id long, open long, close long"), spark.createDataFrame(points, "page_id long, pos long")
    unique = {(g, a) for g, a, _ in nodes}
    if len(unique) < len(nodes):  # no two elements open at one place
        nodes = [x for x in nodes if x[2] == max(y[2] for y in nodes if y[:2] == x[:2])]
        n = spark.createDataFrame(nodes, "page_id long, open long, close long")
    want = sorted((g, x, a, b) for g, x in points for h, a, b in nodes if g == h and a < x < b)
    assert sorted((y.page_id, y.pos, y.node.open, y.node.close) for y in m.held(p, n).collect()) == want
    inner = {(y.page_id, y.pos): y.node and y.node.open for y in m.held(p, n, innermost=True).collect()}
    assert inner == {(g, x): max((a for h, y, a, _ in want if (h, y) == (g, x)), default=None) for g, x in points}


# The standard's own examples.
BASE = "http://a/b/c/d;p?q"
REFERENCES = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y",
    "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y#s", "": "http://a/b/c/d;p?q",
    ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g",
    "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g",
    "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y",
    "g?y/./x": "http://a/b/c/g?y/./x", "g?y/../x": "http://a/b/c/g?y/../x", "g#s/./x": "http://a/b/c/g#s/./x", "g#s/../x": "http://a/b/c/g#s/../x", "http:g": "http:g",
}


def test_references(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([*((BASE, k, v) for k, v in REFERENCES.items()), ("https://h", "x", "https://h/x"), ("https://h/a/b/c/d", "../../x", "https://h/a/x"), ("https://h/a", "/a/../b", "https://h/b")], "base string, href string, want string")
    got = rows.withColumn("got", links.absolute(F.col("href"), F.col("base"))).collect()
    assert [(r.href, r.got) for r in got if r.got != r.want] == []
