import re
import random
from itertools import product

from gleanery.llm import html_text as m
from tests.llm.fixtures import words

PAGES = "page_id long, url string, html string, text string, n_chars long"


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def test_cut_is_minimal():
    r = random.Random(2)
    for _ in range(60):
        n = r.randint(1, 8)
        costs = [r.uniform(-3, 3) for _ in range(n)]
        edges = [(i, j, r.uniform(0, 2)) for i in range(n) for j in range(i) if r.random() < 0.5]

        def price(labels):
            return sum(abs(c) for c, l in zip(costs, labels) if (c > 0) != l and c) + sum(w for i, j, w in edges if labels[i] != labels[j])

        best = min(price(x) for x in product((True, False), repeat=n))
        assert abs(price(m.minimum_cut(costs, edges)) - best) < 1e-9


def test_article_without_its_surroundings():
    paragraphs = [words(i, 30) + "." for i in range(6)]
    body = (
        "<header><a href='/'>Home of words</a></header><nav><ul>" + "".join(f"<li><a href='/{i}'>{words(50 + i, 2)}</a></li>" for i in range(6)) + "</ul></nav>"
        f"<div class='cookie-notice'><p>We use cookies to make this site better.</p></div><div class='ad'>{words(70, 12)}.</div>"
        "<main><article><h1>Short &amp; sweet</h1>" + "".join(f"<p>{p}" for p in paragraphs) + f"</article></main>"
        f"<aside class='sidebar'><p>{words(71, 20)}.</p></aside><form><label>Mail</label><input value='x'><button>Go</button></form>"
        f"<section id='comments'><h2>Comments</h2><div class='comment'><p>{words(72, 25)}.</p></div></section><footer>&copy; us</footer>"
    )
    assert m.main_text(page(body, "<style>p{}</style><script>var t='</p>';</script>")) == "\n".join(["Short & sweet", *paragraphs])


def test_page_without_landmarks():
    paragraphs = [words(i, 40) + "." for i in range(5)]
    body = f"<div><a href='/a'>One</a> <a href='/b'>Two</a> <a href='/c'>Three</a></div><div>{''.join(f'<p>{p}</p>' for p in paragraphs)}</div><div><a href='/z'>Next page</a></div>"
    assert m.main_text(page(body)) == "\n".join(paragraphs)


def test_white_space_references_and_inline_markup():
    html = page("<article><p>a <b>bold</b>\n\tmove &quot;x&quot; &#233;&nbsp;e&am; it is so.</p><p>  second   one, it is so. </p></article>")
    assert m.main_text(html) == 'a bold move "x" é e&am; it is so.\nsecond one, it is so.'


def test_rows(spark):
    long = page("<article>" + "".join(f"<p>{words(i, 50)}.</p>" for i in range(1500)) + "</article>")
    rows = [(1, "u", None), (2, None, ""), (3, "u", "no markup at all"), (4, "u", long), (4, "u", long), (None, "u", page("<nav><a href='/'>x</a></nav>")), (5, "u", "<p><b>broken<div</p>")]
    got = m.extract(spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, u, m.main_text(h or ""), len(m.main_text(h or ""))) for i, u, h in rows), key=str)
    assert m.main_text(long).count("\n") == 1499 and m.main_text(rows[5][2]) == ""
    assert m.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_names_far_up_do_not_cost_the_article():
    paragraphs = [words(i, 40) + "." for i in range(4)]
    article = "<div class='entry-content'>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</div>"
    aside = f"<aside><div class='text'><p>{words(71, 20)}.</p></div></aside>"
    for body in ("<body class='no-sidebar'>", "<body class='page has-sidebar'>", "<body><div class='with-sidebar'><div class='no-banner'>"):
        assert m.main_text(f"<html><head><title>T</title></head>{body}{article}{aside}</body></html>") == "\n".join(paragraphs)


def test_head_without_its_end():
    for body in (f"<body><p>{words(1, 30)}.</p>", f"<p>{words(1, 30)}.</p>", f"{words(1, 30)}."):
        assert m.main_text(f"<html><head><title>T</title><meta charset='utf-8'><style>p{{}}</style>\n{body}") == words(1, 30) + "."


def test_formulas_are_text():
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><msup><mi>y</mi><mn>2</mn></msup></mrow><annotation>x=y^2</annotation></semantics></math>"
    assert m.main_text(page(f"<article><p>{words(1, 20)} {formula} {words(2, 20)}.</p></article>")) == f"{words(1, 20)} x=y2 {words(2, 20)}."


def test_title_in_the_articles_header():
    body = f"<header><h1>Site of words</h1></header><article><header><h1>Title of it</h1><p class='share'>Share this</p></header><p>{words(1, 30)}.</p></article>"
    assert m.main_text(page(body)) == f"Title of it\n{words(1, 30)}."


def test_names_on_an_articles_own_blocks():
    """Ids are what links lead to, and a heading's names its looks; what a container or a paragraph's class says still counts."""
    text = "A full paragraph of the article, with words enough to be read as such, and an end."
    kept = ['<h1 class="entry-header">The title</h1>', '<h2 id="related-work">Related work</h2>', '<h2 id="social">Social aspects</h2>', '<h3 id="copyright" class="widget-title">Copyright law</h3>', f'<p id="share">{text}</p>', f"<p>{text} Again.</p>"]
    gone = [f'<p class="advert">{text}</p>', f'<div id="comments"><h3>Comments</h3><p>{text}</p></div>', f"<aside><h2>Aside</h2><p>{text}</p></aside>"]
    plain = lambda x: re.sub("<[^>]+>", "", x)
    html = f"<body><nav><a href=/>Home</a></nav><article>{''.join(kept)}{''.join(gone)}</article><div id=footer><h2>Footer</h2></div></body>"
    assert m.main_text(html) == "\n".join(map(plain, kept))


def test_deep_nesting():
    text = words(3, 40) + "."
    assert m.main_text(page("<div>" * 400 + f"<p>{text}</p>" + "</div>" * 400)) == text


def test_fitted_weights(spark):
    """Learned from pages that label themselves; every page of the table against the extraction with those
    weights, and against the text that the page was made of."""
    rows, want = [], {}
    for i in range(60):
        paragraphs = [words(100 * i + k, 20 + k) + "." for k in range(4)]
        menu = "".join(f"<li><a href='/{k}'>{words(5000 + i + k, 2)}</a></li>" for k in range(5))
        inner = "".join(f"<p>{p}</p>" for p in paragraphs)
        body = f"<nav><ul>{menu}</ul></nav>" + (f"<article>{inner}</article><div class='ad'>{words(i, 8)}.</div><footer>Us {i}</footer>" if i < 40 else f"<div>{inner}</div>")
        rows.append((i, f"u{i}", page(body)))
        want[i] = "\n".join(paragraphs)
    d = spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)
    w = m.learn(d)
    assert w != m.PRIOR and w[1] < 0 < w[2] and w == m.learn(d)
    # Pages without paragraph elements are still taken for content.
    assert m.main_text(page(f"<div>{words(1, 40)}.</div><div>{words(2, 40)}.</div>"), w) != ""
    got = {r.page_id: r.text for r in m.extract(d).collect()}
    assert got == {i: m.main_text(h, w) for i, _, h in rows} == want
    assert m.learn(d.limit(0)) == m.PRIOR


def whole_article(html):
    """The articles of the given pages by plain patterns: their markup is regular."""
    import html as library
    import re

    inner = re.search(r"(?s)<article>(.*)</article>", html)
    if not inner:
        return None
    x = re.sub(r"(?s)<!--.*?-->|<(script|style)\b.*?</\1>", "", inner[1])
    parts = re.split(r"(?i)</?(?:p|h1|h2|br|div|ul|li|table|tr|td|blockquote)\b[^>]*>", x)
    parts = [" ".join(library.unescape(re.sub(r"<[^>]+>", "", y)).split()) for y in parts]
    return "\n".join(y for y in parts if y)


def test_all_given_pages_against_their_articles(spark):
    folder = "/root/testdata/sf0.001"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in m.op7(spark, folder).collect()}
    want = {i: whole_article(h or "") for i, h in html.items()}
    assert all(w is not None for w in want.values()) and got == want
