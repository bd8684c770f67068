"""Main text of web pages: blocks labelled content or boilerplate by a minimum cut."""

from __future__ import annotations

import math
import re
import zlib
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import table, text_or_empty

#: Elements that stand within a line; all others end the block before and after them.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Formulas stand within a line, with all their parts.
INLINE |= frozenset("math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mlabeledtr mtd maction semantics annotation annotation-xml".split())
#: Elements that may stand in a head; any other, or text, ends it.
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: Elements whose text is never shown as text.
HIDDEN = frozenset("annotation annotation-xml script style noscript template head title svg iframe object canvas audio video map select option datalist textarea button input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a new one of these closes, if open: what authors leave out.
CLOSED_BY = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
P_CLOSERS = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())
#: Costs, in nats, of calling a block content although an element around it says boilerplate,
#: and the other way round. The nearest element that says something counts, names on the page's
#: own elements do not, and landmarks count from wherever they are.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LANDMARKS = frozenset("nav footer aside".split())
BOILER_TAGS = {"nav": 8, "footer": 8, "aside": 8, "form": 8, "header": 6, "menu": 8, "dialog": 8, "figcaption": 0}
CONTENT_TAGS = {"article": 5, "main": 4}
BOILER_NAMES = re.compile(r"(?:^|[^a-z])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|respond|replies|disqus|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|promo\w*|sponsor\w*|related|recommend\w*|share|social|sidebar|side-?bar|menu|nav\w*|footer|header|masthead|toolbar|widget|login|signup|copyright|legal|pagination|pager|skip|hidden|sr-only)(?:$|[^a-z])")
CONTENT_NAMES = re.compile(r"(?:^|[^a-z])(?:article|content|main|post|entry|story|body|text)(?:$|[^a-z])")
NAME_COST = 6.0
#: What a block's text and its own element say: the classifier's weights before it is fitted, and how much
#: they weigh against the sample, as a ridge for each of its blocks. Names and landmarks prevail over them within these bounds.
FEATURES = ("constant", "linked share", "words", "sentence end", "paragraph or heading", "list item or cell")
PRIOR, RIDGE, BOUNDS = (-0.8, -4.0, 0.6, 0.4, 0.8, 0.0), 0.05, (-4.8, 2.4)
#: Pages that the classifier is fitted on, and their blocks, at most; by hashes.
SAMPLE_PAGES, SAMPLE_BLOCKS = 2_000, 50
#: Cost of a cut between blocks that follow each other, by how far up their paths part.
ADJACENT, SIBLING = 1.2, 0.6


@dataclass
class Block:
    text: str
    path: tuple[tuple[int, str, str], ...]  # (number, tag, names and \0 and id) of the elements around it, outermost first
    linked: int
    cost: float = 0.0  # positive: rather content; in nats
    around: list[int] = field(default_factory=list)


class _Blocks(HTMLParser):
    """Cuts a page into blocks of text, with the elements around each."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[int, str, str]] = []
        self.n = 0
        self.parts: list[str] = []
        self.linked = 0
        self.hidden = 0
        self.links = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(text, tuple(x for x in self.open if x[1] not in INLINE), min(self.linked, len(text))))
        self.parts, self.linked = [], 0

    def _close(self, at: int) -> None:
        for _, tag, _ in self.open[at:]:
            self.hidden -= tag in HIDDEN
            self.links -= tag == "a"
        del self.open[at:]

    def _leave_head(self) -> None:
        if self.open and self.open[-1][1] == "head":
            self._close(len(self.open) - 1)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.flush()
        if tag not in IN_HEAD:
            self._leave_head()
        closes = CLOSED_BY.get(tag, set()) | ({"p"} if tag in P_CLOSERS else set())
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][1]
            if name in closes:
                self._close(at)
            elif name not in INLINE and name not in closes:
                break
        if tag in VOID:
            return
        a = dict(attrs)
        names = " ".join(filter(None, (a.get("class"), a.get("role")))).lower()
        if "hidden" in a or (a.get("aria-hidden") or "").lower() == "true" or re.search(r"display\s*:\s*none", a.get("style") or "", re.I):
            names += " hidden"
        self.n += 1
        self.open.append((self.n, tag, f"{names}\0{(a.get('id') or '').lower()}"))
        self.hidden += tag in HIDDEN
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][1] == tag:
                self._close(at)
                return

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._leave_head()
        if not self.hidden:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


def blocks_of(html: str) -> list[Block]:
    p = _Blocks()
    p.feed(html)
    p.close()
    p.flush()
    return p.blocks


def features(b: Block) -> list[float]:
    """What tells content from boilerplate without the elements around the block."""
    words, tag = b.text.count(" ") + 1, b.path[-1][1] if b.path else ""
    return [1.0, b.linked / len(b.text), min(2.0 / 0.6, math.log(words)), float(b.text[-1] in ".!?…。！？"), float(tag in ("p", "blockquote", "pre") or tag in HEADINGS), float(tag in ("li", "td", "th", "dt", "dd"))]


def names_at(b: Block, at: int) -> str:
    """The names of an element around a block as they count. Those of the page's own elements do not. Within an
    article, a block's own id is what links lead to, and a heading's own names are its looks: neither says
    that the article's text is none."""
    _, tag, names = b.path[at]
    if tag in ("html", "body"):
        return ""
    if at == len(b.path) - 1 and any(t == "article" for _, t, _ in b.path[:at]):
        return "" if tag in HEADINGS else names.partition("\0")[0]
    return names


def terminal_cost(b: Block, weights: Sequence[float] = PRIOR) -> float:
    """How much rather content than boilerplate a block is, as log odds: the nearest
    element that says so, and the classifier."""
    cost, seen, told = 0.0, False, False
    for n, (_, tag, _) in enumerate(reversed(b.path)):
        names = names_at(b, len(b.path) - 1 - n)
        if tag == "header" and b.path[-1][1] in HEADINGS and any(t == "article" for _, t, _ in b.path[: len(b.path) - 1 - n]):
            continue  # an article's title stands in its header
        boiler = max(BOILER_TAGS.get(tag, 0), NAME_COST if names and BOILER_NAMES.search(names) else 0)
        if boiler:
            if not told or tag in LANDMARKS:
                cost -= boiler
            seen = told = True
        elif tag in BOILER_TAGS:
            seen = True
        elif not seen and (tag in CONTENT_TAGS or (names and CONTENT_NAMES.search(names))):
            cost += CONTENT_TAGS.get(tag, 3)
            seen = told = True
    cost += min(max(sum(w * x for w, x in zip(weights, features(b))), BOUNDS[0]), BOUNDS[1])
    if not seen and b.text[:1] in "©":
        cost -= 4.0
    return cost


def structural_label(b: Block) -> bool | None:
    """For a page that has an article: whether a block is in it and in nothing that is boilerplate (true), or in a
    landmark or named as boilerplate outside it (false); None if neither."""
    tags = [t for _, t, _ in b.path]
    odd = any(t in BOILER_TAGS and BOILER_TAGS[t] for t in tags) or any(BOILER_NAMES.search(names_at(b, at)) for at in range(len(b.path)))
    return not odd if "article" in tags else False if odd else None


def fitted(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> tuple[float, ...]:
    """Logistic weights, classes weighing alike, drawn towards PRIOR."""
    start, ridge = np.array(PRIOR), ridge * len(y)
    w, weight = start.copy(), np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * (w - start))
        w += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def learn(pages: DataFrame) -> tuple[float, ...]:
    """The classifier's weights, fitted on a bounded sample of the pages: those with an article label their
    own blocks by their elements, and the classifier learns what such blocks look like in themselves. Without
    blocks of both labels: PRIOR."""
    n = pages.count()
    lot = F.pmod(F.xxhash64("page_id", "url"), F.lit(1_000_000)) / 1e6

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for html in b.html:
                blocks = blocks_of(html)
                if any(t == "article" for x in blocks for _, t, _ in x.path):
                    told = [(features(x), structural_label(x)) for x in sorted(blocks, key=lambda x: zlib.crc32(x.text.encode("utf-8", "surrogatepass")))]
                    out += [(f, y) for f, y in told if y is not None][:SAMPLE_BLOCKS]
            yield pd.DataFrame(out, columns=["x", "y"])

    sample = pages.where(lot < min(1.0, SAMPLE_PAGES / max(n, 1))).select(text_or_empty("html").alias("html"))
    rows = sample.mapInPandas(measured, "x array<double>, y boolean").toPandas()
    y = rows.y.to_numpy(float)
    return PRIOR if not len(y) or y.min() == y.max() else fitted(np.array(rows.x.tolist()), y)


def _shared(a: Block, b: Block) -> int:
    n = 0
    for x, y in zip(a.path, b.path):
        if x[0] != y[0]:
            break
        n += 1
    return n


def edges_of(blocks: Sequence[Block]) -> list[tuple[int, int, float]]:
    """Smoothness: neighbours on the page, and neighbours under the same parent element,
    the dearer to separate the deeper the element that holds both."""
    out: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            deep = _shared(blocks[i - 1], b)
            out[i - 1, i] = ADJACENT * (deep + 1) / (max(len(blocks[i - 1].path), len(b.path)) + 1)
        holder = b.path[-2][0] if len(b.path) > 1 else 0
        if holder in last:
            key = last[holder], i
            out[key] = out.get(key, 0.0) + SIBLING
        last[holder] = i
    return [(i, j, w) for (i, j), w in out.items()]


def minimum_cut(costs: Sequence[float], edges: Sequence[tuple[int, int, float]]) -> list[bool]:
    """The labelling (true: content) of least total cost: a positive cost is what it takes
    to call its block boilerplate, a negative one to call it content, an edge's weight to
    call its ends differently. Dinic's maximum flow from content to boilerplate; blocks
    that the source still reaches are content."""
    n = len(costs)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: float, back: float) -> None:
        at[a].append(len(to))
        to.append(b)
        room.append(forth)
        at[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, c in enumerate(costs):
        if c > 0:
            join(source, i, c, 0.0)
        elif c < 0:
            join(i, sink, -c, 0.0)
    for i, j, w in edges:
        join(i, j, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in at[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                del path[cut:]
                a = to[path[-1]] if path else source
                continue
            while turn[a] < len(at[a]):
                e = at[a][turn[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(at[a]):
                path.append(at[a][turn[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                turn[a] += 1
            else:
                break


def main_text(html: str, weights: Sequence[float] = PRIOR) -> str:
    """The content blocks' texts, in page order, a line each."""
    blocks = blocks_of(html)
    labels = minimum_cut([terminal_cost(b, weights) for b in blocks], edges_of(blocks))
    return "\n".join(b.text for b, content in zip(blocks, labels) if content)


def extract(pages: DataFrame, weights: Sequence[float] | None = None) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of pages. weights: those of learn(); fitted on the
    pages themselves if not given.

    Null html counts as empty; a page without content gives the empty text. <br> ends a block. Pages are
    parsed whole, in time that grows with their length, and with its square where thousands of elements stay
    open within each other. Repeated rows and null ids or urls each get a row. Empty table: empty result.
    Other columns, whatever their names, are not read.
    """
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    weights = learn(pages) if weights is None else weights

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            t = [main_text(h, weights) for h in b.html]
            yield pd.DataFrame({"page_id": b.page_id, "url": b.url, "text": t, "n_chars": [len(x) for x in t]})

    rows = pages.select("page_id", "url", text_or_empty("html").alias("html"))
    return rows.mapInPandas(texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
