"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap."""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import table, text_or_empty

#: Words of a training passage and between the starts of two. Longer test items are
#: indexed in units of UNIT words or fewer, so that a passage holds most of one.
PASSAGE, STRIDE, UNIT = 64, 32, 40
#: Share of a unit's own BM25 score that a passage must reach to be looked at closely.
THRESHOLD = 0.5
#: Share of the item's word shingles that the matched passages must have; or of the question's
#: and of the answer's that the document must have, where the two stand apart.
OVERLAP = 0.5
#: Of an item as a whole three words: half of them outlive the change of every sixth word.
ITEM_SHINGLE = 3
QUESTION_SHINGLE, ANSWER_SHINGLE = 5, 2
K1, B = 1.2, 0.75
#: Postings of a block, each with its own greatest impact.
BLOCK = 32
#: Bytes of test items in one index, which is broadcast; more items make more indexes.
INDEX_BYTES = 32 << 20
#: Words of documents taken through the first bound at once.
CHUNK_WORDS = 200_000

WORD = re.compile(r"\w+")
PART = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """An item's words: all but the last sentence, and that; of an item of one sentence,
    all but the last quarter, and that."""
    parts = [w for p in PART.split(text.strip()) if (w := words_of(p))]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    every = words_of(text)
    cut = len(every) - max(1, len(every) // 4)
    return every[:cut], every[cut:]


def grams(words: Sequence[str], n: int) -> set[tuple[str, ...]]:
    """Shingles of n words, or the one of fewer words."""
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def overlap(part: Sequence[str], n: int, text: Sequence[str]) -> float:
    """Share of the part's shingles that the text has; 1 for an empty part."""
    own = grams(part, n)
    size = min(n, len(part))
    return 1.0 if not own else len(own & {tuple(text[i : i + size]) for i in range(len(text) - size + 1)}) / len(own)


def item_overlap(item: Sequence[str], text: Sequence[str], spans: Sequence[tuple[int, int]]) -> float:
    """Share of the item's shingles that the passages (first word, one past the last) of the text have."""
    own, size = grams(item, ITEM_SHINGLE), min(ITEM_SHINGLE, len(item))
    found: set[tuple[str, ...]] = set()
    begin = end = 0
    for a, b in [*sorted(spans), (len(text) + 1, len(text) + 1)]:
        if a > end:  # passages that touch are one stretch
            found.update(own & {tuple(text[i : i + size]) for i in range(begin, end - size + 1)})
            begin = a
        end = max(end, b)
    return len(found) / len(own)


class Index:
    """Postings by term, in unit order, with the unit's BM25 impact as a share of the score
    that its own text has, and in blocks with their greatest impact."""

    def __init__(self, items: Sequence[tuple[int, str]]) -> None:
        self.items = [(i, t) for i, t in items if words_of(t or "")]
        units: list[Counter] = []
        self.item_of: list[int] = []
        for n, (_, text) in enumerate(self.items):
            w = words_of(text)
            step = math.ceil(len(w) / math.ceil(len(w) / UNIT))
            for at in range(0, len(w), step):
                units.append(Counter(w[at : at + step]))
                self.item_of.append(n)
        df = Counter(t for u in units for t in u)
        self.terms = {t: i for i, t in enumerate(sorted(df))}
        mean = sum(map(Counter.total, units)) / max(1, len(units))
        idf = {t: math.log(1 + (len(units) - n + 0.5) / (n + 0.5)) for t, n in df.items()}
        self.docs: list[list[int]] = [[] for _ in df]
        self.impacts: list[list[float]] = [[] for _ in df]
        rest, first = np.zeros(len(units)), [[] for _ in df]
        for d, u in enumerate(units):
            raw = {t: idf[t] * n * (K1 + 1) / (n + K1 * (1 - B + B * u.total() / mean)) for t, n in u.items()}
            own = sum(raw.values())
            for t in sorted(u, key=lambda t: (-df[t], t)):
                impact = raw[t] / own
                self.docs[self.terms[t]].append(d)
                self.impacts[self.terms[t]].append(impact)
                # The first bound leaves out a unit's most common terms, half the threshold's worth.
                if rest[d] + impact < THRESHOLD / 2:
                    rest[d] += impact
                else:
                    first[self.terms[t]].append((d, impact))
        self.most = [max(x) for x in self.impacts]
        self.block_most = [[max(x[i : i + BLOCK]) for i in range(0, len(x), BLOCK)] for x in self.impacts]
        self.block_last = [[x[min(i + BLOCK, len(x)) - 1] for i in range(0, len(x), BLOCK)] for x in self.docs]
        # The first bound's postings, end to end.
        self.rest = rest
        self.first_len = np.array([len(x) for x in first], np.int64)
        self.first_at = np.concatenate([[0], np.cumsum(self.first_len)])[:-1].astype(np.int64) if first else np.zeros(0, np.int64)
        flat = [p for x in first for p in x]
        self.first_doc = np.array([d for d, _ in flat], np.int64)
        self.first_impact = np.array([i for _, i in flat])
        self.parts = [question_and_answer(t) for _, t in self.items]
        self.words = [words_of(t) for _, t in self.items]

    def search(self, terms: Sequence[int], theta: float = THRESHOLD) -> list[tuple[int, float]]:
        """Block-max WAND: all units (unit, score) whose score for these distinct terms is theta or more."""
        docs, impacts, most = self.docs, self.impacts, self.most
        at = {t: 0 for t in terms}
        found = []

        def seek(t: int, d: int) -> None:
            at[t] = bisect_left(docs[t], d, at[t])

        while True:
            live = sorted((docs[t][i], t) for t, i in at.items() if i < len(docs[t]))
            bound, pivot = 0.0, -1
            for n, (_, t) in enumerate(live):
                bound += most[t]
                if bound >= theta - 1e-9:
                    pivot = n
                    break
            if pivot < 0:
                return found
            d = live[pivot][0]
            while pivot + 1 < len(live) and live[pivot + 1][0] == d:
                pivot += 1
            before = live[: pivot + 1]
            blocks = [(t, bisect_left(self.block_last[t], d)) for _, t in before]
            tight = sum(self.block_most[t][b] for t, b in blocks if b < len(self.block_most[t]))
            if tight < theta - 1e-9:  # no unit up to the end of the nearest block can do
                ends = [self.block_last[t][b] + 1 for t, b in blocks if b < len(self.block_last[t])]
                if pivot + 1 < len(live):
                    ends.append(live[pivot + 1][0])
                target = max(d + 1, min(ends))
                for _, t in before:
                    seek(t, target)
            elif before[0][0] == d:
                score = sum(impacts[t][at[t]] for _, t in before)
                if score >= theta - 1e-9:
                    found.append((d, score))
                for _, t in before:
                    at[t] += 1
            else:
                for e, t in before:
                    if e < d:
                        seek(t, d)

    def passages(self, terms: np.ndarray, owner_words: np.ndarray) -> list[tuple[int, int, int]]:
        """Of documents given as term numbers (-1: none), end to end, with their word counts:
        (document, first word, one past the last) of the passages that can reach the threshold.

        This is WAND's bound, for all passages at once: what a unit's terms outside its
        most common ones give, plus the most that those could give.
        """
        ends = np.cumsum(owner_words)
        starts = ends - owner_words
        windows = np.maximum(1, -(-owner_words // STRIDE))
        first_window = np.concatenate([[0], np.cumsum(windows)])
        at = np.flatnonzero(terms >= 0)
        at = at[self.first_len[terms[at]] > 0]
        doc = np.searchsorted(ends, at, side="right")
        local = (at - starts[doc]) // STRIDE
        window = first_window[doc] + local
        also = local > 0  # a word is in the passage that begins before it and in the one before that
        n_terms = len(self.first_len)
        key = np.unique(np.concatenate([window, window[also] - 1]) * n_terms + np.concatenate([terms[at], terms[at][also]]))
        w, t = key // n_terms, key % n_terms
        size = self.first_len[t]
        entry = np.repeat(self.first_at[t] - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(size.sum())
        pair, where = np.unique(np.repeat(w, size) * len(self.rest) + self.first_doc[entry], return_inverse=True)
        score = np.bincount(where, self.first_impact[entry], len(pair)) + self.rest[pair % max(1, len(self.rest))]
        hot = np.unique(pair[score >= THRESHOLD - 1e-9] // max(1, len(self.rest)))
        d = np.searchsorted(first_window, hot, side="right") - 1
        begin = (hot - first_window[d]) * STRIDE
        return [(int(i), int(a), int(min(a + PASSAGE, owner_words[i]))) for i, a in zip(d, begin)]

    def matches(self, texts: Sequence[str]) -> list[list[tuple[int, float, float, float, float]]]:
        """For each text: (item id, best score, item, question and answer overlap) of the items that it has."""
        out: list[list[tuple[int, float, float, float, float]]] = [[] for _ in texts]
        if not self.terms:
            return out
        at = 0
        while at < len(texts):
            chunk: list[list[str]] = []
            total = 0
            while at + len(chunk) < len(texts) and (not chunk or total < CHUNK_WORDS):
                chunk.append(words_of(texts[at + len(chunk)]))
                total += len(chunk[-1])
            counts = np.array([len(w) for w in chunk], np.int64)
            get = self.terms.get
            terms = np.fromiter((get(w, -1) for ws in chunk for w in ws), np.int64, total)
            begin = np.cumsum(counts) - counts
            best: dict[tuple[int, int], float] = {}
            spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
            for doc, a, b in self.passages(terms, counts):
                asked = terms[begin[doc] + a : begin[doc] + b]
                for unit, score in self.search(sorted({int(t) for t in asked if t >= 0})):
                    k = doc, self.item_of[unit]
                    best[k] = max(best.get(k, 0.0), score)
                    spans.setdefault(k, []).append((a, b))
            for (doc, n), score in sorted(best.items()):
                question, answer = self.parts[n]
                whole = item_overlap(self.words[n], chunk[doc], spans[doc, n])
                q = overlap(question, QUESTION_SHINGLE, chunk[doc])
                a = overlap(answer, ANSWER_SHINGLE, chunk[doc])
                # No answer is marked: the guess at one may add a match, never veto one.
                if whole >= OVERLAP or (q >= OVERLAP and a >= OVERLAP):
                    out[at + doc].append((self.items[n][0], min(score, 1.0), whole, q, a))
            at += len(chunk)
        return out


_indexes: dict[str, Index] = {}


def _index(name: str, shared) -> Index:
    """The index of the items broadcast under this name, built once in a worker; a worker keeps those of
    one benchmark."""
    own = name.partition("/")[0]
    for other in [k for k in _indexes if k.partition("/")[0] != own]:
        del _indexes[other]
    if name not in _indexes:
        _indexes[name] = Index(shared.value)
    return _indexes[name]


MATCH = "array<struct<item_id:long,score:double,item_overlap:double,question_overlap:double,answer_overlap:double>>"


def _matcher(name: str, shared):
    names = ("item_id", "score", "item_overlap", "question_overlap", "answer_overlap")

    @F.pandas_udf(MATCH)
    def matched(text: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(names, m)) for m in ms] for ms in _index(name, shared).matches([*text])], dtype=object)

    return matched


def matches(benchmark: DataFrame) -> Column:
    """A column for the column `text`: the test items that it contains.

    The items are broadcast in blocks of INDEX_BYTES, by their measured size; each
    block is an index of its own, kept by each worker, and a text is held against all of them: memory
    grows with the benchmark, by some times its own size. Items
    without words match nothing; a null item_id counts as -1.
    """
    items = benchmark.select(F.coalesce("item_id", F.lit(-1)).cast("long").alias("item_id"), text_or_empty().alias("text")).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / INDEX_BYTES))
    sc, name = benchmark.sparkSession.sparkContext, uuid.uuid4().hex
    found = []
    for n in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == n).orderBy("item_id", "text").collect()  # INDEX_BYTES or so
        found.append(_matcher(f"{name}/{n}", sc.broadcast([(r.item_id, r.text) for r in rows]))(text_or_empty()))
    return reduce(F.concat, found) if len(found) > 1 else found[0]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, item_overlap, question_overlap, answer_overlap: one row for each row of
    docs and each test item that it contains.

    A passage of the document must reach THRESHOLD of a unit's BM25 score, and the passages
    that do hold OVERLAP of the item's shingles; or else the document that share of the
    question's and of the (guessed) answer's. Null and empty texts
    contain nothing. Equal rows and null ids each get their own rows. No items: no rows.
    Texts are searched whole. Other columns are not read.
    """
    rows = docs.select("doc_id", matches(benchmark).alias("m"))
    return rows.select("doc_id", F.explode("m").alias("m")).select("doc_id", "m.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that contain a test item; all columns, whatever they are named.

    Null and empty texts contain nothing and stay; so do rows without an id. Repeated rows stay or go together. Texts are
    searched whole. No items, or no documents: docs as they are.
    """
    return docs.where(F.size(matches(benchmark)) == 0)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
