"""Toxicity by compression distance to zstandard dictionaries.

Two dictionaries are cut from running text: one from labelled toxic documents, one from
ordinary ones. A window of text is compressed with each; what the toxic one saves is
evidence, and a document is as toxic as its most toxic passage, however long the rest.
zstandard finds matches of bytes, so words are written as codes of eight bytes first: else
syllables that all words share would drown the words that matter.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import bounded_broadcast, table, text_or_empty

#: Labelled documents of each class that the classifier is fitted on, at most; by a
#: hash of doc_id. Scoring takes every document and every window.
SAMPLE = 4_000
#: Segments of toxic text that the toxic dictionary may begin with: the number is the one
#: that tells apart best the documents that a dictionary was not cut from.
SEGMENTS = (2, 3, 4, 8, 16, 32, 64, 80, 96, 128, 256, 512)
#: Words that the ordinary text in both dictionaries covers, the most frequent ones.
ORDINARY_WORDS = 8_192
#: Parts of the sample: each is measured with dictionaries cut from the others.
PARTS = 3
#: Words of a window, windows of a passage, bytes that a window must save to count.
WINDOW, PASSAGE, SAVED = 32, 8, 3
CODE = 8
LEVEL = 6
#: zstandard cannot match the outermost bytes of a dictionary.
EDGE = bytes(2 * CODE)
#: What a text's last window is filled up with: bytes that no dictionary has.
FILL = hashlib.shake_128(b"fill").digest(WINDOW * CODE)
#: Bytes that end every window and both dictionaries: zstandard leaves alone what it could shorten by a
#: few bytes only, and so a single match would not show.
PAD = hashlib.shake_128(b"pad").digest(8 * CODE)
WORD = re.compile(r"\w+")
#: Codes that a worker keeps; beyond that it starts afresh.
KEPT = 150_000


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; 0: held out. A null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5, F.lit(-1))


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


_codes: dict[str, bytes] = {}


def coded(words: Sequence[str]) -> bytes:
    """Words as hashes of eight bytes each."""
    codes, out = _codes, []
    if len(codes) > KEPT:
        codes.clear()
    for w in words:
        c = codes.get(w)
        if c is None:
            c = codes[w] = hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=CODE).digest()
        out.append(c)
    return b"".join(out)


@dataclass(frozen=True)
class Model:
    toxic: bytes = b""
    ordinary: bytes = b""
    weights: tuple[float, float] = (-30.0, 0.0)  # without labels nothing is toxic

    def score(self, text: str) -> float:
        x = self.weights[0] + self.weights[1] * (evidence(coded(words_of(text)), self.toxic, self.ordinary) if self.weights[1] else 0.0)
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


@lru_cache(maxsize=4)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    p = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=WINDOW * CODE + len(PAD), dict_size=len(content), write_content_size=False, write_dict_id=False)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=p)


def evidence(codes: bytes, toxic: bytes, ordinary: bytes) -> float:
    """Log of the bytes that the toxic dictionary saves, against the ordinary one, in the
    passage where it saves the most. Text around that passage changes nothing."""
    near, far = _compressor(toxic).compress, _compressor(ordinary).compress
    step, most, now = WINDOW * CODE, 0, 0
    gains: list[int] = []
    for i in range(0, len(codes), step):
        w = codes[i : i + step]
        w += FILL[len(w) :] + PAD
        gain = len(far(w)) - len(near(w))
        gains.append(gain if gain >= SAVED else 0)
        now += gains[-1] - (gains[-1 - PASSAGE] if len(gains) > PASSAGE else 0)
        most = max(most, now)
    return float(np.log1p(most))


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each class and part that have a word, counted within a batch."""
    for b in batches:
        n: Counter = Counter()
        for text, y, part in zip(b.text, b.toxic, b.part):
            n.update((w, bool(y), int(part)) for w in set(words_of(text)))
        yield pd.DataFrame([(*k, v) for k, v in n.items()], columns=["word", "toxic", "part", "n"])


def _apart(t: Column, o: Column, n_toxic: int, n_other: int) -> Column:
    """How much more often toxic documents have a word, at the least: the lower bound
    (of 95 %) of the log odds, so that words of few documents come late."""
    odds = F.log((t + 0.5) / (o + 0.5) * ((n_other + 1) / (n_toxic + 1)))
    return odds - 1.96 * F.sqrt(1 / (t + 0.5) + 1 / (o + 0.5))


@dataclass(frozen=True)
class Ranks:
    """For the documents outside one part (none: all): toxic words, the most telling first;
    ordinary words, the most frequent first; both of bounded number."""

    left_out: int | None
    toxic: list[str]
    ordinary: list[str]


def ranked(counts: DataFrame, sizes: dict[tuple[bool, int], int], left_out: int | None) -> Ranks:
    def of(y: bool) -> tuple[Column, int]:
        parts = [p for p in range(PARTS) if p != left_out]
        return sum((F.col(f"{'t' if y else 'o'}{p}") for p in parts), F.lit(0)), sum(sizes.get((y, p), 0) for p in parts)

    (t, n_toxic), (o, n_other) = of(True), of(False)
    rows = counts.select("word", t.alias("t"), o.alias("o"))
    toxic = rows.where("t > 0").orderBy(_apart(F.col("t"), F.col("o"), n_toxic, n_other).desc(), "word").limit(max(SEGMENTS))
    ordinary = rows.where("o > 0").orderBy(F.col("o").desc(), "word").limit(ORDINARY_WORDS)
    return Ranks(left_out, [r.word for r in toxic.collect()], [r.word for r in ordinary.collect()])


def segments(sample: DataFrame, ranks: Sequence[Ranks]) -> dict[tuple[bool, int, str], tuple[int, list[str]]]:
    """By class, part and ranked word: a segment of up to three words of running text around
    it, with its rank: that whose other words are the most ordinary. A toxic segment ends
    before a word that is not ordinary: by itself it would stand for nothing. As many
    as ranked words at most for each part and class."""
    wanted = sample.sparkSession.sparkContext.broadcast(({w for r in ranks for w in r.toxic}, {w: i for r in reversed(ranks) for i, w in enumerate(r.ordinary)}))

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        telling, order = wanted.value
        for b in batches:
            best: dict[tuple[bool, int, str], tuple[int, list[str]]] = {}
            for text, y, part in zip(b.text, b.toxic, b.part):
                words = words_of(text)
                for i, w in enumerate(words):
                    if w not in (telling if y else order):
                        continue
                    seg = words[max(0, i - 1) : i + 2]
                    if y:
                        seg = [v for v in seg if v == w or v in order]
                    rank = max((0 if y and v in telling else order.get(v, ORDINARY_WORDS) for v in seg if v != w), default=ORDINARY_WORDS) + ORDINARY_WORDS * (3 - len(seg))
                    k = bool(y), int(part), w
                    if k not in best or (rank, seg) < best[k]:
                        best[k] = rank, seg
            yield pd.DataFrame([(*k, *v) for k, v in best.items()], columns=["toxic", "part", "word", "rank", "seg"])

    rows = sample.mapInPandas(found, "toxic boolean, part int, word string, rank int, seg array<string>").groupBy("toxic", "part", "word").agg(F.min(F.struct("rank", "seg")).alias("s"))
    of_words = rows.select("toxic", "part", "word", "s.rank", "s.seg").toPandas()
    wanted.destroy()
    return {(bool(y), int(p), w): (int(r), list(seg)) for y, p, w, r, seg in of_words.itertuples(index=False)}


def dictionaries(r: Ranks, found: dict[tuple[bool, int, str], tuple[int, list[str]]]) -> list[tuple[bytes, bytes]]:
    """For each number of segments, the contents of the toxic and of the ordinary dictionary.

    Both end in the same ordinary text, at the same distance from what is compressed; before
    it, one has the most telling segments of toxic text, the other as much more ordinary text.
    """

    def filled(words: Iterable[str], toxic: bool) -> list[list[str]]:
        out, covered = [], set()
        for w in words:
            mine = [found[toxic, p, w] for p in range(PARTS) if p != r.left_out and (toxic, p, w) in found]
            if w not in covered and mine:
                out.append(min(mine)[1])
                covered.update(out[-1])
        return out

    content = lambda segs: coded([w for s in reversed(segs) for w in s])
    telling = filled(r.toxic, True)
    # What stands beside telling words is shared before all else.
    every = filled([*(w for s in telling for w in s), *r.ordinary], False)
    common, rest = every[: len(every) * 3 // 4], content(every[len(every) * 3 // 4 :]) or EDGE
    shared = content(common)
    out = []
    for n in SEGMENTS:
        own = content(telling[:n])
        out.append(tuple(EDGE + x + shared + PAD + EDGE for x in (own, (rest * (len(own) // len(rest) + 1))[: len(own)])))
    return out


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method, with steps halved until they help."""
    b = np.zeros(x.shape[1])
    loss = lambda b: np.sum(w * (np.logaddexp(0, x @ b) - y * (x @ b))) + ridge / 2 * b @ b
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (w * (y - p)) - ridge * b)
        while np.abs(step).max() > 1e-8 and loss(b + step) > loss(b):
            step = step / 2
        b = b + step
        if np.abs(step).max() <= 1e-8:
            break
    return b


def _threshold(p: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """The best F1, and the score from which a document is called toxic for it: half-way to the score below."""
    order = np.argsort(-p, kind="stable")
    p, right, called = p[order], np.cumsum((w * y)[order]), np.cumsum(w[order])
    last = np.flatnonzero(np.append(p[1:] != p[:-1], True))
    f1 = 2 * right[last] / (called[last] + (w * y).sum())
    best = last[np.argmax(f1)]
    return float(f1.max()), float((p[best] + (p[best + 1] if best + 1 < len(p) else 0.0)) / 2)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Cuts the dictionaries and calibrates what they save, on labelled rows outside the
    held-out fold; each document of the sample is measured with dictionaries that were cut
    from others. What reaches the driver is bounded: ranked words, a segment for each, and
    a number for each sampled document and size of dictionary."""
    known = labels.where("toxic is not null").where(fold_of(F.col("doc_id")) > 0).groupBy(F.col("doc_id").alias("id")).agg((F.max("toxic") > 0).alias("toxic"))
    found = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    shares = {y: min(1.0, sample / n) for y, n in found.items()}
    lot = F.pmod(F.xxhash64(F.col("id"), F.lit("toxicity")), F.lit(1_000_000)) / 1e6
    known = known.where(lot < F.when(F.col("toxic"), F.lit(shares.get(True, 0.0))).otherwise(F.lit(shares.get(False, 0.0))))
    # The sample's ids are few: they go to the documents, not the texts through a shuffle.
    rows = docs.select(F.col("doc_id").alias("id"), text_or_empty().alias("text")).join(bounded_broadcast(known, 4 * sample), "id")
    # Copies tell nothing new and would pass their words off as telling.
    rows = rows.groupBy(F.md5("text").alias("m"), "toxic").agg(F.first("text").alias("text"))
    rows = rows.select("text", "toxic", F.pmod(F.xxhash64("m"), F.lit(PARTS)).cast("int").alias("part")).persist()
    sizes = {(r.toxic, r.part): r.n for r in rows.groupBy("toxic", "part").agg(F.count("*").alias("n")).collect()}
    if len({y for y, _ in sizes}) < 2:
        rows.unpersist()
        return Model(weights=(30.0 if any(y for y, _ in sizes) else -30.0, 0.0))
    n = lambda y, p: F.sum(F.when((F.col("toxic") == y) & (F.col("part") == p), F.col("n")).otherwise(0)).alias(f"{'t' if y else 'o'}{p}")
    counts = rows.mapInPandas(_word_counts, "word string, toxic boolean, part int, n long").groupBy("word").agg(*(n(y, p) for y in (True, False) for p in range(PARTS))).persist()
    ranks = [ranked(counts, sizes, p) for p in (*range(PARTS), None)]
    counts.unpersist()
    of_words = segments(rows, ranks)
    contents = [dictionaries(r, of_words) for r in ranks]
    shared = docs.sparkSession.sparkContext.broadcast(contents)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            codes, x = [coded(words_of(t)) for t in b.text], np.zeros((len(b), len(SEGMENTS)))
            for part in range(PARTS):
                rows = np.flatnonzero(b.part == part)
                for i, pair in enumerate(shared.value[part]):  # one pair of compressors at a time
                    x[rows, i] = [evidence(codes[j], *pair) for j in rows]
            yield pd.DataFrame({"toxic": b.toxic, "x": list(x)})

    m = rows.mapInPandas(measured, "toxic boolean, x array<double>").toPandas()
    shared.destroy()
    rows.unpersist()
    y = m.toxic.to_numpy(float)
    weight = np.where(y > 0, 1 / shares[True], 1 / shares[False])
    weight /= weight.mean()
    best = None
    for i, x in enumerate(np.array(m.x.tolist()).T):
        x = np.column_stack([np.ones(len(x)), x])
        b = _logistic(x, y, weight)
        b[1] = max(b[1], 0.0)
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        f1, cut = _threshold(p, y, weight)
        cut = np.clip(cut, 1e-9, 1 - 1e-9)
        rank = round(f1, 6), -np.sum(weight * (np.logaddexp(0, x @ b) - y * (x @ b)))
        if best is None or rank > best[0]:
            best = rank, (float(b[0] - np.log(cut / (1 - cut))), float(b[1])), contents[-1][i]
    return Model(*best[2], best[1])


def score(model: Model) -> Column:
    """A column of scores in 0 to 1 for the column `text`; a null text scores as an empty one."""

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in text], dtype="float64")

    return scored(text_or_empty())


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that score 0.5 or more; all columns as they were, whatever
    they are named. Each row is judged by its own text alone: repeated rows, rows that share
    an id and rows without one are each kept or not, null texts as empty ones, long texts by
    their most toxic passage. Without labels of both classes, all or none go. Empty table: empty."""
    return docs.where(score(learn(docs, labels)) < 0.5)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of 0.5 on, that one included), a row
    a row of documents. A null id is not held out, and learned from no label.

    Null, empty and very long texts, repeated rows and texts without any known word are scored as by `score`, each
    row by its whole text. No labels, or no documents of a class: all get one score below 0.5. Empty table: no
    rows. Other columns are not read.
    """
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), score(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
