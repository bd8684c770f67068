"""Document fingerprints from closed syncmers, compared by the anchors' positions."""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import partitions, table, text_or_empty

#: Code points of a k-mer and of its inner substrings. A third of all k-mers or
#: fewer, 2 / (K - S + 1), are closed syncmers.
K, S = 20, 11
#: Hashes that the written form of a fingerprint shows, the least; likeness takes all.
SKETCH = 256
#: Bytes of text of a range of ids, and its rows at the least.
RANGE_BYTES, RANGE_ROWS = 32 << 20, 64
#: Values of the number by which rows of one id and text are dealt to ranges.
LOTS = 1 << 20
#: Code points hashed at once; a longer text is cut into overlapping stretches.
STRETCH = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers have inverses mod 2^64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(cls, name, np.cumprod(powers, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


def _windows(prefix: np.ndarray, down: np.ndarray, width: int) -> np.ndarray:
    """A hash of each window of `width` code points, the same wherever it stands."""
    n = len(prefix) - width
    return _mixed((prefix[width:] - prefix[:n]) * down[:n])


def _stretch(points: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _Powers.of(len(points) + 1)
    prefix = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=prefix[1:])
    inner = _windows(prefix, down, s)
    span = k - s + 1
    least, width = inner, 1
    while width < span:  # minima of windows of doubling width
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    n = len(points) - k + 1
    at = np.flatnonzero((inner[:n] == least) | (inner[span - 1 : span - 1 + n] == least))
    return at, _windows(prefix, down, k)[at]


def syncmers(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the text's closed syncmers: the k-mers whose least
    s-mer (by hash) is their first or last. Whether a k-mer is one depends on itself
    alone. A text of fewer than k code points is its only anchor; an empty one has none.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(points) < k:
        digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        return np.zeros(1, np.int64), np.frombuffer(digest, np.uint64)
    parts = [(start, *_stretch(points[start : start + STRETCH + k - 1], k, s)) for start in range(0, len(points) - k + 1, STRETCH)]
    return np.concatenate([start + at for start, at, _ in parts]), np.concatenate([h for _, _, h in parts])


#: Positions and hashes of all of a text's anchors.
Anchors = tuple[np.ndarray, np.ndarray]


def written_out(anchors: Anchors, size: int = SKETCH) -> str:
    """A digest of all anchors with their positions, and the `size` least distinct hashes,
    ascending, 16 hex digits each; '' for an empty text."""
    at, hashes = anchors
    if not len(at):
        return ""
    whole = hashlib.blake2b(at.astype("<i8").tobytes() + hashes.astype("<u8").tobytes(), digest_size=8).hexdigest()
    return whole + np.unique(hashes)[:size].astype(">u8").tobytes().hex()


def _numbered(hashes: np.ndarray) -> np.ndarray:
    """Hashes of (hash, how many anchors before it have the same)."""
    order = np.argsort(hashes, kind="stable")
    new = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(hashes)), 0))
    nth = np.empty(len(hashes), np.uint64)
    nth[order] = (np.arange(len(hashes)) - first).astype(np.uint64)
    return _mixed(hashes + nth * _BASE)


def chain(a: Anchors, b: Anchors) -> int:
    """Anchors of the longest chain: those that both texts have, in the same order of
    positions. Of an anchor that repeats, the n-th meets the n-th."""
    _, x, y = np.intersect1d(_numbered(a[1]), _numbered(b[1]), assume_unique=True, return_indices=True)
    y = y[np.argsort(x)]
    if len(y) < 2 or (y[1:] > y[:-1]).all():
        return len(y)
    ends: list[int] = []  # the least end of a chain of each length
    for v in y.tolist():
        n = bisect_left(ends, v)
        ends[n : n + 1] = [v]
    return len(ends)


def likeness(a: Anchors, b: Anchors) -> float:
    """Anchors in the longest chain, of all that either text has: 1 for texts of the same
    anchors in the same order, lower for each that is changed, moved, or in one only."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    n = chain(a, b)
    return n / (len(a[0]) + len(b[0]) - n)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the order: last (no id), down (falls as doc_id rises), h (of the text).
    lot: deals rows that are equal in all of it; it decides no order."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    down = F.bitwise_not(F.coalesce(F.col("doc_id"), F.lit(0)).cast("long"))
    lot = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(LOTS))
    return rows.select("*", F.col("doc_id").isNull().cast("int").alias("last"), down.alias("down"), F.xxhash64("text").alias("h"), lot.alias("lot"))


def _bounds(rows: DataFrame) -> list[tuple[int, int, int, int]]:
    """The least key of each range but the first: ranges of about as many rows, found
    by dealing the keys alone, with no texts. Rows of one id and text that fill whole ranges are cut
    at even lots; fewer stay together."""
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    n = min(max(partitions(rows.sparkSession), (size.b or 0) // RANGE_BYTES), size.n // RANGE_ROWS)
    if n < 2:
        return []
    key = F.struct("last", "down", "h", "lot")
    dealt = rows.select("last", "down", "h", "lot").repartitionByRange(n, "last", "down", "h", "lot")
    ends = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("head"), F.max(key).alias("end")).orderBy("head").collect()  # one a range
    found: list[tuple[int, int, int, int]] = []
    inside: list[tuple[int, int, int]] = []  # bounds within rows of one id and text
    for i, r in enumerate(ends[1:], 1):
        mine, before = tuple(r.head)[:3], tuple(ends[i - 1].end)[:3]
        if inside and mine != inside[0]:
            found += _even(inside)
            inside = []
        if mine == before:
            inside.append(mine)
        else:
            found.append((*mine, -1))
    return found + _even(inside)


def _even(inside: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    m = len(inside)
    return [(*k, LOTS * (i + 1) // (m + 1)) for i, k in enumerate(inside)] if m > 1 else []


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """bucket, doc_id, text, mine, and the order's columns: docs' rows cut into ranges of the
    order, and for each range, as its last row (mine false), the row that follows: the first of
    the next range. Also the number of ranges.

    Order: doc_id descending, null last, then a hash of the text. After the last row comes
    the first. What is collected is a key a range.
    """
    rows = _keyed(docs)
    bounds = _bounds(rows)

    @F.pandas_udf("int")
    def bucket(last: pd.Series, down: pd.Series, h: pd.Series, lot: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, k) for k in zip(last.tolist(), down.tolist(), h.tolist(), lot.tolist())], dtype="int32")

    order = ["last", "down", "h"]
    least = rows.agg(F.min(F.struct(*order)).alias("k")).first().k
    mine = rows.select(bucket(*order, "lot").alias("bucket"), "doc_id", "text", *order, F.lit(True).alias("mine"))
    if least is None:
        return mine, 1
    heads = [tuple(least), *(b[:3] for b in bounds)]
    before = docs.sparkSession.createDataFrame([((i - 1) % len(heads), *k) for i, k in enumerate(heads)], "bucket int, last int, down long, h long")
    first = rows.join(F.broadcast(before.select(*order).distinct()), order).groupBy("doc_id", *order).agg(F.max("text").alias("text"))
    guests = first.join(F.broadcast(before), order).select("bucket", "doc_id", "text", *order, F.lit(False).alias("mine"))
    return mine.unionByName(guests), len(heads)


def edited(text: str, following: str) -> str:
    """text, its last third's code points replaced by as many of what follows, or all."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted; each needs the row after it."""
    held = None
    for b in batches:
        out = []
        for doc, text, mine in zip(b.doc_id, b.text, b.mine):
            f = syncmers(text)
            if held is not None:
                doc0, text0, f0 = held
                new = edited(text0, text)
                g = syncmers(new)
                out.append((doc0, len(text0), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), written_out(f0), written_out(g), likeness(f0, g), likeness(f0, f)))
            held = (None if pd.isna(doc) else int(doc), text, f) if mine else None
        yield pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]).astype({"doc_id": "Int64"})


def compare_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Likeness is reckoned from all anchors and their order. Null text counts as empty: no
    syncmers, fingerprint '', likeness 1 to an empty text and 0 to any other. Equal texts have
    equal fingerprints. Rows that share a doc_id, or have none, follow each other by a hash of
    their texts; equal rows follow each other, and any number of them is spread over ranges.
    The only row of a table is followed by itself. Texts are taken whole. Empty
    table: empty result. Other columns are not read.
    """
    rows, ranges = with_next(docs)
    # One shuffle of texts: each range meets in a task, which streams through it.
    dealt = rows.repartitionById(ranges, "bucket").sortWithinPartitions(F.col("mine").desc(), "last", "down", "h").select("doc_id", "text", "mine")
    return dealt.mapInPandas(_compared, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(table(spark, sf_dir, "documents"))
