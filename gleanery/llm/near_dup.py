"""Near-duplicate documents: DartMinHash signatures, banded join, exact check.

Two texts are near-duplicates if their word shingles are alike, as bags (weighted by their
counts) or as sets. A text whose shingles repeat has a signature of each kind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import bounded_broadcast, table, text_or_empty, unused, written
from gleanery.llm.components import components

#: Words of a shingle; similarity from which two documents are near-duplicates.
SHINGLE, SIMILAR = 5, 0.8
#: Two documents of similarity 0.8 agree on none of the bands once in 14,000 times.
BANDS, ROWS = 24, 5
#: Signatures that agree on less than this share of coordinates are not compared as
#: texts: 4 standard errors below SIMILAR.
HOPELESS = 0.65
#: Documents of a block where a bucket's members are compared one by one.
BLOCK = 512
#: Shingle bytes of a block where all members of a class are compared; classes of one block
#: or less share tasks up to as many.
CLASS_BYTES = 16 << 20
#: Cells of the incidence matrices that are multiplied at once.
CELLS = 1 << 22
#: Code points hashed at once.
CHUNK = 1 << 18
#: Narrow rows up to which a table of ids is broadcast.
SMALL = 500_000

_U = np.uint64
_BASE = _U(0xD1342543DE82EF95)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _times(a: int, b: int) -> np.uint64:
    return _U(a * b % (1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the runs without ASCII white space in UTF-8 data."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~((raw == 32) | ((raw >= 9) & (raw <= 13))), [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + _U(1)) * _powers(_BASE, len(raw)))])
    down = _powers(_INVERSE, len(raw) + 1)
    return start, _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(texts: Sequence[str], size: int = SHINGLE) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text, its distinct word shingles (lower case, as hashes) and their counts.
    A text of fewer words is one shingle; one without words has none."""
    data = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    start, words = _word_hashes(b"\n".join(data) + b"\n")
    bounds = np.searchsorted(start, np.cumsum([0, *(len(d) + 1 for d in data)]))
    mixed = words
    factors = [_times(2 * i + 3, 0x9E3779B97F4A7C15) for i in range(size)]
    if len(words) >= size:
        n = len(words) - size + 1
        mixed = _mix(sum((words[i : i + n] * factors[i] for i in range(size)), np.zeros(n, np.uint64)))
    out = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= size:
            out.append(np.unique(mixed[a : b - size + 1], return_counts=True))
        elif b > a:
            whole = _mix(sum((words[a + i : a + i + 1] * factors[i] for i in range(b - a)), np.full(1, b - a, np.uint64)))
            out.append((whole, np.ones(1, np.int64)))
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    return out


def repeats(shingled: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each occurrence of a shingle but its first, a hash of the shingle and its number: with
    these, two bags share as many elements as the lesser counts of each shingle add up to."""
    h, n = shingled
    more = np.flatnonzero(n > 1)
    if not len(more):
        return np.zeros(0, np.uint64)
    again = np.repeat(h[more], n[more] - 1)
    first = np.repeat(np.cumsum(n[more] - 1) - (n[more] - 1), n[more] - 1)
    nth = (np.arange(len(again)) - first + 2).astype(np.uint64)
    return np.unique(_mix(again + nth * _U(0x9FB21C651E98DF25)))


def _likeness(shared: np.ndarray, again: np.ndarray, sizes: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Of sets and of bags, the greater similarity; sizes and repeated: of both sides together."""
    bags = (shared + again) / np.maximum(sizes + repeated - shared - again, 1)
    return np.maximum(shared / np.maximum(sizes - shared, 1), bags)


def _unit(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((h >> _U(11)).astype(np.float64) + 1) / float(1 << 53)


def dart_signatures(sets: Sequence[tuple[np.ndarray, np.ndarray]], k: int = BANDS * ROWS) -> np.ndarray:
    """DartMinHash signatures (k 32-bit coordinates each) of weighted sets (elements, weights).

    Darts fall on the plane of weight and rank over each element, at a rate of one a
    unit of area, the same for whoever has the element. Its weight axis is cut into
    regions of doubling width; in each, darts come in the order of rank, with hashed
    gaps. A set is hit by the darts below its element's weight. Each dart goes to a
    hashed coordinate, and each coordinate keeps the earliest. Only darts of rank up
    to t over the set's total weight are thrown, about t in all, however many elements
    there are; sets that leave a coordinate empty throw twice as far.

    Two sets agree on a coordinate with a probability of their weighted Jaccard similarity.
    """
    out = np.zeros((len(sets), k), np.uint32)
    total = np.array([float(w.sum()) for _, w in sets])
    todo = np.flatnonzero(total > 0)
    t = k * (np.log(k) + 4)
    while len(todo):
        items = np.concatenate([sets[i][0] for i in todo])
        weight = np.concatenate([sets[i][1] for i in todo]).astype(np.float64)
        owner = np.repeat(np.arange(len(todo)), [len(sets[i][0]) for i in todo])
        far = t / total[todo]
        keys, ranks, ids = [], [], []
        region = 0
        live = np.arange(len(items))
        while len(live):
            low, width = float((1 << region) - 1), float(1 << region)
            e, own, w = _mix(items[live] + _times(region + 1, 0xA24BAED4963EE407)), owner[live], weight[live]
            rank, j = np.zeros(len(e)), 0
            while len(e):
                j += 1
                h = _mix(e + _times(j, 0x9FB21C651E98DF25))
                rank = rank - np.log(_unit(h)) / width
                near = rank <= far[own]
                e, own, w, rank, h = e[near], own[near], w[near], rank[near], h[near]
                g = _mix(h ^ _U(0xC2B2AE3D27D4EB4F))
                hit = low + _unit(g) * width <= w
                d = _mix(g + _U(0x165667B19E3779F9))[hit]
                keys.append(own[hit] * k + ((d >> _U(32)) % _U(k)).astype(np.int64))
                ranks.append(rank[hit])
                ids.append((d & _U(0xFFFFFFFF)).astype(np.uint32))
            region += 1
            live = live[weight[live] > float((1 << region) - 1)]
        key, rank, dart = np.concatenate(keys), np.concatenate(ranks), np.concatenate(ids)
        latest_first = np.argsort(-rank, kind="stable")
        flat, filled = np.zeros(len(todo) * k, np.uint32), np.zeros(len(todo) * k, bool)
        flat[key[latest_first]] = dart[latest_first]  # the earliest is written last
        filled[key] = True
        full = filled.reshape(-1, k).all(axis=1)
        out[todo[full]] = flat.reshape(-1, k)[full]
        todo, t = todo[~full], 2 * t
    return out


def _bands(signatures: np.ndarray) -> np.ndarray:
    n = len(signatures)
    parts = signatures.reshape(n, BANDS, ROWS).astype(np.uint64)
    factors = np.array([_times(2 * i + 5, 0x9E3779B97F4A7C15) for i in range(ROWS)])
    return _mix((parts * factors).sum(axis=2, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _U(0xD6E8FEB86659FD93)).astype(np.int64)


def _slices(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Where to cut the texts so that each part has CHUNK code points or fewer, or is one text."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > CHUNK:
            yield start, i
            start, size = i, 0
        size += len(t)
    if len(texts) > start:
        yield start, len(texts)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, texts = b.column("id"), b.column("text").to_pylist()
        for at, end in _slices(texts):
            part = texts[at:end]
            # Weights are the shingles' counts; where some repeat, a second signature takes each once.
            bags = shingles(part)
            some = np.array([len(s) > 0 for s, _ in bags], bool)
            twice = np.array([len(s) > 0 and n.max() > 1 for s, n in bags], bool)
            sig = dart_signatures(bags)
            once = dart_signatures([(s, np.ones(len(s))) for (s, _), t in zip(bags, twice) if t])
            more = np.cumsum(twice) - 1
            signatures = [r.tobytes() + (once[more[i]].tobytes() if twice[i] else b"") for i, r in enumerate(sig)]
            bands, also = _bands(sig), _bands(once)
            buckets = [np.union1d(bands[i], also[more[i]]) if twice[i] else bands[i] if some[i] else bands[i][:0] for i in range(len(part))]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in buckets])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(at, end - at),
                    b.column("same").slice(at, end - at),
                    pa.array(signatures, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(buckets), pa.int64())),
                ],
                names=["id", "same", "signature", "bands"],
            )


def _parted(signatures: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The signatures by counts, and those of the sets (the same where nothing repeats)."""
    size = BANDS * ROWS * 4
    parts = (b"".join([bytes(x)[:size] for x in signatures]), b"".join([bytes(x)[-size:] for x in signatures]))
    return tuple(np.frombuffer(p, np.uint32).reshape(len(signatures), -1) for p in parts)


def _alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        if len(b):
            hopeful = np.zeros(len(b), bool)
            for x, y in zip(_parted(b.sa), _parted(b.sb)):
                hopeful |= (x == y).mean(axis=1) >= HOPELESS
            yield b.loc[hopeful, ["a", "b", "hub"]]


def _against_hub(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted: a hub's text, then its partners'."""
    hub = None
    for b in batches:
        rows = []
        for start, end in _slices([*b.text]):
            part = b.iloc[start:end]
            for at, mine, x in zip(part.id, part.partner, shingles([*part.text])):
                y = x[0], repeats(x)
                if not mine:
                    hub = at, y
                    continue
                shared, again = (len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(hub[1], y))
                s = float(_likeness(shared, again, len(hub[1][0]) + len(y[0]), len(hub[1][1]) + len(y[1])))
                if s >= SIMILAR:
                    rows.append((min(hub[0], at), max(hub[0], at), s))
        yield pd.DataFrame(rows, columns=["a", "b", "similarity"]).astype({"a": "int64", "b": "int64", "similarity": "float64"})


#: The texts of a table of text numbers (id), with its other columns.
Texts = Callable[[DataFrame], DataFrame]


def _same() -> Column:
    """The text's hash; texts of the same hash are taken to be equal."""
    return F.unhex(F.md5(text_or_empty()))


def _links(pairs: DataFrame, signatures: DataFrame, texts: Texts, name: str) -> DataFrame:
    """a, b, similarity: those of the pairs (a, b, hub: one of the two) that are near-duplicates by
    their whole texts. A hub's text goes once to each block of its partners."""
    a, b = (signatures.select(F.col("id").alias(x), F.col("signature").alias(f"s{x}")) for x in "ab")
    likely = written(pairs.join(a, "a").join(b, "b").select("a", "b", "hub", "sa", "sb").mapInPandas(_alike, "a long, b long, hub long"), f"{name}-likely")
    own = written(texts(likely.select(F.explode(F.array("a", "b")).alias("id")).distinct()), f"{name}-texts")
    sizes = likely.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).where("blocks > 1")
    met = likely.select("hub", (F.col("a") + F.col("b") - F.col("hub")).alias("id")).join(bounded_broadcast(sizes, SMALL), "hub", "left")
    met = met.select("hub", "id", F.coalesce(F.pmod(F.xxhash64("id"), "blocks"), F.lit(0)).cast("int").alias("block"), F.lit(True).alias("partner"))
    both = met.unionByName(met.select("hub", F.col("hub").alias("id"), "block", F.lit(False).alias("partner")).distinct())
    dealt = both.join(own, "id").repartition("hub", "block").sortWithinPartitions("hub", "block", "partner").select("id", "partner", "text")
    return written(dealt.mapInPandas(_against_hub, "a long, b long, similarity double"), f"{name}-links")


def _stored(shingled: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[pa.Array, pa.Array]:
    return pa.array([h.tobytes() for h, _ in shingled], pa.binary()), pa.array([repeats(x).tobytes() for x in shingled], pa.binary())


def _read(column: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(bytes(x), np.uint64) for x in column]


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, texts = b.column("id"), b.column("text").to_pylist()
        for i, end in _slices(texts):
            part = shingles(texts[i:end])
            yield pa.RecordBatch.from_arrays([ids.slice(i, len(part)), *_stored(part)], names=["id", "shingles", "again"])


def _between_blocks(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
    """Links between the components of two blocks of a bucket (or of one block). Components once linked here are one from then on."""
    bucket, i, j = key
    out: list[tuple[int, int, float]] = []
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    ids, labels, block = b.id.to_numpy(), b.label.to_numpy(), b.block.to_numpy()
    sig, once = _parted(b.signature)
    bands = [np.asarray(x, np.int64) for x in b.bands]  # ascending only where two signatures were joined
    own, again = _read(b.shingles), _read(b.again)
    sets = [frozenset(x.tolist()) for x in bands]
    right = np.flatnonzero(block == j)
    for x in np.flatnonzero(block == i):
        ys = right[ids[right] > ids[x]] if i == j else right
        ys = ys[labels[ys] != labels[x]]
        if len(ys):
            ys = ys[np.maximum((sig[ys] == sig[x]).mean(axis=1), (once[ys] == once[x]).mean(axis=1)) >= HOPELESS]
        for y in ys:
            # Each pair meets in the least bucket that it shares.
            if root(labels[x]) == root(labels[y]) or min(sets[x] & sets[y]) != bucket:
                continue
            shared, twice = (len(np.intersect1d(z[x], z[y], assume_unique=True)) for z in (own, again))
            s = float(_likeness(shared, twice, len(own[x]) + len(own[y]), len(again[x]) + len(again[y])))
            if s >= SIMILAR:
                out.append((min(ids[x], ids[y]), max(ids[x], ids[y]), s))
                parent[root(labels[x])] = root(labels[y])
    return pd.DataFrame(out, columns=["a", "b", "similarity"]).astype({"a": "int64", "b": "int64", "similarity": "float64"})


def _residual(placed: DataFrame, signatures: DataFrame, texts: Texts) -> DataFrame:
    """a, b, similarity: what links different components within the buckets `placed` (bucket,
    id, label). Members are dealt to blocks and each two blocks of a bucket meet in a group of
    bounded size, where pairs are compared and only links come out."""
    ids = placed.select("id").distinct()
    own = texts(ids).mapInArrow(_shingled, "id long, shingles binary, again binary")
    data = written(own.join(signatures, "id"), "residual")
    sizes = placed.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = placed.select("bucket", "id", "label").join(bounded_broadcast(written(sizes, "bucket-sizes"), SMALL), "bucket").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, "block").alias("i"), F.greatest(k, "block").alias("j")))
    met = dealt.select("bucket", "id", "label", "block", F.explode(others).alias("m")).select("bucket", "m.i", "m.j", "id", "label", "block")
    return written(met.join(data, "id").groupBy("bucket", "i", "j").applyInPandas(_between_blocks, "a long, b long, similarity double"), "dup3-links")


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        for i, end in _slices(texts):
            part = shingles(texts[i:end])
            yield pa.RecordBatch.from_arrays([b.column("id").slice(i, len(part)), b.column("label").slice(i, len(part)), *_stored(part)], names=["id", "label", "shingles", "again"])


def _overlaps(x: Sequence[np.ndarray], y: Sequence[np.ndarray]) -> np.ndarray:
    """How many shingles each of x shares with each of y, exactly: products of incidence
    matrices, over stretches of the shingles that both sides have."""
    flat = [np.concatenate(z) for z in (x, y)]
    common = np.intersect1d(*flat)
    found = []
    for z, f in zip((x, y), flat):
        at = np.minimum(np.searchsorted(common, f), max(0, len(common) - 1))
        hit = common[at] == f if len(common) else np.zeros(len(f), bool)
        order = np.argsort(at[hit], kind="stable")
        found.append((at[hit][order], np.repeat(np.arange(len(z)), [len(s) for s in z])[hit][order]))
    out = np.zeros((len(x), len(y)), np.int64)
    width = max(1, CELLS // (len(x) + len(y)))
    for start in range(0, len(common), width):
        end = min(start + width, len(common))
        sides = []
        for z, (at, row) in zip((x, y), found):
            part = slice(*np.searchsorted(at, (start, end)))
            m = np.zeros((len(z), end - start), np.float32)  # sums of up to `width` ones are exact
            m[row[part], at[part] - start] = 1
            sides.append(m)
        out += (sides[0] @ sides[1].T).astype(np.int64)
    return out


def _near_pairs(i: int, j: int, b: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each class: ids, ids and similarity of the near-duplicates between blocks i and j."""
    b = b.sort_values("label", kind="stable")
    ids, labels, block = b.id.to_numpy(), b.label.to_numpy(), b.block.to_numpy()
    own, again = _read(b.shingles), _read(b.again)
    size, extra = (np.array([len(x) for x in z], np.int64) for z in (own, again))
    edge = np.flatnonzero(np.concatenate([[True], labels[1:] != labels[:-1], [True]]))
    for start, end in zip(edge, edge[1:]):
        left, right = (start + np.flatnonzero(block[start:end] == n) for n in (i, j))
        if not len(left) or not len(right):
            continue
        shared, twice = (_overlaps([z[n] for n in left], [z[n] for n in right]) for z in (own, again))
        alike = _likeness(shared, twice, size[left][:, None] + size[right], extra[left][:, None] + extra[right])
        near = alike >= SIMILAR
        x, y = np.nonzero(np.triu(near, 1) if i == j else near)
        yield ids[left[x]], ids[right[y]], alike[x, y]


def _class_links(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
    out = [pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y), "similarity": s}) for x, y, s in _near_pairs(*key[2:], b)]
    return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "similarity": []})


def _class_degrees(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
    ends = [z for x, y, _ in _near_pairs(*key[2:], b) for z in (x, y)]
    ids, n = np.unique(np.concatenate(ends) if ends else np.zeros(0, np.int64), return_counts=True)
    return pd.DataFrame({"id": ids, "n_links": n})


def _within_classes(labels: DataFrame, texts: Texts) -> GroupedData:
    """Groups in which every two members of a class (labels: id, label) meet once: a link's
    ends are in one class, so these hold all links. Members of a large class are dealt
    to blocks, and each two of its blocks are a group; small classes share groups."""
    own = written(texts(labels).mapInArrow(_labelled, "id long, label long, shingles binary, again binary"), "class-shingles")
    n_bytes = F.sum(F.octet_length("shingles") + F.octet_length("again"))
    sizes = own.groupBy("label").agg(n_bytes.alias("bytes"), F.ceil(F.greatest(F.count("*") / BLOCK, n_bytes / CLASS_BYTES)).cast("int").alias("blocks"))
    sizes = written(sizes, "class-sizes")
    lots = 1 + (sizes.where("blocks = 1").agg(F.sum("bytes")).first()[0] or 0) // CLASS_BYTES
    large = sizes.where("blocks > 1").select("label", "blocks")
    dealt = own.join(bounded_broadcast(large, SMALL), "label", "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("id"), "blocks"), F.lit(0)).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1), lambda k: F.struct(F.least(k, "block").alias("i"), F.greatest(k, "block").alias("j")))
    lot = F.when(F.col("blocks").isNull(), F.pmod(F.xxhash64("label"), F.lit(lots))).otherwise(F.lit(-1))
    met = dealt.select("id", "label", "block", "shingles", "again", lot.alias("lot"), F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(F.col("label")).alias("large"), F.explode(others).alias("m"))
    return met.select("large", "lot", "m.i", "m.j", "id", "label", "block", "shingles", "again").groupBy("large", "lot", "i", "j")


def _other(x: str, y: str) -> tuple[Column, Column]:
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def _classed(docs: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame, Texts]:
    """doc, same, head, class_id, keeper of each row of docs; id, least of each text; id, label
    of the texts that have links; and the texts by number.

    Rows are what their id and text are: those of equal text are one class from the start,
    whoever they are, and each different text, under a number of its own (id; in classes,
    head), takes part in what follows. Those that share a band meet in a bucket.
    In each bucket one document, the one whose bands are shared the most (in a group of copies
    of one text, that text), is compared with all others, then the like among those
    not linked to it; only pairs of the rest that are in different components after
    that are compared one by one. So the pairs grow with the members, not their square,
    and no link between components is lost. class_id is the class's least id, null where
    no row of it has one; keeper is the class's least hash of a text.
    """
    rows = docs.select(F.col(key).alias("id"), _same().alias("same"), text_or_empty().alias("text"))
    signed = written(rows.mapInArrow(_signed, "id long, same binary, signature binary, bands array<long>"), "signatures")
    firsts = signed.groupBy("same").agg(F.min("id").alias("least"), F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    firsts = written(firsts.withColumn("id", F.monotonically_increasing_id()), "first-signatures")
    heads = firsts.select("id", "same", "least")

    def texts(ids: DataFrame) -> DataFrame:
        named = bounded_broadcast(heads.join(bounded_broadcast(ids, SMALL), "id").withColumnRenamed("same", "of"), SMALL)
        found = rows.withColumnRenamed("id", "doc").join(named, F.col("same").eqNullSafe(F.col("of")) & F.col("doc").eqNullSafe(F.col("least")))
        return found.select(*ids.columns, "text").dropDuplicates(["id"])

    signatures = firsts.select("id", "signature", "bands")
    banded = signatures.select("id", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = written(banded.join(sizes, "bucket"), "bucket-members")
    mass = members.groupBy("id").agg(F.sum("size").alias("mass"))
    members = written(members.join(mass, "id").select("bucket", "id", "mass"), "members")
    best = F.max_by("id", F.struct("mass", -F.col("id"))).alias("hub")
    hubs = members.groupBy("bucket").agg(best)
    first = written(members.join(hubs, "bucket").where("id != hub").groupBy(*_other("id", "hub")).agg(F.min("hub").alias("hub")), "first-pairs")
    links = _links(first, signatures, texts, "dup1")
    # A hub has met all of its bucket; what may still be linked is among the others.
    left = members.join(hubs, "bucket").where("id != hub")
    for n in (2, 3):
        labels = components(links)
        placed = left.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        mixed = placed.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("bucket")
        placed = written(placed.join(mixed, "bucket"), "mixed")
        if placed.isEmpty():
            break
        if n == 2:
            of = labels.select(F.col("id").alias("hub"), F.col("label").alias("of"))
            inner = placed.join(of, "hub", "left").where(F.col("label") != F.coalesce("of", "hub"))
            second = written(inner.groupBy("bucket").agg(best, F.max_by("label", F.struct("mass", -F.col("id"))).alias("own")), "second-hubs")
            placed = placed.drop("hub").join(second, "bucket")
            pairs = placed.where("label != own").groupBy(*_other("id", "hub")).agg(F.min("hub").alias("hub"))
            links = links.unionByName(_links(pairs.join(first, ["a", "b"], "left_anti"), signatures, texts, "dup2"))
            left = placed.where("id != hub").select("bucket", "id", "mass", "hub")
        else:
            links = links.unionByName(_residual(placed, signatures, texts))
    labels = components(links)
    # Each text with its class; then all rows of that text.
    linked = labels.join(heads, "id")
    least = linked.groupBy("label").agg(F.min("least").alias("class_id"), F.min("same").alias("keeper"))
    linked = written(linked.join(bounded_broadcast(least, SMALL), "label").select("id", "class_id", "keeper"), "linked")
    named = heads.join(bounded_broadcast(linked, SMALL), "id", "left")
    named = named.select("same", F.col("id").alias("head"), F.coalesce("class_id", "least").alias("class_id"), F.coalesce("keeper", "same").alias("keeper"))
    classes = signed.select(F.col("id").alias("doc"), "same").join(named, "same")
    return classes, heads.select("id", "least"), labels, texts


def _named() -> Column:
    """The class of a row that has an id."""
    return F.when(F.col("doc").isNotNull(), F.col("class_id")).alias("class_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Classes and links.

    classes: id, class_id, one row per row of docs; class_id is the least id of the
    documents that are linked to it, directly or through others. links: a, b,
    similarity, between the least ids of different texts: every two texts of a class
    that are near-duplicates, not only what it takes to hold the class together.

    Similarity is the greater of that of the bags and that of the sets of shingles; 0.8
    itself is enough. Texts are taken whole. Null text counts as empty; texts without words are alike only if equal. Rows that
    share an id are classed each by its own text. Rows without an id take part, but
    their class_id is null and texts that only they have are in no row of links. Empty
    table: empty results. Other columns are not read.
    """
    classes, heads, labels, texts = _classed(docs, key)
    links = _within_classes(labels, texts).applyInPandas(_class_links, "a long, b long, similarity double")
    least = written(heads.join(bounded_broadcast(labels, SMALL), "id", "left_semi").where("least is not null"), "link-ends")
    for x in "ab":
        ends = bounded_broadcast(least.select(F.col("id").alias(x), F.col("least").alias(f"least_{x}")), SMALL)
        links = links.join(ends, x)
    return classes.select(F.col("doc").alias("id"), _named()), links.select(*_other("least_a", "least_b"), "similarity")


def keep_one(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """docs with one document of each class, that of the least id: the class's rows of that
    id all stay. Of a class without ids one row stays, of the least text by hash. All columns
    as they were, whatever they are named."""
    classes, _, _, _ = _classed(docs, key)
    copy = F.when(F.col("class_id").isNull(), F.col("same") != F.col("keeper")).otherwise(~F.col("doc").eqNullSafe(F.col("class_id")))
    one, text = (unused(docs.columns, c) for c in ("copy_of", "copy_text"))
    extra = written(classes.where(copy).select(F.col("doc").alias(one), F.col("same").alias(text)).distinct(), "copies")
    own = F.col(f"`{key}`")
    kept = docs.join(bounded_broadcast(extra, SMALL), own.eqNullSafe(F.col(one)) & (_same() == F.col(text)), "left_anti")
    if classes.where("doc is null").isEmpty():
        return kept
    nameless = kept.where(own.isNull()).withColumn(text, _same()).dropDuplicates([text]).drop(text)
    return kept.where(own.isNotNull()).unionByName(nameless)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id, n_links: how many other texts are near-duplicates of the row's
    own; the same for all copies of one text."""
    classes, _, labels, texts = _classed(table(spark, sf_dir, "documents"), "doc_id")
    degrees = _within_classes(labels, texts).applyInPandas(_class_degrees, "id long, n_links long").groupBy(F.col("id").alias("head")).agg(F.sum("n_links").alias("n_links"))
    degrees = written(degrees, "degrees")
    return classes.join(bounded_broadcast(degrees, SMALL), "head", "left").select(F.col("doc").alias("doc_id"), _named(), F.coalesce("n_links", F.lit(0)).alias("n_links"))
