import hashlib

from pyspark.sql import functions as F

from gleanery.llm import syncmers as m
from tests.llm.fixtures import docs, words


def brute(text, k=m.K, s=m.S):
    """Closed syncmers by their definition, over the operator's own hashes of substrings."""
    import numpy as np

    def h(x):
        points = np.array([ord(c) + 1 for c in x], np.uint64)
        up, _ = m._Powers.of(len(points))
        return int(m._mixed(np.array([(points * up).sum(dtype=np.uint64)]))[0])

    out = []
    for i in range(len(text) - k + 1):
        inner = [h(text[i + j : i + j + s]) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i, h(text[i : i + k])))
    return out


def test_syncmers_match_definition():
    for text in (words(1, 60), "é😀" * 40 + words(2, 20), "a" * 50):
        at, hashes = m.syncmers(text)
        assert list(zip(at.tolist(), map(int, hashes))) == brute(text)


def test_stretches_change_nothing(monkeypatch):
    text = words(3, 400)
    whole = m.syncmers(text)
    monkeypatch.setattr(m, "STRETCH", 100)
    cut = m.syncmers(text)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def brute_likeness(a, b):
    """Longest common run of anchors by the textbook's table, an n-th of a hash meeting the n-th."""
    if not a or not b:
        return float(len(a) == len(b))
    number = lambda xs: [(h, xs[:i].count(h)) for i, h in enumerate(xs)]
    x, y = number(a), number(b)
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, u in enumerate(x):
        for j, v in enumerate(y):
            best[i + 1][j + 1] = best[i][j] + 1 if u == v else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1] / (len(x) + len(y) - best[-1][-1])


def text_hash(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h")).collect()
    return {r.t: r.h for r in rows}


def expected(spark, rows, like=None):
    """The contract, by hand over all rows at once."""
    h = text_hash(spark, {t or "" for _, t in rows} or {""})
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), h[r[1]]))
    out = []
    for n, (i, t) in enumerate(rows):
        nxt = rows[(n + 1) % len(rows)][1]
        e = m.edited(t, nxt)
        f, g, x = map(m.syncmers, (t, e, nxt))
        near = like or m.likeness
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), m.written_out(f), m.written_out(g), near(f, g), near(f, x)))
    return sorted(out, key=str)


def test_rows_against_brute_force(spark):
    rows = [(i * 3, words(i, 5 + i * 7 % 90)) for i in range(60)]
    rows += [(500, None), (501, ""), (502, "short"), (None, "no id"), (503, words(9, 300)), (3, words(1, 12)), (504, words(7, 54)), (505, "one line, again and again. " * 20)]
    got = sorted(map(tuple, m.compare_edits(docs(spark, rows, clash=True)).collect()), key=str)
    assert got == expected(spark, rows, lambda a, b: brute_likeness(a[1].tolist(), b[1].tolist()))


def test_ranges(spark):
    """Several ranges; an id, and a row, that hold a third of the table; many nulls."""
    rows = [(i, words(i, 5)) for i in range(600)] + [(77, words(i, 4)) for i in range(900)] + [(200, "the same")] * 900 + [(None, words(i, 3)) for i in range(400)]
    d = docs(spark, rows)
    assert 2 < m.with_next(d)[1]
    got = sorted(map(tuple, m.compare_edits(d).collect()), key=str)
    assert got == expected(spark, rows)
    sizes = [r.n for r in m.with_next(d)[0].groupBy("bucket").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 2.5 * len(rows) / len(sizes)


def test_one_and_no_rows(spark):
    assert [tuple(r) for r in m.compare_edits(docs(spark, [(1, "only text here, longer than k")])).collect()] == expected(spark, [(1, "only text here, longer than k")])
    assert m.compare_edits(docs(spark, [])).count() == 0


def test_likeness():
    a, b = m.syncmers(words(1, 50)), m.syncmers(words(2, 50))
    assert m.likeness(a, a) == 1 and m.likeness(a, b) < 0.05
    assert m.likeness(m.syncmers(""), m.syncmers("")) == 1 and m.likeness(a, m.syncmers("")) == 0


def test_small_edits_and_moves_of_long_texts_show():
    text = words(4, 20_000)
    a = m.syncmers(text)
    one = m.syncmers(text[:50_000] + "X" + text[50_001:])
    moved = m.syncmers(text[60_000:] + text[:60_000])
    assert 0.99 < m.likeness(a, one) < 1 and m.written_out(a) != m.written_out(one)
    assert 0.2 < m.likeness(a, moved) < 0.6
