import re

import pytest
from pyspark.sql import functions as F

from gleanery.llm import mixing as m
from tests.llm.fixtures import docs, words


def filled(sizes, weights=(5, 2, 1), most=3):
    """Targets by the rounds themselves: clamp, share out the excess, again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, clamped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in clamped]
        left = total - sum(clamped.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return clamped | share
        clamped |= {s: float(most * sizes[s]) for s in over}


def rows():
    out = [(i, words(i, 5 + i % 40), "abcdefg"[min(6, int(i**0.5) // 2)]) for i in range(150)]
    return out + [(200, None, "a"), (201, "", "h"), (202, " \t ", None), (203, "x y z", None), (204, words(1, 30_000), "b"), (None, "one two", "a"), (3, words(3, 8), "a"), (3, words(3, 8), "a")]


def test_against_the_rounds(spark):
    frame = docs(spark, rows(), clash=True)
    got = m.mix(frame).select("doc.doc_id", "size", "source_size", "target", "taken").collect()
    assert len(got) == len(rows())
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = {}, {}
    for i, t, s in rows():
        sizes[s] = sizes.get(s, 0) + size(t)
    want = filled(sizes)
    with_source = m.mix(frame, keep=("doc_id", "source")).select("doc.source", "size", "source_size", "target", "taken").collect()
    for r in with_source:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes if sizes[s])
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, m.mix(frame.repartition(5)).select("doc.doc_id", "size", "source_size", "target", "taken").collect()), key=str)


def test_rows_of_the_mix(spark):
    frame = docs(spark, rows(), clash=True)
    out = m.mixed_rows(frame)
    assert out.columns == frame.columns
    per = {r.source: r.n for r in out.groupBy("source").agg(F.sum(m.word_count(F.col("text"))).alias("n")).collect()}
    sizes = {}
    for _, t, s in rows():
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = filled(sizes)
    longest = 45
    assert all(abs(per[s] - want[s]) <= (longest if s != "b" else 30_000) for s in sizes if sizes[s])
    assert m.mixed_rows(docs(spark, [])).count() == 0 and m.mix(docs(spark, [])).count() == 0


def test_all_texts_empty(spark):
    got = m.mix(docs(spark, [(1, "", "a"), (2, None, "b")])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
