import random

import pytest

from gleanery.llm import decontam as m
from tests.llm.fixtures import docs, words


@pytest.fixture(scope="module")
def items():
    r = random.Random(4)
    return [(i, words(i, r.choice((3, 8, 20, 45, 130))).capitalize() + ". " + words(500 + i, r.choice((1, 4, 9))).capitalize() + ".") for i in range(60)]


def test_search_finds_all_above_threshold(items):
    index = m.Index(items)
    r = random.Random(5)
    for _ in range(150):
        asked = sorted({r.randrange(len(index.terms)) for _ in range(r.choice((3, 30, 200)))})
        scores = {}
        for t in asked:
            for d, p in zip(index.docs[t], index.impacts[t]):
                scores[d] = scores.get(d, 0) + p
        for theta in (0.05, 0.2, 0.5):
            assert sorted(d for d, s in scores.items() if s >= theta) == sorted(d for d, _ in index.search(asked, theta))


def test_first_bound_drops_no_passage(items):
    index = m.Index(items)
    texts = [words(900 + i, 150) + " " + items[i][1] + " " + words(i, 20) for i in range(20)]
    for text in texts:
        w = m.words_of(text)
        import numpy as np

        terms = np.array([index.terms.get(x, -1) for x in w])
        kept = {a for _, a, _ in index.passages(terms, np.array([len(w)]))}
        for a in range(0, max(1, len(w)), m.STRIDE):
            asked = sorted({int(t) for t in terms[a : a + m.PASSAGE] if t >= 0})
            assert not index.search(asked) or a in kept


def planted(items):
    rows = [(i, words(1000 + i, 30 + 5 * i)) for i in range(25)]
    rows += [(100 + i, f"{words(2000 + i, 70)} {t.upper() if i % 2 else t} {words(3000 + i, 33)}") for i, t in items[::3]]
    rows += [(300, None), (301, ""), (302, items[5][1] + " " + items[6][1]), (303, words(7777, 30_000) + " " + items[7][1]), (302, items[5][1] + " " + items[6][1]), (None, items[8][1])]
    return rows


def expected(rows, items):
    """Items whose words stand in a text as they are."""
    own = [(i, " ".join(m.words_of(t))) for i, t in items]
    return sorted((str(d), i) for d, t in rows for x in [f" {' '.join(m.words_of(t or ''))} "] for i, w in own if f" {w} " in x)


def test_rows_against_brute_force(spark, items):
    rows = planted(items)
    bench = spark.createDataFrame([*items, (900, None), (901, ""), (3, items[3][1])], "item_id long, text string")
    got = m.contaminated(docs(spark, rows, clash=True), bench).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in got) == expected(rows, items)
    assert all(m.THRESHOLD <= r.score <= 1 and r.question_overlap >= m.OVERLAP for r in got)
    assert len(m.decontaminated(docs(spark, rows, clash=True), bench).columns) == 9
    left = [r.doc_id for r in m.decontaminated(docs(spark, rows), bench).collect()]
    assert sorted(map(str, left)) == sorted(str(d) for d, _ in rows if str(d) not in {x for x, _ in expected(rows, items)})


def test_blocks_of_items(spark, items, monkeypatch):
    monkeypatch.setattr(m, "INDEX_BYTES", 2000)
    rows = planted(items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = m.contaminated(docs(spark, rows), bench).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in got) == expected(rows, items)


def test_empty(spark, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert m.contaminated(docs(spark, []), bench).count() == 0
    assert m.contaminated(docs(spark, [(1, "x")]), bench.limit(0)).count() == 0


def test_parts_of_an_item_are_leaks(spark):
    """An item without its first or last words, or with a changed last sentence, is found; a quarter of it is not."""
    items = [(i, words(i, 20 + 9 * i).capitalize() + ". " + words(500 + i, 1 + i % 4).capitalize() + ".") for i in range(20)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = []
    for i, t in items:
        w = t.split()
        last = len(m.question_and_answer(t)[1])
        kept = [w[: -(-len(w) * 9 // 10)], w[: -(-len(w) * 7 // 10)], w[len(w) // 5 :], [*w[:-last], *words(700 + i, last).split()], w[: len(w) // 4]]
        rows += [(10 * i + n, f"{words(2000 + i, 70)} {' '.join(k)} {words(3000 + i, 80)}") for n, k in enumerate(kept)]
    got = {(r.doc_id, r.item_id) for r in m.contaminated(docs(spark, rows), bench).collect()}
    assert got == {(10 * i + n, i) for i, _ in items for n in range(4)}


def test_recall_of_edited_items():
    """Items with words changed, in other text: all with one word in ten, nine of ten with three in twenty."""
    r = random.Random(7)
    items = [(i, f"{words(5000 + i, 30)}. {words(7000 + i, 6)}.") for i in range(150)]
    index = m.Index(items)

    def edited(text, share):
        w = text.split()
        for i in r.sample(range(len(w)), round(share * len(w))):
            w[i] = words(r.randrange(10**6), 1)
        return f"{words(r.randrange(10**6), 50)} {' '.join(w)} {words(r.randrange(10**6), 50)}"

    for share, least in ((0.05, 1.0), (0.1, 1.0), (0.15, 0.9)):
        got = index.matches([edited(t, share) for _, t in items])
        assert sum(any(x[0] == i for x in g) for (i, _), g in zip(items, got)) >= least * len(items)
        assert not any(x[0] != i for (i, _), g in zip(items, got) for x in g)
    assert index.matches([words(10**6 + i, 300) for i in range(100)]) == [[]] * 100
