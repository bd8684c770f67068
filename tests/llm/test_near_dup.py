import random
from collections import Counter, defaultdict

import numpy as np

from gleanery.llm import near_dup as m
from gleanery.llm.components import components
from tests.llm.fixtures import docs, save, words


def edit(text, n, seed):
    r, w = random.Random(seed), text.split()
    for i in r.sample(range(len(w)), n):
        w[i] = f"changed{seed}x{i}"
    return " ".join(w)


def brute(rows, key=lambda t: t or ""):
    """Least id of each row's class: equal texts, and shingle sets of Jaccard 0.8 or more."""
    ids = sorted({i for i, _ in rows if i is not None})
    text = {i: key(t) for i, t in sorted(rows, key=str) if i is not None}

    def grams(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets, parent = {i: grams(text[i]) for i in ids}, {i: i for i in ids}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for x in ids:
        for y in ids:
            if x < y and (text[x] == text[y] or (sets[x] and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]))):
                a, b = root(x), root(y)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def table():
    base = words(1, 150)
    rows = [(i, words(100 + i, 40 + i)) for i in range(20)]
    rows += [(50, base)] + [(51 + i, edit(base, 3, i)) for i in range(12)]  # alike to base, not all to each other
    rows += [(80 + i, base) for i in range(5)]
    chain = words(2, 300)
    for i in range(5):
        rows.append((90 + i, chain))
        chain = edit(chain, 4, 200 + i)
    rows += [(110, None), (111, ""), (112, " "), (113, "two words"), (114, "Two words"), (115, words(7, 20_000)), (116, edit(words(7, 20_000), 5, 9))]
    return rows


def test_classes_against_brute_force(spark):
    rows = table()
    classes, links = m.near_duplicates(docs(spark, [*rows, (50, words(1, 150)), (None, words(1, 150))], clash=True))
    got = classes.collect()
    assert len(got) == len(rows) + 2
    assert {r.id: r.class_id for r in got if r.id is not None} == brute(rows)
    assert all(r.similarity >= 0.8 for r in links.collect())
    assert [r.class_id for r in got if r.id is None] == [None]


def test_keep_one(spark):
    rows = table()
    frame = docs(spark, [*rows, (None, "x")], clash=True).selectExpr("*", "1 AS copy_of", "2 AS copy_text", "3 AS same", "4 AS doc")
    kept = m.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(brute(rows).values()))


def test_empty(spark):
    classes, links = m.near_duplicates(docs(spark, []))
    assert classes.count() == 0 and links.count() == 0


def test_darts_estimate_weighted_jaccard():
    r = np.random.default_rng(1)
    e = r.integers(0, 1 << 60, 300, dtype=np.uint64)
    for scale in (0.3, 1.0, 9.0):
        w = r.random(300) * scale
        v = np.where(r.random(300) < 0.3, r.random(300) * scale, w)
        a, b = m.dart_signatures([(e, w), (e[40:], v[40:])], 4000)
        v[:40] = 0
        assert abs((a == b).mean() - np.minimum(w, v).sum() / np.maximum(w, v).sum()) < 0.04


def test_shingles_match_definition():
    texts = ["", "one", "a b c d e", "A  b\tc d\ne a b c d e", "é è ê ü ß ñ"]
    known = defaultdict(set)
    for t, (h, n) in zip(texts, m.shingles(texts)):
        w = t.lower().split()
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])
        assert len(h) == len(set(grams)) and n.sum() == len(grams)
        known[frozenset(grams)].add(tuple(h))
    assert all(len(v) == 1 for v in known.values())


def test_components(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(r.randint(200, 260), r.randint(200, 260)) for _ in range(40)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else root(parent[x])

    for a, b in links:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {x.id: x.label for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_residual_in_small_blocks(spark, monkeypatch):
    """Chains that no hub covers, compared in blocks of two."""
    monkeypatch.setattr(m, "BLOCK", 2)
    rows = []
    for c in range(3):
        text = words(40 + c, 300)
        for i in range(9):
            rows.append((100 * c + (i * 5) % 9, text))
            text = edit(text, 4, 1000 * c + i)
    classes, _ = m.near_duplicates(docs(spark, rows))
    assert {r.id: r.class_id for r in classes.collect()} == brute(rows)


def brute_links(rows):
    """All links between the least ids of different texts."""
    heads = {}
    for i, t in rows:
        heads[t or ""] = min(i, heads.get(t or "", i))
    sets = {i: m.shingles([t])[0][0] for t, i in heads.items()}
    out = set()
    for x in sets:
        for y in sets:
            shared = len(np.intersect1d(sets[x], sets[y]))
            if x < y and shared and shared >= 0.8 * (len(sets[x]) + len(sets[y]) - shared):
                out.add((x, y))
    return out, {i: heads[t or ""] for i, t in rows}


def test_all_links_are_there(spark, tmp_path, monkeypatch):
    """In a class whose members are nearly all alike, in blocks and in one; copies count as their text does."""
    base = words(1, 150)
    rows = table() + [(200 + i, edit(base, 1 + i % 3, 50 + i)) for i in range(30)] + [(300, edit(base, 1, 50)), (301, base)]
    want, head = brute_links(rows)
    assert len(want) > 200
    frame = docs(spark, rows)
    save(frame, tmp_path, "documents")
    for block in (512, 7):
        monkeypatch.setattr(m, "BLOCK", block)
        got = [(r.a, r.b) for r in m.near_duplicates(frame)[1].collect()]
        assert len(got) == len(set(got)) and set(got) == want
        counts = {r.doc_id: r.n_links for r in m.op3(spark, str(tmp_path)).collect()}
        assert counts == {i: sum(h in w for w in want) for i, h in head.items()}


def bag_likeness(x, y):
    grams = [[tuple(w[i : i + 5]) for i in range(len(w) - 4)] for w in (x.split(), y.split())]
    a, b = map(Counter, grams)
    sets = len(a.keys() & b.keys()) / len(a.keys() | b.keys())
    return sets, (a & b).total() / (a | b).total()


def test_bags_and_sets(spark):
    """Texts alike by their counts only, and by their distinct shingles only."""
    line, text = words(50, 12) + " ", words(51, 90)
    rows = [(1, line * 60 + words(52, 30)), (2, line * 60 + words(53, 30)), (3, text), (4, f"{text} {text}"), (5, line * 3 + words(54, 60)), (6, words(55, 50))]
    (s, b), (t, c) = bag_likeness(rows[0][1], rows[1][1]), bag_likeness(text, rows[3][1])
    assert s < 0.8 <= b and c < 0.8 <= t
    classes, links = m.near_duplicates(docs(spark, rows))
    assert {r.id: r.class_id for r in classes.collect()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6}
    assert {(r.a, r.b): round(r.similarity, 9) for r in links.collect()} == {(1, 2): round(b, 9), (3, 4): round(t, 9)}


def test_a_shared_hub_in_blocks(spark, monkeypatch):
    """A hub's partners are dealt to several blocks, each with the hub's text."""
    monkeypatch.setattr(m, "BLOCK", 3)
    base = words(60, 120)
    rows = [(0, base)] + [(i, edit(base, 2, i)) for i in range(1, 25)]
    assert {r.class_id for r in m.near_duplicates(docs(spark, rows))[0].collect()} == {0}


def test_keep_one_of_rows_that_share_an_id_or_have_none(spark):
    a, b, c = words(900, 80), words(901, 80), words(902, 120)
    rows = [(7, a), (7, b), (3, b), (9, edit(a, 1, 1)), (None, b), (None, c), (None, c), (None, edit(c, 1, 2)), (None, words(903, 60))]
    kept = [(r.doc_id, r.text) for r in m.keep_one(docs(spark, rows, clash=True)).collect()]
    assert sorted(x for x in kept if x[0] is not None) == sorted([(7, a), (3, b)])
    nameless = [t for i, t in kept if i is None]
    assert len(nameless) == 2 and words(903, 60) in nameless and b not in nameless
