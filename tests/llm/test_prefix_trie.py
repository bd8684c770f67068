import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gleanery.llm import prefix_trie as m
from gleanery.llm.prefix_sums import running
from tests.llm.fixtures import save, words

SHAPE = "conv_id long, turn long, role string, text string"


def brute(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn, role or "", text or ""))
    digest = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
    for own in turns.values():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, digest(x[1], x[2])))
    made = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = [x[1:] for x in turns.get(c - c % 100, [])[:h] + turns[c][h:]]
    nodes = {}
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for node, members in nodes.items():
        d = len(node)
        below = [(x, ms) for x, ms in nodes.items() if x[:d] == node]
        kids = sum(len(x) == d + 1 for x, _ in below)
        leaves = sum(not any(y[:-1] == x for y, _ in below if y) for x, _ in below)
        saved = sum((len(ms) - 1) * len(x[-1][1]) for x, ms in below if x)
        ends = sorted(c for c in members if len(made[c]) == d)
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(members), d, min(nodes[node[:-1]]) if d else None, len(members), kids, leaves, saved, sha, len(below)))
    return sorted(out)


def conversations(seed, n=60):
    r = random.Random(seed)
    rows = []
    base = [(t, "user" if t % 2 == 0 else "assistant", f"t{t} é😀") for t in range(7)]
    for c in range(n):
        c += 100 * r.randrange(3)
        k = r.randrange(8)
        own = base[:k] + [(t, r.choice(("user", "assistant", None, "")), r.choice((None, "", "a", "b", words(r.randrange(5), 4)))) for t in range(k, k + r.randrange(3))]
        rows += [(c, None if r.random() < 0.05 else t, role, text) for t, role, text in own]
    rows += [(None, 1, "user", "no conversation"), (999, 1, "user", "x"), (999, 1, "user", "x"), (400, 0, "user", "alone"), (400, None, None, None)]
    rows += [(1000 + i, t, role, text) for i in range(40) for t, role, text in base]  # a group of near copies
    rows += [(5000, t, "user", f"long {t}") for t in range(300)] + [(5001, t, "user", f"long {t}") for t in range(290)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("many", [False, True])
def test_against_brute_force(spark, tmp_path, many):
    rows = conversations(many)
    if many:  # ranges of few rows: groups and running totals go over several
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame([(*r, 1, "x", None) for r in rows], f"{SHAPE}, depth long, t string, nth long")
        got = [tuple(r) for r in m.op12(spark, save(frame, tmp_path, "conversations")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((*g[:8], g[9] - g[8]) for g in got) == brute(rows)
    # Preorder: each position once; a parent's interval holds its children's.
    assert sorted(g[8] for g in got) == list(range(len(got)))
    at = {(g[0], g[1]): g for g in got}
    assert all(at[g[2], g[1] - 1][8] < g[8] and g[9] <= at[g[2], g[1] - 1][9] for g in got if g[1])


def test_turnless_conversation(spark):
    convs = spark.createDataFrame([(1,), (2,)], "conv_id long")
    turns = spark.createDataFrame([(2, 1, b"x", 5)], "conv_id long, depth long, t binary, chars long")
    got = sorted(tuple(r)[:8] for r in m.trie(convs, turns).collect())
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert got == [(1, 0, None, 2, 1, 1, 0, sha(b"1")), (2, 1, 1, 1, 0, 1, 0, sha(b"2"))]


def test_empty(spark, tmp_path):
    empty = spark.createDataFrame([], SHAPE)
    assert m.op12(spark, save(empty, tmp_path, "conversations")).count() == 0
    assert m.op12(spark, save(spark.createDataFrame([(None, 1, "user", "x")], SHAPE), tmp_path, "conversations")).count() == 0


def test_running_totals(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        r = random.Random(4)
        rows = [(r.choice((1, 1, 1, 2, 3)), i, r.randrange(-50, 50), r.getrandbits(62)) for i in range(500)]
        frame = spark.createDataFrame(rows, "g long, i long, v long, x long")
        for group in ([], ["g"]):
            want, so_far = {}, {}
            for g, i, v, x in sorted(rows) if group else sorted(rows, key=lambda y: y[1]):
                n, a, b = so_far.get(g if group else 0, (0, 0, 0))
                so_far[g if group else 0] = want[i] = (n + 1, a + v, b ^ x)
            got = {y.i: (y.nth, y.v, y.x) for y in running(frame, group, ["i"], ["i"], sums=["v"], xors=["x"]).collect()}
            assert got == want
        assert running(frame.where(F.lit(False)), ["g"], ["i"], ["i"]).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
