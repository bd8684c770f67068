"""Containment joins against comparing all pairs."""

import random

from gleanery.operators.containment import containing


def run(spark, texts, needles):
    t = spark.createDataFrame([(*x, 1) for x in texts], "id long, text string, n long")
    n = spark.createDataFrame([(*x, "k") for x in needles], "item long, text string, key string")
    frame = containing(t, n, "id", "item")
    return frame, sorted(map(tuple, frame.collect()))


def test_against_all_pairs(spark):
    r = random.Random(1)
    say = lambda k: " ".join(r.choice(("ab", "abc", "b", "é", "x.y", "a\tb", "😀")) for _ in range(k))
    texts = [(i, say(r.randrange(12))) for i in range(60)] + [(100, None), (101, ""), (102, "ab " * 40_000 + "end")]
    needles = [(i, say(r.randrange(1, 5))) for i in range(40)]
    needles += [(100 + i, x) for i, x in enumerate((None, "", "a", "bc", "abc", "é ", " ", "b é", "nowhere", "c a", "end", "x.y ab b", "ab  ab"))]
    needles += [(200 + i, texts[i][1][2:-2]) for i in range(10)]
    _, got = run(spark, texts, needles)
    assert got == sorted((i, k) for i, t in texts for k, n in needles if t and n and n in t)


def test_one_key_in_all_texts(spark):
    """A word that all texts have does not make all of them candidates."""
    texts = [(i, f"common words everywhere t{i} common end") for i in range(400)]
    needles = [(i, f"everywhere t{i} common end") for i in range(0, 400, 40)] + [(999, "common words everywhere t")]
    frame, got = run(spark, texts, needles)
    assert got == sorted([(i, i) for i in range(0, 400, 40)] + [(i, 999) for i in range(400)])
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan  # what was broadcast went into the stored keys


def test_nothing(spark):
    for texts, needles in (([], [(1, "a b c")]), ([(1, "a")], []), ([(1, "a")], [(1, ""), (2, None)])):
        assert run(spark, texts, needles)[1] == []
