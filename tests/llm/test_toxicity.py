import zlib

from pyspark.sql import functions as F

from gleanery.llm import toxicity as m
from tests.llm.fixtures import docs, save, words

BAD = ["grubby", "vilest", "wretch"]


def corpus(n=160):
    rows, labels = [], []
    for i in range(n):
        w = words(i, 30 + i % 50).split()
        toxic = i % 4 == 0
        if toxic:
            for k, b in enumerate(BAD):
                w.insert(3 + 7 * k, b)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def frames(spark, rows, labels, clash=False):
    return docs(spark, rows, clash), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_told_apart(spark):
    rows, labels = corpus()
    d, l = frames(spark, rows, labels)
    model = m.learn(d, l)
    got = {r.doc_id: r.s for r in d.select("doc_id", m.score(model).alias("s")).collect()}
    held = [(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 20 and all((got[i] >= 0.5) == bool(y) for i, y in held)


def test_query_is_the_model_on_every_row(spark, tmp_path):
    """op5 against its parts, row by row: fold, score of the whole text, cut at one half."""
    rows, labels = corpus()
    rows += [(900, None), (901, ""), (3, rows[3][1]), (None, rows[4][1])]
    d, l = frames(spark, rows, labels, clash=True)
    folder = save(d, tmp_path, "documents")
    save(l, tmp_path, "labels")
    model = m.learn(d, l)
    want = sorted((str(i), i is not None and zlib.crc32(str(i).encode()) % 5 == 0, model.score(t or ""), int(model.score(t or "") >= 0.5)) for i, t in rows)
    got = sorted((str(r.doc_id), r.held_out, r.score, r.predicted) for r in m.op5(spark, folder).collect())
    assert got == want and {g[3] for g in got} == {0, 1}


def test_length_does_not_dilute(spark):
    model = m.learn(*frames(spark, *corpus()))
    scores = [model.score(f"{words(5, n)} {' '.join(BAD)} {words(6, n)}") for n in (0, 100, 1000, 9000)]
    assert min(scores) >= 0.5


def test_dictionaries_are_running_text(spark):
    rows, labels = corpus()
    model = m.learn(*frames(spark, rows, labels))
    toxic = [m.words_of(t) for i, t in rows if i % 4 == 0]
    seen = {m.coded(w[i : i + n]) for w in toxic for i in range(len(w)) for n in (1, 2, 3)}
    assert any(model.toxic[2 * m.CODE : (2 + n) * m.CODE] in seen for n in (1, 2, 3)) and len(model.toxic) == len(model.ordinary)


def test_held_out_labels_are_not_read(spark):
    rows, labels = corpus()
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in labels]
    assert m.learn(*frames(spark, rows, labels)) == m.learn(*frames(spark, rows, flipped))


def test_keep_ordinary(spark):
    rows, labels = corpus()
    extra = [(900, None), (901, ""), (902, words(5, 30_000)), (903, f"{words(6, 9000)} {' '.join(BAD)} {words(7, 9000)}"), (None, words(8, 40)), (5, rows[5][1])]
    d, l = frames(spark, rows + extra, [*labels, (901, None, None), (7, 1, 0)], clash=True)
    kept = m.keep_ordinary(d, l)
    assert kept.columns == d.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [i for i in range(160) if i % 4] + [900, 901, 902, None, 5]))


def test_no_labels_and_empty_tables(spark):
    rows, labels = corpus(20)
    d, l = frames(spark, rows, labels)
    assert m.keep_ordinary(d, l.limit(0)).count() == 20
    assert m.keep_ordinary(d.limit(0), l).count() == 0
    assert m.keep_ordinary(d, l.where("toxic = 0")).count() == 20


def test_fold_is_crc32_of_the_id_as_text(spark):
    got = spark.range(50).select("id", m.fold_of(F.col("id")).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)
