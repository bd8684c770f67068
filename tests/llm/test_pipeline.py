import corpus_pipeline
from gleanery.llm import decontam, near_dup, toxicity
from gleanery.llm.common import written
from tests.llm.fixtures import docs, save, words
from tests.llm.test_decontam import expected
from tests.llm.test_near_dup import brute, edit
from tests.llm.test_toxicity import BAD, corpus


def tables(spark, folder):
    rows, labels = corpus(120)
    items = [(i, f"{words(5000 + i, 24).capitalize()}. {words(6000 + i, 6).capitalize()}.") for i in range(8)]
    base = words(777, 120)
    rows = [(i, t, f"src{i % 4}") for i, t in rows]
    rows += [(500, base, "src1"), (501, edit(base, 2, 1), "src2"), (502, base, "src0")]
    rows += [(600 + i, f"{words(8000 + i, 50)} {t} {words(9000 + i, 20)}", "src3") for i, t in items[:4]]
    rows += [(700, None, None), (701, "", "src0"), (702, f"{words(30, 60)} {' '.join(BAD)}", "src0")]
    rows += [(None, words(9999, 50), "src1"), (500, base, "src1"), (703, words(9998, 20_000), "src2")]  # no id, a repeated row, a very long text
    frame = docs(spark, rows, clash=True)
    save(frame, folder, "documents")
    save(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), folder, "labels")
    save(spark.createDataFrame(items, "item_id long, text string"), folder, "benchmark")
    return rows, labels, items, frame.columns


def test_stages_against_brute_force(spark, tmp_path):
    rows, labels, items, columns = tables(spark, tmp_path)
    text = {i: t for i, t, _ in rows}
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = {i for i, t in text.items() if not any(b in (t or "").split() for b in BAD)}
    for name, stage in corpus_pipeline.STAGES[:3]:
        d = written(stage(spark, d, str(tmp_path)), name)
        assert d.columns == columns
        if name == "near_duplicates":
            want &= {*brute([(i, text[i]) for i in want]).values(), None}
        if name == "decontamination":
            leaks = {int(i) for i, _ in expected([(i, text[i]) for i in want if i is not None], items)}
            assert len(leaks) == 4
            want -= leaks
        assert {r.doc_id for r in d.collect()} == want, name
    mixed = written(corpus_pipeline.STAGES[3][1](spark, d, str(tmp_path)), "mixing")
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} <= want
    shards = corpus_pipeline.STAGES[4][1](spark, mixed, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in shards) == sorted(str(r.doc_id) for r in mixed.collect())
    ran = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, ran), key=str) == sorted(map(tuple, shards), key=str)


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert toxicity and near_dup and decontam and corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark, tmp_path):
    tables(spark, tmp_path)
    d = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        d = stage(spark, d, str(tmp_path))
        assert d.count() == 0
