import hashlib
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from gleanery.llm import sharding as m
from tests.llm.fixtures import docs, words


def split(rows, limit, bits=""):
    """Extendible hashing by its definition, for unique ids."""
    here = [(i, t) for i, t in rows if bin(int(hashlib.md5(str(i).encode()).hexdigest(), 16))[2:].zfill(128).startswith(bits)]
    if sum(len((t or "").encode()) for _, t in here) <= limit or len(here) <= 1:
        return {i: (bits, len(here), sum(len((t or "").encode()) for _, t in here)) for i, t in here}
    return split(here, limit, bits + "0") | split(here, limit, bits + "1")


def test_against_definition(spark):
    rows = [(i, words(i, 3 + i % 30)) for i in range(300)] + [(900, None), (901, ""), (902, "é" * 400), (903, "z" * 5000)]
    for limit in (10**9, 20_000, 3_000, 700):
        got = {r.doc_id: (r.shard, r.shard_docs, r.shard_bytes) for r in m.shard(docs(spark, rows, clash=True), limit).collect()}
        assert got == split(rows, limit)


def test_sql_at_a_small_limit(spark, tmp_path):
    rows = [(i, words(i, 3 + i % 30)) for i in range(200)]
    docs(spark, rows).write.parquet(str(tmp_path / "d"))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = sorted(db.sql(m.op2_sql(900)).fetchall())
    cols = ["doc_id", "n_bytes", "shard", "shard_depth", "shard_docs", "shard_bytes"]
    assert sorted(tuple(r[c] for c in cols) for r in m.shard(docs(spark, rows), 900).collect()) == want


def test_one_id_in_a_third_of_the_rows(spark):
    rows = [(7, "same text " * 5)] * 60 + [(None, "n" * 50)] * 20 + [(i, words(i, 9)) for i in range(100, 200)]
    got = m.shard(docs(spark, rows), 600).collect()
    assert len(got) == len(rows)
    sums = defaultdict(int)
    for r in got:
        sums[r.shard] += r.n_bytes
    assert all(b <= 600 for b in sums.values()) and all(sums[r.shard] == r.shard_bytes for r in got)
    assert sum(1 for x in sums for y in sums if x != y and y.startswith(x)) == 0  # no shard within another


def test_limit_does_not_look_at_the_table(spark):
    few, many = ([(i, words(i, 30)) for i in range(n)] for n in (100, 400))
    for rows in (few, many):
        assert {(r.shard, r.shard_depth) for r in m.shard(docs(spark, rows)).collect()} == {("", 0)}
        assert max(r.shard_bytes for r in m.shard(docs(spark, rows), 9_000).collect()) <= 9_000


def test_rows_meet_one_directory_however_many_shards(spark, monkeypatch):
    levels = []
    monkeypatch.setattr(m, "written", lambda df, name, own=m.written: levels.append(name) or own(df, name))
    rows = [(i, words(i, 20)) for i in range(600)]
    for limit in (9_000, 1_500):
        levels.clear()
        assert len({r.shard for r in m.shard(docs(spark, rows), limit).collect()}) > 8
        # Before, each four bits of depth took all rows through one more semi-join than the last.
        assert levels.count("shard-directory") == 1


def test_names_that_clash(spark, tmp_path):
    rows = [(i, words(i, 9)) for i in range(40)]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        frame = docs(spark, rows).withColumn("Name", F.lit("a")).withColumn("name_1", F.lit("b")).withColumn("shard_name", F.lit("c")).withColumn("folder", F.lit("d"))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    manifest = m.write_shards(frame, str(tmp_path / "out"), 600)
    assert manifest.count() == 40
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {*back.columns} - {*frame.columns} == {"name_2"} and back.count() == 40
    assert back.select("Name", "name_1", "shard_name", "folder").distinct().collect() == [("a", "b", "c", "d")]


def test_shards_are_written_whole(spark, tmp_path):
    rows = [(i, words(i, 9)) for i in range(80)] + [(5, words(5, 9))] * 3 + [(None, None)]
    frame = docs(spark, rows, clash=True).withColumn("name", F.lit("clash"))
    manifest = m.write_shards(frame, str(tmp_path / "out"), 600).collect()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, (tuple(r[c] for c in frame.columns) for r in back.collect()))) == sorted(map(str, map(tuple, frame.collect())))
    assert len(manifest) == len(rows)
    for folder in {r.folder for r in manifest}:
        here = sorted(str(r.doc_id) for r in manifest if r.folder == folder)
        assert sorted(str(r.doc_id) for r in spark.read.parquet(folder).collect()) == here
    assert m.write_shards(frame.limit(0), str(tmp_path / "none")).count() == 0


def test_empty(spark):
    assert m.shard(docs(spark, []), 10).count() == 0
