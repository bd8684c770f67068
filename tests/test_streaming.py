from datetime import datetime

from gleanery.streaming import rollups
from gleanery.streaming.new_pages import signals_of_new_pages


def test_each_page_once(spark, tmp_path):
    pages, out, state = tmp_path / "pages", tmp_path / "out", tmp_path / "state"
    pages.mkdir()
    (pages / "a.html").write_text("<p>Q1: what</p><p>(a) x</p><p>Ans: a</p>")
    signals_of_new_pages(spark, str(pages), str(out), str(state)).awaitTermination()
    (pages / "b.html").write_text("<p>Q1: what</p><p>Q2: who</p>")
    signals_of_new_pages(spark, str(pages), str(out), str(state)).awaitTermination()
    rows = spark.read.parquet(str(out)).collect()
    assert sorted((r.page_id.rpartition("/")[2], r.expected_question_count) for r in rows) == [("a.html", 1), ("b.html", 2)]


def test_rollups_late_rows_restarts_and_totals(spark, tmp_path):
    """Rows within the lateness count, later ones do not; a second run goes on where the first stopped."""
    source, out, state = (str(tmp_path / x) for x in ("events", "out", "state"))
    shape = "ts timestamp, kind string, value double"

    def run(rows):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(shape).parquet(source)
        rollups.keep_rollups(stream, out, state, ["kind"], "value").awaitTermination()
        return {(r.begins.hour, r.kind): (r.n, r.total) for r in rollups.latest(spark, out, ["kind"]).collect()}

    at = lambda h, m=0: datetime(2024, 1, 1, h, m)
    first = run([(at(9), "view", 1.0), (at(9, 59), "view", 2.0), (at(12), "click", 5.0), (at(12), None, None)])
    assert first == {(9, "view"): (2, 3.0), (12, "click"): (1, 5.0), (12, None): (1, 0.0)}
    second = run([(at(11), "click", 1.0), (at(12, 30), "click", 1.0)])  # an hour late, which is not too late
    assert second == first | {(11, "click"): (1, 1.0), (12, "click"): (2, 6.0)}
    third = run([(at(7), "view", 100.0), (at(9, 30), "view", 100.0), (at(15), "view", 1.0)])  # 7 and 9 are closed
    assert third == second | {(15, "view"): (1, 1.0)}
    # A batch that is run again leaves the same rows; nothing new, nothing changed.
    stream = spark.readStream.schema(shape).parquet(source)
    rollups.keep_rollups(stream, out, state, ["kind"], "value").awaitTermination()
    assert {(r.begins.hour, r.kind): (r.n, r.total) for r in rollups.latest(spark, out, ["kind"]).collect()} == third
