"""Fetched pages as rows, failures included; folders that a table prunes."""

import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from gleanery.sources import fetch
from gleanery.sources import pages as P


class Site(BaseHTTPRequestHandler):
    seen: list = []

    def do_GET(self):
        Site.seen.append((self.path, self.headers["User-Agent"]))
        if self.path == "/slow":
            time.sleep(3)
        body = b"<p>\xff caf\xc3\xa9 " + self.path.encode()
        self.send_response({"/gone": 404, "/broken": 500}.get(self.path, 200))
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def site():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_pages_are_fetched_and_failures_are_rows(spark, site, tmp_path):
    fetch.register(spark)
    (tmp_path / "own.html").write_text("<p>own é")
    lists = tmp_path / "lists"
    lists.mkdir()
    many = [f"{site}/p{i}" for i in range(60)]
    (lists / "a.txt").write_text("\n".join([*many, "", f"{site}/gone", f"{site}/broken", f"{site}/slow", many[0]]) + "\n")
    (lists / "b.txt").write_text("\n".join([(tmp_path / "own.html").as_uri(), "file:///nowhere/x", "http://127.0.0.1:1/x", "mailto:a@b", "http://[bad"]))
    read = spark.read.format("pages").option("path", str(lists)).option("timeout", "1").option("split_bytes", "200").option("agent", "tester").load()
    assert read.rdd.getNumPartitions() > 5
    rows = read.collect()
    got = {r.url: r for r in rows}
    assert len(rows) == 60 + 4 + 5 and sum(r.url == many[0] for r in rows) == 2
    assert all(got[u].status == 200 and got[u].html == f"<p>� café /p{i}" and got[u].error is None for i, u in enumerate(many))
    assert [(got[f"{site}/{x}"].status, got[f"{site}/{x}"].html, got[f"{site}/{x}"].error) for x in ("gone", "broken", "slow")] == [(404, None, "status 404"), (500, None, "status 500"), (None, None, "timed out")]
    assert got[(tmp_path / "own.html").as_uri()].html == "<p>own é"
    failed = [r for r in rows if r.error is not None]
    assert len(failed) == 7 and all(r.html is None for r in failed)
    assert {a for _, a in Site.seen} == {"tester"}


def test_no_lists(spark, tmp_path):
    fetch.register(spark)
    assert spark.read.format("pages").option("path", str(tmp_path)).load().count() == 0


def test_only_chosen_folders_are_read(spark, tmp_path):
    rows = spark.range(400).select("id", F.when(F.col("id") % 2 == 0, "biology").otherwise("physics").alias("subject"), F.concat(F.lit("X"), (F.col("id") % 5).cast("string")).alias("class"))
    P.write_chapters(rows, str(tmp_path / "q"))
    assert len(list((tmp_path / "q").glob("subject=*/class=*"))) == 10
    config = spark.createDataFrame([("biology", "X1", 1), ("biology", "X2", 2), ("physics", "X1", 0)], "subject string, class string, rank int").where("rank > 0")
    found = P.chosen_chapters(spark, str(tmp_path / "q"), "id long", config)
    assert sorted(r.id for r in found.collect()) == [i for i in range(0, 400, 2) if i % 5 in (1, 2)]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
