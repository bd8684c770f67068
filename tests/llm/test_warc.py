import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from gleanery.llm import warc as m
from tests.llm.fixtures import save

PAGES = "page_id long, url string, html string, digest string, first long"
TRAP = "x\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nabcde"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)


def table():
    rows = [(i, f"http://e/{i}", f"<p>é {i} {'text ' * i}</p>") for i in range(40)]
    return rows + [(100, "u", None), (101, None, ""), (102, "u\nv", TRAP), (103, "u", TRAP), (7, "again", "<p>other</p>"), (104, "u", "<p>other</p>"), (105, "u", "z" * 300_000)]


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        h = h or ""
        first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        own = first[h or ""] == i or len(b) < least
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if own else "revisit", None if own else first[h or ""]))
    return sorted(out, key=str)


def number(record_id):
    return int(record_id.removeprefix("<urn:page:").split(":")[0] or -1)


def test_null_and_shared_ids(spark, tmp_path):
    rows = [(None, "a", "same"), (None, "b", "same"), (None, None, "same"), (5, "y", "two"), (5, "x", "two"), (5, "x", "other"), (None, "c", "two"), (9, "z", "three"), (9, "z", "three")]
    got = sorted(map(tuple, m.archive_rows(pages(spark, rows)).select("record_type", "target_uri", "record_id", "refers_to").collect()), key=str)
    kinds = sorted((t, u or "-") for t, u, _, _ in got)
    assert kinds == sorted([("response", "a"), ("revisit", "b"), ("revisit", "-"), ("revisit", "y"), ("response", "x"), ("response", "x"), ("revisit", "c"), ("response", "z"), ("response", "z")])
    ids = {r for t, _, r, _ in got if t == "response"}
    assert len({r for _, _, r, _ in got}) == len(rows) - 1 and all(f in ids for t, _, _, f in got if t == "revisit")  # equal rows share one id
    back = m.op4(spark, save(pages(spark, rows), tmp_path, "pages")).collect()
    assert sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in back if r.payload_bytes == 4) == [("None", "response", "None"), ("None", "revisit", "None"), ("None", "revisit", "None")]


def test_gzip_members(spark, tmp_path):
    m.register(spark)
    rows = table()
    path = str(tmp_path / "packed")
    m.archive_rows(pages(spark, rows)).repartition(2).write.format("warc").mode("append").option("compression", "gzip").option("file_bytes", 2_000).save(path)
    names = [f.name for f in (tmp_path / "packed").iterdir()]
    assert len(names) > 2 and all(n.endswith(".warc.gz") for n in names)
    read = spark.read.format("warc").load(path)
    assert read.count() == len(rows)
    assert sorted(number(r.record_id) for r in read.where("record_type = 'revisit'").collect()) == sorted(i for i, _, _, k, _ in expected(rows) if k == "revisit")
    assert {number(r.record_id): bytes(r.payload).decode() for r in read.where("record_type = 'response'").collect()}[105] == "z" * 300_000


def test_round_trip_in_one_query(spark, tmp_path):
    rows = table()
    got = m.op4(spark, save(pages(spark, rows), tmp_path, "pages")).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_splits_filters_and_columns(spark, tmp_path):
    m.register(spark)
    rows = table()
    path = str(tmp_path / "archive")
    m.archive_rows(pages(spark, rows)).repartition(2).write.format("warc").mode("append").option("file_bytes", 200_000).save(path)
    read = spark.read.format("warc")
    for split in (1 << 26, 20_000, 4_999):
        all_ = read.option("split_bytes", split).load(path).collect()
        assert len(all_) == len(rows)
        responses = {number(r.record_id): bytes(r.payload).decode() for r in all_ if r.record_type == "response"}
        assert responses[102] == TRAP and responses[100] == "" and len({r.record_id for r in all_}) == len(rows)
    some = read.load(path).where("record_type = 'revisit' and target_uri = 'u' and content_length = 0").select("record_id").collect()
    assert sorted(number(r.record_id) for r in some) == [103, 104]
    thin = read.option("columns", "record_id,content_length").load(path)
    assert thin.columns == ["record_id", "content_length"]
    assert thin.agg(F.sum("content_length")).first()[0] == sum(n for i, n, _, kind, _ in expected(rows) if kind == "response")


def test_pushed_filters_skip_payloads(tmp_path):
    """Payload bytes of records that a filter drops are not read."""
    from pyspark.sql.datasource import EqualTo, GreaterThan

    reader = m.WarcReader(str(tmp_path), m.SCHEMA, 1 << 20)
    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("content_length",), 5)]))
    assert [type(f).__name__ for f in left] == ["GreaterThan"] and reader.wanted == {"record_type": {"revisit"}}
    big = b"q" * (5 << 20)
    with open(tmp_path / "a.warc", "wb") as f:
        f.write(m.record({"WARC-Type": "response"}, big) + m.record({"WARC-Type": "revisit"}, b""))
    (only,) = list(reader.read(m.Stretch(str(tmp_path / "a.warc"), 0, 6 << 20)))
    assert only.column("record_type").to_pylist() == ["revisit"]

    class Counting:
        def __init__(self, f):
            self.f, self.n = f, 0

        def seek(self, at):
            self.f.seek(at)

        def read(self, n):
            out = self.f.read(n)
            self.n += len(out)
            return out

    with open(tmp_path / "a.warc", "rb") as f:
        counted = Counting(f)
        c = m._Cursor(counted, 0, (tmp_path / "a.warc").stat().st_size)
        head = c.until(b"\r\n\r\n")
        c.skip(len(big) + 4)
        assert c.until(b"\r\n\r\n") and head and counted.n <= 2 * m.READ_BYTES


def test_least_bytes_and_empty_table(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    kinds = {number(r.record_id): r.record_type for r in m.archive_rows(pages(spark, rows), least=5).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert m.op4(spark, save(pages(spark, []), tmp_path, "pages")).count() == 0


@pytest.mark.parametrize("packed", [False, True])
def test_damaged_archives_are_errors(tmp_path, packed):
    """What is cut off, or is longer than it says, does not pass as whole, with payloads or without."""
    records = [m.record({"WARC-Type": "response", "WARC-Record-ID": f"<urn:page:{i}:x>"}, b"y" * 1000) for i in range(3)]
    made = b"".join(gzip.compress(r) if packed else r for r in records)
    whole = b"".join(records)
    places = {"payload": len(whole) - 400, "end": len(whole) - 2, "headers": len(whole) - 1030, "version": 2 * len(records[0]) + 3}
    file = tmp_path / f"a.warc{'.gz' if packed else ''}"
    columns = ("record_id,payload", "record_id")

    def read(names):
        reader = m.WarcReader(str(file), m.StructType([m.SCHEMA[c] for c in names.split(",")]), 1 << 20)
        return sum(b.num_rows for p in reader.partitions() for b in reader.read(p))

    file.write_bytes(made)
    assert [read(c) for c in columns] == [3, 3]
    for n in places.values():
        file.write_bytes(gzip.compress(whole[:n]) if packed else whole[:n])
        for c in columns:
            with pytest.raises(ValueError, match="archive ends"):
                read(c)
    longer = whole.replace(b"Content-Length: 1000", b"Content-Length: 0900")
    file.write_bytes(gzip.compress(longer) if packed else longer)
    for c in columns:
        with pytest.raises(ValueError):
            read(c)


def test_revisits_tell_their_profile(spark, tmp_path):
    m.register(spark)
    m.archive_rows(pages(spark, [(1, "a", "same"), (2, "b", "same")])).write.format("warc").mode("append").save(str(tmp_path))
    got = {r.record_type: r.headers for r in spark.read.format("warc").load(str(tmp_path)).collect()}
    assert got["revisit"]["warc-profile"] == m.PROFILE and "warc-profile" not in got["response"]
