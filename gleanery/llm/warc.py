"""WARC archives as a PySpark Python data source.

    spark.dataSource.register(WarcSource)
    df.write.format("warc").mode("append").save("hdfs://.../archive")
    spark.read.format("warc").load("hdfs://.../archive").where("record_type = 'response'")

Files are reached through pyarrow's file systems, so a path may be in any store that
these know.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage
from pyspark.sql.types import BinaryType, LongType, MapType, StringType, StructField, StructType

from gleanery.llm.common import bounded_broadcast, shared_dir, table, text_or_empty, written

SCHEMA = StructType(
    [
        StructField("record_type", StringType()),
        StructField("record_id", StringType()),
        StructField("target_uri", StringType()),
        StructField("date", StringType()),
        StructField("content_type", StringType()),
        StructField("content_length", LongType()),
        StructField("payload_digest", StringType()),
        StructField("refers_to", StringType()),
        StructField("headers", MapType(StringType(), StringType())),
        StructField("payload", BinaryType()),
    ]
)
#: Columns that are headers, by the headers' names (in lower case).
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date", "content_type": "content-type", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
#: The same as they are written.
WRITTEN = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
DATE = "2024-01-01T00:00:00Z"
#: What the standard calls a revisit of the same payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of a file that one task reads; of a file that one task writes.
SPLIT_BYTES, FILE_BYTES = 64 << 20, 512 << 20
#: Bytes taken from a file at once while headers are looked for.
READ_BYTES = 1 << 16
#: Rows and payload bytes of a batch handed to Spark.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20
#: Digests (of payloads that occur twice) up to which they are broadcast.
SMALL = 500_000
#: A compressed file has no known end of its records; it is one stretch.
ENDLESS = 1 << 62
MARK = b"WARC/1.1\r\n"


def digest(payload: bytes) -> str:
    """Base32 of the SHA-1, in upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digest_column(payload: Column) -> Column:
    """The same of a column: five hex digits are four of base 32."""
    h = F.sha1(payload)
    fours = (F.lpad(F.conv(F.substring(h, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5))
    return F.translate(F.concat(*fours), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return (pafs.LocalFileSystem(), unquote(urlparse(path).path)) if path.startswith("file:") else pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def record(headers: dict[str, str], payload: bytes) -> bytes:
    """A record: version, headers, empty line, payload, two empty lines."""
    lines = [f"{k}: {v}" for k, v in headers.items()] + [f"Content-Length: {len(payload)}"]
    return MARK + "\r\n".join(x.replace("\r", " ").replace("\n", " ") for x in lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


@dataclass
class Stretch(InputPartition):
    """A record belongs to the stretch of its file that its first byte is in."""

    path: str
    start: int
    end: int


class _Cursor:
    """Reads a file from front to back; what is skipped is not read."""

    def __init__(self, file, at: int, size: int | None = None) -> None:
        self.file, self.at, self.size, self.held = file, at, size, b""
        file.seek(at)

    def more(self) -> bool:
        new = self.file.read(READ_BYTES)
        self.held += new
        return bool(new)

    def until(self, mark: bytes) -> bytes | None:
        """What comes before the next mark, and the mark; None if there is none."""
        looked = 0
        while (i := self.held.find(mark, looked)) < 0:
            looked = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                return None
        return self.take(i + len(mark))

    def take(self, n: int) -> bytes:
        """The next n bytes; an archive that ends before them is damaged."""
        if n > len(self.held):
            self.held += self.file.read(n - len(self.held))
        if n > len(self.held):
            raise ValueError(f"archive ends {n - len(self.held)} bytes early, in the record at {self.at}")
        out, self.held = self.held[:n], self.held[n:]
        self.at += len(out)
        return out

    def skip(self, n: int) -> None:
        if n <= len(self.held):
            self.held = self.held[n:]
        else:
            self.file.seek(self.at + n)
            self.held = b""
            # A plain file can be sought past its end; in a compressed one the place stays at the end.
            if self.at + n > (self.file.tell() if self.size is None else self.size):
                raise ValueError(f"archive ends early, in the record at {self.at}")
        self.at += n


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, split: int) -> None:
        self.path, self.schema, self.split = path, schema, split
        self.wanted: dict[str, set[str] | None] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality, IN and IS NOT NULL on header columns; hands the others back."""
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column not in HEADERS:
                yield f
            elif isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                old = self.wanted.get(column)
                self.wanted[column] = values if old is None else old & values
            elif isinstance(f, IsNotNull):
                self.wanted.setdefault(column, None)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, path = _file_system(self.path)
        found = fs.get_file_info(pafs.FileSelector(path, recursive=True)) if fs.get_file_info(path).type == pafs.FileType.Directory else [fs.get_file_info(path)]
        files = sorted((f for f in found if f.type == pafs.FileType.File), key=lambda f: f.path)
        plain = [Stretch(f.path, at, min(at + self.split, f.size)) for f in files if f.path.endswith(".warc") for at in range(0, f.size, self.split)]
        return plain + [Stretch(f.path, 0, ENDLESS) for f in files if f.path.endswith(".warc.gz")]

    def _passes(self, headers: dict[str, str]) -> bool:
        for column, values in self.wanted.items():
            v = headers.get(HEADERS[column])
            if v is None or (values is not None and v not in values):
                return False
        return True

    def read(self, partition: Stretch | None) -> Iterator[pa.RecordBatch]:
        """Headers first; the payload of a record that the filters drop, or of a query
        that does not ask for payloads, is passed over. None: there are no files. A file that ends within
        a record, or a payload that is not as long as it says, is an error."""
        if partition is None:
            return
        fs, _ = _file_system(self.path)
        names = self.schema.names
        arrow = pa.schema([(f.name, {"binary": pa.binary(), "bigint": pa.int64(), "map<string,string>": pa.map_(pa.string(), pa.string())}.get(f.dataType.simpleString(), pa.string())) for f in self.schema])
        rows: list[dict] = []
        size = 0
        with fs.open_input_file(partition.path) as file:
            packed = partition.end == ENDLESS
            c = _Cursor(gzip.GzipFile(fileobj=file) if packed else file, partition.start, None if packed else file.size())
            if partition.start and not self._first(c, partition):
                return
            while c.at < partition.end:
                if not c.held and not c.more():
                    break
                head = c.until(b"\r\n\r\n")
                if head is None:
                    raise ValueError(f"archive ends in the headers at {c.at} of {partition.path}")
                if not head.startswith(b"WARC/"):
                    raise ValueError(f"no WARC record at {c.at - len(head)} of {partition.path}")
                headers = {}
                for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:]:
                    key, colon, value = line.partition(":")
                    if colon:
                        headers[key.strip().lower()] = value.strip()
                length = int(headers["content-length"])
                if not self._passes(headers):
                    c.skip(length + 4)
                    continue
                row = {n: headers.get(HEADERS[n]) for n in names if n in HEADERS}
                if "payload" in names:
                    row["payload"] = c.take(length)
                    if c.take(4) != b"\r\n\r\n":
                        raise ValueError(f"the record before {c.at} of {partition.path} is longer than it says")
                    size += length
                else:
                    c.skip(length + 4)
                if "content_length" in names:
                    row["content_length"] = length
                if "headers" in names:
                    row["headers"] = list(headers.items())
                rows.append(row)
                if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    def _first(self, c: _Cursor, partition: Stretch) -> bool:
        """Moves to the first record that begins in the stretch. Payloads may hold what
        looks like a record, so the search starts from the file's beginning, over headers only."""
        c.__init__(c.file, 0, c.size)
        while c.at < partition.start:
            head = c.until(b"\r\n\r\n")
            if head is None:
                return False
            length = next(int(line.partition(b":")[2]) for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:"))
            c.skip(length + 4)
        return c.at < partition.end


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Writes a file a task, under a name of its own; with gzip, each record as a member of
    its own. A task's file counts once it is committed: until then it has another ending, and
    tasks that fail leave no archive."""

    def __init__(self, path: str, limit: int, packed: bool) -> None:
        self.path, self.limit, self.packed = path, limit, packed

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, path = _file_system(self.path)
        fs.create_dir(path, recursive=True)
        paths: list[str] = []
        out = None
        for b in batches:
            columns = {n: b.column(n).to_pylist() for n in b.schema.names}
            own = {WRITTEN[n]: columns[n] for n in WRITTEN if n in columns}
            known = {k.lower() for k in WRITTEN.values()} | {"content-length"}
            extra, payloads = columns.get("headers"), columns.get("payload")
            for i in range(b.num_rows):
                if out is None or out.tell() >= self.limit:
                    if out is not None:
                        out.close()
                    paths.append(f"{path}/{uuid.uuid4().hex}.warc{'.gz' if self.packed else ''}")
                    out = fs.open_output_stream(paths[-1] + ".part", compression=None)
                headers = {k: v[i] for k, v in own.items() if v[i] is not None}
                headers |= {k: x for k, x in (extra and extra[i] or ()) if k.lower() not in known and x is not None}
                r = record(headers, payloads and payloads[i] or b"")
                out.write(gzip.compress(r, mtime=0) if self.packed else r)
        if out is not None:
            out.close()
        return Written(paths)

    def commit(self, messages: list[Written | None]) -> None:
        fs, _ = _file_system(self.path)
        for m in messages:
            for p in m.paths if m else ():
                fs.move(p + ".part", p)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = _file_system(self.path)
        for m in messages:
            for p in m.paths if m else ():
                if fs.get_file_info(p + ".part").type == pafs.FileType.File:
                    fs.delete_file(p + ".part")


class WarcSource(DataSource):
    """Format "warc": files .warc, read in stretches, and .warc.gz, each read by one task.
    Options: path; split_bytes, file_bytes; compression: gzip, for writing; columns: a comma-separated
    list of the columns to read (all by default). Python data sources are not told which
    columns a query uses, so a scan that needs no payloads says so with `columns`."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> StructType:
        asked = self.options.get("columns")
        return SCHEMA if not asked else StructType([SCHEMA[c.strip()] for c in asked.split(",")])

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options["path"], schema, int(self.options.get("split_bytes", SPLIT_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], int(self.options.get("file_bytes", FILE_BYTES)), self.options.get("compression") == "gzip")


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def archive_rows(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages (page_id, url, html) as rows of WARC records.

    Of the records with equal payloads of `least` bytes or more, that of the least page_id
    (and of the least url, where pages share an id; null ids and urls come last) is the
    response and holds the payload; the others are revisits of it, with its record id in
    WARC-Refers-To, the profile of that kind, and without a payload, whose length and digest they keep in headers. Rows
    that are equal in all of page_id, url and payload are each what one of them is. A record's
    id is made of page_id and digest, a revisit's of its url too. Null html is an empty
    payload; payloads are taken whole. Empty table: no records. Other columns are not read.
    """
    rows = pages.select("page_id", "url", text_or_empty("html").alias("html")).withColumn("digest", digest_column(F.col("html").cast("binary"))).withColumn("n_bytes", F.octet_length("html"))
    # Only payloads that occur twice need a first page; those of one copy, nearly all, get none.
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.col("url").isNull().alias("nowhere"), "url")
    firsts = rows.where(F.col("n_bytes") >= least).groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    joined = rows.join(bounded_broadcast(written(firsts, "first-pages"), SMALL), "digest", "left")
    is_first = F.col("first").isNull() | (F.col("n_bytes") < least) | F.col("first").eqNullSafe(rank)
    name = lambda c, *more: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(":"), F.col("digest"), *more, F.lit(">"))
    return joined.select(
        F.when(is_first, "response").otherwise("revisit").alias("record_type"),
        F.when(is_first, name(F.col("page_id"))).otherwise(name(F.col("page_id"), F.lit(":"), F.md5(F.coalesce("url", F.lit(""))))).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(DATE).alias("date"),
        F.lit("text/html").alias("content_type"),
        F.when(is_first, F.col("n_bytes")).otherwise(0).cast("long").alias("content_length"),
        F.concat(F.lit("sha1:"), F.col("digest")).alias("payload_digest"),
        F.when(~is_first, name(F.col("first.page_id"))).alias("refers_to"),
        F.when(is_first, F.create_map(F.lit("X-Payload-Bytes"), F.col("n_bytes").cast("string"))).otherwise(F.create_map(F.lit("X-Payload-Bytes"), F.col("n_bytes").cast("string"), F.lit("WARC-Profile"), F.lit(PROFILE))).alias("headers"),
        F.when(is_first, F.col("html").cast("binary")).alias("payload"),
    )


def page_of(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, "^<urn:page:([^:]*):.*>$", 1), F.lit("")).cast("long")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive read back in two scans, each of which drops the other's records by their
    headers: responses with their payloads, and revisits from their headers alone."""
    register(spark)
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    archive_rows(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(path)
    read = spark.read.format("warc")
    responses = read.option("columns", "record_type,record_id,payload").load(path).where("record_type = 'response'")
    revisits = read.option("columns", "record_type,record_id,payload_digest,refers_to,headers").load(path).where("record_type = 'revisit'")
    page = page_of(F.col("record_id")).alias("page_id")
    # A response's digest is taken of the payload as read back; a revisit's is its header's.
    found = responses.select(page, F.octet_length("payload").cast("long").alias("payload_bytes"), digest_column(F.col("payload")).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    again = revisits.select(page, F.col("headers")["x-payload-bytes"].cast("long"), F.regexp_replace("payload_digest", "^sha1:", ""), "record_type", page_of(F.col("refers_to")))
    return found.union(again)
