"""Pages from addresses: a data source that plans stretches of address lists and fetches in tasks.

    spark.dataSource.register(fetch.PageSource)
    spark.read.format("pages").option("path", "/lists").load()

What cannot be fetched is a row with its error, not a failed job.
"""

from __future__ import annotations

import io
import socket
import urllib.error
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "url string, status int, html string, error string"
#: Bytes of a list that one task takes (some hundreds of addresses), seconds to wait, the name given to servers.
SPLIT_BYTES, TIMEOUT, AGENT = 16 << 10, 120, "Mozilla/5.0"
SCHEMES = ("http://", "https://", "file://")


@dataclass
class Stretch(InputPartition):
    """Lines of a list that begin in [start, end)."""

    path: str
    start: int
    end: int


def fetched(url: str, timeout: float = TIMEOUT, agent: str = AGENT) -> tuple[int | None, str | None, str | None]:
    """status, html and error of an address: one of the last two is null. Other statuses than 200 to 299 are
    errors; bytes that are no UTF-8 become replacement characters."""
    if not url.startswith(SCHEMES):
        return None, None, "no http, https or file address"
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout) as r:
            status = getattr(r, "status", None)
            return status if status is not None else 200, r.read().decode("utf-8", "replace"), None
    except urllib.error.HTTPError as e:
        return e.code, None, f"status {e.code}"
    except (urllib.error.URLError, TimeoutError, socket.timeout, OSError, ValueError) as e:
        reason = getattr(e, "reason", e)
        return None, None, "timed out" if isinstance(reason, (TimeoutError, socket.timeout)) else f"{type(reason).__name__}: {reason}"


class PageReader(DataSourceReader):
    def __init__(self, path: str, split: int, timeout: float, agent: str) -> None:
        self.path, self.split, self.timeout, self.agent = path, split, timeout, agent

    def _files(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.path) if "://" in self.path else (pafs.LocalFileSystem(), self.path.removeprefix("file:"))

    def partitions(self) -> list[InputPartition]:
        fs, path = self._files()
        of = fs.get_file_info(path)
        found = fs.get_file_info(pafs.FileSelector(path, recursive=True)) if of.type == pafs.FileType.Directory else [of]
        files = sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")))
        return [Stretch(p, at, min(at + self.split, size)) for p, size in files for at in range(0, size, self.split)]

    def read(self, partition: Stretch | None) -> Iterator[tuple]:
        if partition is None:
            return
        fs, _ = self._files()
        with io.BufferedReader(fs.open_input_file(partition.path)) as file:
            # A line belongs to the stretch that its first byte is in; the one before reads on to its end.
            file.seek(max(partition.start - 1, 0))
            if partition.start:
                file.readline()
            while file.tell() < partition.end:
                line = file.readline()
                if not line:
                    break
                if url := line.decode("utf-8", "replace").strip():
                    yield (url, *fetched(url, self.timeout, self.agent))


class PageSource(DataSource):
    """Format "pages". Options: path, of lists of addresses, a line each (a file or a folder of any size); timeout
    in seconds; agent; split_bytes. Empty lines are passed over; repeated addresses are fetched and returned each time."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        o = self.options
        return PageReader(o["path"], int(o.get("split_bytes", SPLIT_BYTES)), float(o.get("timeout", TIMEOUT)), o.get("agent", AGENT))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PageSource)
