"""Web archives as a data source of Spark whose partitions are ranges of bytes, so that one archive is read by
several tasks.

A record belongs to the range in which its gzip member begins; a task reads on past the end of its range for the
metadata of its last story. Where members begin is told by the file that write_warc leaves beside an archive. Of
other archives, a task looks for the first member of its range: a gzip mark, a whole record behind it, and another
member or the end of the file behind that. An archive that is one member is read by the task of its first range.
"""

from __future__ import annotations

import io
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidewire.sources.warc import BATCH_BYTES, BATCH_ROWS, END, HEAD, MEMBERS, STORY, parts_of_stories, records, storage

#: Bytes of a range, and bytes that are read at once.
RANGE, CHUNK = 64 << 20, 1 << 20
MAGIC, GZIP, WARC = b"\x1f\x8b\x08", 31, b"WARC/1."


def _places(store: pafs.FileSystem, path: str) -> array | None:
    """Where the members of an archive begin, if a file beside it tells."""
    if not store.get_file_info(path + MEMBERS).is_file:
        return None
    with store.open_input_stream(path + MEMBERS, compression=None) as index:
        return array("q", index.read())


class _Member(io.RawIOBase):
    """What one gzip member of a file holds, as a stream; `end` is where the next one begins, once it is read."""

    def __init__(self, file: pa.NativeFile, start: int):
        self.file, self.at, self.unzip, self.end = file, start, zlib.decompressobj(GZIP), None
        self.rest = b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while self.end is None:
            if not self.rest:
                self.file.seek(self.at)
                self.rest = self.file.read(CHUNK)
                self.at += len(self.rest)
            some = self.unzip.decompress(self.rest, len(into))
            ended = not self.rest
            self.rest = self.unzip.unused_data if self.unzip.eof else self.unzip.unconsumed_tail
            if self.unzip.eof or ended:  # a member that is cut off ends with the file
                self.end = self.at - len(self.rest)
            if some:
                into[: len(some)] = some
                return len(some)
        return 0


def _begins(file: pa.NativeFile, at: int, size: int) -> bool:
    """Whether a member with a WARC record begins here, and another one, or the end of the file, follows."""
    try:
        member = _Member(file, at)
        if member.read(len(WARC)) != WARC:
            return False
        while member.read(CHUNK):
            pass
    except zlib.error:
        return False
    if member.end >= size:
        return member.unzip.eof
    file.seek(member.end)
    return file.read(len(MAGIC)) == MAGIC


def first_member(file: pa.NativeFile, start: int, end: int, places: array | None) -> int | None:
    """Where the first member begins in a range of bytes."""
    if places is not None:
        k = bisect_left(places, start)
        return places[k] if k < len(places) and places[k] < end else None
    at, size = start, file.size()
    if start == 0:
        return 0
    while at < end:
        file.seek(at)
        chunk = file.read(min(CHUNK, end - at) + len(MAGIC) - 1)
        found = chunk.find(MAGIC)
        while found >= 0:
            if _begins(file, at + found, size):
                return at + found
            found = chunk.find(MAGIC, found + 1)
        at += CHUNK
    return None


def records_from(file: pa.NativeFile, start: int, end: int, places: array | None) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place of its member, headers, body) of the records from the first member of a range on, to the end of the
    file: whoever has enough stops. A range whose bytes hold no beginning of a member has none."""
    at, size = first_member(file, start, end, places), file.size()
    while at is not None and at < size:
        member = _Member(file, at)
        for head, body in records(member):
            yield at, head, body
        while member.read(CHUNK):
            pass
        at = member.end


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int


class WarcReader(DataSourceReader):
    def __init__(self, path: str, pattern: str, size: int, heads: bool):
        self.path, self.pattern, self.size, self.heads = path, pattern, size, heads

    def partitions(self) -> list[ByteRange]:
        """Names and sizes of files are all that the driver sees."""
        store, root = storage(self.path)
        info = store.get_file_info(root)
        files = [info] if info.is_file else store.get_file_info(pafs.FileSelector(root, recursive=True))
        own = sorted((f.path, f.size) for f in files if f.is_file and fnmatch(f.base_name, self.pattern))
        cut = [ByteRange(p, at, min(at + self.size, n)) for p, n in own for at in range(0, n, self.size)]
        return cut or [ByteRange("", 0, 0)]

    def _rows(self, part: ByteRange, file: pa.NativeFile, places: array | None) -> Iterator[tuple]:
        held = None
        for at, head, body in records_from(file, part.start, part.end, places):
            kind = head.get("warc-type")
            if at >= part.end and (held is None or kind != "metadata"):
                return
            if self.heads:
                yield part.path, kind, head.get("warc-record-id"), head.get("warc-refers-to")
            elif kind == "response":
                held = head, body.split(END, 1)[-1]
            elif kind == "metadata" and held and head.get("warc-refers-to") == held[0].get("warc-record-id"):
                yield part.path, held[0].get("warc-target-uri"), held[0].get("warc-date"), held[1], body.decode("utf-8", "replace")
                held = None

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        columns = [c.split(" ") for c in (HEAD if self.heads else STORY).split(", ")]
        schema = pa.schema([(n, pa.binary() if k == "binary" else pa.string()) for n, k in columns])
        store, _ = storage(self.path)
        rows, size = [], 0
        with store.open_input_file(partition.path) as file:
            for row in self._rows(partition, file, _places(store, partition.path)):
                rows.append(row)
                size += sum(len(v) for v in row if v is not None)
                if len(rows) == BATCH_ROWS or size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class WarcSource(DataSource):
    """spark.read.format("warc"): stories, or with the option `only` = `heads` the records' headers, of which no
    body is handed on. Options: `pattern` of file names (*.gz), `range_bytes`."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def _heads(self) -> bool:
        return self.options.get("only") == "heads"

    def schema(self) -> str:
        return HEAD if self._heads() else STORY

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("pattern", "*.gz"), int(self.options.get("range_bytes", RANGE)), self._heads())


def read_ranges(spark: SparkSession, path: str, part_schemas: dict[str, str], range_bytes: int = RANGE) -> DataFrame:
    """Stories of archives as read_warc gives them, an archive by as many tasks as it has ranges."""
    spark.dataSource.register(WarcSource)
    return parts_of_stories(spark.read.format("warc").option("range_bytes", str(range_bytes)).load(path), part_schemas)


def read_heads(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """file, kind, id, refers_to of each record."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("range_bytes", str(range_bytes)).option("only", "heads").load(path)
