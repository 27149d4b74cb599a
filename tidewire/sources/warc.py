"""Web archives: records are built and laid out with columns; tasks write and read them one record at a time.

Paths are local or of a scheme that pyarrow's file systems know (s3, gs, hdfs, abfs), as tasks open archives themselves.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.shared import stash

PARTS = ("rss_entry", "http_metadata", "content_metadata")
END = b"\r\n\r\n"
MANY = 5_000


def archive_layout(df: DataFrame, stamp: Column, prefix: str = "archive", host: str = "spark", rows: int = MANY) -> DataFrame:
    """Add archive (the file's name) and archive_key (YYYY/MM/DD/name): a new archive after `rows` stories of
    a partition. The number of a story in its partition needs no window."""
    number = F.monotonically_increasing_id()
    partition, at = F.shiftright(number, 33), number.bitwiseAND(F.lit((1 << 33) - 1))
    df = df.withColumns({"__partition": partition, "archive_row": at % rows, "__serial": F.floor(at / rows)})
    serial = F.concat_ws("-", F.col("__partition").cast("string"), F.col("__serial").cast("string"))
    name = F.concat_ws("-", F.lit(prefix), F.date_format(stamp, "yyyyMMddHHmmss"), serial, F.lit(host))
    df = df.withColumn("archive", F.concat(name, F.lit(".warc")))
    return df.withColumn("archive_key", F.concat(F.date_format(stamp, "yyyy/MM/dd/"), "archive")).drop("__partition", "__serial")


def layout_counts(laid: DataFrame) -> DataFrame:
    return laid.groupBy("archive").agg(F.count("*").alias("stories"), (F.max("archive_row") + 1).alias("last_row"))


def _uuid(*of: Column) -> Column:
    h = F.md5(F.concat_ws("\u0001", *of))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def _record(kind: str, headers: list[tuple[str, Column]], body: Column) -> Column:
    head = F.concat(F.lit(f"WARC/1.0\r\nWARC-Type: {kind}\r\n"), *[F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")) for k, v in headers])
    size = F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(_bytes(F.concat(head, size)), body)


def target_uri(df_url: str = "content_metadata.original_url") -> Column:
    names = ("http_metadata.final_url", df_url, "content_metadata.url", "rss_entry.link")
    return F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names])


def to_records(stories: DataFrame, now: Column) -> DataFrame:
    """Add response and metadata: the records of a story, each with its closing blank lines; null with
    disposition no-url or no-html for stories that can't be archived."""
    uri, html = target_uri(), F.col("raw_html.html")
    code = F.col("http_metadata.response_code")
    when = F.coalesce(F.timestamp_seconds(F.floor("http_metadata.fetch_timestamp")), now)
    date = F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    encoding = F.coalesce("http_metadata.encoding", "raw_html.encoding", F.lit("utf-8"))
    status = F.concat(F.lit("HTTP/1.0 "), F.when(F.coalesce(code, F.lit(200)) == 200, "200 OK").otherwise(F.concat(code.cast("string"), F.lit(" HUH?"))))
    http = F.concat(_bytes(F.concat(status, F.lit("\r\nContent-Type: text/html; encoding="), encoding, F.lit("\r\n\r\n"))), html)
    own = _uuid(uri, date, F.lit("response"))
    meta = _bytes(F.to_json(F.struct(*PARTS), {"ignoreNullFields": "false"}))
    response = _record("response", [("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Record-ID", own), ("Content-Type", F.lit("application/http; msgtype=response"))], http)
    metadata = _record("metadata", [("WARC-Target-URI", uri), ("WARC-Refers-To", own), ("WARC-Date", date), ("WARC-Record-ID", _uuid(uri, date, F.lit("metadata"))), ("Content-Type", F.lit("application/json"))], meta)
    bad = F.when(uri.isNull(), "no-url").when(F.coalesce(F.octet_length(html), F.lit(0)) == 0, "no-html")
    ended = {name: F.when(bad.isNull(), F.concat(record, F.lit(END))) for name, record in (("response", response), ("metadata", metadata))}
    return stories.withColumns({"disposition": F.coalesce(bad, F.lit("archived")), **ended})


def _info(archive: str, stamp: str, software: str) -> bytes:
    """The warcinfo record in front of an archive."""
    body = f"software: {software}\r\nformat: WARC File Format 1.0\r\n"
    date = datetime.strptime(stamp, STAMP).strftime("%Y-%m-%dT%H:%M:%SZ")
    own = uuid.uuid5(uuid.NAMESPACE_URL, archive)
    return f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Date: {date}\r\nWARC-Record-ID: <urn:uuid:{own}>\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n".encode()


def storage(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark gives it, and the path within it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


STAMP = "%Y%m%d%H%M%S"
TEMPORARY = "_temporary"
#: Behind the name of an archive, of the file with the places of its members: numbers of eight bytes each.
MEMBERS = ".members"
WRITTEN = "archive string, stories long, bytes long"


def _write_archives(rows: Iterable[tuple[str, str, bytes, bytes]], path: str, prefix: str, host: str, most: int, software: str) -> Iterator[tuple[str, int, int]]:
    """Write a partition's (stamp, batch, response, metadata) as archives of `most` stories of one batch, one gzip
    member for each record; gives (archive, stories, bytes). Names follow from the batch, or from the partition
    where it is empty, and an archive is moved to its place when it is whole: a task that runs again, or twice,
    leaves the same files."""
    store, root = storage(path)
    task = TaskContext.get()
    draft = f"{root}/{TEMPORARY}/{task.taskAttemptId()}.warc.gz"
    serial, stories, size, out, name, key, held, places = 0, 0, 0, None, "", "", None, []

    def add(record: bytes, at: int) -> int:
        member = gzip.compress(record, mtime=0)
        out.write(member)
        places.append(at)
        return len(member)

    def finish() -> tuple[str, int, int]:
        out.close()
        store.create_dir(key.rpartition("/")[0])
        with store.open_output_stream(f"{key}.gz{MEMBERS}", compression=None) as index:
            index.write(array("q", places).tobytes())
        store.move(draft, f"{key}.gz")
        return name, stories, size

    for stamp, batch, response, metadata in rows:
        if out is not None and batch != held:
            yield finish()
            out = None
        if batch != held:
            serial, held = 0, batch
        if out is None:
            name = f"{prefix}-{stamp}-{batch or task.partitionId()}-{serial}-{host}.warc"
            key = f"{root}/{stamp[:4]}/{stamp[4:6]}/{stamp[6:8]}/{name}"
            store.create_dir(f"{root}/{TEMPORARY}")
            out, stories = store.open_output_stream(draft, compression=None), 0
            places.clear()
            size = add(_info(name, stamp, software), 0)
        size += add(response, size)
        size += add(metadata, size)
        stories += 1
        if stories == most:
            yield finish()
            serial, out = serial + 1, None
    if out is not None:
        yield finish()


def _fresh(path: str, mode: str) -> None:
    """Make way for archives below path: `error` refuses a folder with anything in it, `overwrite` empties it,
    `replace` leaves all but archives of the same names."""
    store, root = storage(path)
    held = store.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    if mode not in ("error", "overwrite", "replace"):
        raise ValueError(f"mode {mode}: archives are written with error, overwrite or replace")
    if mode == "replace":
        return
    if held and mode == "error":
        raise FileExistsError(path)
    if held:
        store.delete_dir_contents(root)


def write_warc(stories: DataFrame, path: str, now: Column, prefix: str = "archive", max_rows: int = MANY, raise_errors: bool = True, mode: str = "error", host: str = "spark", software: str = "tidewire", batch: str | None = None) -> DataFrame:
    """Write the stories that can be archived below path as YYYY/MM/DD/name.warc.gz, a new archive after max_rows
    stories of a partition; gives (archive, stories, bytes, status) of what was written, kept in a written table.
    Stories are read once, or once more before any is written where raise_errors asks for their judgement.
    batch: a column; stories that share it go to archives of their own, named after it, so that the same batch
    leaves the same files whatever comes with it; `now` is to be the same for all of a batch."""
    judged = to_records(stories, now)
    if raise_errors and (first := judged.where("disposition <> 'archived'").select("disposition").first()):
        raise ValueError(first["disposition"])
    _fresh(path, mode)
    of = F.lit("") if batch is None else F.coalesce(F.col(batch).cast("string"), F.lit(""))
    rows = judged.where("disposition = 'archived'").select(F.date_format(now, "yyyyMMddHHmmss").alias("stamp"), of.alias("batch"), "response", "metadata")
    if batch is not None:
        rows = rows.repartition("batch").sortWithinPartitions("batch", "response")

    def run(batches):
        records = (tuple(v.as_py() for v in row) for batch in batches for row in zip(*batch.columns))
        for done in _write_archives(records, path, prefix, host, max_rows, software):
            yield pa.RecordBatch.from_pylist([dict(zip(("archive", "stories", "bytes"), done))])

    try:
        return stash(rows.mapInArrow(run, WRITTEN)).withColumn("status", F.lit("written"))
    finally:
        store, root = storage(path)
        if store.get_file_info(f"{root}/{TEMPORARY}").type == pafs.FileType.Directory:
            store.delete_dir(f"{root}/{TEMPORARY}")


def records(source: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, body) of each record of an archive, gzipped (in one stream or a stream for each
    record) or plain. No more than one record is held."""
    stream = io.BufferedReader(source)
    if stream.peek(2)[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
    while line := stream.readline():
        if not line.startswith(b"WARC/1."):
            continue
        head = {}
        while (line := stream.readline()).strip():
            name, colon, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(": ")
            if colon:
                head[name.lower()] = value
        yield head, stream.read(int(head.get("content-length", 0)))


STORY = "file string, target_uri string, warc_date string, html binary, metadata string"
HEAD = "file string, kind string, id string, refers_to string"
BATCH_ROWS, BATCH_BYTES = 200, 16 << 20


def _stories(name: str, source: BinaryIO) -> Iterator[tuple]:
    """Responses with the metadata record behind that refers to them."""
    held = None
    for head, body in records(source):
        if head.get("warc-type") == "response":
            held = head, body.split(END, 1)[-1]
        elif head.get("warc-type") == "metadata" and held and head.get("warc-refers-to") == held[0].get("warc-record-id"):
            yield name, held[0].get("warc-target-uri"), held[0].get("warc-date"), held[1], body.decode("utf-8", "replace")
            held = None


def _heads(name: str, source: BinaryIO) -> Iterator[tuple]:
    for head, _ in records(source):
        yield name, head.get("warc-type"), head.get("warc-record-id"), head.get("warc-refers-to")


def _scan(spark: SparkSession, path: str, pattern: str, rows_of: Callable[[str, BinaryIO], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows of archives. Spark lists and shares out the files; a task reads each as a stream and hands on
    bounded batches, whatever the size of the archive."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path")
    kinds = [pa.binary() if c.endswith("binary") else pa.string() for c in schema.split(", ")]
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches):
        for name in (n for batch in batches for n in batch["path"].to_pylist()):
            store, place = storage(name)
            rows, size = [], 0
            with store.open_input_stream(place, compression=None) as source:
                for row in rows_of(name, source):
                    rows.append(row)
                    size += sum(len(v) for v in row if v is not None)
                    if len(rows) == BATCH_ROWS or size > BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
            if rows:
                yield batch_of(rows)

    return files.mapInArrow(run, schema)


def read_warc(spark: SparkSession, path: str, part_schemas: dict[str, str], pattern: str = "*.gz") -> DataFrame:
    """Stories of archives: raw_html, the parts in the metadata record by their schemas, parsed_date from the
    metadata or the record's date; raw_html's encoding is the one of http_metadata."""
    return parts_of_stories(_scan(spark, path, pattern, _stories, STORY), part_schemas)


def parts_of_stories(rows: DataFrame, part_schemas: dict[str, str]) -> DataFrame:
    """Rows of STORY as stories."""
    schema = ", ".join(f"{k} struct<{v}>" for k, v in part_schemas.items())
    rows = rows.withColumn("m", F.from_json("metadata", schema))
    raw = F.struct(F.col("html"), F.col("m.http_metadata.encoding").alias("encoding")).alias("raw_html")
    parsed = F.coalesce("m.content_metadata.parsed_date", F.regexp_replace("warc_date", "Z$", "")).alias("parsed_date")
    return rows.select("file", "target_uri", "warc_date", raw, *[F.col(f"m.{k}") for k in part_schemas], parsed)


def pair_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, response_id, metadata_id) by a join on what a metadata record refers to."""
    rows = _scan(spark, path, "*.gz", _heads, HEAD)
    left = rows.where("kind = 'response'").select("file", F.col("id").alias("response_id"))
    right = rows.where("kind = 'metadata'").select("file", F.col("refers_to").alias("response_id"), F.col("id").alias("metadata_id"))
    return left.join(right, ["file", "response_id"])


def dump_headers(headers: dict[str, str]) -> str:
    """Only the headers of the pipeline come back from a dump."""
    return json.dumps({k: v for k, v in headers.items() if k.startswith("x-mc-")})
