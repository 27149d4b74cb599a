"""The end-to-end jobs: feed, historical, archive replay, URL list, batch feed, dump and reload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire import schema
from tidewire.config import Config
from tidewire.functions import text as X
from tidewire.functions import urls as U
from tidewire.operators import classify as C
from tidewire.operators import crawl, dedup, index, parse
from tidewire.shared import stash
from tidewire.sources import warc


def passing() -> Column:
    """Whether a row still passes, for the stage that carry_on runs."""
    return F.col("__action") == "pass"


def carry_on(df: DataFrame, stage, *args, changes: Sequence[str] = (), **kwargs) -> DataFrame:
    """Run a stage in the same pass over all rows: what it says counts for the rows that passed so far, the
    others keep the disposition they have, and nulls in the columns that the stage adds.

    The stage sees the rows that no longer pass too, as it must drop none; passing() tells them apart. changes: columns
    of df that the stage overwrites; rows that no longer pass keep theirs.
    """
    was = {c: f"__was_{c}" for c in changes if c in df.columns}
    held = df.withColumnsRenamed({"disposition": "__disposition", "action": "__action"}).withColumns({w: F.col(c) for c, w in was.items()})
    out = stage(held, *args, **kwargs)
    now = {c: F.when(passing(), F.col(c)).otherwise(F.col(f"__{c}")) for c in ("disposition", "action")}
    now |= {c: F.when(passing(), F.col(c)).otherwise(F.col(w)) for c, w in was.items()}
    now |= {c: F.when(passing(), F.col(c)) for c in out.columns if c not in held.columns and c not in now}
    return out.withColumns(now).drop("__disposition", "__action", *was.values())


def own_key(key: Column, *order: str) -> Column:
    """The key of rows that still pass; the others get one that meets no other, so they gather nowhere."""
    return F.when(passing(), key.cast("string")).otherwise(F.concat(F.lit("\u0000"), F.xxhash64(*order).cast("string")))


def check_stage(df: DataFrame, cfg: Config, url: str = "url") -> DataFrame:
    return C.disposed(df, U.check_url(F.col(url), cfg.excluded_domains), passed="checked")


def parse_stage(df: DataFrame, cfg: Config, batch_ts: Column, need_url: bool = False) -> DataFrame:
    """From (url, html, raw_encoding, http_encoding) to content, in order of the contract. need_url: the page
    itself is to tell the URL, which then takes the place of the mark."""
    df = carry_on(df, parse.decode_html, where=passing(), changes=("text", "encoding"))
    df = carry_on(df, parse.extract_content, batch_ts, cfg.public_suffixes, least=cfg.min_text_chars, where=passing(), changes=parse.CONTENT)
    if not need_url:
        return carry_on(df, C.gate_parsed)
    df = carry_on(df, C.gate_parsed, need_url=True, sentinel=cfg.need_canonical_url, excluded=cfg.excluded_domains)
    return carry_on(df, C.adopt_canonical_url, cfg.need_canonical_url, cfg.excluded_domains, cfg.public_suffixes, changes=("final_url", "url", "canonical_domain", "is_homepage"))


def index_stage(df: DataFrame, known: DataFrame, cfg: Config, batch_ts: Column, order: str) -> DataFrame:
    """Gates, dates, truncation and create-only dispositions of passing rows; the document's fields in place.

    Rows without data, URL or text go to quarantine; a feed's date that can't be read is tried again (retry);
    long texts are cut from their composed normal form; the rest is created, or a duplicate.
    """

    def dated(x: DataFrame) -> DataFrame:
        if "pub_date" not in x.columns:
            x = x.withColumn("pub_date", F.lit(None).cast("string"))
        x = index.resolve_pub_date(x)
        again = F.col("pub_date_status") == "retry"
        return C.disposed(x, F.when(again, "bad-pub-date"), passed="dated", retry=again)

    def documents(x: DataFrame) -> DataFrame:
        x = x.withColumn("indexed_date", index.resolve_indexed_date(F.col("parsed_date"), batch_ts))
        for name in ("text_content", "article_title"):
            x = X.with_normal_form(x, name, cfg.max_field_bytes, "__nfc")
            x = x.withColumn(name, X.truncate_utf8(F.col(name), cfg.max_field_bytes, F.col("__nfc"))).drop("__nfc")
        x = x.withColumn("doc_id", U.doc_id(F.col("url")))
        x = index.create_only(x.withColumn("__key", own_key(F.col("doc_id"), order)), known.select(F.col("doc_id").alias("__key")), [order], "__key").drop("__key")
        return x.withColumn("action", F.when(F.col("disposition") == "created", "pass").otherwise("discard"))

    df = carry_on(carry_on(df, C.gate_index), dated, changes=("pub_date", "pub_date_status", "publication_date"))
    return carry_on(df, documents, changes=("indexed_date", "text_content", "article_title", "doc_id"))


def _fields(df: DataFrame, spec: str, **names: str) -> Column:
    """A part of a story from columns of the same names (or the given ones), null where there is none."""
    out = []
    for name, kind in (f.rsplit(" ", 1) for f in spec.split(", ")):
        source = names.get(name, name)
        out.append((F.col(source) if source in df.columns else F.lit(None)).cast(kind).alias(name))
    return F.struct(*out)


def to_stories(df: DataFrame, *keep: str) -> DataFrame:
    """The four parts of a story from the flat columns of a job, beside the columns of `keep`."""
    return df.select(
        *keep,
        _fields(df, schema.RSS_ENTRY).alias("rss_entry"),
        _fields(df, schema.RAW_HTML, encoding="raw_encoding").alias("raw_html"),
        _fields(df, schema.HTTP_METADATA, final_url="url", encoding="http_encoding", response_code="status" if "status" in df.columns else "response_code").alias("http_metadata"),
        _fields(df, schema.CONTENT_METADATA).alias("content_metadata"),
    )


def archive_created(out: DataFrame, archive: str | None, batch_ts: Column, cfg: Config) -> DataFrame:
    """The dispositions of a job, as a written table, and its created stories in archives below `archive`;
    without a path nothing is written and the dispositions stay a plan."""
    if archive is None:
        return out
    out = stash(out)
    archive_stories(to_stories(out.where("disposition = 'created'")), archive, batch_ts, cfg)
    return out


def captured_job(queued: DataFrame, responses: DataFrame, known: DataFrame, cfg: Config, batch_ts: Column, order: str, archive: str | None = None) -> DataFrame:
    """Queued rows (url, disposition, action) with captured responses (url, status, body, …) through fetch
    results, parsing and the index into archives."""
    held = responses.withColumnRenamed("url", "__url")
    fetched = carry_on(queued, lambda x: C.classify_fetch(x.join(held, own_key(x["url"], order) == held["__url"], "left").drop("__url"), cfg.max_html_bytes))
    fetched = fetched.withColumn("html", F.col("body")).withColumns({"raw_encoding": F.col("encoding"), "http_encoding": F.lit(None).cast("string")}).drop("encoding", "body")
    return archive_created(index_stage(parse_stage(fetched, cfg, batch_ts), known, cfg, batch_ts, order), archive, batch_ts, cfg)


def crawl_feed_job(entries: DataFrame, responses: DataFrame, known: DataFrame, cfg: Config, batch_ts: Column, order: str = "link", archive: str | None = None) -> DataFrame:
    """Entries of feed files and feed rows (link, pub_date, …, disposition), as their readers give them, with
    captured responses, to the index and archives: every entry has exactly one disposition."""
    queued = entries.withColumn("url", F.col("link")).withColumn("action", F.when(F.col("disposition") == "queuing", "pass").otherwise("discard"))
    queued = carry_on(queued, lambda x: check_stage(x, cfg))
    return captured_job(queued, responses, known, cfg, batch_ts, order, archive)


def feed_job(stories: DataFrame, known: DataFrame, cfg: Config, batch_ts: Column, order: str) -> DataFrame:
    """Captured stories (url, html, encodings) to dispositions of an index: every row has exactly one."""
    return index_stage(parse_stage(check_stage(stories, cfg), cfg, batch_ts), known, cfg, batch_ts, order)


def history_rows(read: DataFrame) -> DataFrame:
    """Rows of read_history_csv as history_job takes them, in the order of their files."""
    return read.select(
        "file", F.monotonically_increasing_id().alias("pos"), F.col("final_url").alias("url"), "final_url", F.col("link").alias("dlid"), "fetch_timestamp",
        F.date_format(F.timestamp_micros((F.col("fetch_timestamp") * 1_000_000).cast("bigint")), "yyyy-MM-dd HH:mm:ss").alias("collect_date"),
    )


def url_rows(read: DataFrame) -> DataFrame:
    """Rows of read_url_csv as url_list_job takes them, in the order of their files."""
    return read.select("file", F.monotonically_increasing_id().alias("pos"), F.col("final_url").alias("url"))


def history_job(
    rows: DataFrame, objects: DataFrame, known: DataFrame, cfg: Config, batch_ts: Column, versions: DataFrame | None = None,
    overlap: tuple[int, int] = (0, -1), archive: str | None = None, need_url: bool = False,
) -> DataFrame:
    """Rows of historical files (file, pos, url, dlid, fetch_timestamp) with the bodies of their objects (key,
    body, modified_at).

    versions (key, version_id, listed, last_modified): rows whose key lies in `overlap` take the first
    version of their epoch, by their collect_date; objects then have a version_id, null for the only one.
    need_url: rows have the mark for a URL, which the page tells; they are not sifted by URL.
    """
    if need_url:
        digits = F.coalesce(F.col("dlid").rlike("^[0-9]+$"), F.lit(False))
        queued = C.disposed(rows, F.when(~digits, "bad-dlid"), passed="queuing")
    else:
        queued = dedup.dedup_urls_history(rows, cfg.excluded_domains)
    queued = queued.withColumn("key", F.col("dlid").try_cast("bigint"))
    one = F.col("key").cast("string")
    if versions is not None:
        queued = carry_on(queued, dedup.pick_object_version, versions, cfg.epochs, overlap, ["listed"])
        one = F.concat_ws("@", one, F.col("version_id").cast("string"))
        objects = objects.withColumn("object", F.concat_ws("@", F.col("key").cast("string"), F.col("version_id").cast("string")))
    else:
        objects = objects.withColumn("object", F.col("key").cast("string"))
    fetched = carry_on(queued, lambda x: dedup.fetch_objects(x.withColumn("object", own_key(one, "pos")), objects, "object", cfg.max_html_bytes), changes=("fetch_timestamp",))
    none = F.lit(None).cast("string")
    fetched = fetched.withColumn("html", F.col("body")).drop("body", "object").withColumns({"raw_encoding": none, "http_encoding": none})
    return archive_created(index_stage(parse_stage(fetched, cfg, batch_ts, need_url), known, cfg, batch_ts, "pos"), archive, batch_ts, cfg)


def url_list_job(rows: DataFrame, responses: DataFrame, known: DataFrame, cfg: Config, batch_ts: Column, archive: str | None = None) -> DataFrame:
    """Rows of URL files (file, pos, url) with captured responses (url, status, body, …)."""
    return captured_job(dedup.dedup_urls_csv(rows, cfg.excluded_domains), responses, known, cfg, batch_ts, "pos", archive)


def batch_feed_job(rows: DataFrame, responses: DataFrame, known: DataFrame, cfg: Config, batch_ts: Column, batches: int = 20, archive: str | None = None) -> DataFrame:
    """Feed rows (pos, url, domain) packed into batches by domain, then as url_list_job, by the older tests."""
    packed = crawl.attach_batch(rows, crawl.pack_domains(rows, batches))
    held = responses.withColumnRenamed("url", "__url")
    joined = packed.join(held, packed["url"] == held["__url"], "left").drop("__url").withColumn("final_url", F.col("url"))
    joined = joined.withColumn("size", F.octet_length("body"))
    fetched = C.classify_fetch_batch(joined, cfg.excluded_domains, cfg.max_html_bytes)
    fetched = fetched.withColumn("html", F.col("body")).withColumns({"raw_encoding": F.col("encoding"), "http_encoding": F.lit(None).cast("string")}).drop("encoding", "body")
    return archive_created(index_stage(parse_stage(fetched, cfg, batch_ts), known, cfg, batch_ts, "pos"), archive, batch_ts, cfg)


def archive_stories(stories: DataFrame, path: str, batch_ts: Column, cfg: Config, mode: str = "error", batch: str | None = None) -> DataFrame:
    """Stories to archives of archive_rows stories at most; those that can't be archived are left out."""
    return warc.write_warc(stories, path, batch_ts, max_rows=cfg.archive_rows, raise_errors=False, mode=mode, batch=batch)


def archive_replay(spark: SparkSession, path: str, known: DataFrame, cfg: Config, batch_ts: Column) -> DataFrame:
    """Stories of archives straight to the index: URL and length are checked again, nothing is parsed, and
    the first parsed_date stays."""
    stories = warc.read_warc(spark, path, schema.PARTS)
    rows = stories.select(
        F.col("http_metadata.final_url").alias("final_url"), F.col("rss_entry.link").alias("link"), F.col("rss_entry.pub_date").alias("pub_date"), F.col("raw_html.html").alias("html"),
        F.coalesce("content_metadata.url", "http_metadata.final_url", "rss_entry.link").alias("url"), F.col("content_metadata.article_title").alias("article_title"),
        F.col("content_metadata.text_content").alias("text_content"), F.col("content_metadata.canonical_domain").alias("canonical_domain"), F.col("content_metadata.language").alias("language"),
        F.col("content_metadata.publication_date").alias("publication_date"), "parsed_date",
    )
    checked = C.gate_producer(rows, cfg.excluded_domains, check_html=True, most=cfg.max_html_bytes)
    return index_stage(checked, known, cfg, batch_ts, "url")


def dump_stories(stories: DataFrame, path: str, batch_ts: Column) -> DataFrame:
    """Any stories to archives; those that can't be are left out."""
    return warc.write_warc(stories, path, batch_ts, prefix="dump", raise_errors=False)


def reload_stories(spark: SparkSession, path: str, include: tuple[str, ...] | None = None, exclude: tuple[str, ...] | None = None) -> DataFrame:
    """Stories of a dump, by domains if they are asked for."""
    stories = warc.read_warc(spark, path, schema.PARTS)
    if include is None and exclude is None:
        return stories
    flat = stories.withColumns({"__a": F.col("rss_entry.link"), "__b": F.col("http_metadata.final_url"), "__c": F.col("content_metadata.url")})
    return U.filter_domains(flat, ["__a", "__b", "__c"], include, exclude).drop("__a", "__b", "__c")
