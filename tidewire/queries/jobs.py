"""Queries over the end-to-end jobs and the streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire import schema
from tidewire.config import FIXTURE
from tidewire.functions import urls as U
from tidewire.operators import crumbs as B
from tidewire.plans import jobs as J
from tidewire.queries.base import INDEX_DOCS, index_docs, stories
from tidewire.queries.crumbs import LINES, messages
from tidewire.queries.dedup import file_rows
from tidewire.queries.sources import archived, now
from tidewire.sources import feeds, warc
from tidewire.shared import new_path, read_table
from tidewire.streaming import jobs as S


def no_index(spark):
    return spark.createDataFrame([], schema.INDEX)


def captured(spark, sf_dir):
    """Pages as captured stories; every tenth comes again under a longer form of its URL."""
    p, none = read_table(spark, sf_dir, "pages"), F.lit(None).cast("string")
    again = p.where("page_id % 10 = 0").select((F.col("page_id") + 1_000_000_000).alias("page_id"), F.concat("url", F.lit("#again")).alias("url"), "html")
    rows = p.select("page_id", "url", "html").unionByName(again)
    return rows.select("page_id", "url", F.encode("html", "UTF-8").alias("html"), none.alias("raw_encoding"), none.alias("http_encoding"))


def j1_flagship(spark, sf_dir):
    """Stories to new index documents, counted by domain and language."""
    out = J.feed_job(captured(spark, sf_dir), no_index(spark), FIXTURE, now(), "page_id")
    return out.where("disposition = 'created'").groupBy("canonical_domain", "language").agg(F.count("*").alias("documents"), F.sum(F.char_length("text_content")).alias("chars"))


def j1_dispositions(spark, sf_dir):
    out = J.feed_job(captured(spark, sf_dir), no_index(spark), FIXTURE, now(), "page_id")
    return B.disposition_counts(out, F.lit("feed"))


def o100_stage_protocol(spark, sf_dir):
    """A stage of the user's own between two of ours: long titles are refused."""

    def own(df):
        long = F.char_length("article_title") > 25
        return df.withColumn("disposition", F.when(long, "long-title").otherwise("kept")).withColumn("action", F.when(long, "discard").otherwise("pass"))

    parsed = J.parse_stage(J.check_stage(captured(spark, sf_dir), FIXTURE), FIXTURE, now())
    return B.disposition_counts(J.carry_on(parsed, own), F.lit("own"))


def j2_history(spark, sf_dir):
    rows = file_rows(spark, sf_dir).withColumn("fetch_timestamp", F.lit(None).cast("double"))
    objects = read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("key"), F.encode("html", "UTF-8").alias("body"), F.col("page_id").cast("double").alias("modified_at"))
    out = J.history_job(rows, objects, no_index(spark), FIXTURE, now())
    return B.disposition_counts(out, F.lit("history"))


def j3_archive_replay(spark, sf_dir):
    """Stories that the first job accepts, archived with their content and read into an empty index again."""
    p, first = stories(spark, sf_dir), J.parse_stage(J.check_stage(captured(spark, sf_dir), FIXTURE), FIXTURE, now()).where("action = 'pass'")
    fields = [f.split()[0] for f in schema.CONTENT_METADATA.split(", ")]
    content = F.struct(*[F.col(f) for f in fields]).alias("content_metadata")
    rows = p.join(first.select("page_id", content), "page_id")
    path = new_path(spark)
    J.archive_stories(rows, path, now(), FIXTURE)
    out = J.archive_replay(spark, path, no_index(spark), FIXTURE, now())
    return out.groupBy("disposition", "language").agg(F.count("*").alias("stories"), F.sum(F.char_length("text_content")).alias("chars"), F.min(F.date_format("indexed_date", "yyyy-MM-dd HH:mm:ss")).alias("first"))


def responses(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("url", F.lit(200).alias("status"), F.when(F.col("page_id") % 9 == 0, F.lit("image/png")).otherwise(F.lit("text/html")).alias("content_type"), F.lit(None).cast("string").alias("encoding"), F.encode("html", "UTF-8").alias("body"), F.lit(None).cast("string").alias("error_class")).dropDuplicates(["url"])


def j4_url_list(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    rows = p.select((F.col("page_id") % 3).cast("string").alias("file"), F.col("page_id").alias("pos"), "url")
    rows = rows.unionByName(rows.where("pos % 4 = 0").withColumn("pos", F.col("pos") + 1_000_000_000))
    return B.disposition_counts(J.url_list_job(rows, responses(spark, sf_dir), no_index(spark), FIXTURE, now()), F.lit("list"))


def j5_batch_feed(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    rows = p.select(F.col("page_id").alias("pos"), "url", F.regexp_extract("url", "://([^/]+)", 1).alias("domain"))
    return B.disposition_counts(J.batch_feed_job(rows, responses(spark, sf_dir), no_index(spark), FIXTURE, now(), 5), F.lit("batch"))


def j6_dump_reload(spark, sf_dir):
    path, _ = archived(spark, sf_dir, rows=100)
    back = J.reload_stories(spark, path, include=("example.com",))
    return back.select(F.col("rss_entry.link").alias("link"), F.octet_length("raw_html.html").cast("bigint").alias("size"))


def json_stream(spark, df, files: int, key: str, per_batch: int = 1):
    path = new_path(spark)
    df.repartition(files, key).write.json(path)
    return S.stream_files(spark, path, df.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), per_batch)


def o95_stream_dedup_index(spark, sf_dir):
    docs = index_docs(spark, sf_dir).select("doc_id", "seq", "language")
    index, path = docs.where("seq % 2 = 0"), new_path(spark)
    stream = json_stream(spark, docs.where("seq % 2 = 1"), 4, "seq")
    S.stream_dedup_index(stream, path, index, new_path(spark), ["seq"]).awaitTermination()
    return spark.read.parquet(path).select("doc_id").distinct()


def o97_crumb_stream(spark, sf_dir):
    path = new_path(spark)
    S.crumb_stream(json_stream(spark, messages(spark, sf_dir), 3, "user_id"), path, new_path(spark)).awaitTermination()
    return S.crumb_table(spark, path).groupBy("status", "feed_id").agg(F.sum("count").alias("total"))


def o94_micro_batch_archive(spark, sf_dir):
    path = new_path(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")

    def write(batch, to):
        batch.groupBy("source").agg(F.count("*").alias("stories")).write.mode("overwrite").parquet(to)

    S.micro_batch_archive(json_stream(spark, docs, 3, "doc_id"), path, new_path(spark), write, S.ALL).awaitTermination()
    return spark.read.parquet(path).groupBy("source").agg(F.sum("stories").alias("stories"))


def o90_cursor_resume(spark, sf_dir):
    """A stream that is ended and started again from its checkpoint as more files come."""
    e, path, out, point = read_table(spark, sf_dir, "events").select("event_id", "event_type"), new_path(spark), new_path(spark), new_path(spark)
    for part in (0, 1):
        e.where(F.col("event_id") % 2 == part).write.mode("append").json(path)
        stream = S.stream_files(spark, path, "event_id bigint, event_type string")
        S.stream_pipeline(stream, lambda b: b.groupBy("event_type").count(), f"{out}/run={part}", point).awaitTermination()
    return spark.read.parquet(out).groupBy("event_type").agg(F.sum("count").alias("events"))


def o98_stream_pipeline(spark, sf_dir):
    rows, path = captured(spark, sf_dir).withColumn("html", F.col("html").cast("string")), new_path(spark)

    def stages(batch):
        return J.parse_stage(J.check_stage(batch.withColumn("html", F.encode("html", "UTF-8")), FIXTURE), FIXTURE, now()).select("page_id", "disposition", "action")

    S.stream_pipeline(json_stream(spark, rows, 3, "page_id", 2), stages, path, new_path(spark)).awaitTermination()
    return B.disposition_counts(spark.read.parquet(path), F.lit("stream"))


def o94_stream_archives(spark, sf_dir):
    """Micro-batches of stories to archives, read back: each story is in one archive."""
    path = new_path(spark)

    def write(batch, to):
        rows = batch.select("url", F.encode("html", "UTF-8").alias("html"), F.lit("utf-8").alias("raw_encoding"), F.lit(1.7e9).alias("fetch_timestamp"))
        J.archive_stories(J.to_stories(rows), to, now(), FIXTURE, mode="overwrite")

    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    S.micro_batch_archive(json_stream(spark, pages, 3, "page_id"), path, new_path(spark), write, S.ALL).awaitTermination()
    back = warc.read_warc(spark, path, schema.PARTS)
    return back.select(F.col("http_metadata.final_url").alias("url"), F.md5("raw_html.html").alias("digest"))


def o90_feed_cursor(spark, sf_dir):
    """Pulls of feed rows that go on where the last one ended; a dry run moves nothing."""
    e, state = read_table(spark, sf_dir, "events"), new_path(spark)
    entries = e.select(F.col("event_id").alias("id"), F.concat(F.lit("http://u.example.com/"), F.col("event_id").cast("string")).alias("url"), *[F.lit(None).cast("string").alias(c) for c in ("title", "domain", "published_at", "feed_url")], F.col("user_id").alias("feed_id"), F.col("user_id").alias("sources_id"))
    out = None
    for pull, (count, dry) in enumerate(((100, False), (70, True), (70, False), (1_000_000, False))):
        rows = feeds.resume_entries(spark, entries, state, count, "api", dry_run=dry)
        rows = rows.agg(F.lit(pull).alias("pull"), F.count("*").alias("entries"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
        out = rows if out is None else out.unionByName(rows)
    return out


def o98_stream_to_index(spark, sf_dir):
    """Captured stories through check, parse, import and archive in micro-batches: the documents made."""
    rows, path = captured(spark, sf_dir).withColumn("html", F.col("html").cast("string")), new_path(spark)

    def stages(batch, known):
        return J.feed_job(batch.withColumn("html", F.encode("html", "UTF-8")), known, FIXTURE, now(), "page_id")

    def archive(created, to):
        J.archive_stories(J.to_stories(created), to, now(), FIXTURE, mode="overwrite")

    def keys(batch):
        return batch.select(U.doc_id(F.col("url")).alias("doc_id"))

    S.stream_to_index(json_stream(spark, rows, 3, "page_id", 2), stages, path, no_index(spark), new_path(spark), archive, key=keys).awaitTermination()
    made = spark.read.parquet(f"{path}/rows").where("disposition = 'created'")
    back = warc.read_warc(spark, f"{path}/archives", schema.PARTS).select(U.doc_id(F.col("content_metadata.url")).alias("doc_id"))
    both = made.select("doc_id").join(back.withColumn("archived", F.lit(1)), "doc_id", "full")
    return both.agg(F.count("*").alias("documents"), F.countDistinct("doc_id").alias("distinct_ids"), F.sum("archived").alias("archived"))


def j1_feed_to_archive(spark, sf_dir):
    """Feed rows with captured responses to the index and archives; dispositions by what was planted."""
    p, k = read_table(spark, sf_dir, "pages"), F.col("page_id") % 10
    url = F.concat(F.lit("http://site.example.com/"), F.col("page_id").cast("string"))
    good = F.lit("Sun, 30 Apr 2023 23:08:47 -0000")
    body = F.concat(F.lit("<html><head><title>t</title></head><body><p>"), F.repeat(F.lit("words of a story that is long enough. "), 20), F.col("page_id").cast("string"), F.lit("</p></body></html>"))
    entries = p.select(F.col("page_id").alias("pos"), F.when(k != 0, url).alias("link"), F.when(k == 3, F.lit("yesterday")).otherwise(good).alias("pub_date"), F.when(k == 0, "bad").otherwise("queuing").alias("disposition"))
    held = p.where(k != 0).select(url.alias("url"), F.when(k == 1, 404).when(k == 2, 503).otherwise(200).alias("status"), F.when(k == 4, F.lit("image/png")).otherwise(F.lit("text/html")).alias("content_type"), F.lit(None).cast("string").alias("encoding"), F.encode(F.when(k == 5, F.lit("")).otherwise(body), "UTF-8").alias("body"), F.lit(None).cast("string").alias("error_class"))
    out = J.crawl_feed_job(entries, held, no_index(spark), FIXTURE, now(), "pos", new_path(spark))
    return out.select("pos", "disposition", "action")


def planted_pages(spark, sf_dir, cases):
    """page_id, k (its case), url and a page that is long enough."""
    p = read_table(spark, sf_dir, "pages")
    body = F.concat(F.lit("<html><head><title>t</title></head><body><p>"), F.repeat(F.lit("words of a story that is long enough. "), 20), F.col("page_id").cast("string"), F.lit("</p></body></html>"))
    return p.select("page_id", (F.col("page_id") % cases).alias("k"), F.concat(F.lit("http://site.example.com/"), F.col("page_id").cast("string")).alias("url"), F.encode(body, "UTF-8").alias("body"))


def archived_too(out, spark, path):
    """Dispositions with whether the archives hold the story, once, with its text."""
    back = J.archive_replay(spark, path, no_index(spark), FIXTURE, now()).where("disposition = 'created'")
    held = back.groupBy(F.col("doc_id").alias("__id")).agg((F.count("*") == 1).alias("archived"))
    keys = F.when(F.col("disposition") == "created", F.col("doc_id"))
    return out.join(held, keys == F.col("__id"), "left").withColumn("archived", F.coalesce("archived", F.lit(False)))


def j2_history_to_archive(spark, sf_dir):
    """Historical CSV files with objects, some of several versions, to archives; by what was planted."""
    p, files, path = planted_pages(spark, sf_dir, 8), new_path(spark), new_path(spark)
    inside = F.col("k").isin(4, 5)
    key = F.col("page_id") + F.when(inside, 1_000_000_000).otherwise(0)
    day = F.when(F.col("k") == 5, "2022-01-01 00:00:00").otherwise("2021-10-01 00:00:00")
    lines = p.select(
        day.alias("collect_date"), F.lit("1").alias("stories_id"), F.lit("2").alias("media_id"), F.when(F.col("k") == 1, F.concat(F.lit("x"), key.cast("string"))).otherwise(key.cast("string")).alias("downloads_id"),
        F.lit("77").alias("feeds_id"), F.lit("en").alias("language"), F.when(F.col("k") == 0, F.concat(F.lit("ftp://site.example.com/"), F.col("page_id").cast("string"))).otherwise(F.col("url")).alias("url"),
    )
    lines.write.csv(files, header=True)
    versions = p.where(inside).select(key.alias("key"), F.explode(F.array(*[F.lit(v).cast("bigint") for v in (1, 2)])).alias("version_id"))
    versions = versions.select("key", "version_id", F.col("version_id").alias("listed"), F.when(F.col("version_id") == 1, "2021-10-02").otherwise("2021-12-01").cast("date").alias("last_modified"))
    objects = p.where("k <> 2").select(key.alias("key"), F.when(inside, F.lit(1).cast("bigint")).alias("version_id"), F.when(F.col("k") == 3, F.encode(F.lit(""), "UTF-8")).otherwise(F.col("body")).alias("body"), F.lit(1.0).alias("modified_at"))
    rows = J.history_rows(feeds.read_history_csv(spark, files))
    out = J.history_job(rows, objects, no_index(spark), FIXTURE, now(), versions, (1_000_000_000, 2_000_000_000), path)
    return archived_too(out, spark, path).select("dlid", "disposition", "action", "archived")


def j4_url_csv_to_archive(spark, sf_dir):
    """CSV files of URLs with captured responses to archives; every sixth URL stands twice in its file."""
    p, files, path = planted_pages(spark, sf_dir, 6), new_path(spark), new_path(spark)
    k = F.col("k")
    url = F.when(k == 4, F.concat(F.lit("http://casino-win.example.com/"), F.col("page_id").cast("string"))).otherwise(F.col("url"))
    p.select(F.explode(F.when(k == 0, F.array(url, url)).otherwise(F.array(url)))).write.csv(files)
    held = p.where("k <> 3").select("url", F.when(k == 1, 403).when(k == 2, 503).otherwise(200).alias("status"), F.lit(None).cast("string").alias("encoding"), F.lit("text/html").alias("content_type"), "body", F.lit(None).cast("string").alias("error_class"))
    out = J.url_list_job(J.url_rows(feeds.read_url_csv(spark, files)), held, no_index(spark), FIXTURE, now(), path)
    return archived_too(out, spark, path).select("url", "disposition", "action", "archived")


def j5_batch_feed_to_archive(spark, sf_dir):
    """Feed files, dealt into batches by domain, with captured responses to archives."""
    p, files, path = planted_pages(spark, sf_dir, 5), new_path(spark), new_path(spark)
    k, n = F.col("k"), F.col("page_id").cast("string")
    link = F.when(k == 0, F.lit("")).otherwise(F.col("url"))
    item = F.concat(F.lit("<item><link>"), link, F.lit("</link><title>"), n, F.lit("</title><domain>d"), (F.col("page_id") % 7).cast("string"), F.lit(".org</domain></item>"))
    some = p.groupBy((F.col("page_id") % (p.count() // 1_000 + 3)).alias("n")).agg(F.array_join(F.collect_list(item), "").alias("items"))  # a thousand pages or so to a file
    some.select(F.concat(F.lit("<rss><channel>"), "items", F.lit("</channel></rss>")).alias("value"), "n").repartition("n").write.partitionBy("n").text(files)
    rows = feeds.read_daily_feed(spark, f"{files}/*/*.txt", empty_as="", fetch_date="2023-05-01").select(F.col("title").cast("bigint").alias("pos"), F.col("link").alias("url"), "domain")
    held = p.where("k not in (0, 3)").select("url", F.when(k == 1, 404).when(k == 2, 500).otherwise(200).alias("status"), F.lit(None).cast("string").alias("encoding"), F.lit("text/html").alias("content_type"), "body", F.lit(None).cast("string").alias("error_class"))
    out = J.batch_feed_job(rows, held, no_index(spark), FIXTURE, now(), 5, path)
    return archived_too(out, spark, path).select("pos", "disposition", "action", "archived")


QUERIES = {
    f.__name__: f
    for f in (
        j1_flagship, j1_dispositions, o100_stage_protocol, j2_history, j3_archive_replay, j4_url_list, j5_batch_feed, j6_dump_reload,
        o95_stream_dedup_index, o97_crumb_stream, o94_micro_batch_archive, o90_cursor_resume, o98_stream_pipeline, o94_stream_archives, o90_feed_cursor,
        o98_stream_to_index, j1_feed_to_archive, j2_history_to_archive, j4_url_csv_to_archive, j5_batch_feed_to_archive,
    )
}

ORACLES = {
    "j6_dump_reload": "SELECT url AS link, octet_length(encode(html))::BIGINT AS size FROM pages WHERE regexp_matches(url, '^https?://[^/]*example\\.com(?:[/:?#]|$)')",
    "o95_stream_dedup_index": f"WITH {INDEX_DOCS} SELECT DISTINCT doc_id FROM docs WHERE seq % 2 = 1 AND doc_id NOT IN (SELECT doc_id FROM docs WHERE seq % 2 = 0)",
    "o97_crumb_stream": f"WITH {LINES} SELECT status, feed_id, sum(c)::BIGINT AS total FROM rows WHERE kind = 'crumb' GROUP BY status, feed_id",
    "o94_micro_batch_archive": "SELECT source, count(*)::BIGINT AS stories FROM documents GROUP BY source",
    "o94_stream_archives": "SELECT url, md5(encode(html)) AS digest FROM pages",
    "o90_feed_cursor": """WITH e AS (SELECT event_id AS id, row_number() OVER (ORDER BY event_id) AS r FROM events WHERE event_id > 0),
 p AS (SELECT * FROM (VALUES (0, 0, 100), (1, 100, 70), (2, 100, 70), (3, 170, 1000000)) t(pull, skip, n))
SELECT pull::INTEGER AS pull, count(id) AS entries, min(id) AS first_id, max(id) AS last_id FROM p LEFT JOIN e ON r > skip AND r <= skip + n GROUP BY pull""",
    "j1_feed_to_archive": """SELECT page_id AS pos, CASE page_id % 10 WHEN 0 THEN 'bad' WHEN 1 THEN 'http-404' WHEN 2 THEN 'http-5xx' WHEN 3 THEN 'bad-pub-date' WHEN 4 THEN 'not-text' WHEN 5 THEN 'no-html' ELSE 'created' END AS disposition,
 CASE WHEN page_id % 10 IN (2, 3) THEN 'retry' WHEN page_id % 10 IN (0, 1, 4, 5) THEN 'discard' ELSE 'pass' END AS action FROM pages""",
    "j2_history_to_archive": """SELECT CASE page_id % 8 WHEN 1 THEN 'x' ELSE '' END || (page_id + CASE WHEN page_id % 8 IN (4, 5) THEN 1000000000 ELSE 0 END)::VARCHAR AS dlid,
 CASE page_id % 8 WHEN 0 THEN 'bad-scheme' WHEN 1 THEN 'bad-dlid' WHEN 2 THEN 'not-found' WHEN 3 THEN 'no-html' WHEN 5 THEN 'epoch-err' ELSE 'created' END AS disposition,
 CASE WHEN page_id % 8 IN (4, 6, 7) THEN 'pass' ELSE 'discard' END AS action, page_id % 8 IN (4, 6, 7) AS archived FROM pages""",
    "j4_url_csv_to_archive": """WITH r AS (SELECT page_id, 1 AS n FROM pages UNION ALL SELECT page_id, 2 FROM pages WHERE page_id % 6 = 0)
SELECT CASE page_id % 6 WHEN 4 THEN 'http://casino-win.example.com/' ELSE 'http://site.example.com/' END || page_id AS url,
 CASE WHEN n = 2 THEN 'dups' ELSE CASE page_id % 6 WHEN 1 THEN 'http-403' WHEN 2 THEN 'http-5xx' WHEN 3 THEN 'no-html' WHEN 4 THEN 'non-news' ELSE 'created' END END AS disposition,
 CASE WHEN n = 1 AND page_id % 6 IN (0, 5) THEN 'pass' WHEN page_id % 6 = 2 THEN 'retry' ELSE 'discard' END AS action, n = 1 AND page_id % 6 IN (0, 5) AS archived FROM r""",
    "j5_batch_feed_to_archive": """SELECT page_id AS pos, CASE page_id % 5 WHEN 0 THEN 'no-resp' WHEN 1 THEN 'http-404' WHEN 2 THEN 'http-5xx' WHEN 3 THEN 'no-resp' ELSE 'created' END AS disposition,
 CASE WHEN page_id % 5 = 4 THEN 'pass' ELSE 'discard' END AS action, page_id % 5 = 4 AS archived FROM pages""",
    "o90_cursor_resume": "SELECT event_type, count(*)::BIGINT AS events FROM events GROUP BY 1",
}
