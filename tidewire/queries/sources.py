"""Queries over sources and sinks: tables written as files of each kind and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire import schema
from tidewire.config import FIXTURE
from tidewire.functions import urls as U
from tidewire.queries.base import BATCH_TS, ODD_URLS, odd_urls, sql_check, sql_parts, stories
from tidewire.queries.dedup import file_rows
from tidewire.shared import new_path, read_table
from tidewire.sources import disk, feeds, inputs, warc


def now():
    return F.to_timestamp(F.lit(BATCH_TS))


def feed_files(spark, sf_dir):
    """Feed files of about a thousand pages each."""
    p, k = read_table(spark, sf_dir, "pages"), F.col("page_id")
    esc = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    link = F.when(k % 13 == 0, F.lit("<link></link>")).otherwise(F.concat(F.lit("<link> "), esc, F.lit(" </link>")))
    source = F.concat(F.lit('<source url="http://f.example.com/" mcFeedId="'), k.cast("string"), F.lit('" mcSourceId="'), F.when(k % 3 == 0, F.lit("x")).otherwise((k % 7).cast("string")), F.lit('">f</source>'))
    item = F.concat(F.lit("<item>"), link, F.lit("<title>t"), k.cast("string"), F.lit("</title><domain></domain><pubDate>Sun, 30 Apr 2023 23:08:47 -0000</pubDate>"), source, F.lit("</item>"))
    buckets = p.count() // 1_000 + 5
    files = p.groupBy((k % buckets).alias("n")).agg(F.array_join(F.collect_list(item), "").alias("items"))
    body = F.concat(F.lit("<rss><channel><lastBuildDate>Mon, 01 May 2023 00:10:00 +0000</lastBuildDate>"), "items", F.lit("</channel></rss>"))
    path = new_path(spark)
    files.select(body.alias("value"), "n").repartition("n").write.option("compression", "gzip").partitionBy("n").text(path)
    return f"{path}/*/*.gz"


def o01_daily_feed(spark, sf_dir):
    out = feeds.read_daily_feed(spark, feed_files(spark, sf_dir))
    return out.select("link", "title", "domain", "pub_date", "fetch_date", "source_url", "source_feed_id", "source_source_id", "disposition")


def o02_daily_feed_simple(spark, sf_dir):
    out = feeds.read_daily_feed(spark, feed_files(spark, sf_dir), empty_as="", fetch_date="2023-05-01")
    return out.select("link", "title", "domain", "fetch_date", "disposition")


def o03_feed_entries(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    u = odd_urls(spark, sf_dir).select(F.col("page_id").alias("id"), "url").join(e.select(F.col("event_id").alias("id"), "ts", "user_id"), "id")
    entries = u.select("id", "url", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("published_at"), F.lit("d").alias("domain"), F.lit("t").alias("title"), F.lit(3).cast("bigint").alias("sources_id"), F.col("user_id").alias("feed_id"), F.lit("f").alias("feed_url"))
    return feeds.read_feed_entries(entries, 20, 150, "api", FIXTURE.excluded_domains).select("id", "link", "pub_date", "source_feed_id", "via", "disposition")


def o04_history_csv(spark, sf_dir):
    e, path = read_table(spark, sf_dir, "events"), new_path(spark)
    rows = e.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("collect_date"), F.col("event_id").cast("string").alias("stories_id"), F.when(F.col("user_id") % 9 == 0, F.lit("x")).otherwise(F.col("user_id").cast("string")).alias("media_id"),
        F.col("event_id").cast("string").alias("downloads_id"), F.lit("77").alias("feeds_id"), F.lit("en").alias("language"), F.concat(F.lit("http://u"), F.col("user_id").cast("string")).alias("url"),
    )
    rows.write.csv(path, header=True)
    out = feeds.read_history_csv(spark, path)
    return out.select("link", "source_feed_id", "source_source_id", "fetch_timestamp", "language", "final_url")


def o05_url_csv(spark, sf_dir):
    path = new_path(spark)
    read_table(spark, sf_dir, "pages").select("url", "page_id").write.csv(path)
    return feeds.read_url_csv(spark, path).select("link", "final_url")


def o06_url_list(spark, sf_dir):
    path = new_path(spark)
    read_table(spark, sf_dir, "pages").select(F.concat(F.lit("  "), "url", F.lit(" "))).write.text(path)
    return feeds.read_url_list(spark, path)


def o10_expand_inputs(spark, sf_dir):
    path, names = new_path(spark), new_path(spark)
    read_table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id").repartition("day").write.partitionBy("day").csv(path)
    found = inputs.expand_inputs(spark, path, pattern="*.csv")
    found.select("path").write.text(names)
    back = inputs.expand_inputs(spark, names, indirect=True)
    return back.select(F.regexp_extract("path", "day=([0-9-]+)", 1).alias("day"))


def o11_expand_dates(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).groupBy(F.year("d").alias("year")).agg(F.min("d").alias("a"))
    day = F.date_add(F.to_date(F.lit("2022-02-10")), (F.col("year") - 1990).cast("int"))
    out = inputs.expand_dates(o.select("year", day.alias("first")), F.col("first"), F.date_add("first", 9), F.concat(F.lit("s3://b/"), F.col("year").cast("string"), F.lit("/mc-{pattern}.rss.gz")), F.to_date(F.lit("2022-02-26")))
    return out.select(F.col("year").cast("bigint").alias("year"), F.date_format("date", "yyyy-MM-dd").alias("day"), "path", "valid")


def o12_pending_inputs(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    files = e.select(F.concat(F.lit("in/"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv.gz")).alias("path")).distinct()
    status = F.get(F.array(F.lit("FINISHED"), F.lit("STARTED"), F.lit("NOT_STARTED")), (F.col("user_id") % 3).cast("int"))
    manifest = e.select(F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv")).alias("name"), status.alias("status"), (F.col("event_id") * 100).alias("ts"))
    plain = inputs.pending_inputs(files, manifest, 1_000_000).withColumn("mode", F.lit("plain"))
    clean = inputs.pending_inputs(files, manifest, 1_000_000, cleanup=True).withColumn("mode", F.lit("cleanup"))
    forced = inputs.pending_inputs(files, manifest, 1_000_000, force=True).withColumn("mode", F.lit("force"))
    again = inputs.pending_inputs(files, inputs.mark_inputs(manifest, plain, "FINISHED", 2_000_000), 2_000_000).withColumn("mode", F.lit("after"))
    return plain.unionByName(clean).unionByName(forced).unionByName(again).select("mode", "name")


def o13_object_versions(spark, sf_dir):
    versions = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).cast("bigint").alias("version_id"), F.col("l_shipdate").alias("last_modified"))
    return inputs.read_object_versions(versions.distinct()).select("key", "version_id", "listed")


def archived(spark, sf_dir, rows: int = 40):
    path = new_path(spark)
    done = warc.write_warc(stories(spark, sf_dir).withColumn("content_metadata", F.lit(None).cast(f"struct<{schema.CONTENT_METADATA}>")), path, now(), max_rows=rows)
    return path, done


def o07_warc_round_trip(spark, sf_dir):
    path, _ = archived(spark, sf_dir)
    back = warc.read_warc(spark, path, schema.PARTS)
    return back.select(F.col("rss_entry.link").alias("link"), F.md5(F.col("raw_html.html")).alias("digest"), F.col("raw_html.encoding").alias("encoding"), F.col("http_metadata.fetch_timestamp").alias("fetched"), "parsed_date", F.col("rss_entry.source_feed_id").alias("feed"))


def o15_o78_archive_stats(spark, sf_dir):
    from tidewire.operators.metrics import archive_stats

    return archive_stats(archived(spark, sf_dir)[1]).select("status", "stories")


def o16_archive_layout(spark, sf_dir):
    laid = warc.archive_layout(read_table(spark, sf_dir, "events").coalesce(1), now(), rows=3_000)
    return warc.layout_counts(laid).select("stories", F.col("last_row").cast("bigint").alias("last_row"))


def o16_archive_layout_all(spark, sf_dir):
    """The layout over the table's own partitions: every row is in one archive of 3,000 rows at most."""
    laid = warc.layout_counts(warc.archive_layout(read_table(spark, sf_dir, "events"), now(), rows=3_000))
    return laid.agg(F.sum("stories").alias("stories"), F.sum(F.col("last_row")).cast("bigint").alias("last_rows"), F.sum((F.col("stories") > 3_000).cast("int")).alias("too_large"))


def o64_pair_records(spark, sf_dir):
    path, _ = archived(spark, sf_dir)
    return warc.pair_records(spark, path).groupBy((F.col("response_id") == F.col("metadata_id")).alias("same")).agg(F.count("*").alias("pairs"))


def o17_disk_round_trip(spark, sf_dir):
    path = new_path(spark)
    rows = stories(spark, sf_dir).withColumn("content_metadata", F.lit(None).cast(f"struct<{schema.CONTENT_METADATA}>"))
    disk.write_disk_stories(rows, path)
    back = disk.read_disk_stories(spark, path, {k: schema.PARTS[k] for k in ("rss_entry", "http_metadata")})
    return back.select("story_id", F.col("rss_entry.link").alias("link"), F.md5(F.col("raw_html.html")).alias("digest"), F.col("http_metadata.response_code").cast("bigint").alias("code"))


def o18_write_url_list(spark, sf_dir):
    path = new_path(spark)
    rows = file_rows(spark, sf_dir).select(F.col("file").alias("archive"), F.nullif("url", F.lit("")).alias("url"))
    feeds.write_url_list(rows, path)
    return spark.read.option("basePath", path).text(path).groupBy(F.col("archive").cast("string").alias("archive")).agg(F.count("*").alias("urls"), F.countDistinct("value").alias("distinct_urls"))


def o101_source_protocol(spark, sf_dir):
    """A source is a function that gives stories; here two of them, one after the other."""
    sources = [lambda: odd_urls(spark, sf_dir).select(F.col("url").alias("link")), lambda: read_table(spark, sf_dir, "pages").select(F.col("url").alias("link"))]
    out = None
    for source in sources:
        rows = source().select("link", F.coalesce(U.check_url(F.col("link"), FIXTURE.excluded_domains), F.lit("queuing")).alias("disposition"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("disposition").agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        o01_daily_feed, o02_daily_feed_simple, o03_feed_entries, o04_history_csv, o05_url_csv, o06_url_list, o10_expand_inputs, o11_expand_dates, o12_pending_inputs,
        o13_object_versions, o07_warc_round_trip, o15_o78_archive_stats, o16_archive_layout, o16_archive_layout_all, o64_pair_records, o17_disk_round_trip, o18_write_url_list, o101_source_protocol,
    )
}

ITEMS = "items AS (SELECT page_id, CASE WHEN page_id % 13 = 0 THEN NULL ELSE url END AS link FROM pages)"

ORACLES = {
    "o01_daily_feed": f"""WITH {ITEMS} SELECT link, 't' || page_id AS title, NULL::VARCHAR AS domain, 'Sun, 30 Apr 2023 23:08:47 -0000' AS pub_date, '2023-05-01' AS fetch_date, 'http://f.example.com/' AS source_url, page_id AS source_feed_id,
 CASE WHEN page_id % 3 = 0 THEN NULL ELSE page_id % 7 END AS source_source_id, CASE WHEN link IS NULL THEN 'bad' ELSE 'queuing' END AS disposition FROM items""",
    "o02_daily_feed_simple": f"WITH {ITEMS} SELECT coalesce(link, '') AS link, 't' || page_id AS title, '' AS domain, '2023-05-01' AS fetch_date, CASE WHEN link IS NULL THEN 'bad' ELSE 'queuing' END AS disposition FROM items",
    "o03_feed_entries": f"""WITH {ODD_URLS}, r AS (SELECT o.page_id AS id, o.url, e.ts, e.user_id FROM odd o JOIN events e ON e.event_id = o.page_id WHERE o.page_id > 20 ORDER BY id LIMIT 150), {sql_parts('url', 'r')}
SELECT id, url AS link, strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' -0000' AS pub_date, user_id AS source_feed_id, id || '@api' AS via, CASE WHEN url IS NULL THEN 'no-url' ELSE coalesce({sql_check('url')}, 'queuing') END AS disposition FROM parts""",
    "o04_history_csv": """SELECT event_id::VARCHAR AS link, 77::BIGINT AS source_feed_id, CASE WHEN user_id % 9 = 0 THEN NULL ELSE user_id END AS source_source_id, epoch(date_trunc('second', ts))::DOUBLE AS fetch_timestamp, 'en' AS language, 'http://u' || user_id AS final_url FROM events""",
    "o05_url_csv": "SELECT url AS link, url AS final_url FROM pages",
    "o06_url_list": "SELECT url FROM pages",
    "o10_expand_inputs": "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events",
    "o11_expand_dates": """WITH y AS (SELECT year(o_orderdate) AS year, DATE '2022-02-10' + (year(o_orderdate) - 1990)::INTEGER AS first FROM orders GROUP BY 1), d AS (SELECT year, (first + unnest(range(10))::INTEGER)::DATE AS d FROM y)
SELECT year::BIGINT AS year, strftime(d, '%Y-%m-%d') AS day, 's3://b/' || year || '/mc-' || strftime(d, '%Y-%m-%d') || '.rss.gz' AS path, d >= DATE '2022-02-18' AND d <= DATE '2022-02-25' AS valid FROM d""",
    "o12_pending_inputs": """WITH m AS (SELECT strftime(ts, '%Y-%m-%d') || '.csv' AS name, (['FINISHED', 'STARTED', 'NOT_STARTED'])[user_id % 3 + 1] AS status, event_id * 100 AS t FROM events),
 l AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY name ORDER BY t DESC, status) = 1), p AS (SELECT name FROM l WHERE status = 'NOT_STARTED')
SELECT 'plain' AS mode, name FROM p UNION ALL SELECT 'cleanup', name FROM l WHERE status = 'NOT_STARTED' OR (status = 'STARTED' AND t < 1000000 - 86400) UNION ALL SELECT 'force', name FROM l""",
    "o13_object_versions": """WITH v AS (SELECT DISTINCT l_orderkey AS key, (l_linenumber * 1000000 + l_partkey)::BIGINT AS version_id, l_shipdate AS m FROM lineitem) SELECT key, version_id, row_number() OVER (PARTITION BY key ORDER BY m DESC, version_id DESC) AS listed FROM v""",
    "o07_warc_round_trip": "SELECT url AS link, md5(encode(html)) AS digest, 'utf-8' AS encoding, (1.7e9 + page_id)::DOUBLE AS fetched, strftime(to_timestamp(1700000000 + page_id) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') AS parsed_date, page_id % 9 AS feed FROM pages",
    "o15_o78_archive_stats": "SELECT 'written' AS status, count(*)::BIGINT AS stories FROM pages",
    "o16_archive_layout": "SELECT count(*) AS stories, count(*) AS last_row FROM (SELECT (row_number() OVER (ORDER BY event_id) - 1) // 3000 AS c FROM events) GROUP BY c",
    "o16_archive_layout_all": "SELECT count(*) AS stories, count(*) AS last_rows, 0::BIGINT AS too_large FROM events",
    "o64_pair_records": "SELECT false AS same, count(*) AS pairs FROM pages",
    "o18_write_url_list": """SELECT strftime(ts, '%Y-%m-%d') AS archive, count(*) AS urls, count(DISTINCT CASE WHEN event_id % 31 = 0 THEN 'http://localhost/x' WHEN event_id % 41 = 0 THEN 'http://[::1/' WHEN event_id % 43 = 0 THEN 'f' ELSE user_id::VARCHAR END) AS distinct_urls
FROM events WHERE event_id % 31 = 0 OR event_id % 37 <> 0 GROUP BY 1""",
    "o101_source_protocol": f"""WITH {ODD_URLS}, both_ AS (SELECT url FROM odd UNION ALL SELECT url FROM pages), {sql_parts('url', 'both_')} SELECT coalesce({sql_check('url')}, 'queuing') AS disposition, count(*) AS n FROM parts GROUP BY 1""",
}
