"""Inputs that the queries derive from the driver's tables, in columns and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.config import FIXTURE
from tidewire.shared import read_table

EXCLUDED = "[" + ", ".join(f"'{d}'" for d in FIXTURE.excluded_domains) + "]"
BATCH_TS = "2024-06-01 12:00:00"


def sql_parts(url: str, source: str, extra: str = "*") -> str:
    """CTEs up to `parts`: scheme, net, hp, host and bad of a URL column in DuckDB."""
    return f"""
cleaned AS (SELECT {extra}, regexp_replace(regexp_replace(coalesce({url}, ''), '^[\\x00-\\x20]+', ''), '[\\t\\r\\n]', '', 'g') AS c_ FROM {source}),
split1 AS (SELECT *, lower(regexp_extract(c_, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)) AS scheme, regexp_replace(c_, '^[A-Za-z][A-Za-z0-9+.\\-]*:', '') AS rest FROM cleaned),
split2 AS (SELECT *, regexp_extract(rest, '^//([^/?#]*)', 1) AS net FROM split1),
split3 AS (SELECT *, regexp_replace(net, '^.*@', '') AS hp FROM split2),
split4 AS (SELECT *, lower(CASE WHEN hp LIKE '[%' THEN regexp_extract(hp, '^\\[([^\\]]*)\\]', 1) ELSE regexp_extract(hp, '^([^:]*)', 1) END) AS host FROM split3),
parts AS (SELECT *, (contains(net, '[') <> contains(net, ']')) OR (contains(net, '[') AND contains(net, ']') AND NOT (hp LIKE '[%' AND regexp_matches(host, '^(?:[0-9a-f:.]+|v.*)$'))) AS bad FROM split4)"""


def sql_check(url: str) -> str:
    """check_url over the columns of sql_parts."""
    listed = f"len(list_filter({EXCLUDED}, lambda d: host = d OR ends_with(host, '.' || d))) > 0"
    return f"""CASE WHEN coalesce({url}, '') = '' THEN 'no-url' WHEN bad THEN 'bad-url' WHEN host = '' THEN 'no-host'
 WHEN scheme NOT IN ('http', 'https') THEN 'bad-scheme' WHEN {listed} THEN 'non-news' WHEN host IN ('localhost', '127.0.0.1') THEN 'bad-host' END"""


def odd_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' URLs, most of them as they are and some bent out of shape."""
    pages, k, u = read_table(spark, sf_dir, "pages"), F.col("page_id") % 23, F.col("url")
    bent = (
        F.when(k == 1, F.lit("")).when(k == 2, F.regexp_replace(u, "^https?", "ftp")).when(k == 3, F.lit("mailto:x@y.z"))
        .when(k == 4, F.regexp_replace(u, "^https?:", "")).when(k == 5, F.lit("http://[::1/x")).when(k == 6, F.lit("http://localhost/a"))
        .when(k == 7, F.upper(u)).when(k == 8, F.concat(F.lit("  \t"), u)).when(k == 9, F.regexp_replace(u, "://", "://user:pw@"))
        .when(k == 10, F.regexp_replace(u, "^(https?://[^/]+)", "$1:443")).when(k == 11, F.lit("http://[::1]:80/x")).when(k == 12, F.lit(None).cast("string"))
        .when(k == 13, F.concat(u, F.lit("/?utm_source=a&b=2&a=1#top"))).when(k == 14, F.regexp_replace(u, "^(https?://)([^/]+).*", "$1www.$2/index.html"))
        .when(k == 15, F.lit("http://127.0.0.1:80/")).otherwise(u)
    )
    return pages.select("page_id", bent.alias("url"))


ODD_URLS = """odd AS (SELECT page_id, CASE page_id % 23 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(url, '^https?', 'ftp') WHEN 3 THEN 'mailto:x@y.z'
 WHEN 4 THEN regexp_replace(url, '^https?:', '') WHEN 5 THEN 'http://[::1/x' WHEN 6 THEN 'http://localhost/a' WHEN 7 THEN upper(url) WHEN 8 THEN '  ' || chr(9) || url
 WHEN 9 THEN replace(url, '://', '://user:pw@') WHEN 10 THEN regexp_replace(url, '^(https?://[^/]+)', '\\1:443') WHEN 11 THEN 'http://[::1]:80/x' WHEN 12 THEN NULL
 WHEN 13 THEN url || '/?utm_source=a&b=2&a=1#top' WHEN 14 THEN regexp_replace(url, '^(https?://)([^/]+).*', '\\1www.\\2/index.html') WHEN 15 THEN 'http://127.0.0.1:80/' ELSE url END AS url FROM pages)"""


def crumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.nullif(F.col("user_id") % 50, F.lit(0).cast("bigint")).alias("feed_id"), (F.col("user_id") % 7).alias("source_id"),
        F.when(F.col("event_type") != "signup", F.concat(F.lit("d"), (F.col("user_id") % 11).cast("string"), F.lit(".example.com"))).alias("domain"),
        F.lit("parser").alias("app"), F.col("event_type").alias("status"), F.lit(1).cast("bigint").alias("count"),
    )


CRUMBS = """crumbs AS (SELECT strftime(ts, '%Y-%m-%d') AS date, nullif(user_id % 50, 0) AS feed_id, user_id % 7 AS source_id,
 CASE WHEN event_type <> 'signup' THEN 'd' || (user_id % 11) || '.example.com' END AS domain, 'parser' AS app, event_type AS status, 1::BIGINT AS "count" FROM events)"""


def stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as stories with the four parts."""
    p = read_table(spark, sf_dir, "pages")
    none = F.lit(None).cast("string")
    rss = F.struct(F.col("url").alias("link"), none.alias("title"), none.alias("domain"), F.lit("Sun, 30 Apr 2023 23:08:47 -0000").alias("pub_date"), F.lit("2023-05-01").alias("fetch_date"), none.alias("source_url"), (F.col("page_id") % 9).alias("source_feed_id"), (F.col("page_id") % 5).alias("source_source_id"), none.alias("via"))
    raw = F.struct(F.encode("html", "UTF-8").alias("html"), F.lit("utf-8").alias("encoding"))
    http = F.struct(F.lit(200).alias("response_code"), (F.lit(1.7e9) + F.col("page_id")).alias("fetch_timestamp"), F.col("url").alias("final_url"), F.lit("utf-8").alias("encoding"))
    return p.select("page_id", rss.alias("rss_entry"), raw.alias("raw_html"), http.alias("http_metadata"))


def index_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows of an index: doc_id is a hash of the text, indexed_date one second per id."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.sha2("text", 256).alias("doc_id"), F.col("doc_id").alias("seq"), F.col("text").alias("text_content"), F.col("lang").alias("language"), "source",
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")).alias("indexed_date"),
    )


INDEX_DOCS = "docs AS (SELECT sha256(text) AS doc_id, doc_id AS seq, text AS text_content, lang AS language, source, TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS indexed_date FROM documents)"
