"""Queries over dispositions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.config import FIXTURE
from tidewire.functions import text as X
from tidewire.operators import classify as C
from tidewire.operators import counters
from tidewire.operators import crumbs as B
from tidewire.queries.base import EXCLUDED, ODD_URLS, odd_urls, sql_check, sql_parts
from tidewire.shared import new_path, read_table


def fetches(spark, sf_dir):
    """Captured responses made of events."""
    e, k = read_table(spark, sf_dir, "events"), F.col("event_id")
    codes = F.array(*[F.lit(c) for c in (200, 200, 200, 404, 403, 429, 503, 501, 200, 301, 410, 522)])
    types = F.array(*[F.lit(c) for c in ("text/html", "image/png", "application/xhtml+xml; q=1", "", "APPLICATION/XML", "application/pdf", "text/plain")])
    return e.select(
        "event_id", F.get(codes, (k % 12).cast("int")).alias("status"), F.get(types, (k % 7).cast("int")).alias("content_type"), F.when(k % 5 == 0, F.lit("utf-8")).alias("encoding"),
        F.when(k % 13 != 0, F.encode(F.col("props"), "UTF-8")).alias("body"), F.when(F.col("event_type") == "error", F.when(k % 2 == 0, F.lit("bad-url")).otherwise(F.lit("timeout"))).alias("error_class"),
        F.when(k % 9 != 0, F.concat(F.lit("http://h"), (F.col("user_id") % 40).cast("string"), F.when(k % 15 == 1, F.lit(".example.com/?u=free-bets.example.com")).otherwise(F.lit(".example.com/")))).alias("final_url"),
        (F.col("user_id") * 100_000).alias("size"),
    )


def o25_classify_fetch(spark, sf_dir):
    return C.classify_fetch(fetches(spark, sf_dir), most=40).select("event_id", "disposition", "action")


def o26_classify_fetch_batch(spark, sf_dir):
    rows = fetches(spark, sf_dir).withColumn("status", F.when(F.col("event_id") % 17 != 0, F.col("status")))
    return C.classify_fetch_batch(rows, FIXTURE.excluded_domains).select("event_id", "disposition", "action")


def o30_redundant_feed(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    body = F.encode(F.when(F.col("page_id") % 6 == 0, F.concat(F.lit("(redundant feed)"), F.col("html"))).otherwise(F.col("html")), "UTF-8")
    return p.select("page_id", X.is_redundant_feed(body).alias("redundant"))


def o31_gate_parsed(spark, sf_dir):
    d, k = read_table(spark, sf_dir, "documents"), F.col("doc_id")
    rows = d.select("doc_id", (k % 7 == 0).alias("is_homepage"), F.when(k % 5 != 0, F.col("text")).alias("text_content"), F.when(k % 3 != 0, F.lit("m")).alias("text_extraction_method"))
    return C.gate_parsed(rows).select("doc_id", "disposition", "action")


def o43_adopt_canonical_url(spark, sf_dir):
    rows = odd_urls(spark, sf_dir).withColumnRenamed("url", "own")
    k, none = F.col("page_id") % 10, F.lit(None).cast("string")
    rows = rows.select(
        "page_id", F.when(k == 0, F.lit(FIXTURE.need_canonical_url)).otherwise(F.col("own")).alias("canonical_url"), F.lit(FIXTURE.need_canonical_url).alias("original_url"),
        none.alias("final_url"), none.alias("url"), none.alias("canonical_domain"), F.lit(None).cast("boolean").alias("is_homepage"),
    )
    out = C.adopt_canonical_url(rows, FIXTURE.need_canonical_url, FIXTURE.excluded_domains, FIXTURE.public_suffixes)
    return out.select("page_id", "disposition", "action", "url", "original_url")


def o32_gate_index(spark, sf_dir):
    d, k = read_table(spark, sf_dir, "documents"), F.col("doc_id")
    rows = d.select("doc_id", F.when(k % 4 != 0, F.col("source")).alias("url"), F.when(k % 6 != 0, F.col("text")).alias("text_content"), F.when(k % 12 != 0, F.col("lang")).alias("article_title"))
    return C.gate_index(rows).select("doc_id", "disposition", "action")


def o33_gate_producer(spark, sf_dir):
    rows = odd_urls(spark, sf_dir).join(read_table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("html")), "page_id")
    rows = rows.select("page_id", F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.lit("")).alias("final_url"), F.col("url").alias("link"), "html")
    return C.gate_producer(rows, FIXTURE.excluded_domains, check_html=True, most=8000).select("page_id", "disposition", "action")


EPOCHS = (("B", "1996-01-01", "1997-06-30"), ("D", "1999-01-01", "2000-12-31"))


def o34_in_epoch(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    epoch = C.in_epoch(F.to_date("o_orderdate"), EPOCHS)
    return o.groupBy(epoch.alias("epoch")).agg(F.count("*").alias("n"), F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last"))


def o35_select_by_query(spark, sf_dir):
    chosen, n = C.select_by_query(read_table(spark, sf_dir, "documents"), "lang = 'en' AND n_chars > 2000")
    return chosen.select("doc_id", "source", F.lit(n).cast("bigint").alias("matching"))


def o57_make_crumbs(spark, sf_dir):
    rows = C.classify_fetch(fetches(spark, sf_dir), most=40)
    rows = rows.withColumns({"source_feed_id": F.col("event_id") % 5, "source_source_id": F.col("event_id") % 3, "canonical_domain": F.lit(None).cast("string")})
    crumbs = B.make_crumbs(rows.where("action <> 'pass'"), "fetcher", F.to_timestamp(F.lit("2024-06-01 12:00:00")))
    return B.crumb_sum(crumbs, ["date", "feed_id", "status"])


def o72_disposition_counts(spark, sf_dir):
    return B.disposition_counts(C.classify_fetch(fetches(spark, sf_dir), most=40), F.lit("fetcher"))


def o72_observed_counts(spark, sf_dir):
    """The same counts, made by the pass that writes the rows."""
    rows, seen = counters.count_dispositions(C.classify_fetch(fetches(spark, sf_dir), most=40))
    rows.write.parquet(new_path(spark))
    return counters.as_table(spark, seen.get, "fetcher")


QUERIES = {
    f.__name__: f
    for f in (
        o25_classify_fetch, o26_classify_fetch_batch, o30_redundant_feed, o31_gate_parsed, o43_adopt_canonical_url, o32_gate_index, o33_gate_producer,
        o34_in_epoch, o35_select_by_query, o57_make_crumbs, o72_disposition_counts, o72_observed_counts,
    )
}

FETCHES = """fetches AS (SELECT event_id, ([200, 200, 200, 404, 403, 429, 503, 501, 200, 301, 410, 522])[event_id % 12 + 1] AS status,
 (['text/html', 'image/png', 'application/xhtml+xml; q=1', '', 'APPLICATION/XML', 'application/pdf', 'text/plain'])[event_id % 7 + 1] AS content_type,
 CASE WHEN event_id % 5 = 0 THEN 'utf-8' END AS encoding, CASE WHEN event_id % 13 <> 0 THEN octet_length(encode(props)) END AS n,
 CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'bad-url' ELSE 'timeout' END END AS error_class,
 CASE WHEN event_id % 9 <> 0 THEN 'http://h' || (user_id % 40) || CASE WHEN event_id % 15 = 1 THEN '.example.com/?u=free-bets.example.com' ELSE '.example.com/' END END AS final_url,
 user_id * 100000 AS size FROM events)"""
FETCHED = FETCHES + """, judged AS (SELECT *, CASE WHEN error_class = 'bad-url' THEN 'badurl2' WHEN error_class IS NOT NULL THEN 'noconn'
 WHEN status <> 200 THEN CASE WHEN status IN (403, 404, 429) THEN 'http-' || status ELSE 'http-' || (status // 100) || 'xx' END
 WHEN NOT (coalesce(encoding, '') <> '' OR regexp_matches(lower(coalesce(content_type, '')), '^(?:text/|application/xhtml|application/xml|application/vnd\\.wap\\.xhtml\\+xml|$)')) THEN 'not-text'
 WHEN coalesce(n, 0) = 0 THEN 'no-html' WHEN n > 40 THEN 'oversized' ELSE 'success' END AS disposition FROM fetches),
 acted AS (SELECT *, CASE WHEN disposition = 'success' THEN 'pass' WHEN disposition = 'noconn' OR (error_class IS NULL AND status IN (408, 429, 500, 502, 503, 504, 522, 524)) THEN 'retry' ELSE 'discard' END AS action FROM judged)"""

ORACLES = {
    "o25_classify_fetch": f"WITH {FETCHED} SELECT event_id, disposition, action FROM acted",
    "o26_classify_fetch_batch": f"""WITH {FETCHES}, s AS (SELECT * REPLACE (CASE WHEN event_id % 17 <> 0 THEN status END AS status) FROM fetches),
 j AS (SELECT event_id, CASE WHEN final_url IS NULL THEN 'no-url' WHEN status IS NULL THEN 'no-resp'
  WHEN status = 200 THEN CASE WHEN size > 10000000 THEN 'oversized' WHEN len(list_filter({EXCLUDED}, lambda d: contains(final_url, d))) > 0 THEN 'non-news' ELSE 'success' END
  WHEN status IN (403, 404, 429) THEN 'http-' || status ELSE 'http-' || (status // 100) || 'xx' END AS disposition FROM s)
SELECT event_id, disposition, CASE WHEN disposition = 'success' THEN 'pass' ELSE 'discard' END AS action FROM j""",
    "o30_redundant_feed": "SELECT page_id, page_id % 6 = 0 AS redundant FROM pages",
    "o31_gate_parsed": """WITH j AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'homepage' WHEN doc_id % 5 = 0 OR text = '' THEN 'no-text' WHEN doc_id % 3 <> 0 THEN 'OK-m' ELSE 'OK-none' END AS disposition FROM documents)
SELECT doc_id, disposition, CASE WHEN disposition LIKE 'OK-%' THEN 'pass' ELSE 'discard' END AS action FROM j""",
    "o43_adopt_canonical_url": f"""WITH {ODD_URLS}, c AS (SELECT page_id, CASE WHEN page_id % 10 = 0 THEN 'http://example.invalid/need_canonical_url' ELSE url END AS own FROM odd), {sql_parts('own', 'c')},
 j AS (SELECT page_id, own, CASE WHEN coalesce(own, '') IN ('', 'http://example.invalid/need_canonical_url') THEN 'no-canonical-url' ELSE coalesce({sql_check('own')}, 'adopted') END AS disposition FROM parts)
SELECT page_id, disposition, CASE WHEN disposition = 'adopted' THEN 'pass' ELSE 'discard' END AS action, CASE WHEN disposition = 'adopted' THEN own END AS url, 'http://example.invalid/need_canonical_url' AS original_url FROM j""",
    "o32_gate_index": """WITH j AS (SELECT doc_id, CASE WHEN doc_id % 12 = 0 THEN 'no-data' WHEN doc_id % 4 = 0 THEN 'no-url' WHEN doc_id % 6 = 0 OR text = '' THEN 'no-text' ELSE 'index' END AS disposition FROM documents)
SELECT doc_id, disposition, CASE WHEN disposition = 'index' THEN 'pass' ELSE 'quarantine' END AS action FROM j""",
    "o33_gate_producer": f"""WITH {ODD_URLS}, c2 AS (SELECT o.page_id, o.url AS u, octet_length(encode(p.html)) AS n FROM odd o JOIN pages p ON o.page_id = p.page_id),
 {sql_parts('u', 'c2')}, j AS (SELECT page_id, coalesce({sql_check('u')}, CASE WHEN n = 0 THEN 'no-html' WHEN n > 8000 THEN 'oversized' END, 'queuing') AS disposition FROM parts)
SELECT page_id, disposition, CASE WHEN disposition = 'queuing' THEN 'pass' ELSE 'discard' END AS action FROM j""",
    "o34_in_epoch": """SELECT CASE WHEN o_orderdate::DATE BETWEEN DATE '1996-01-01' AND DATE '1997-06-30' THEN 'B' WHEN o_orderdate::DATE BETWEEN DATE '1999-01-01' AND DATE '2000-12-31' THEN 'D' END AS epoch,
 count(*) AS n, min(o_orderdate::DATE) AS first, max(o_orderdate::DATE) AS last FROM orders GROUP BY 1""",
    "o35_select_by_query": "SELECT doc_id, source, (count(*) OVER ())::BIGINT AS matching FROM documents WHERE lang = 'en' AND n_chars > 2000",
    "o57_make_crumbs": f"""WITH {FETCHED} SELECT '2024-06-01' AS date, event_id % 5 AS feed_id, disposition AS status, count(*)::BIGINT AS sum, count(*) AS rows FROM acted WHERE action <> 'pass' GROUP BY ALL""",
    "o72_observed_counts": f"WITH {FETCHED} SELECT 'fetcher' AS app, disposition AS status, count(*) AS stories FROM acted GROUP BY ALL",
    "o72_disposition_counts": f"WITH {FETCHED} SELECT 'fetcher' AS app, disposition AS status, count(*) AS stories FROM acted GROUP BY ALL",
}
