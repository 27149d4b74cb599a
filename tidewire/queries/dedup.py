"""Queries over first-wins rules, object versions and old dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.config import FIXTURE
from tidewire.operators import dedup as D
from tidewire.queries.base import CRUMBS, crumbs, sql_check, sql_parts
from tidewire.queries.classify import EPOCHS
from tidewire.shared import read_table

OVERLAP = (2_000, 12_000)


def file_rows(spark, sf_dir):
    e, k = read_table(spark, sf_dir, "events"), F.col("event_id")
    url = F.when(k % 31 == 0, F.lit("http://localhost/x")).when(k % 37 == 0, F.lit("")).when(k % 41 == 0, F.lit("http://[::1/")).when(k % 43 == 0, F.lit("http://www.free-bets.example.com/"))
    url = url.otherwise(F.concat(F.lit("http://u"), F.col("user_id").cast("string"), F.lit(".example.com/")))
    return e.select(F.date_format("ts", "yyyy-MM-dd").alias("file"), url.alias("url"), k.alias("pos"), F.when(F.col("event_type") == "error", F.lit("x1")).otherwise(k.cast("string")).alias("dlid"))


def o51_dedup_urls_csv(spark, sf_dir):
    return D.dedup_urls_csv(file_rows(spark, sf_dir), FIXTURE.excluded_domains).select("pos", "disposition", "action")


def o52_dedup_urls_history(spark, sf_dir):
    return D.dedup_urls_history(file_rows(spark, sf_dir), FIXTURE.excluded_domains).select("pos", "disposition", "action")


def o53_old_feed_dates(spark, sf_dir):
    out = D.old_feed_dates(crumbs(spark, sf_dir), 20)
    return out.select("date", "feed_id", F.col("rank").cast("bigint").alias("rank"))


def o60_pick_object_version(spark, sf_dir):
    stories = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderdate")).alias("collect_date"))
    versions = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("version"), F.col("l_shipdate").alias("last_modified"), "l_partkey", "l_suppkey", "l_quantity")
    order = ["version", "last_modified", "l_partkey", "l_suppkey", "l_quantity"]
    out = D.pick_object_version(stories, versions, EPOCHS, OVERLAP, order)
    return out.select("key", "epoch", F.col("version").cast("bigint").alias("version"), "l_partkey", "disposition", "action")


def o56_latest_version_pick(spark, sf_dir):
    """The newest shipment of each order, the first in listing order."""
    rows = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")
    order = [F.col("l_shipdate").desc(), F.col("l_linenumber"), F.col("l_partkey")]
    return D.latest_version_pick(rows, ["l_orderkey"], order).select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("line"), "l_partkey")


def o60_fetch_objects(spark, sf_dir):
    p, k = read_table(spark, sf_dir, "pages"), F.col("page_id")
    stories = p.select(k.alias("key"), F.when(k % 3 == 0, F.lit(5.0)).alias("fetch_timestamp"))
    body = F.when(k % 8 == 1, F.concat(F.lit("(redundant feed)"), F.col("html"))).when(k % 8 == 2, F.lit("")).otherwise(F.col("html"))
    objects = p.where("page_id % 5 <> 0").select(k.alias("key"), F.encode(body, "UTF-8").alias("body"), (k * 2.0).alias("modified_at"))
    return D.fetch_objects(stories, objects, most=8000).select("key", "fetch_timestamp", "disposition")


QUERIES = {f.__name__: f for f in (o51_dedup_urls_csv, o52_dedup_urls_history, o53_old_feed_dates, o60_pick_object_version, o56_latest_version_pick, o60_fetch_objects)}

ROWS = f"""rows AS (SELECT strftime(ts, '%Y-%m-%d') AS file, CASE WHEN event_id % 31 = 0 THEN 'http://localhost/x' WHEN event_id % 37 = 0 THEN '' WHEN event_id % 41 = 0 THEN 'http://[::1/'
 WHEN event_id % 43 = 0 THEN 'http://www.free-bets.example.com/' ELSE 'http://u' || user_id || '.example.com/' END AS url, event_id AS pos, event_type <> 'error' AS good FROM events),
 {sql_parts('url', 'rows')}, checked AS (SELECT file, url, pos, good, {sql_check('url')} AS fault FROM parts)"""

ORACLES = {
    "o51_dedup_urls_csv": f"""WITH {ROWS}, j AS (SELECT pos, coalesce(fault, CASE WHEN row_number() OVER (PARTITION BY file, url, fault IS NULL ORDER BY pos) > 1 THEN 'dups' END, 'queuing') AS disposition FROM checked)
SELECT pos, disposition, CASE WHEN disposition = 'queuing' THEN 'pass' ELSE 'discard' END AS action FROM j""",
    "o52_dedup_urls_history": f"""WITH {ROWS}, s AS (SELECT *, coalesce(bool_or(fault IS NULL AND good) OVER (PARTITION BY file, url ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS seen FROM checked),
 j AS (SELECT pos, CASE WHEN fault IN ('bad-url', 'no-url') THEN 'bad-url' WHEN seen THEN 'dups' WHEN fault IS NOT NULL THEN fault WHEN NOT good THEN 'bad-dlid' ELSE 'queuing' END AS disposition FROM s)
SELECT pos, disposition, CASE WHEN disposition = 'queuing' THEN 'pass' ELSE 'discard' END AS action FROM j""",
    "o53_old_feed_dates": f"WITH {CRUMBS}, d AS (SELECT DISTINCT date, feed_id FROM crumbs), r AS (SELECT *, rank() OVER (PARTITION BY feed_id ORDER BY date DESC) AS rank FROM d) SELECT date, feed_id, rank FROM r WHERE rank > 20",
    "o60_pick_object_version": """WITH e AS (SELECT * FROM (VALUES ('B', DATE '1996-01-01', DATE '1997-06-30'), ('D', DATE '1999-01-01', DATE '2000-12-31')) t(epoch, a, b)),
 s AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate::DATE END AS d, o_orderkey BETWEEN 2000 AND 12000 AS inside FROM orders),
 st AS (SELECT s.*, e.epoch FROM s LEFT JOIN e ON d BETWEEN a AND b),
 v AS (SELECT l_orderkey AS key, l_linenumber AS version, l_partkey, e.epoch, row_number() OVER (PARTITION BY l_orderkey, e.epoch ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity) AS rn
  FROM lineitem JOIN e ON l_shipdate::DATE BETWEEN a AND b WHERE l_orderkey BETWEEN 2000 AND 12000),
 j AS (SELECT st.key, st.epoch, v.version::BIGINT AS version, v.l_partkey, CASE WHEN d IS NULL THEN 'no-date' WHEN NOT inside THEN 'unversioned' WHEN st.epoch IS NULL THEN 'no-epoch' WHEN v.key IS NULL THEN 'epoch-err' ELSE 'versioned' END AS disposition
  FROM st LEFT JOIN v ON v.key = st.key AND v.epoch = st.epoch AND rn = 1 AND inside)
SELECT *, CASE WHEN disposition IN ('versioned', 'unversioned') THEN 'pass' WHEN disposition IN ('no-date', 'no-epoch') THEN 'quarantine' ELSE 'discard' END AS action FROM j""",
    "o56_latest_version_pick": "SELECT l_orderkey, l_linenumber::BIGINT AS line, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey) = 1",
    "o60_fetch_objects": """SELECT page_id AS key, CASE WHEN page_id % 3 = 0 THEN 5.0 WHEN page_id % 5 <> 0 THEN page_id * 2.0 END::DOUBLE AS fetch_timestamp,
 CASE WHEN page_id % 5 = 0 THEN 'not-found' WHEN page_id % 8 = 1 THEN 'redundant' WHEN page_id % 8 = 2 OR html = '' THEN 'no-html' WHEN octet_length(encode(html)) > 8000 THEN 'oversized' ELSE 'success' END AS disposition FROM pages""",
}
