"""Queries over crawl plans and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.operators import crawl as C
from tidewire.queries.urls import SUFFIXES
from tidewire.functions import urls as U
from tidewire.shared import read_table


def o54_paced_release(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    rows = e.select("event_id", (F.col("user_id") % 40).alias("host"), F.unix_timestamp("ts").cast("double").alias("arrival"))
    return C.paced_release(rows, "host", "arrival", 5.0, ("event_id",)).select("event_id", "issued_at")


def fetch_log(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    outcome = F.when(F.col("event_type") == "error", "NOCONN").when(F.col("event_type") == "signup", "THROTTLE").when(F.col("event_type") == "view", "NODATA").otherwise("DATA")
    return e.select(F.concat(F.lit("h"), (F.col("user_id") % 40).cast("string")).alias("host"), F.unix_timestamp("ts").cast("double").alias("at"), F.col("event_id").alias("seq"), F.col("value").alias("seconds"), outcome.alias("outcome"))


def o55_host_interval_state(spark, sf_dir):
    out = C.host_interval_state(fetch_log(spark, sf_dir))
    return out.select("host", "fetches", F.round("avg", 4).alias("avg"), F.round("interval", 4).alias("interval"), "blocked_until")


def page_domains(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", U.canonical_domain(F.col("url"), SUFFIXES).alias("domain"))


def o73_pack_domains(spark, sf_dir):
    return C.pack_domains(page_domains(spark, sf_dir), 5, pos="page_id")


def o65_attach_batch(spark, sf_dir):
    rows = page_domains(spark, sf_dir)
    return C.attach_batch(rows, C.pack_domains(rows, 5, pos="page_id")).select("page_id", "domain", "batch")


def o74_batch_stats(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return C.batch_stats(d.select((F.col("doc_id") % 20).alias("batch"), F.col("source").alias("domain")))


QUERIES = {f.__name__: f for f in (o54_paced_release, o55_host_interval_state, o73_pack_domains, o65_attach_batch, o74_batch_stats)}

ORACLES = {
    "o54_paced_release": """WITH r AS (SELECT event_id, user_id % 40 AS host, epoch(date_trunc('second', ts))::DOUBLE AS a FROM events), n AS (SELECT *, row_number() OVER w - 1 AS rn FROM r WINDOW w AS (PARTITION BY host ORDER BY a, event_id))
SELECT event_id, rn * 5.0 + max(a - rn * 5.0) OVER (PARTITION BY host ORDER BY a, event_id ROWS UNBOUNDED PRECEDING) AS issued_at FROM n""",
    "o55_host_interval_state": """WITH RECURSIVE l AS (SELECT 'h' || (user_id % 40) AS host, epoch(date_trunc('second', ts))::DOUBLE AS at_, value AS s, event_type AS t, row_number() OVER (PARTITION BY user_id % 40 ORDER BY date_trunc('second', ts), event_id) AS n FROM events),
 f(host, n, avg, blocked) AS (SELECT DISTINCT host, 0::BIGINT, 0.0::DOUBLE, 0.0::DOUBLE FROM l
  UNION ALL SELECT f.host, l.n, CASE WHEN t = 'error' THEN avg WHEN t = 'signup' THEN CASE WHEN avg >= 30 THEN avg * pow(2, 1.0 / 8) ELSE 30.0 END
   ELSE CASE WHEN (CASE WHEN avg = 0 THEN s ELSE avg + 0.25 * (s - avg) END) > avg OR t <> 'view' THEN CASE WHEN avg = 0 THEN s ELSE avg + 0.25 * (s - avg) END ELSE avg END END,
   CASE WHEN t = 'error' THEN at_ + 600 ELSE blocked END FROM f JOIN l ON l.host = f.host AND l.n = f.n + 1)
SELECT host, n AS fetches, round(avg, 4) AS avg, round(greatest(avg / 4, 5.0), 4) AS interval, blocked AS blocked_until FROM f QUALIFY row_number() OVER (PARTITION BY host ORDER BY n DESC) = 1""",
    "o74_batch_stats": "SELECT doc_id % 20 AS batch, count(*) AS stories, count(DISTINCT source) AS domains, round(count(*) / count(DISTINCT source), 6) AS stories_per_domain FROM documents GROUP BY 1",
}
