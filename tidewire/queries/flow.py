"""Queries over failures, samples, orders and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.operators import failures as R
from tidewire.operators import sampling as S
from tidewire.queries.base import BATCH_TS
from tidewire.queries.classify import FETCHED, fetches
from tidewire.operators.classify import classify_fetch
from tidewire.shared import new_path, read_table




def failed(spark, sf_dir):
    e, k = read_table(spark, sf_dir, "events"), F.col("event_id")
    action = F.get(F.array(*[F.lit(a) for a in ("ok", "retry", "requeue", "quarantine", "retry")]), (k % 5).cast("int"))
    return e.select("event_id", action.alias("action"), (F.col("user_id") % 12).alias("retries"), F.when(k % 3 == 0, F.lit("gone")).alias("error_class"))


def o91_route_failures(spark, sf_dir):
    out = R.route_failures(failed(spark, sf_dir), F.to_timestamp(F.lit(BATCH_TS)), discard=("gone",))
    return out.select("event_id", "dest", "next_retries", F.date_format("available_at", "yyyy-MM-dd HH:mm:ss").alias("available_at"))


def o92_due_retries(spark, sf_dir):
    out = R.route_failures(failed(spark, sf_dir), F.to_timestamp(F.lit(BATCH_TS)), discard=("gone",))
    fresh = out.where("event_id % 100 = 7").select("event_id", F.lit("new").alias("dest"))
    due = R.due_retries(out.where("dest in ('retry', 'requeue')"), F.to_timestamp(F.lit("2024-06-01 12:30:00")), fresh=fresh, rerun=out.where("dest = 'quarantine' and event_id % 2 = 0"))
    return due.groupBy("dest").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


def o93_last_retry_status(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return R.last_retry_status(e.select(F.col("user_id").alias("story_id"), F.col("event_type").alias("status"), F.col("event_id").alias("attempt")))


def o80_limit_stories(spark, sf_dir):
    out = S.limit_stories(classify_fetch(fetches(spark, sf_dir), most=40), 500)
    return out.agg(F.count("*").alias("n"), F.count_if(F.col("action") != "pass").alias("others"))


def o81_sample_percent(spark, sf_dir):
    return S.sample_percent(read_table(spark, sf_dir, "documents").select("doc_id"), 25.0, seed=5)


def o82_sample_exact(spark, sf_dir):
    return S.sample_exact(read_table(spark, sf_dir, "documents").select("doc_id"), 100, seed=5).agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids"))


def o83_shuffle_batches(spark, sf_dir):
    out = S.shuffle_batches(read_table(spark, sf_dir, "events").select("event_id"), "event_id", seed=3)
    return out.groupBy("batch").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


def o84_newest_first(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select(F.concat(F.lit("in/"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv")).alias("name")).distinct()
    return S.newest_first(e, "name")


def o86_union_producers(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages").select(F.col("url").alias("link"), F.lit("file").alias("via"))
    d = read_table(spark, sf_dir, "documents").select(F.concat(F.lit("http://"), F.col("source")).alias("link"), F.col("doc_id").alias("source_feed_id"))
    return S.union_producers(p, d).groupBy("via").agg(F.count("*").alias("n"), F.sum("source_feed_id").alias("feeds"))


def o87_fan_out(spark, sf_dir):
    """The same rows to two tables, read back."""
    a, b = new_path(spark), new_path(spark)
    rows = classify_fetch(fetches(spark, sf_dir), most=40).select("event_id", "disposition", "action")
    S.fan_out(rows, lambda df: df.where("action = 'pass'").write.parquet(a), lambda df: df.groupBy("disposition").count().write.parquet(b))
    passed = spark.read.parquet(a).agg(F.count("*").alias("n")).select(F.lit("passed").alias("sink"), "n")
    return passed.unionByName(spark.read.parquet(b).select(F.concat(F.lit("count "), "disposition").alias("sink"), F.col("count").alias("n")))


QUERIES = {f.__name__: f for f in (o91_route_failures, o92_due_retries, o93_last_retry_status, o80_limit_stories, o81_sample_percent, o82_sample_exact, o83_shuffle_batches, o84_newest_first, o86_union_producers, o87_fan_out)}

ROUTED = f"""f AS (SELECT event_id, (['ok', 'retry', 'requeue', 'quarantine', 'retry'])[event_id % 5 + 1] AS action, user_id % 12 AS retries, event_id % 3 = 0 AS gone FROM events),
 d AS (SELECT *, CASE action WHEN 'ok' THEN 'done' WHEN 'quarantine' THEN 'quarantine' WHEN 'requeue' THEN 'requeue' ELSE CASE WHEN retries < 10 THEN 'retry' WHEN gone THEN 'discard' ELSE 'quarantine' END END AS dest FROM f),
 r AS (SELECT event_id, dest, CASE dest WHEN 'retry' THEN retries + 1 WHEN 'quarantine' THEN 0 ELSE retries END AS next_retries,
  CASE dest WHEN 'retry' THEN TIMESTAMP '{BATCH_TS}' + INTERVAL 60 MINUTE WHEN 'requeue' THEN TIMESTAMP '{BATCH_TS}' + INTERVAL 2 MINUTE END AS at_ FROM d)"""

ORACLES = {
    "o91_route_failures": f"WITH {ROUTED} SELECT event_id, dest, next_retries, strftime(at_, '%Y-%m-%d %H:%M:%S') AS available_at FROM r",
    "o92_due_retries": f"""WITH {ROUTED}, u AS (SELECT event_id, dest FROM r WHERE dest IN ('retry', 'requeue') AND at_ <= TIMESTAMP '2024-06-01 12:30:00'
 UNION ALL SELECT event_id, 'new' FROM r WHERE event_id % 100 = 7 UNION ALL SELECT event_id, dest FROM r WHERE dest = 'quarantine' AND event_id % 2 = 0) SELECT dest, count(*) AS n, sum(event_id)::BIGINT AS ids FROM u GROUP BY 1""",
    "o93_last_retry_status": "SELECT user_id AS story_id, arg_max(event_type, event_id) AS status, count(*) AS attempts FROM events GROUP BY 1",
    "o80_limit_stories": f"WITH {FETCHED} SELECT least(500, count(*))::BIGINT AS n, 0::BIGINT AS others FROM acted WHERE action = 'pass'",
    "o82_sample_exact": "SELECT least(100, count(*))::BIGINT AS n, least(100, count(DISTINCT doc_id))::BIGINT AS ids FROM documents",
    "o83_shuffle_batches": "SELECT event_id // 2500 AS batch, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1",
    "o84_newest_first": "SELECT DISTINCT 'in/' || strftime(ts, '%Y-%m-%d') || '.csv' AS name FROM events ORDER BY 1 DESC",
    "o86_union_producers": "SELECT 'file' AS via, count(*) AS n, NULL::BIGINT AS feeds FROM pages UNION ALL SELECT NULL, count(*), sum(doc_id)::BIGINT FROM documents",
    "o87_fan_out": f"WITH {FETCHED} SELECT 'passed' AS sink, count(*) AS n FROM acted WHERE action = 'pass' UNION ALL SELECT 'count ' || disposition, count(*) FROM acted GROUP BY 1",
}
