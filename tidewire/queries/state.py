"""Queries over what is kept between batches: retries that wait, timed batches, tables changed in place, keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire import schema
from tidewire.config import FIXTURE
from tidewire.operators import crumbs as B
from tidewire.operators import index as I
from tidewire.operators import rewrite as R
from tidewire.operators.keys import KeyStore
from tidewire.plans import jobs as J
from tidewire.queries.base import INDEX_DOCS, crumbs, index_docs, sql_parts, stories
from tidewire.queries.crumbs import LINES, OLD, messages
from tidewire.queries.index import urls_index
from tidewire.queries.jobs import json_stream
from tidewire.queries.sources import now
from tidewire.queries.urls import NORMAL, REGISTERED
from tidewire.shared import new_path, read_table, stash
from tidewire.sources import ranges, warc
from tidewire.streaming import batches as S
from tidewire.streaming import jobs
from tidewire.streaming import retries


def daily_index(spark, sf_dir):
    """The pages' index, written in folders of twenty days."""
    path = new_path(spark)
    rows = urls_index(spark, sf_dir).withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 20).cast("int")))
    rows.repartition("day").write.partitionBy("day").parquet(path)
    return path


def folders(df):
    """Rows with the name of their file: a rewrite puts its rows in files of its own."""
    return df.withColumn("file", F.col("_metadata.file_name"))


def o62_delete_in_place(spark, sf_dir):
    """The index after a delete of two days' documents; whether a row's file is one of those written first."""
    path = daily_index(spark, sf_dir)
    first = stash(folders(spark.read.parquet(path)).select("file").distinct().withColumn("untouched", F.lit(True)))
    gone = read_table(spark, sf_dir, "pages").where("page_id % 10 = 0").select(F.concat("url", F.lit("#x")).alias("url"))
    R.delete_in_place(spark, path, gone)
    left = folders(spark.read.parquet(path)).join(first, "file", "left")
    return left.select("page_id", "url", F.coalesce("untouched", F.lit(False)).alias("untouched"))


def o50_recompute_in_place(spark, sf_dir):
    path = daily_index(spark, sf_dir)
    R.recompute_in_place(spark, path, F.col("page_id") % 20 == 3, FIXTURE.public_suffixes)
    return spark.read.parquet(path).select("page_id", "canonical_domain", F.date_format("day", "yyyy-MM-dd").alias("day"))


def o63_prune_in_place(spark, sf_dir):
    path = new_path(spark)
    crumbs(spark, sf_dir).repartition("date").write.partitionBy("date").parquet(path)
    R.prune_in_place(spark, path, 20)
    table = spark.read.parquet(path).withColumn("date", F.col("date").cast("string"))
    return B.crumb_sum(table, ["date", "feed_id"])


def o61_key_store(spark, sf_dir):
    """Four batches against the keys of those before, in buckets."""
    docs, store = index_docs(spark, sf_dir).select("doc_id", "seq"), KeyStore(new_path(spark), buckets=16, most=2)
    store.start(docs.where("seq % 5 = 0"))
    out = None
    for number in range(4):
        batch = docs.where(F.col("seq") % 5 == number + 1)
        path = new_path(spark)
        I.create_only(batch, store.known(batch, number), ["seq"]).write.parquet(path)
        done = spark.read.parquet(path)
        store.add(done.where("disposition = 'created'"), number)
        out = done if out is None else out.unionByName(done)
    return out


def o97_crumb_table(spark, sf_dir):
    """The table of sums that a stream of messages keeps: a row for each key, and how many rows there are."""
    path = new_path(spark)
    jobs.crumb_stream(json_stream(spark, messages(spark, sf_dir), 3, "user_id"), path, new_path(spark)).awaitTermination()
    return jobs.crumb_table(spark, path).select("date", "feed_id", "app", "status", "count")


def o91_stream_retries(spark, sf_dir):
    """Attempts of 50 stories in order of time, each with the count of retries that its story has by then."""
    e, k, user = read_table(spark, sf_dir, "events"), F.col("event_id"), (F.col("user_id") % 50).cast("string")
    action = F.get(F.array(*[F.lit(a) for a in ("retry", "retry", "requeue", "retry", "retry", "quarantine", "ok", "retry", "retry", "retry", "retry")]), (k % 11).cast("int"))
    rows = e.select(user.alias("story"), k.alias("attempt"), F.timestamp_seconds(k * 60).alias("at"), action.alias("action"), F.when(k % 3 == 0, F.lit("gone")).alias("error_class"), F.lit("").alias("body"))
    path, out = new_path(spark), new_path(spark)
    rows.repartitionByRange(3, "attempt").write.json(path)
    stream = jobs.stream_files(spark, path, "story string, attempt bigint, at timestamp, action string, error_class string, body string")

    def step(batch, number):
        batch.where("event = 'routed'").write.mode("overwrite").parquet(f"{out}/batch={number}")

    with S.with_timers(spark, jobs.ALL):
        jobs.run_batches(retries.stream_retries(stream, FIXTURE, ("gone",)), new_path(spark), step).awaitTermination()
    done = spark.read.parquet(out)
    return done.select(F.col("story").cast("bigint").alias("story"), "attempt", "dest", F.col("retries").cast("bigint").alias("retries"))


def o94_timed_batches(spark, sf_dir):
    """Stories in archives of batches of 100, or of ten minutes, in two channels; what is left is archived at the
    end. Each story with the archive's batch and the size of the batch."""
    p, path = read_table(spark, sf_dir, "pages"), new_path(spark)
    k = F.col("page_id")
    rows = p.select((k % 2).alias("channel"), F.timestamp_seconds(k * F.when(k % 1000 < 500, 1).otherwise(20)).alias("arrived"), "url", "html", k.cast("double").alias("fetch_timestamp"))

    def write(batch, to):
        stories = batch.select("batch", "first", "url", F.encode("html", "UTF-8").alias("html"), F.lit("utf-8").alias("raw_encoding"), "fetch_timestamp")
        J.archive_stories(J.to_stories(stories, "batch", "first"), to, F.timestamp_millis("first"), FIXTURE, mode="replace", batch="batch")

    S.archive_in_batches(json_stream(spark, rows, 3, "arrived"), path, new_path(spark), write, F.col("channel"), "arrived", 100, 600.0, jobs.ALL).awaitTermination()
    S.archive_open(spark, path, write)
    back = warc.read_warc(spark, f"{path}/archives", schema.PARTS)
    batch = F.regexp_extract("file", r"archive-\d{14}-(\d+-\d+)-\d+-spark", 1)
    rows = back.select(F.col("http_metadata.final_url").alias("url"), batch.alias("batch"))
    sizes = rows.groupBy("batch").agg(F.count("*").alias("stories"))
    return rows.join(sizes, "batch").select("url", (F.length("batch") > 2).alias("batched"), (F.col("stories") <= 100).alias("fits"))


def o101_warc_ranges(spark, sf_dir):
    """Archives read by ranges of 20,000 bytes, so that each is many tasks': every story once."""
    path = new_path(spark)
    J.archive_stories(stories(spark, sf_dir).withColumn("content_metadata", F.lit(None).cast(f"struct<{schema.CONTENT_METADATA}>")), path, now(), FIXTURE)
    back = ranges.read_ranges(spark, path, schema.PARTS, 20_000)
    return back.select(F.col("target_uri").alias("url"), F.md5("raw_html.html").alias("digest"))


QUERIES = {
    f.__name__: f
    for f in (o62_delete_in_place, o50_recompute_in_place, o63_prune_in_place, o61_key_store, o97_crumb_table, o91_stream_retries, o94_timed_batches, o101_warc_ranges)
}

#: Retries since a story's last fresh start go round in a circle: ten that wait and an eleventh that ends them.
RETRIED = """a AS (SELECT event_id AS attempt, user_id % 50 AS story, event_id % 3 = 0 AS gone,
  (['retry', 'retry', 'requeue', 'retry', 'retry', 'quarantine', 'ok', 'retry', 'retry', 'retry', 'retry'])[event_id % 11 + 1] AS action FROM events),
 s AS (SELECT *, coalesce(sum((action IN ('ok', 'quarantine'))::INT) OVER (PARTITION BY story ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS era FROM a),
 n AS (SELECT *, coalesce(sum((action = 'retry')::INT) OVER (PARTITION BY story, era ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 11 AS held FROM s)"""

ORACLES = {
    "o62_delete_in_place": f"""WITH {sql_parts('url', 'pages', 'page_id, url')}, {NORMAL} SELECT page_id, url,
 page_id % 20 NOT IN (SELECT page_id % 20 FROM normal WHERE normalized IN (SELECT normalized FROM normal WHERE page_id % 10 = 0)) AS untouched
FROM normal WHERE normalized NOT IN (SELECT normalized FROM normal WHERE page_id % 10 = 0)""",
    "o50_recompute_in_place": f"""WITH {sql_parts('url', 'pages', 'page_id')} SELECT page_id, CASE WHEN page_id % 20 = 3 THEN {REGISTERED.format(h='host')} ELSE 'old' END AS canonical_domain,
 strftime(DATE '2024-01-01' + (page_id % 20)::INTEGER, '%Y-%m-%d') AS day FROM parts""",
    "o63_prune_in_place": f"""{OLD} SELECT date, feed_id, sum("count")::BIGINT AS sum, count(*) AS rows FROM crumbs c WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.date = c.date AND o.feed_id = c.feed_id) GROUP BY ALL""",
    "o61_key_store": f"""WITH {INDEX_DOCS}, o AS (SELECT *, CASE WHEN seq % 5 = 0 THEN 0 ELSE seq % 5 END AS turn FROM docs),
 f AS (SELECT *, min(turn) OVER (PARTITION BY doc_id) AS first_turn, row_number() OVER (PARTITION BY doc_id, turn ORDER BY seq) AS nth FROM o)
SELECT doc_id, seq, CASE WHEN first_turn < turn THEN 'ilm-dups' WHEN nth > 1 THEN 'dups' ELSE 'created' END AS disposition FROM f WHERE turn > 0""",
    "o97_crumb_table": f"""WITH {LINES.replace("ELSE 'crumb' END AS kind,", "ELSE 'crumb' END AS kind, strftime(ts, '%Y-%m-%d') AS date,").replace("SELECT 'too-new', 'vers-ok',", "SELECT 'too-new', NULL, 'vers-ok',")}
SELECT date, feed_id, counted_app AS app, status, sum(c)::BIGINT AS "count" FROM rows WHERE kind = 'crumb' GROUP BY ALL""",
    "o91_stream_retries": f"""WITH {RETRIED} SELECT story, attempt,
 CASE action WHEN 'ok' THEN 'done' WHEN 'requeue' THEN 'requeue' WHEN 'quarantine' THEN 'quarantine' ELSE CASE WHEN held < 10 THEN 'retry' WHEN gone THEN 'discard' ELSE 'quarantine' END END AS dest,
 CASE WHEN action = 'quarantine' THEN 0 WHEN action = 'retry' THEN CASE WHEN held < 10 THEN held + 1 WHEN gone THEN held ELSE 0 END ELSE held END::BIGINT AS retries FROM n""",
    "o101_warc_ranges": "SELECT url, md5(encode(html)) AS digest FROM pages",
    "o94_timed_batches": "SELECT url, true AS batched, true AS fits FROM pages",
}
