"""Queries over breadcrumbs and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.operators import crumbs as B
from tidewire.operators import metrics as M
from tidewire.queries.base import CRUMBS, crumbs
from tidewire.shared import read_table


def o70_crumb_sum(spark, sf_dir):
    return B.crumb_sum(crumbs(spark, sf_dir), ["feed_id", "status"], start_date="2024-01-05", end_date="2024-01-25")


def o70_crumb_sum_null_domain(spark, sf_dir):
    return B.crumb_sum(crumbs(spark, sf_dir), ["date"], domain="", app="parser")


def o70_crumb_total(spark, sf_dir):
    return B.crumb_sum(crumbs(spark, sf_dir))


def o71_crumb_upsert(spark, sf_dir):
    c = crumbs(spark, sf_dir)
    return B.crumb_upsert(B.crumb_upsert(c.where("source_id < 4").limit(0), c.where("source_id < 4")), c.where("source_id >= 2"))


def o63_prune_crumbs(spark, sf_dir):
    return B.crumb_sum(B.prune_crumbs(crumbs(spark, sf_dir), 20), ["date", "feed_id"])


def o76_prune_summary(spark, sf_dir):
    return B.prune_summary(crumbs(spark, sf_dir), 20)


def messages(spark, sf_dir):
    """A message for each user: most with a header, some of a newer version or without, some lines broken."""
    e = read_table(spark, sf_dir, "events").where("event_type <> 'view'")
    line = F.concat(
        F.lit('{"date":"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('","feed_id":'), F.when(F.col("user_id") % 50 == 0, F.lit("null")).otherwise((F.col("user_id") % 50).cast("string")),
        F.lit(',"source_id":1,"domain":null,"app":"'), F.lit("fetcher"), F.lit('","status":"'), F.col("event_type"), F.when(F.col("event_id") % 3 == 0, F.lit('"}')).otherwise(F.lit('","count":2}')),
    )
    line = F.when(F.col("event_id") % 19 == 0, F.lit("{broken")).otherwise(line)
    body = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))).alias("lines"))
    u = F.col("user_id")
    head = F.when(u % 5 == 0, F.lit("")).when(u % 7 == 0, F.lit('{"version":[2,0,0],"app":"new"}\n')).otherwise(F.lit('{"version":[1,0,0],"app":"parser"}\n'))
    return body.select("user_id", F.concat(head, F.array_join(F.transform("lines", lambda x: x["line"]), "\n")).alias("body"))


def o09_read_crumbs(spark, sf_dir):
    out = B.read_crumbs(messages(spark, sf_dir))
    return out.groupBy("kind", "header", "status", "feed_id", "counted_app").agg(F.count("*").alias("rows"), F.sum("count").alias("total"))


def o19_publish_crumbs(spark, sf_dir):
    c = crumbs(spark, sf_dir).withColumn("ts", F.to_timestamp("date"))
    out = B.publish_crumbs(c, "ts", "parser", seconds=86_400)
    return out.select(F.date_format("period", "yyyy-MM-dd").alias("day"), "crumbs", F.size(F.split("body", "\n")).cast("bigint").alias("lines"), F.substring_index("body", "\n", 1).alias("header"))


def o19_publish_messages(spark, sf_dir):
    """A day's crumbs in messages of 50 lines at most, read back: the sums by all keys, and that no message is longer."""
    c = crumbs(spark, sf_dir).withColumn("ts", F.to_timestamp("date"))
    out = B.publish_messages(c, "ts", "parser", seconds=86_400, most=50)
    back = B.read_crumbs(out.select("number", "body")).where("kind = 'crumb'")
    return back.groupBy(*B.KEYS).agg(F.sum("count").alias("count"), F.max("line_no").alias("most")).select(*B.KEYS, "count", (F.col("most") <= 50).alias("fits"))


def o77_metric_rollup(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "view", "timer").when(F.col("event_type") == "signup", "gauge").otherwise("counter")
    rows = e.select("ts", F.col("event_id").alias("seq"), F.col("event_type").alias("name"), kind.alias("kind"), "value")
    out = M.metric_rollup(rows, "1 day")
    keep = ["counter", "gauge", "mean", "median", "std", "sum", "sum_squares", "lower", "upper", "p90", "p99", "p99_9"]
    return out.select(F.date_format("period", "yyyy-MM-dd").alias("day"), "name", "kind", "count", *[F.round(c, 4).alias(c) for c in keep])


def o77_merged_rollup(spark, sf_dir):
    """Minutes of metrics merged to days: what is exact, and whether the sketch's median has its rank among the
    values, give or take a hundredth."""
    e = read_table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "view", "timer").when(F.col("event_type") == "signup", "gauge").otherwise("counter")
    rows = e.select("ts", F.col("event_id").alias("seq"), F.col("event_type").alias("name"), kind.alias("kind"), "value")
    out = M.finish_parts(M.merge_parts(M.metric_parts(rows), "1 day")).withColumn("day", F.date_format("period", "yyyy-MM-dd"))
    both = rows.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "name", "value").join(out.select("day", "name", "median"), ["day", "name"])
    below, upto = F.avg((F.col("value") < F.col("median")).cast("int")), F.avg((F.col("value") <= F.col("median")).cast("int"))
    fits = both.groupBy("day", "name").agg(((below <= 0.51) & (upto >= 0.49)).alias("fits"))
    keep = ["counter", "gauge", "mean", "sum", "lower", "upper"]
    return out.join(fits, ["day", "name"]).select("day", "name", "kind", "count", *[F.round(c, 4).alias(c) for c in keep], "fits")


QUERIES = {f.__name__: f for f in (o70_crumb_sum, o70_crumb_sum_null_domain, o70_crumb_total, o71_crumb_upsert, o63_prune_crumbs, o76_prune_summary, o09_read_crumbs, o19_publish_crumbs, o19_publish_messages, o77_metric_rollup, o77_merged_rollup)}

OLD = f"WITH {CRUMBS}, d AS (SELECT DISTINCT date, feed_id FROM crumbs), r AS (SELECT *, rank() OVER (PARTITION BY feed_id ORDER BY date DESC) AS rank FROM d), old AS (SELECT * FROM r WHERE rank > 20)"
LINES = """e AS (SELECT * FROM events WHERE event_type <> 'view'), heads AS (SELECT user_id, CASE WHEN user_id % 5 = 0 THEN 'no-vers' WHEN user_id % 7 = 0 THEN 'too-new' ELSE 'vers-ok' END AS h FROM (SELECT DISTINCT user_id FROM e)),
 rows AS (SELECT CASE WHEN event_id % 19 = 0 THEN 'bad' ELSE 'crumb' END AS kind, h AS header, CASE WHEN event_id % 19 <> 0 THEN event_type END AS status, CASE WHEN event_id % 19 <> 0 THEN nullif(user_id % 50, 0) END AS feed_id,
  CASE WHEN event_id % 19 <> 0 THEN 'fetcher' END AS counted_app, CASE WHEN event_id % 19 <> 0 THEN CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END END AS c FROM e JOIN heads USING (user_id) WHERE h <> 'too-new'
  UNION ALL SELECT 'too-new', 'vers-ok', NULL, NULL, NULL, NULL FROM heads WHERE h = 'too-new')"""

ORACLES = {
    "o70_crumb_sum": f"""WITH {CRUMBS} SELECT feed_id, status, sum("count")::BIGINT AS sum, count(*) AS rows FROM crumbs WHERE date BETWEEN '2024-01-05' AND '2024-01-25' GROUP BY ALL""",
    "o70_crumb_sum_null_domain": f"""WITH {CRUMBS} SELECT date, sum("count")::BIGINT AS sum, count(*) AS rows FROM crumbs WHERE domain IS NULL AND app = 'parser' GROUP BY ALL""",
    "o70_crumb_total": f"""WITH {CRUMBS} SELECT sum("count")::BIGINT AS sum, count(*) AS rows FROM crumbs""",
    "o71_crumb_upsert": f"""WITH {CRUMBS}, both_ AS (SELECT * FROM crumbs WHERE source_id < 4 UNION ALL SELECT * FROM crumbs WHERE source_id >= 2)
SELECT date, feed_id, source_id, domain, app, status, sum("count")::BIGINT AS "count" FROM both_ GROUP BY ALL""",
    "o63_prune_crumbs": f"""{OLD} SELECT date, feed_id, sum("count")::BIGINT AS sum, count(*) AS rows FROM crumbs c WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.date = c.date AND o.feed_id = c.feed_id) GROUP BY ALL""",
    "o76_prune_summary": f"""{OLD} SELECT count(*) AS pairs, count(DISTINCT date) AS dates, count(DISTINCT feed_id) AS feeds, (SELECT count(*) FROM crumbs c WHERE EXISTS (SELECT 1 FROM old o WHERE o.date = c.date AND o.feed_id = c.feed_id)) AS rows_hit FROM old""",
    "o09_read_crumbs": f"WITH {LINES} SELECT kind, header, status, feed_id, counted_app, count(*) AS rows, sum(c)::BIGINT AS total FROM rows GROUP BY kind, header, status, feed_id, counted_app",
    "o19_publish_crumbs": """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS crumbs, count(*) + 1 AS lines, '{"version":[1,0,0],"sent_at":' || (epoch(strptime(strftime(ts, '%Y-%m-%d'), '%Y-%m-%d'))::BIGINT + 86400) || '.0,"app":"parser"}' AS header FROM events GROUP BY strftime(ts, '%Y-%m-%d')""",
    "o19_publish_messages": f"""WITH {CRUMBS} SELECT date, feed_id, source_id, domain, app, status, sum("count")::BIGINT AS "count", true AS fits FROM crumbs GROUP BY ALL""",
    "o77_merged_rollup": """WITH r AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS name, CASE event_type WHEN 'view' THEN 'timer' WHEN 'signup' THEN 'gauge' ELSE 'counter' END AS kind, value, ts, event_id FROM events)
SELECT day, name, kind, count(value) FILTER (WHERE kind = 'timer') AS "count", round(sum(value) FILTER (WHERE kind = 'counter'), 4) AS counter, round((list(value ORDER BY ts, event_id) FILTER (WHERE kind = 'gauge'))[-1], 4) AS gauge,
 round(avg(value) FILTER (WHERE kind = 'timer'), 4) AS mean, round(sum(value) FILTER (WHERE kind = 'timer'), 4) AS sum, round(min(value) FILTER (WHERE kind = 'timer'), 4) AS lower, round(max(value) FILTER (WHERE kind = 'timer'), 4) AS upper,
 CASE WHEN kind = 'timer' THEN true END AS fits FROM r GROUP BY day, name, kind""",
    "o77_metric_rollup": """WITH r AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS name, CASE event_type WHEN 'view' THEN 'timer' WHEN 'signup' THEN 'gauge' ELSE 'counter' END AS kind, value, ts, event_id FROM events)
SELECT day, name, kind, count(value) FILTER (WHERE kind = 'timer') AS "count", round(sum(value) FILTER (WHERE kind = 'counter'), 4) AS counter, round((list(value ORDER BY ts, event_id) FILTER (WHERE kind = 'gauge'))[-1], 4) AS gauge,
 round(avg(value) FILTER (WHERE kind = 'timer'), 4) AS mean, round(quantile_cont(value, 0.5) FILTER (WHERE kind = 'timer'), 4) AS median, round(stddev_pop(value) FILTER (WHERE kind = 'timer'), 4) AS std, round(sum(value) FILTER (WHERE kind = 'timer'), 4) AS sum,
 round(sum(value * value) FILTER (WHERE kind = 'timer'), 4) AS sum_squares, round(min(value) FILTER (WHERE kind = 'timer'), 4) AS lower, round(max(value) FILTER (WHERE kind = 'timer'), 4) AS upper,
 round(quantile_cont(value, 0.9) FILTER (WHERE kind = 'timer'), 4) AS p90, round(quantile_cont(value, 0.99) FILTER (WHERE kind = 'timer'), 4) AS p99, round(quantile_cont(value, 0.999) FILTER (WHERE kind = 'timer'), 4) AS p99_9 FROM r GROUP BY day, name, kind""",
}
