"""Retries over a clock: counts are kept, waits end, and routes are those of the batch form."""

import random
import time
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidewire.config import Config
from tidewire.operators import failures
from tidewire.streaming import jobs as S
from tidewire.streaming import retries as R
from tidewire.streaming.batches import with_timers

ROW = "story string, attempt long, at timestamp, action string, error_class string, body string"
CFG = Config(max_retries=3)


def attempts(n, seed=1):
    rng, clock, out = random.Random(seed), 0, []
    for k in range(n):
        clock += rng.choice([0, 20, 60, 400])
        out.append((f"s{rng.randrange(6)}", k, clock, rng.choice(["ok", "retry", "retry", "retry", "retry", "requeue", "quarantine"]), rng.choice([None, "gone"]), f"body {k}"))
    return out


def run(spark, tmp_path, parts, cfg=CFG, late="1 hour", trigger=None, until=None):
    for k, rows in enumerate(parts):
        df = spark.createDataFrame(rows, "story string, attempt long, seconds long, action string, error_class string, body string")
        df.select("story", "attempt", F.timestamp_seconds("seconds").alias("at"), "action", "error_class", "body").coalesce(1).write.mode("append").json(f"{tmp_path}/in/{k:03d}")
    stream = S.stream_files(spark, f"{tmp_path}/in/*", ROW, 1)
    out, trigger = f"{tmp_path}/out", trigger or S.ALL

    def step(rows, number):
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    with with_timers(spark, trigger):
        query = S.run_batches(R.stream_retries(stream, cfg, ("gone",), late), f"{tmp_path}/point", step, trigger)
    if until is None:
        query.awaitTermination()
    else:
        end = time.time() + 60
        try:
            while time.time() < end and not until(out):
                time.sleep(1)
        finally:
            query.stop()
    return spark.read.parquet(out).withColumn("due", F.unix_seconds("available_at"))


def by_the_rule(spark, rows, cfg):
    """Each attempt through the batch form, with the count that its story has by then."""
    counts, out = {}, {}
    now = datetime(1970, 1, 1, tzinfo=timezone.utc)
    cases = [(a, n, e) for a in ("ok", "retry", "requeue", "quarantine") for n in range(cfg.max_retries + 1) for e in (None, "gone")]
    df = spark.createDataFrame([(*c, now) for c in cases], "action string, retries int, error_class string, t timestamp")
    routed = failures.route_failures(df, F.col("t"), cfg.max_retries, cfg.retry_minutes, cfg.requeue_minutes, ("gone",)).withColumn("wait", F.unix_seconds("available_at"))
    table = {(r["action"], r["retries"], r["error_class"]): (r["dest"], r["next_retries"], r["wait"]) for r in routed.collect()}
    for story, attempt, at, action, error, body in rows:
        dest, n, wait = table[(action, counts.get(story, 0), error)]
        out[attempt] = (story, dest, n, None if wait is None else at + wait, body)
        counts[story] = 0 if dest in ("done", "discard") else n
    return out


def test_routes_and_waits_over_a_replayed_clock(spark, tmp_path):
    rows = attempts(150)
    want = by_the_rule(spark, rows, CFG)
    got = run(spark, tmp_path, [rows[i : i + 30] for i in range(0, 150, 30)]).collect()
    routed = {r["attempt"]: (r["story"], r["dest"], r["retries"], r["due"]) for r in got if r["event"] == "routed"}
    assert routed == {k: v[:4] for k, v in want.items()} and {v[1] for v in want.values()} == {"done", "retry", "requeue", "quarantine", "discard"}
    due = {r["attempt"]: (r["story"], r["dest"], r["retries"], r["due"], r["body"]) for r in got if r["event"] == "due"}
    clock = rows[-31][2] - 3600  # the watermark of the last batch with rows
    assert due.items() <= {k: v for k, v in want.items() if v[3] is not None}.items()
    assert due.keys() >= {k for k, v in want.items() if v[3] is not None and v[3] < clock} and len(due) > 20
    assert len(got) == len(routed) + len(due)


def test_a_wait_ends_by_the_machines_clock(spark, tmp_path):
    cfg = Config(requeue_minutes=0, retry_minutes=60)
    rows = [("a", 1, 5, "requeue", None, "again"), ("b", 2, 5, "retry", None, "later")]

    def until(out):
        try:
            return spark.read.parquet(out).where("event = 'due'").count() > 0
        except Exception:  # nothing is written yet
            return False

    got = run(spark, tmp_path, [rows], cfg, None, {"processingTime": "1 second"}, until).collect()
    assert [(r["story"], r["dest"], r["body"]) for r in got if r["event"] == "due"] == [("a", "requeue", "again")]
    assert {r["attempt"]: r["retries"] for r in got if r["event"] == "routed"} == {1: 0, 2: 1}
