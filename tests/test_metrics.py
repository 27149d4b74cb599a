"""Roll-ups that merge: exact where they can be, within a rank error where they are sketches."""

import random
from bisect import bisect_left, bisect_right

from pyspark.sql import functions as F

from tidewire.operators import metrics as M


def rows(spark):
    rng = random.Random(1)
    data = []
    for i in range(40_000):
        name = rng.choice(["t1", "t2", "c", "g"])
        kind = {"t": "timer", "c": "counter", "g": "gauge"}[name[0]]
        value = rng.choice([1.0, 2.0, rng.expovariate(0.01)]) if kind == "timer" else float(rng.randint(0, 9))
        data.append((rng.randrange(3 * 86_400), i, name, kind, value))
    df = spark.createDataFrame(data, "s int, seq int, name string, kind string, value double").withColumn("ts", F.timestamp_seconds("s"))
    return data, df


def test_minutes_merge_to_days(spark):
    data, df = rows(spark)
    parts = M.merge_parts(M.merge_parts(M.metric_parts(df), "1 hour"), "1 day")
    got = {(r["name"], r["period"].day): r for r in M.finish_parts(parts).collect()}
    want = {(r["name"], r["period"].day): r for r in M.metric_rollup(df, "1 day").collect()}
    assert got.keys() == want.keys() and len(got) == 12
    for key, r in got.items():
        exact = want[key]
        for c in ("counter", "gauge", "count", "lower", "upper"):
            assert r[c] == exact[c], (key, c)
        for c in ("mean", "std", "sum", "sum_squares"):
            assert r[c] is None and exact[c] is None or abs(r[c] - exact[c]) <= 1e-6 * abs(exact[c]) + 1e-9
        values = sorted(v for s, _, n, k, v in data if n == key[0] and k == "timer" and s // 86_400 + 1 == key[1])
        for p in M.PERCENTILES if values else ():
            v = r["p" + f"{p:g}".replace(".", "_")]
            low, high = bisect_left(values, v) / len(values), bisect_right(values, v) / len(values)
            assert low - 0.005 <= p / 100 <= high + 0.005, (key, p, v)


def test_parts_of_nothing(spark):
    _, df = rows(spark)
    assert M.finish_parts(M.merge_parts(M.metric_parts(df.limit(0)), "1 day")).count() == 0
    gauges = M.finish_parts(M.metric_parts(df.where("kind = 'gauge'"), "1 day")).collect()
    assert gauges and all(r["median"] is None and r["mean"] is None and r["count"] == 0 and r["gauge"] is not None for r in gauges)
