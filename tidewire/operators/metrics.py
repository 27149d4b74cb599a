"""Roll-ups of metrics and of archives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERCENTILES = (50, 75, 90, 95, 98, 99, 99.5, 99.9, 99.99, 99.999)


def metric_rollup(df: DataFrame, interval: str = "60 seconds", exact: bool = True) -> DataFrame:
    """(ts, seq, name, kind, value) by period and name: counters sum, gauges keep the last value, timers get
    count, mean, median, std, sum, sum_squares, lower, upper and percentiles (approximate on request)."""
    percentile = F.percentile if exact else F.percentile_approx
    timer = F.col("kind") == "timer"
    value = F.when(timer, F.col("value"))
    out = df.groupBy(F.window("ts", interval).alias("w"), "name", "kind").agg(
        F.sum(F.when(F.col("kind") == "counter", F.col("value"))).alias("counter"),
        F.max_by(F.when(F.col("kind") == "gauge", F.col("value")), F.struct("ts", "seq")).alias("gauge"),
        F.count(value).alias("count"), F.avg(value).alias("mean"), percentile(value, F.lit(0.5)).alias("median"), F.stddev_pop(value).alias("std"),
        F.sum(value).alias("sum"), F.sum(value * value).alias("sum_squares"), F.min(value).alias("lower"), F.max(value).alias("upper"),
        *[percentile(value, F.lit(p / 100)).alias("p" + f"{p:g}".replace(".", "_")) for p in PERCENTILES],
    )
    return out.select(F.col("w.start").alias("period"), *[c for c in out.columns if c != "w"])


#: Size of the sketches of timers: their quantiles are off by about one rank in 750.
SKETCH = 2_000


def metric_parts(df: DataFrame, interval: str = "60 seconds") -> DataFrame:
    """(ts, seq, name, kind, value) by period and name, in a form that merges to longer periods: sums, the last
    value of a gauge with its time, bounds, and a sketch of a timer's values, whose size has a bound."""
    timer, gauge = F.col("kind") == "timer", F.col("kind") == "gauge"
    value = F.when(timer, F.col("value").cast("double"))
    out = df.groupBy(F.window("ts", interval).alias("w"), "name", "kind").agg(
        F.sum(F.when(F.col("kind") == "counter", F.col("value"))).alias("counter"),
        F.max(F.when(gauge, F.struct("ts", "seq", "value"))).alias("last"),
        F.count(value).alias("count"), F.sum(value).alias("sum"), F.sum(value * value).alias("sum_squares"), F.min(value).alias("lower"), F.max(value).alias("upper"),
        F.kll_sketch_agg_double(value, SKETCH).alias("sketch"),
    )
    return out.select(F.col("w.start").alias("period"), *[c for c in out.columns if c != "w"])


def merge_parts(parts: DataFrame, interval: str) -> DataFrame:
    """Parts of longer periods, from parts of shorter ones; values aren't looked at again."""
    out = parts.groupBy(F.window("period", interval).alias("w"), "name", "kind").agg(
        F.sum("counter").alias("counter"), F.max("last").alias("last"), F.sum("count").alias("count"), F.sum("sum").alias("sum"), F.sum("sum_squares").alias("sum_squares"),
        F.min("lower").alias("lower"), F.max("upper").alias("upper"), F.kll_merge_agg_double("sketch", SKETCH).alias("sketch"),
    )
    return out.select(F.col("w.start").alias("period"), *[c for c in out.columns if c != "w"])


def finish_parts(parts: DataFrame) -> DataFrame:
    """The columns of metric_rollup from parts; percentiles come from the sketches, all else is exact."""
    some = F.col("count") > 0
    ranks = {"median": 50.0} | {"p" + f"{p:g}".replace(".", "_"): float(p) for p in PERCENTILES}
    quantiles = F.when(some, F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(p / 100) for p in ranks.values()])))
    mean = F.when(some, F.col("sum") / F.col("count"))
    std = F.sqrt(F.greatest(F.lit(0.0), F.col("sum_squares") / F.col("count") - mean * mean))
    return parts.withColumn("__q", quantiles).select(
        "period", "name", "kind", "counter", F.col("last.value").alias("gauge"), "count", mean.alias("mean"), F.when(some, std).alias("std"), "sum", "sum_squares", "lower", "upper",
        *[F.get("__q", F.lit(k)).alias(c) for k, c in enumerate(ranks)],
    )


def archive_stats(archived: DataFrame) -> DataFrame:
    return archived.groupBy("status").agg(F.count("*").alias("archives"), F.sum("stories").alias("stories"), F.sum("bytes").alias("bytes"))
