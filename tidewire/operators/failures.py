"""Where failed rows go: retry, requeue, quarantine, discard; and when they come back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route_failures(df: DataFrame, now: Column, max_retries: int = 10, delay_minutes: int = 60, requeue_minutes: int = 2, discard: Sequence[str] = ()) -> DataFrame:
    """dest, next_retries and available_at from (action, retries, error_class).

    action: ok, quarantine, requeue, retry. A retry after max_retries ends in quarantine, or is discarded
    for the listed error classes; quarantine restarts the count.
    """
    spent = F.col("retries") >= max_retries
    last = F.coalesce(F.col("error_class").isin(*discard), F.lit(False)) if discard else F.lit(False)
    dest = (
        F.when(F.col("action") == "ok", "done")
        .when(F.col("action") == "quarantine", "quarantine")
        .when(F.col("action") == "requeue", "requeue")
        .when(~spent, "retry")
        .when(last, "discard")
        .otherwise("quarantine")
    )
    df = df.withColumn("dest", dest)
    wait = F.when(F.col("dest") == "retry", F.lit(delay_minutes)).when(F.col("dest") == "requeue", F.lit(requeue_minutes))
    return df.withColumns(
        {
            "next_retries": F.when(F.col("dest") == "retry", F.col("retries") + 1).when(F.col("dest") == "quarantine", F.lit(0)).otherwise(F.col("retries")),
            "available_at": F.timestamp_micros(F.unix_micros(now) + wait.cast("long") * F.lit(60_000_000)),
        }
    )


def due_retries(delayed: DataFrame, now: Column, fresh: DataFrame | None = None, rerun: DataFrame | None = None) -> DataFrame:
    """Rows whose wait is over, with new input and rows taken back from quarantine."""
    out = delayed.where(F.col("available_at") <= now)
    for more in (fresh, rerun):
        if more is not None:
            out = out.unionByName(more, allowMissingColumns=True)
    return out


def last_retry_status(attempts: DataFrame, story: str = "story_id") -> DataFrame:
    """The status of each story's last attempt."""
    return attempts.groupBy(story).agg(F.max_by("status", "attempt").alias("status"), F.count("*").alias("attempts"))
