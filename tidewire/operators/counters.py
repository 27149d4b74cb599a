"""Counts that the pass itself makes: of dispositions and of missing fields, without a second job."""

from __future__ import annotations

from collections.abc import Sequence
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewire.config import INDEX_FIELDS

#: The dispositions of the jobs; others are counted together, under the last name.
STATUSES = (
    "created", "dups", "ilm-dups", "no-data", "no-url", "no-text", "bad-pub-date", "homepage", "too-short", "no-html", "no-decode", "oversized", "not-text", "non-news", "bad-url", "bad-host",
    "no-host", "bad-scheme", "bad-dlid", "bad", "not-found", "redundant", "epoch-err", "no-epoch", "no-date", "no-resp", "noconn", "badurl2", "http-403", "http-404", "http-429", "http-1xx",
    "http-2xx", "http-3xx", "http-4xx", "http-5xx", "success",
)
OTHER = "other"


def _counts(statuses: Sequence[str], fields: Sequence[str], status: str) -> list[Column]:
    at = F.col(status)
    own = [F.count_if(at == s).alias(s) for s in statuses]
    rest = F.count_if(at.isNull() | ~at.isin(*statuses)).alias(OTHER)
    missing = [F.count_if(F.coalesce(F.col(f).cast("string"), F.lit("")) == "").alias(f"missing_{f}") for f in fields]
    return [*own, rest, *missing]


def count_dispositions(df: DataFrame, statuses: Sequence[str] = STATUSES, fields: Sequence[str] = (), status: str = "disposition") -> tuple[DataFrame, Observation]:
    """df with an observation of how many rows have each status, and of how many lack each of `fields`. What it
    counts is there once df, or what is made of it, has run once: observation.get."""
    seen = Observation()
    return df.observe(seen, *_counts(statuses, fields, status)), seen


def count_missing(df: DataFrame, fields: Sequence[str] = INDEX_FIELDS) -> tuple[DataFrame, Observation]:
    """df with an observation of how many rows lack each field."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *_counts((), fields, fields[0])[1:]), seen


def as_table(spark: SparkSession, counts: dict[str, int], app: str) -> DataFrame:
    """app, status, stories of an observation's counts, those that aren't zero: a row for each status at most."""
    rows = [(app, k, int(n)) for k, n in counts.items() if n]
    return spark.createDataFrame(rows, "app string, status string, stories bigint")


def count_stream(stream: DataFrame, name: str, statuses: Sequence[str] = STATUSES, fields: Sequence[str] = (), status: str = "disposition") -> DataFrame:
    """The same for a stream; a StreamCounts that listens adds up what its batches count under this name."""
    return stream.observe(name, *_counts(statuses, fields, status))


class StreamCounts(StreamingQueryListener):
    """Sums over all batches of what streams observe, by the observation's name. spark.streams.addListener(it)."""

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = {}
        self._lock = Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        with self._lock:
            for name, row in event.progress.observedMetrics.items():
                held = self.totals.setdefault(name, {})
                for k, n in row.asDict().items():
                    held[k] = held.get(k, 0) + n

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
