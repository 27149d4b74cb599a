"""Failed stories that wait and come back: the count of retries is kept with each story, and a timer ends its wait."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewire.config import Config

#: What comes out: `routed` says where an attempt went, `due` that a story's wait is over.
OUT = "event string, story string, attempt long, dest string, retries int, available_at timestamp, body string"


def route(action: str, retries: int, error_class: str | None, cfg: Config, discard: Sequence[str] = ()) -> tuple[str, int, int | None]:
    """dest, the count of retries after it, and the minutes to wait: route_failures for one story."""
    if action == "ok":
        return "done", retries, None
    if action == "quarantine":
        return "quarantine", 0, None
    if action == "requeue":
        return "requeue", retries, cfg.requeue_minutes
    if retries < cfg.max_retries:
        return "retry", retries + 1, cfg.retry_minutes
    return ("discard", retries, None) if error_class is not None and error_class in discard else ("quarantine", 0, None)


class Retries(StatefulProcessor):
    """One story: how often it was tried again, and what it waits with."""

    def __init__(self, cfg: Config, discard: Sequence[str], by_rows: bool):
        self.cfg, self.discard, self.by_rows = cfg, tuple(discard), by_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "retries int")
        self.waiting = handle.getMapState("waiting", "attempt long", "until long, dest string, retries int, body string")

    def _rows(self, rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["event", "story", "attempt", "dest", "retries", "available_at", "body"], dtype=object)
        out["available_at"] = pd.to_datetime(out["available_at"].astype("float64"), unit="ms", utc=True).astype("datetime64[us, UTC]")
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        retries = self.count.get()[0] if self.count.exists() else 0
        attempts = sorted((r for part in rows for r in part.iloc[:, 1:].itertuples(index=False, name=None)), key=lambda r: (r[1], r[0]))
        out, now = [], timerValues.getCurrentProcessingTimeInMs()
        for attempt, at, action, error_class, body in attempts:
            dest, retries, wait = route(action, retries, None if pd.isna(error_class) else error_class, self.cfg, self.discard)
            until = None
            if wait is not None:
                until = int((at if self.by_rows else now) + wait * 60_000)
                self.waiting.updateValue((int(attempt),), (until, dest, retries, body))
                self.handle.registerTimer(until)
            out.append(("routed", key[0], int(attempt), dest, retries, until, None))
            if dest in ("done", "discard"):
                retries = 0
        self.count.update((retries,))
        yield self._rows(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        ended = expiredTimerInfo.getExpiryTimeInMs()
        due = [(k[0], v) for k, v in self.waiting.iterator() if v[0] == ended]
        for attempt, _ in due:
            self.waiting.removeKey((attempt,))
        if due:
            yield self._rows([("due", key[0], a, v[1], v[2], v[0], v[3]) for a, v in sorted(due)])

    def close(self) -> None:
        pass


def stream_retries(attempts: DataFrame, cfg: Config, discard: Sequence[str] = (), late: str | None = None) -> DataFrame:
    """attempts: a stream of (story, attempt, at, action, error_class, body), action being ok, retry, requeue or
    quarantine, body what the story needs to be tried again. Gives a `routed` row for each attempt at once and a
    `due` row, with the body, when its wait is over.

    Waits run by the machine's clock. With `late` they run by the column `at`, for a replay in order of time: Spark
    then passes over rows that are later than that. A story that is done or discarded starts anew; quarantine
    sets its count to 0. State is held for each story; spread is as even as stories are.
    """
    stream = attempts if late is None else attempts.withWatermark("at", late)
    at = F.unix_millis("at").alias("millis")
    rows = stream.select(F.col("story").cast("string").alias("story"), F.col("attempt").cast("bigint").alias("attempt"), at, "action", "error_class", F.col("body").cast("string").alias("body"), *(["at"] if late else []))
    processor = _ByRows(cfg, discard, True) if late else Retries(cfg, discard, False)
    return rows.groupBy("story").transformWithStateInPandas(processor, OUT, "append", "EventTime" if late else "ProcessingTime")


class _ByRows(Retries):
    """The same, for rows with the time column that Spark needs behind theirs."""

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        return super().handleInputRows(key, (part.iloc[:, :-1] for part in rows), timerValues)
