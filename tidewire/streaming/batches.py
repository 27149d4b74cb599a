"""Batches of a number of stories or a span of time, whichever is full first, across the triggers of a stream.

State is a few numbers for each channel; stories go to a staging table by batch at once and to their archive
when their batch closes, so nothing of a story is held in the state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewire.operators.rewrite import read_or_none
from tidewire.sources.warc import storage
from tidewire.streaming.jobs import QUARTER, run_batches

#: Stories of a batch at most, and seconds from its first story.
MOST, SECONDS = 5_000, 15 * 60
#: Timers and lists of state need this store.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


#: Whether triggers come without new rows, as timers need; a stream that is to end with its rows mustn't have them.
IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextmanager
def with_timers(spark: SparkSession, trigger: dict) -> Iterator[None]:
    """Let a stream that starts herein keep its state in the store that timers need."""
    was = {k: spark.conf.get(k, None) for k in (STORE[0], IDLE)}
    spark.conf.set(*STORE)
    spark.conf.set(IDLE, str("availableNow" not in trigger).lower())
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Batches(StatefulProcessor):
    """Gives each story of a channel its batch, and a row that says so when a batch closes.

    A batch closes with its `most`th story, before a story that arrives `seconds` after its first, or when its
    timer ends. Its timer runs by the clock of the machine from the time that its first story was read. Stories
    are taken in the order of arrival among those that come together, else as they come; none is too late.
    """

    def __init__(self, most: int, seconds: float, columns: list[str]):
        self.most, self.wait, self.columns = most, int(seconds * 1000), columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "number long, stories long, first long, timer long")

    def _said(self, channel: str, number: int, first: int) -> pd.DataFrame:
        """The row that closes a batch."""
        nulls = {c: pd.Series([None], dtype=object) for c in self.columns}
        return pd.DataFrame(nulls | {"batch": [f"{channel}-{number}"], "first": [first], "event": ["closed"]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        channel = key[0]
        number, stories, first, timer = self.open.get() if self.open.exists() else (0, 0, 0, 0)
        was, now = timer, timerValues.getCurrentProcessingTimeInMs()
        for part in rows:
            part.columns = [*self.columns, "__channel", "__at"]  # computed columns come without their names
            part["__at"] = part["__at"].fillna(now).astype("int64")
            part = part.sort_values("__at", kind="stable")
            batches, firsts, closed = [], [], []
            for at in part["__at"]:
                if stories and at >= first + self.wait:
                    closed.append((number, first))
                    number, stories = number + 1, 0
                if not stories:
                    first, timer = int(at), now + self.wait
                stories += 1
                batches.append(f"{channel}-{number}")
                firsts.append(first)
                if stories == self.most:
                    closed.append((number, first))
                    number, stories, timer = number + 1, 0, 0
            yield part[self.columns].astype(object).where(part[self.columns].notna(), None).assign(batch=batches, first=firsts, event="story")
            for k, since in closed:
                yield self._said(channel, k, since)
        if was != timer:
            if was:
                self.handle.deleteTimer(was)
            if timer:
                self.handle.registerTimer(timer)
        self.open.update((number, stories, first, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if not self.open.exists():
            return
        number, stories, first, timer = self.open.get()
        if stories and timer == expiredTimerInfo.getExpiryTimeInMs():
            yield self._said(key[0], number, first)
            self.open.update((number + 1, 0, 0, 0))

    def close(self) -> None:
        pass


def assign_batches(stream: DataFrame, channel: Column, arrived: str, most: int = MOST, seconds: float = SECONDS) -> DataFrame:
    """The rows of a stream with batch (channel-number), first (milliseconds of its first arrival) and event
    (story); and rows of nulls with event closed. Channels fill their batches each for itself, so stories spread
    over as many tasks; a hash of the story serves."""
    columns = stream.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)
    keyed = stream.withColumns({"__channel": channel.cast("string"), "__at": F.unix_millis(arrived)})
    processor = Batches(most, seconds, columns)
    return keyed.groupBy("__channel").transformWithStateInPandas(processor, f"{schema}, batch string, first long, event string", "append", "ProcessingTime")


def _stories_of(spark: SparkSession, path: str, closed: list[str]) -> DataFrame:
    """The staged stories of some batches; only their folders are read."""
    rows = spark.read.option("basePath", f"{path}/staged").parquet(*[f"{path}/staged/batch={b}" for b in closed])
    return rows.where("event = 'story'").withColumn("batch", F.col("batch").cast("string")).drop("event", "trigger")


def archive_in_batches(
    stream: DataFrame, path: str, checkpoint: str, write: Callable[[DataFrame, str], None], channel: Column, arrived: str,
    most: int = MOST, seconds: float = SECONDS, trigger: dict | None = None,
):
    """Stories of a stream to archives, one for each batch, whatever the triggers: write(rows, path) is called
    with the stories of the batches that a trigger closes (batch, first beside their columns), and is to leave
    the same files if it is called again.

    A story is staged with its trigger before its batch is archived; a trigger that comes again stages and
    archives the same. Staged stories of a batch go when the trigger after the one that closed it begins.
    """

    def step(rows: DataFrame, trigger_no: int) -> None:
        spark = rows.sparkSession
        past = read_or_none(spark, f"{path}/closed/trigger={trigger_no - 1}")
        store, root = storage(path)
        for b in [r["batch"] for r in past.collect()] if past is not None else []:  # batches of one trigger, a row each
            if store.get_file_info(f"{root}/staged/batch={b}").is_file is False:
                store.delete_dir(f"{root}/staged/batch={b}")
        staged = rows.withColumn("trigger", F.lit(trigger_no))
        staged.write.partitionBy("batch", "trigger").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/staged")
        held = read_or_none(spark, f"{path}/staged")
        if held is None:
            return
        closed = held.where((F.col("trigger") == trigger_no) & (F.col("event") == "closed")).select(F.col("batch").cast("string").alias("batch"), "first").distinct()
        closed.coalesce(1).write.mode("overwrite").parquet(f"{path}/closed/trigger={trigger_no}")
        names = [r["batch"] for r in spark.read.parquet(f"{path}/closed/trigger={trigger_no}").collect()]
        if names:
            write(_stories_of(spark, path, names), f"{path}/archives")

    with with_timers(stream.sparkSession, trigger or QUARTER):
        return run_batches(assign_batches(stream, channel, arrived, most, seconds), checkpoint, step, trigger or QUARTER)


def archive_open(spark: SparkSession, path: str, write: Callable[[DataFrame, str], None]) -> int:
    """Archive what is staged in batches that are still open, with the stream at rest; how many they are. If the
    stream goes on later, such a batch is archived again, whole, in place of this."""
    held = read_or_none(spark, f"{path}/staged")
    if held is None:
        return 0
    names = {str(r["batch"]) for r in held.groupBy("batch").agg(F.count_if(F.col("event") == "closed").alias("n")).where("n = 0").collect()}
    if names:
        write(_stories_of(spark, path, sorted(names)), f"{path}/archives")
    return len(names)
