"""Continuous forms: each stream reads files as they come and ends when all are read (availableNow) unless a
trigger says otherwise."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators import crumbs as B
from tidewire.operators import index as I
from tidewire.operators.keys import KeyStore
from tidewire.operators.rewrite import replace_rows

ALL = {"availableNow": True}
QUARTER = {"processingTime": "15 minutes"}


def stream_files(spark: SparkSession, path: str, schema: str, per_batch: int | None = None, kind: str = "json") -> DataFrame:
    reader = spark.readStream.format(kind).schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(path)


def run_batches(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None], trigger: dict | None = None, mode: str = "append"):
    """Run step on each micro-batch; a failed batch comes again whole, with its number."""
    return stream.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", checkpoint).trigger(**(trigger or ALL)).start()


def _batch_path(path: str, number: int) -> str:
    return f"{path}/batch={number}"


def _keys_of(path: str) -> KeyStore:
    """The keys of the index at path, in a folder beside it."""
    return KeyStore(path.rstrip("/") + ".keys")


def stream_dedup_index(stream: DataFrame, index_path: str, seed: DataFrame, checkpoint: str, order: list[str], trigger: dict | None = None):
    """Create-only writes for ever: a batch goes to its own folder of the index, so that doing it again gives
    the same; no watermark, as duplicates are refused however late. A batch reads the keys in the buckets of its
    own keys; the keys of `seed` are taken over once."""
    columns, keys = seed.columns, _keys_of(index_path)
    keys.start(seed)

    def step(batch: DataFrame, number: int) -> None:
        new, out = I.create_only(batch, keys.known(batch, number), order), _batch_path(index_path, number)
        new.where("disposition = 'created'").select(*columns).write.mode("overwrite").parquet(out)
        keys.add(batch.sparkSession.read.schema(seed.schema).parquet(out), number)

    return run_batches(stream, checkpoint, step, trigger)


def stream_to_index(
    stream: DataFrame, stages: Callable[[DataFrame, DataFrame], DataFrame], path: str, known: DataFrame, checkpoint: str,
    archive: Callable[[DataFrame, str], None] | None = None, trigger: dict | None = None, key: Callable[[DataFrame], DataFrame] | None = None,
):
    """Stories to the index and to archives, batch by batch: stages(batch, known) gives every row its
    disposition. Rows go to path/rows, archives of the created ones to path/archives, a folder for each
    batch; the created rows of earlier batches are known to later ones.

    key: gives the keys (doc_id) that a batch may create, by which only their buckets of the known ones are
    read; without it all buckets are."""
    rows, keys = f"{path}/rows", _keys_of(f"{path}/rows")
    keys.start(known)

    def step(batch: DataFrame, number: int) -> None:
        out = _batch_path(rows, number)
        seen = keys.known(key(batch), number) if key is not None else keys.every(batch.sparkSession, number)
        stages(batch, seen).write.mode("overwrite").parquet(out)
        done = batch.sparkSession.read.parquet(out).where("disposition = 'created'")
        keys.add(done, number)
        if archive is not None:
            archive(done, _batch_path(f"{path}/archives", number))

    return run_batches(stream, checkpoint, step, trigger)


def crumb_stream(messages: DataFrame, table_path: str, checkpoint: str, trigger: dict | None = None):
    """Messages to a table of sums by the six keys, in folders by date: the sums are the stream's state, and a
    batch puts the new sums of its keys in place of the old ones, so that doing it again gives the same."""
    rows = B.read_crumbs(messages).where("kind = 'crumb' and app is not null")
    sums = rows.groupBy(*B.KEYS).agg(F.sum("count").alias("count"))

    def step(batch: DataFrame, number: int) -> None:
        replace_rows(batch.sparkSession, table_path, batch, B.KEYS, "date")

    return run_batches(sums, checkpoint, step, trigger, "update")


def crumb_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The table of crumb_stream: one row for each key."""
    return spark.read.parquet(table_path).withColumn("date", F.col("date").cast("string")).select(*B.KEYS, "count")


def micro_batch_archive(stories: DataFrame, path: str, checkpoint: str, write: Callable[[DataFrame, str], None], trigger: dict | None = None):
    """A batch of stories, or a quarter of an hour of them, to archives; a failed batch is written again."""

    def step(batch: DataFrame, number: int) -> None:
        write(batch, _batch_path(path, number))

    return run_batches(stories, checkpoint, step, trigger or QUARTER)


def stream_pipeline(stream: DataFrame, stages: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, trigger: dict | None = None):
    """Any chain of stages on each batch; all dispositions are kept."""

    def step(batch: DataFrame, number: int) -> None:
        stages(batch).write.mode("overwrite").parquet(_batch_path(path, number))

    return run_batches(stream, checkpoint, step, trigger)
