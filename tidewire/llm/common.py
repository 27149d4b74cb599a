"""What the training-data operators share: reading, written tables, running sums, text passes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewire.shared import new_path, read_table, shared_dir, stash  # noqa: F401  shared with the operators

#: Words as the contracts have them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def crc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Bits of the numbers that hash_order gives.
ORDER_BITS = 60


def hash_order(key: Column, text: Column) -> Column:
    """A fixed pseudo-random order of rows, from their own values alone; SQL engines can repeat it."""
    digest = F.md5(F.concat_ws("\u0001", F.coalesce(key.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(digest, 1, ORDER_BITS // 4), 16, 10).cast("long")


def running_sum(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    bits: int = 10,
    width: int = 64,
    per_group: DataFrame | None = None,
) -> DataFrame:
    """Add `out`: the sum of `value` over the rows of the same group that come before.

    The order is (bucket, order...), where the bucket is the top `bits` of the `width` bits of the first order
    column, a hash. A window over whole groups would put a hot group into one task, so sums of buckets give
    where each bucket starts, and the window runs inside buckets only. `group` and `order` must not be null.
    per_group: more columns for each group, which ride on the table of buckets.
    """
    keys = [*group, "__bucket"]
    df = df.withColumn("__bucket", F.shiftrightunsigned(F.col(order[0]), width - bits).cast("int"))
    starts = df.groupBy(*keys).agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("__start", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    if per_group is not None:
        starts = starts.join(per_group, list(group))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(starts, keys)
    total = F.col("__start") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return joined.withColumn(out, total.cast("long")).drop("__bucket", "__start")


def text_sizes(batch: pa.RecordBatch) -> np.ndarray:
    """Bytes of each value of the last column."""
    return pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)


def parts_of(batch: pa.RecordBatch, most: int, first: int | None = None) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose last column has about `most` bytes, or one longer value; first: those of the first part."""
    sizes = text_sizes(batch)
    upto, at, room = np.cumsum(sizes), 0, most if first is None else first
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + room, "right")))
        yield batch.slice(at, end - at)
        at, room = end, most


def blocks_of(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """All batches as blocks whose last column has `most` bytes at most, or one longer value, whatever the size of
    the batches."""
    held: list[pa.RecordBatch] = []
    room = most
    for batch in batches:
        if held and batch.num_rows and text_sizes(batch)[0] > room:
            yield pa.concat_batches(held)
            held, room = [], most
        *full, last = [*parts_of(batch, most, room)] or [batch]
        for part in full:
            yield pa.concat_batches([*held, part])
            held, room = [], most
        held.append(last)
        room -= int(text_sizes(last).sum())
    if held:
        yield pa.concat_batches(held)


@contextmanager
def arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Inside, Python gets the rows of what is run in batches of about `most` bytes. By default a batch has 10,000
    rows, however long their texts are; the JVM and the worker each hold it whole, for every core."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def map_texts(
    df: DataFrame,
    keep: Sequence[str | Column],
    make: Callable[[], Callable[[list], list[pa.Array]]],
    fields: Sequence[T.StructField],
    text: str = "text",
    most: int | None = None,
) -> DataFrame:
    """Pass the texts through Python in Arrow batches, as UTF-8 bytes (None for null), and add `fields`.

    make() runs once for each task and returns what turns the texts of one batch into arrays. The columns
    of `keep` go through untouched; nothing else of df does, so columns with clashing names do no harm.
    most: batches with more bytes of text are passed on in parts of that size, or of one longer text.
    """
    source = df.select(*keep, F.col(text).cast("binary").alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], *fields])
    names = schema.names

    def run(batches):
        work = make()
        for batch in batches if most is None else (part for b in batches for part in parts_of(b, most)):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *work(texts)], names=names)

    return source.mapInArrow(run, schema)


#: Draws are hashes of 63 bits, so that a share far below one in a million still picks rows.
DRAW_BITS = 63


def draw(*columns: Column | str) -> Column:
    """A pseudo-random number of DRAW_BITS bits from the values of a row alone."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - DRAW_BITS)


def cut_of(bound: int, n: int) -> int:
    """The draw below which about `bound` of n rows stand; at least one in n, whatever n is."""
    return (1 << DRAW_BITS) - 1 if n <= bound else max(bound << DRAW_BITS, 1 << DRAW_BITS) // n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, held_out, bound: int) -> DataFrame:
    """text, label, weight of a bounded sample of labelled rows outside the held-out part.

    The sampled ids have a proven bound (about `bound` for each of two classes) and are broadcast, so the
    texts of the corpus aren't shuffled. weight is how many labelled rows each stands for. A doc_id labelled
    twice counts as 1 if any of its labels is; of rows that share an id, one text is taken.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("__label"))
    known = known.where(~held_out(F.col("doc_id")))
    counts = {r[0]: r[1] for r in known.groupBy("__label").count().collect()}
    cut = {y: cut_of(bound, counts.get(y, 0)) for y in (0, 1)}
    stands = {y: max(1.0, counts.get(y, 0) / bound) for y in (0, 1)}
    positive = F.col("__label") == 1
    chosen = known.where(draw(F.lit("train"), "doc_id") <= F.when(positive, F.lit(cut[1])).otherwise(F.lit(cut[0])))
    weight = F.when(positive, F.lit(stands[1])).otherwise(F.lit(stands[0]))
    chosen = chosen.select(F.col("doc_id").alias("__id"), "__label", weight.alias("__weight"))
    rows = docs.select(F.col(key).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id")
    rows = rows.groupBy("__id", "__label", "__weight").agg(F.min("__text").alias("text"))
    return rows.select("text", F.col("__label").alias("label"), F.col("__weight").alias("weight"))


def distinct_sample(df: DataFrame, value: str, bound: int, n: int | None = None) -> tuple[DataFrame, float]:
    """Distinct values of a column, about `bound` of them at most, and how many each stands for.

    Chosen by a hash of the value alone, so any partitioning gives the same ones, and thousands of equal
    rows count once. All are taken if there are no more than `bound`; never none of a table with rows. n:
    the number of distinct values, estimated from sketches where it is not given.
    """
    rows = df.select(value).where(F.col(value).isNotNull())
    if n is None:
        n = rows.agg(F.approx_count_distinct(F.xxhash64(value), 0.02)).first()[0]
    drawn = rows.withColumn("__draw", draw(F.lit("sample"), value)).where(F.col("__draw") <= F.lit(cut_of(bound, n)))
    return drawn.dropDuplicates(["__draw"]).select(value), max(1.0, n / bound)
