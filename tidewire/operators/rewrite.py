"""Changes of written tables in place: of a Parquet table in folders by one column, only the folders that a
change touches are read and written again; the files of all others stay as they are."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import urls as U
from tidewire.operators import index as I
from tidewire.operators.crumbs import old_feed_dates
from tidewire.shared import stash
from tidewire.sources.warc import storage


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at path; None if there is nothing yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None


def _within(by: str, values: list) -> Column:
    """A condition on the folders' column alone, so that only their files are listed and read."""
    some = F.col(by).isin([v for v in values if v is not None])
    return some | F.col(by).isNull() if None in values else some


def rewrite_folders(spark: SparkSession, path: str, by: str, touched: DataFrame, change: Callable[[DataFrame], DataFrame]) -> list:
    """Write the folders of the values in `touched` (a column named as `by`) again, with change() over their rows;
    gives these values. change is to give the same if it is run again over its own result, as a rewrite that
    fails halfway is simply run again.

    What is collected are names of folders. New rows are whole before an old file goes; a folder that is left
    without rows goes too; rows whose value has no folder yet get one.
    """
    values = [r[0] for r in touched.select(by).distinct().collect()]
    if not values:
        return []
    held = read_or_none(spark, path)
    old: dict = {}
    if held is not None:
        held = held.withColumn(by, F.col(by).cast(touched.schema[by].dataType)).where(_within(by, values))
        places = held.select(by, F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("place")).distinct().collect()
        old = {r[by]: r["place"] for r in places}
    else:
        held = touched.limit(0)
    fresh = stash(change(held))
    fresh.repartition(by).write.partitionBy(by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    left = {r[0] for r in fresh.select(by).distinct().collect()}
    for value, place in old.items():
        if value not in left:
            store, root = storage(unquote(place))
            store.delete_dir(root)
    return values


def delete_in_place(spark: SparkSession, path: str, urls: DataFrame, by: str = "day", url: str = "url", key: str = "doc_id") -> list:
    """Delete the documents of the listed URLs from the index at path; the folders written again."""
    gone = urls.select(U.doc_id(F.col(url)).alias(key)).distinct()
    hit = spark.read.parquet(path).select(by, key).join(gone, key, "left_semi")
    return rewrite_folders(spark, path, by, hit, lambda rows: rows.join(gone, key, "left_anti"))


def recompute_in_place(spark: SparkSession, path: str, where: Column, public_suffixes: Sequence[str], by: str = "day") -> list:
    """Matching documents of the index at path get canonical_domain from their URL, where that changes it."""

    def fresh(rows: DataFrame) -> DataFrame:
        return I.recompute_canonical_domain(rows, where, public_suffixes)

    table = spark.read.parquet(path)
    was = table.withColumn("__was", F.col("canonical_domain"))
    hit = fresh(was).where((F.col("update_status") == "updated") & ~F.col("canonical_domain").eqNullSafe(F.col("__was"))).select(by)
    return rewrite_folders(spark, path, by, hit, lambda rows: fresh(rows).drop("update_status"))


def prune_in_place(spark: SparkSession, path: str, days: int, by: str = "date") -> list:
    """Delete the crumbs of dates that are old for their feed from the table at path; null feeds stay."""
    old = stash(old_feed_dates(spark.read.parquet(path), days).select("date", "feed_id"))
    hit = old.where(F.col("feed_id").isNotNull()).select(by)
    return rewrite_folders(spark, path, by, hit, lambda rows: rows.join(old, ["date", "feed_id"], "left_anti"))


def replace_rows(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], by: str) -> list:
    """Put rows into the table at path, each in place of the one with the same keys (null keys are equal), if there
    is one; `by` is one of the keys. Rows that come again change nothing."""
    rows = stash(rows)
    own = rows.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))

    def change(held: DataFrame) -> DataFrame:
        return held.select(*rows.columns).join(own, same, "left_anti").unionByName(rows)

    return rewrite_folders(spark, path, by, rows, change)
