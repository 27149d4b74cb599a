"""Limits, samples, orders and unions of story tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def limit_stories(df: DataFrame, n: int, accepted: str = "action = 'pass'") -> DataFrame:
    """The first n accepted rows; others don't count."""
    return df.where(accepted).limit(n)


def sample_percent(df: DataFrame, percent: float, seed: int, n: int | None = None) -> DataFrame:
    out = df.where(F.rand(seed) * 100 <= percent)
    return out if n is None else out.limit(n)


def sample_size(df: DataFrame, n: int, seed: int) -> DataFrame:
    return sample_percent(df, 10.0, seed, n)


def sample_exact(df: DataFrame, n: int, seed: int) -> DataFrame:
    """n rows without replacement; fewer are an error."""
    out = df.orderBy(F.rand(seed)).limit(n)
    have = df.limit(n).count()
    if have < n:
        raise ValueError(f"{have} rows, {n} asked for")
    return out


def shuffle_batches(df: DataFrame, pos: str, seed: int, size: int = 2_500) -> DataFrame:
    """Batches of `size` positions in order, rows inside in random order."""
    batch = F.floor(F.col(pos) / size).cast("bigint")
    return df.withColumn("batch", batch).repartition("batch").sortWithinPartitions("batch", F.rand(seed))


def newest_first(df: DataFrame, name: str) -> DataFrame:
    return df.orderBy(F.col(name).desc())


def scan_in_order(df: DataFrame, date: str = "indexed_date", key: str = "doc_id") -> DataFrame:
    return df.orderBy(date, key)


def union_producers(first: DataFrame, *others: DataFrame) -> DataFrame:
    for df in others:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def fan_out(df: DataFrame, *sinks) -> None:
    """The same rows to several sinks, computed once."""
    df = df.persist()
    try:
        for sink in sinks:
            sink(df)
    finally:
        df.unpersist()
