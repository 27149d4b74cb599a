"""Sharding by rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import read_table, running_sum, stash

SHARDS = 8


def equal_shards(n: int) -> dict[int, float]:
    return dict.fromkeys(range(n), 1.0)


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard with the best draw for this key: u ** (1 / weight) is largest, u uniform in (0, 1).

    A shard's draw depends on the key and its own number and weight only, so another shard takes rows only
    into itself, and a dropped one gives rows only away. Null keys go to one shard, as one key does.
    """
    draws = []
    for shard, weight in sorted(weights.items()):
        if weight <= 0:
            raise ValueError("weights of shards must be positive")
        bits = F.shiftrightunsigned(F.xxhash64(F.lit("shard"), F.lit(shard), key), 11)
        u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        draws.append(F.struct((F.log(u) / F.lit(float(weight))).alias("draw"), F.lit(-shard).alias("back")))
    best = F.array_max(F.array(*draws)) if len(draws) > 1 else draws[0]
    return (-best["back"]).cast("int")


def with_slots(df: DataFrame, shard: str, identity: list[Column], out: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in the order of a hash of `identity`.

    The number of the input partition is part of the order, so that thousands of equal rows don't meet in
    one bucket. df must come from a written table, whose partitions are the same in every pass.
    """
    spread = F.xxhash64(F.lit("slot"), F.spark_partition_id(), *identity)
    df = df.withColumns({"__order": spread, "__one": F.lit(1)})
    return running_sum(df, [shard], ["__order"], "__one", out, bits=12).drop("__order", "__one")


LAW = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def shard_documents(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", carry: Sequence[str] = (), written: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the columns of `carry` for every row of docs.

    The law is `key`. A null text has size 1 and the checksum of no bytes; a null id is a key like any
    other; repeated rows share a shard and get slots of their own; an empty table gives no rows; columns
    other than the key, the text and those of `carry` are ignored. written: docs is a written table.
    """
    raw = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(raw).cast("long") + F.lit(1)).alias("size"),
        F.crc32(raw).cast("long").alias("text_crc32"),
        F.struct(F.lit(0).alias("__none"), *[F.col(f"`{c}`") for c in carry]).alias("__row"),
    )
    rows = rows.withColumns(
        {
            "law": F.lit("key"),
            "shard": rendezvous(F.col("doc_id"), equal_shards(shards)),
            "grown_shard": rendezvous(F.col("doc_id"), equal_shards(shards + 1)),
        }
    )
    out = with_slots(rows if written else stash(rows), "shard", [F.col("doc_id"), F.col("text_crc32")])
    return out.select(*LAW, *[F.col(f"__row.`{c}`").alias(c) for c in carry])


def op9_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op9_rendezvous_sharding": op9_rendezvous_sharding}
ORACLES: dict[str, str] = {}
