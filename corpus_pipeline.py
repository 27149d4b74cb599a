"""Documents to training shards: toxicity, near duplicates, benchmark leaks, mixing, sharding.

Each stage takes the rows that the one before kept, written as Parquet and read again: the partitions of a
stage's input are the same in every pass over it, which mixing and sharding rely on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import decontaminate, mixing, sharding, simhash, toxicity
from tidewire.llm.common import read_table, stash


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the weakly supervised classifier predicts toxic go.

    Null, empty and wordless texts match no entry and stay; rows with equal texts share one verdict; without
    labels nothing goes; an empty table stays empty; the columns stay, whatever their names.
    """
    return toxicity.remove_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of linked fingerprints stays, that of the smallest doc_id.

    Null, empty and wordless texts are one component; of equal rows, and of rows that tie in id and text,
    one stays; a component without ids keeps one row; an empty table stays empty; the columns stay.
    """
    return simhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold windows of benchmark items for a twentieth of their words or more go.

    Null and wordless texts have no window and stay; equal rows share one verdict; an empty benchmark takes
    nothing away; an empty table stays empty; the columns stay, whatever their names.
    """
    return decontaminate.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is read to its target, in rounds; one row for each time a document is taken, in training
    order.

    Null and wordless texts are in no mix; null sources are one source; equal rows are taken each for
    itself; rows that tie in position stand by their hash order; an empty table stays empty; the columns stay.
    """
    return mixing.curriculum(docs, written=True)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with their shard and their slot in it.

    Null texts have size 1; a null id is a key like any other; equal rows share a shard and get slots of
    their own; an empty table gives no rows; columns whose names are those of the result give way to it.
    """
    carry = [c for c in docs.columns if c not in sharding.LAW]
    return sharding.shard_documents(docs, carry=carry, written=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Hashes of shingles, a trained classifier and components are beyond plain SQL; tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else stash(docs), sf_dir)
    return docs
