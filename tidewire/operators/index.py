"""From parsed stories to index documents: fields, dates, create-only writes, maintenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.config import INDEX_FIELDS
from tidewire.functions import urls as U

RFC_DATE = r"^\s*(?:[A-Za-z]{3},\s*)?(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} [+-]\d{4})\s*$"


def to_index_doc(df: DataFrame, fields: Sequence[str] = INDEX_FIELDS, keep: Sequence[str] = ()) -> DataFrame:
    """The index fields, empty text as null."""
    return df.select(*keep, *[F.nullif(F.col(f), F.lit("")).alias(f) for f in fields])


def field_missing_counts(df: DataFrame, fields: Sequence[str] = INDEX_FIELDS, more: Sequence[Column] = ()) -> DataFrame:
    """How often each field is missing, and further counts in the same pass."""
    return df.agg(*[F.count_if(F.coalesce(F.col(f), F.lit("")) == "").alias(f"missing_{f}") for f in fields], *more)


def rfc_day(stamp: Column) -> Column:
    """The day of an RFC 2822 stamp in the stamp's own offset, null if it can't be read."""
    core = F.regexp_extract(stamp, RFC_DATE, 1)
    local = F.try_to_timestamp(F.regexp_replace(core, r" [+-]\d{4}$", ""), F.lit("d MMM yyyy HH:mm:ss"))
    return F.when(core != "", F.date_format(local, "yyyy-MM-dd"))


def resolve_pub_date(df: DataFrame, own: str = "publication_date", stamp: str = "pub_date") -> DataFrame:
    """publication_date and pub_date_status: extracted, rss or none; a feed stamp that can't be read: retry."""
    has = ~F.coalesce(F.col(own), F.lit("")).isin("", "None")
    given = F.coalesce(F.col(stamp), F.lit("")) != ""
    day = rfc_day(F.col(stamp))
    status = F.when(has, "extracted").when(~given, "none").when(day.isNull(), "retry").otherwise("rss")
    return df.withColumns({"pub_date_status": status, own: F.when(has, F.col(own)).when(given, day)})


def resolve_indexed_date(parsed: Column, batch: Column) -> Column:
    return F.coalesce(parsed.try_cast("timestamp"), batch)


def create_only(batch: DataFrame, index: DataFrame, order: Sequence[str], key: str = "doc_id", no_import: bool = False) -> DataFrame:
    """disposition of each row of a batch: ilm-dups (the key is in the index), dups (it came before in the
    batch), created, or noimp for all. Only the index's keys are read, and it is only asked whether a key is
    among them, so they needn't be distinct; the batch is evaluated once."""
    if no_import:
        return batch.withColumn("disposition", F.lit("noimp"))
    known = index.select(F.col(key).alias("__known"))
    rows = batch.withColumn("__asked", F.col(key))  # a name that the index doesn't have, so that it means the batch's
    rows = rows.withColumn("__held", known.where(F.col("__known") == F.col("__asked").outer()).exists())
    first = Window.partitionBy(key).orderBy(*order)
    rows = rows.withColumn("__nth", F.row_number().over(first))
    status = F.when(F.col("__held"), "ilm-dups").when(F.col("__nth") > 1, "dups").otherwise("created")
    return rows.withColumn("disposition", status).drop("__asked", "__held", "__nth")


def write_index(batch: DataFrame, index: DataFrame, path: str, order: Sequence[str], key: str = "doc_id") -> DataFrame:
    """Append the rows that create_only creates to path, by day of indexed_date; gives all dispositions."""
    judged = create_only(batch, index, order, key)
    new = judged.where("disposition = 'created'").drop("disposition").withColumn("day", F.to_date("indexed_date"))
    new.write.mode("append").partitionBy("day").parquet(path)
    return judged


def delete_by_urls(index: DataFrame, urls: DataFrame, url: str = "url", key: str = "doc_id") -> DataFrame:
    """The index without the documents of the listed URLs; keys are hashes of their normal form."""
    gone = urls.select(U.doc_id(F.col(url)).alias(key)).distinct()
    return index.join(gone, key, "left_anti")


def delete_stats(index: DataFrame, urls: DataFrame, url: str = "url", key: str = "doc_id") -> DataFrame:
    gone = urls.select(U.doc_id(F.col(url)).alias(key)).distinct()
    deleted = index.join(gone, key, "left_semi").select(F.lit(1).alias("deleted"), F.lit(0).alias("requested"))
    both = deleted.unionByName(gone.select(F.lit(0).alias("deleted"), F.lit(1).alias("requested")))
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("deleted", "requested")])


def recompute_canonical_domain(index: DataFrame, where: Column, public_suffixes: Sequence[str]) -> DataFrame:
    """Matching documents get canonical_domain from their URL; those without a host keep theirs."""
    fresh = F.nullif(U.canonical_domain(F.col("url"), public_suffixes), F.lit(""))
    hit = F.coalesce(where, F.lit(False))
    status = F.when(~hit, "untouched").when(fresh.isNull(), "failed").otherwise("updated")
    return index.withColumn("update_status", status).withColumn("canonical_domain", F.when(F.col("update_status") == "updated", fresh).otherwise(F.col("canonical_domain")))


def reindex_copy(source: DataFrame, target: DataFrame, key: str = "doc_id", where: str | None = None, max_docs: int | None = None) -> DataFrame:
    """Rows of source to append to target: those of the query, up to max_docs in order of key, whose key
    target lacks."""
    chosen = source.where(where) if where else source
    if max_docs is not None:
        chosen = chosen.orderBy(key).limit(max_docs)
    return chosen.join(target.select(key), key, "left_anti")


def incremental_window(runs: DataFrame, now: Column, delay: str = "interval 2 hours") -> DataFrame:
    """(since, until) of the next incremental copy from a log of runs (started, until, status); no row if
    the last run failed or still runs."""
    last = runs.orderBy(F.col("started").desc()).limit(1)
    return last.where("status = 'done'").select(F.col("until").alias("since"), (now - F.expr(delay)).alias("until"))


def incremental_reindex(source: DataFrame, target: DataFrame, since: Column, until: Column, fields: Sequence[str], key: str = "doc_id") -> DataFrame:
    """Rows with since < indexed_date <= until that target lacks."""
    day = F.col("indexed_date")
    return reindex_copy(source.where((day > since) & (day <= until)).select(*fields), target, key)
