"""Stories from feeds, CSV files and lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.config import NEED_CANONICAL_URL
from tidewire.functions import urls as U
from tidewire.shared import stash

ITEM = "link string, title string, domain string, pubDate string, source struct<_VALUE:string,_url:string,_mcFeedId:string,_mcSourceId:string>"


def optional_int(text: Column) -> Column:
    """A number only if the text is all digits."""
    return F.when(text.rlike("^[0-9]+$"), text).try_cast("bigint")


def rfc_to_day(stamp: Column) -> Column:
    """YYYY-MM-DD of an RFC 2822 stamp, the text itself if it can't be read."""
    day = F.try_to_timestamp(F.regexp_extract(stamp, r"(\d{1,2} [A-Za-z]{3} \d{4})", 1), F.lit("d MMM yyyy"))
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), stamp)


def read_daily_feed(spark: SparkSession, paths: str | Sequence[str], empty_as: str | None = None, fetch_date: str | None = None) -> DataFrame:
    """One row per item of daily feed files (gzip or plain), with the fields of rss_entry, disposition and
    via, the file's name. lastBuildDate of a file is the fetch_date of its items, unless one is given."""
    items = spark.read.format("xml").option("rowTag", "item").schema(ITEM).load(paths).select("*", F.col("_metadata.file_name").alias("via"), F.col("_metadata.file_path").alias("__path"))

    def field(name):
        value = F.nullif(F.trim(F.col(name)), F.lit(""))
        return F.coalesce(value, F.lit(empty_as)) if empty_as is not None else value

    rows = items.select(
        field("link").alias("link"), field("title").alias("title"), field("domain").alias("domain"), field("pubDate").alias("pub_date"),
        F.col("source._url").alias("source_url"), optional_int(F.col("source._mcFeedId")).alias("source_feed_id"),
        optional_int(F.col("source._mcSourceId")).alias("source_source_id"), "via", "__path",
    )
    if fetch_date is not None:
        rows = rows.withColumn("fetch_date", F.lit(fetch_date))
    else:
        built = spark.read.format("xml").option("rowTag", "channel").schema("lastBuildDate string").load(paths)
        built = built.select(F.col("_metadata.file_path").alias("__path"), rfc_to_day(F.trim("lastBuildDate")).alias("fetch_date"))
        rows = rows.join(built, "__path", "left")
    return rows.drop("__path").withColumn("disposition", F.when(F.coalesce("link", F.lit("")) == "", "bad").otherwise("queuing"))


def iso_to_rfc(stamp: Column) -> Column:
    ts = stamp.try_cast("timestamp")
    return F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" -0000"))


def read_feed_entries(entries: DataFrame, last: int, count: int, host: str, excluded: Sequence[str] = ()) -> DataFrame:
    """The next `count` feed rows behind id `last`, as rss_entry fields with their disposition. Rows without
    an id come last, as bad-id."""
    rows = entries.where(F.col("id").isNull() | (F.col("id") > last)).orderBy(F.col("id").asc_nulls_last()).limit(count)
    status = F.when(F.col("id").isNull(), "bad-id").when(F.col("url").isNull(), "no-url").otherwise(U.check_url(F.col("url"), excluded))
    return rows.select(
        "id", F.col("url").alias("link"), "title", "domain", iso_to_rfc(F.col("published_at")).alias("pub_date"), F.col("feed_url").alias("source_url"),
        F.col("feed_id").alias("source_feed_id"), F.col("sources_id").alias("source_source_id"), F.concat(F.col("id").cast("string"), F.lit(f"@{host}")).alias("via"),
        F.coalesce(status, F.lit("queuing")).alias("disposition"),
    )


def _last_pulled(spark: SparkSession, state: str) -> int:
    """The id where the last pull ended; 0 before the first."""
    try:
        return spark.read.schema("last bigint").parquet(state).agg(F.max("last")).first()[0] or 0
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return 0


def resume_entries(spark: SparkSession, entries: DataFrame, state: str, count: int, host: str, excluded: Sequence[str] = (), dry_run: bool = False) -> DataFrame:
    """The next `count` feed rows behind the id where the last pull ended, from a table of such ids at `state`;
    its first pull starts behind 0. A dry run leaves the table as it is, and so do a pull without rows and one
    during which another pull moved it. The rows are a written table, so that they are those whose last id is
    kept; rows without an id come again with each pull."""
    last = _last_pulled(spark, state)
    rows = stash(read_feed_entries(entries, last, count, host, excluded))
    end = rows.agg(F.max("id")).first()[0]
    if not dry_run and end is not None and _last_pulled(spark, state) == last:
        spark.createDataFrame([(end,)], "last bigint").coalesce(1).write.mode("append").parquet(state)
    return rows


HISTORY = "collect_date string, stories_id string, media_id string, downloads_id string, feeds_id string, language string, url string"


def read_history_csv(spark: SparkSession, paths: str | Sequence[str], schema: str = HISTORY, require_url: bool = True, mark: str = NEED_CANONICAL_URL) -> DataFrame:
    """Rows of historical CSV files: link is the download's id, final_url the URL or, if none is asked for,
    the mark that the page is to tell it."""
    rows = spark.read.csv(paths, schema=schema, header=True).select("*", F.col("_metadata.file_name").alias("file"))
    stamp = F.unix_micros(F.col("collect_date").try_cast("timestamp")) / F.lit(1e6)
    return rows.select(
        "file", F.col("downloads_id").alias("link"), optional_int(F.col("feeds_id")).alias("source_feed_id"), optional_int(F.col("media_id")).alias("source_source_id"),
        stamp.alias("fetch_timestamp"), (F.col("language") if "language" in rows.columns else F.lit(None).cast("string")).alias("language"),
        (F.col("url") if require_url else F.lit(mark)).alias("final_url"),
    )


def read_url_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The first column of CSV files without a header."""
    rows = spark.read.csv(paths, schema="url string", header=False, enforceSchema=True)
    return rows.select(F.col("url").alias("link"), F.col("url").alias("final_url"), F.col("_metadata.file_name").alias("file"))


def read_url_list(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.text(paths).select(F.trim("value").alias("url"))


def write_url_list(stories: DataFrame, path: str, archive: str = "archive", url: str = "url") -> None:
    """A list of URLs for each archive."""
    stories.where(F.col(url).isNotNull()).select(F.col(url).alias("value"), archive).write.partitionBy(archive).text(path)
