"""Stories as files: a folder per day, a JSON table per part, pages as binary columns in Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.urls import story_id

JSON_PARTS = ("rss_entry", "http_metadata", "content_metadata")


def write_disk_stories(stories: DataFrame, path: str) -> DataFrame:
    """Write stories that have a link and a fetch date below path, by day and story_id; gives the others,
    with action quarantine."""
    fault = F.when(F.coalesce("rss_entry.link", F.lit("")) == "", "no-link").when(F.coalesce("rss_entry.fetch_date", F.lit("")) == "", "no-fetch-date")
    rows = stories.withColumns({"__fault": fault, "story_id": story_id(F.col("rss_entry.link"))})
    good = rows.where("__fault is null")
    day = F.to_date("rss_entry.fetch_date")
    good = good.withColumns({"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"), "day": F.date_format(day, "dd")})
    for part in JSON_PARTS:
        good.where(F.col(part).isNotNull()).select("year", "month", "day", "story_id", F.col(part)).write.partitionBy("year", "month", "day").json(f"{path}/_{part}")
    good.where("raw_html is not null").select("year", "month", "day", "story_id", "raw_html").write.partitionBy("year", "month", "day").parquet(f"{path}/_raw_html")
    return rows.where("__fault is not null").withColumns({"disposition": F.col("__fault"), "action": F.lit("quarantine")}).drop("__fault")


def read_disk_stories(spark: SparkSession, path: str, part_schemas: dict[str, str]) -> DataFrame:
    """Stories by story_id; a missing part is null."""
    out = None
    for part, schema in part_schemas.items():
        rows = spark.read.schema(f"story_id string, {part} struct<{schema}>").json(f"{path}/_{part}").select("story_id", part)
        out = rows if out is None else out.join(rows, "story_id", "full")
    pages = spark.read.parquet(f"{path}/_raw_html").select("story_id", "raw_html")
    return out.join(pages, "story_id", "left")
