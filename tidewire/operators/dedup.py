"""First-wins rules over rows in file order, object versions, old dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.functions import text as X
from tidewire.functions import urls as U
from tidewire.operators.classify import disposed, in_epoch


def dedup_urls_csv(df: DataFrame, excluded: Sequence[str] = (), file: str = "file", url: str = "url", pos: str = "pos") -> DataFrame:
    """URL faults first, then repeats within a file of an accepted URL: dups."""
    df = df.withColumn("__fault", U.check_url(F.col(url), excluded))
    nth = F.row_number().over(Window.partitionBy(file, url, F.col("__fault").isNull()).orderBy(pos))
    status = F.coalesce("__fault", F.when(nth > 1, "dups"))
    return disposed(df.withColumn("__status", status), F.col("__status"), passed="queuing").drop("__fault", "__status")


def dedup_urls_history(df: DataFrame, excluded: Sequence[str] = (), file: str = "file", url: str = "url", pos: str = "pos", dlid: str = "dlid") -> DataFrame:
    """bad-url, dups of a URL accepted earlier in the file, other URL faults, bad-dlid; only accepted rows
    mark their URL."""
    fault = U.check_url(F.col(url), excluded)
    df = df.withColumns({"__fault": fault, "__digits": F.coalesce(F.col(dlid).rlike("^[0-9]+$"), F.lit(False))})
    accepted = (F.col("__fault").isNull() & F.col("__digits")).cast("int")
    before = Window.partitionBy(file, url).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("__seen", F.coalesce(F.max(accepted).over(before), F.lit(0)) == 1)
    status = (
        F.when(F.col("__fault").isin("bad-url", "no-url"), "bad-url")
        .when(F.col("__seen"), "dups")
        .when(F.col("__fault").isNotNull(), F.col("__fault"))
        .when(~F.col("__digits"), "bad-dlid")
    )
    return disposed(df.withColumn("__status", status), F.col("__status"), passed="queuing").drop("__fault", "__digits", "__seen", "__status")


def old_feed_dates(crumbs: DataFrame, days: int) -> DataFrame:
    """(date, feed_id) behind the newest `days` dates of each feed."""
    newest = Window.partitionBy("feed_id").orderBy(F.col("date").desc())
    return crumbs.select("date", "feed_id").distinct().withColumn("rank", F.rank().over(newest)).where(F.col("rank") > days)


def latest_version_pick(pairs: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key in listing order."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return pairs.withColumn("__nth", nth).where("__nth = 1").drop("__nth")


def pick_object_version(
    stories: DataFrame, versions: DataFrame, epochs: Sequence[tuple[str, str, str]], overlap: tuple[int, int], order: Sequence[str],
    key: str = "key", collected: str = "collect_date", modified: str = "last_modified",
) -> DataFrame:
    """Stories in the overlapping range of keys take the first version of their epoch; others the object as
    it is. disposition: no-date and no-epoch (quarantine), epoch-err, unversioned, versioned."""
    inside = F.col(key).between(*overlap)
    left = stories.withColumns({"__epoch": in_epoch(F.to_date(collected), epochs), "__inside": inside})
    right = versions.where(F.col(key).between(*overlap)).withColumn("__own", in_epoch(F.to_date(modified), epochs)).where("__own is not null")
    first = latest_version_pick(right, [key, "__own"], order).withColumnsRenamed({key: "__key"})
    joined = left.join(first, (F.col(key) == F.col("__key")) & (F.col("__epoch") == F.col("__own")) & F.col("__inside"), "left")
    status = (
        F.when(F.col(collected).isNull(), "no-date")
        .when(~F.col("__inside"), "unversioned")
        .when(F.col("__epoch").isNull(), "no-epoch")
        .when(F.col("__own").isNull(), "epoch-err")
        .otherwise("versioned")
    )
    out = joined.withColumn("disposition", status)
    action = F.when(F.col("disposition").isin("versioned", "unversioned"), "pass").when(F.col("disposition").isin("no-date", "no-epoch"), "quarantine").otherwise("discard")
    return out.withColumn("action", action).withColumnRenamed("__epoch", "epoch").drop("__inside", "__own", "__key")


def fetch_objects(stories: DataFrame, objects: DataFrame, key: str = "key", most: int = 10_000_000) -> DataFrame:
    """Join the bodies of objects: not-found, redundant, no-html, oversized, or success with code 200 and the
    time of the object where the story has none."""
    joined = stories.join(objects.select(F.col(key).alias("__key"), F.col("body"), F.col("modified_at").alias("__at")), F.col(key) == F.col("__key"), "left")
    status = F.when(F.col("__key").isNull(), "not-found").when(X.is_redundant_feed(F.col("body")), "redundant").otherwise(X.check_length(F.col("body"), most))
    out = disposed(joined.withColumn("__status", status), F.col("__status"))
    return out.withColumns({"response_code": F.lit(200), "fetch_timestamp": F.coalesce("fetch_timestamp", "__at")}).drop("__key", "__at", "__status")
