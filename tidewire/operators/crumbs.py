"""Breadcrumbs: one count per story at its final disposition; sums, upserts, pruning, messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.operators.dedup import old_feed_dates

KEYS = ("date", "feed_id", "source_id", "domain", "app", "status")
LINE = "date string, feed_id bigint, source_id bigint, domain string, app string, status string, count bigint, version array<int>, sent_at double"


def make_crumbs(df: DataFrame, app: str, batch: Column, feed: str = "source_feed_id", source: str = "source_source_id", domain: str = "canonical_domain", status: str = "disposition") -> DataFrame:
    return df.select(
        F.date_format(batch, "yyyy-MM-dd").alias("date"), F.col(feed).cast("bigint").alias("feed_id"), F.col(source).cast("bigint").alias("source_id"),
        F.col(domain).alias("domain"), F.lit(app).alias("app"), F.col(status).alias("status"), F.lit(1).cast("bigint").alias("count"),
    )


def crumb_sum(df: DataFrame, cols: Sequence[str] = (), start_date: str | None = None, end_date: str | None = None, **equal) -> DataFrame:
    """sum and rows of the counts by any of the keys; none of them: one row. An empty domain asks for null."""
    unknown = [c for c in (*cols, *equal) if c not in KEYS]
    if unknown:
        raise ValueError(f"no such key: {unknown}")
    if start_date is not None:
        df = df.where(F.col("date") >= start_date)
    if end_date is not None:
        df = df.where(F.col("date") <= end_date)
    for name, value in equal.items():
        df = df.where(F.col(name).isNull() if name == "domain" and value == "" else F.col(name) == value)
    return df.groupBy(*cols).agg(F.sum("count").alias("sum"), F.count("*").alias("rows"))


def crumb_upsert(table: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables as one, counts of equal keys added; null keys are equal."""
    both = table.select(*KEYS, "count").unionByName(new.select(*KEYS, "count"))
    return both.groupBy(*KEYS).agg(F.sum("count").alias("count"))


def prune_crumbs(crumbs: DataFrame, days: int) -> DataFrame:
    """Without the crumbs of old dates of their feed; null feeds never match and stay."""
    return crumbs.join(old_feed_dates(crumbs, days).select("date", "feed_id"), ["date", "feed_id"], "left_anti")


def prune_summary(crumbs: DataFrame, days: int) -> DataFrame:
    """What pruning would do: pairs, dates and feeds that are old, null feeds included, and the rows hit."""
    old = old_feed_dates(crumbs, days)
    hit = crumbs.join(old.select("date", "feed_id"), ["date", "feed_id"], "left_semi").select("date", "feed_id", F.lit(1).alias("row"))
    both = old.select("date", "feed_id", F.lit(0).alias("row")).unionByName(hit)
    pair = F.col("row") == 0
    return both.agg(
        F.count_if(pair).alias("pairs"), F.countDistinct(F.when(pair, F.col("date"))).alias("dates"), F.countDistinct(F.when(pair, F.col("feed_id"))).alias("feeds"),
        F.count_if(~pair).alias("rows_hit"),
    )


def disposition_counts(df: DataFrame, app: Column, status: str = "disposition") -> DataFrame:
    return df.groupBy(app.alias("app"), F.col(status).alias("status")).agg(F.count("*").alias("stories"))


def read_crumbs(messages: DataFrame, body: str = "body", major: int = 1) -> DataFrame:
    """One row per line of each message: kind (too-new, bad, crumb), header (vers-ok, no-vers), the keys,
    count (1 if missing) and counted_app (falls back to the header's).

    The header is the first line that parses, if it has a version; a newer major version drops the message,
    of which one row stays. A line that isn't a JSON object is bad.
    """

    def parsed(line):
        fields = F.from_json(line, LINE + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
        good = F.coalesce(fields["_bad"].isNull() & line.rlike(r"^\s*\{"), F.lit(False))
        return F.struct(good.alias("good"), fields.alias("c"))

    rows = messages.withColumn("__lines", F.transform(F.split(F.col(body), "\n"), parsed))
    rows = rows.withColumn("__first", F.array_position(F.transform("__lines", lambda x: x["good"]), True) - 1)
    rows = rows.withColumn("__head", F.get(F.col("__lines"), F.col("__first").cast("int"))["c"])
    versioned = F.col("__head.version").isNotNull()
    new = F.coalesce(versioned & (F.get(F.col("__head.version"), F.lit(0)) > major), F.lit(False))
    own = [c for c in messages.columns if c != body]
    rows = rows.select(*own, versioned.alias("__versioned"), new.alias("__new"), "__first", F.col("__head.app").alias("__app"), F.posexplode("__lines").alias("line_no", "__x"))
    at_head = F.col("__versioned") & (F.col("line_no") == F.col("__first"))
    rows = rows.where(F.when(F.col("__new"), at_head).otherwise(~at_head))
    kind = F.when(F.col("__new"), "too-new").when(~F.col("__x.good"), "bad").otherwise("crumb")
    is_crumb = kind == "crumb"
    return rows.select(
        *own, F.col("line_no").cast("bigint").alias("line_no"), kind.alias("kind"), F.when(F.col("__versioned"), "vers-ok").otherwise("no-vers").alias("header"),
        *[F.when(is_crumb, F.col(f"__x.c.{k}")).alias(k) for k in KEYS],
        F.when(is_crumb, F.coalesce("__x.c.count", F.lit(1).cast("bigint"))).alias("count"),
        F.when(is_crumb, F.coalesce("__x.c.app", "__app")).alias("counted_app"),
    )


def publish_crumbs(crumbs: DataFrame, ts: str, app: str, seconds: int = 60) -> DataFrame:
    """One message for each period: a header line, then a JSON line for each crumb."""
    line = F.to_json(F.struct(*[F.col(k) for k in (*KEYS, "count")]), {"ignoreNullFields": "false"})
    window = F.window(ts, f"{seconds} seconds")
    sent = F.unix_micros(F.col("w.end")) / F.lit(1e6)
    header = F.concat(F.lit('{"version":[1,0,0],"sent_at":'), sent.cast("decimal(16,1)").cast("string"), F.lit(f',"app":"{app}"}}'))
    grouped = crumbs.withColumn("__line", line).groupBy(window.alias("w")).agg(F.array_sort(F.collect_list("__line")).alias("lines"))
    return grouped.select(F.col("w.start").alias("period"), F.size("lines").cast("bigint").alias("crumbs"), F.concat_ws("\n", header, F.array_join("lines", "\n")).alias("body"))


def publish_messages(crumbs: DataFrame, ts: str, app: str, seconds: int = 60, most: int = 5_000) -> DataFrame:
    """Messages of `most` lines at most for each period, numbered: a header line, then a JSON line for each sum of
    equal crumbs. read_crumbs gives the sums back.

    Equal crumbs are summed before anything else is shuffled. A period's lines are dealt by their hash into buckets
    of about half that many, and each bucket is cut into messages, so no value or group grows with the period.
    """
    at = F.window(ts, f"{seconds} seconds")
    sums = crumbs.groupBy(at.alias("w"), *KEYS).agg(F.sum("count").alias("count"))
    buckets = sums.groupBy("w").agg(F.ceil(F.count("*") / F.lit(max(1, most // 2))).alias("__buckets"))
    rows = sums.join(buckets, "w").withColumn("__hash", F.xxhash64(*KEYS)).withColumn("__bucket", F.pmod("__hash", "__buckets"))
    nth = F.row_number().over(Window.partitionBy("w", "__bucket").orderBy("__hash", *KEYS)) - 1
    line = F.to_json(F.struct(*[F.col(k) for k in (*KEYS, "count")]), {"ignoreNullFields": "false"})
    rows = rows.withColumns({"number": F.col("__bucket") + F.floor(nth / F.lit(most)) * F.col("__buckets"), "__line": line})
    grouped = rows.groupBy("w", "number").agg(F.array_sort(F.collect_list("__line")).alias("lines"))
    sent = (F.unix_micros(F.col("w.end")) / F.lit(1e6)).cast("decimal(16,1)").cast("string")
    header = F.concat(F.lit('{"version":[1,0,0],"sent_at":'), sent, F.lit(f',"app":"{app}"}}'))
    return grouped.select(F.col("w.start").alias("period"), "number", F.size("lines").cast("bigint").alias("lines"), F.concat_ws("\n", header, F.array_join("lines", "\n")).alias("body"))
