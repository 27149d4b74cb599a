"""Disposition of rows: each stage adds `disposition` and `action` and drops nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.config import RETRY_CODES
from tidewire.functions import text as X
from tidewire.functions import urls as U

#: Content types that are text; an empty or missing one counts as such.
TEXT_TYPES = r"^(?:text/|application/xhtml|application/xml|application/vnd\.wap\.xhtml\+xml|$)"


def disposed(df: DataFrame, status: Column, passed: str = "success", quarantine: Sequence[str] = (), retry: Column | None = None) -> DataFrame:
    """disposition: the status, or `passed` where it is null; action: pass, retry, quarantine or discard."""
    status = F.coalesce(status, F.lit(passed))
    action = F.when(status == passed, "pass")
    if retry is not None:
        action = action.when(retry, "retry")
    action = action.when(status.isin(*quarantine) if quarantine else F.lit(False), "quarantine").otherwise("discard")
    return df.withColumns({"disposition": status, "action": action})


def classify_fetch(df: DataFrame, most: int = 10_000_000) -> DataFrame:
    """Of captured responses (status, encoding, content_type, body, error_class)."""
    code = F.col("status")
    plain = (F.coalesce("encoding", F.lit("")) != "") | F.lower(F.coalesce("content_type", F.lit(""))).rlike(TEXT_TYPES)
    status = (
        F.when(F.col("error_class") == "bad-url", "badurl2")
        .when(F.col("error_class").isNotNull(), "noconn")
        .when(code != 200, F.when(code.isin(403, 404, 429), F.concat(F.lit("http-"), code.cast("string"))).otherwise(F.concat(F.lit("http-"), F.floor(code / 100).cast("string"), F.lit("xx"))))
        .when(~plain, "not-text")
        .otherwise(X.check_length(F.col("body"), most))
    )
    again = ((F.col("error_class") != "bad-url") & F.col("error_class").isNotNull()) | (F.col("error_class").isNull() & code.isin(*RETRY_CODES))
    return disposed(df, status, retry=F.coalesce(again, F.lit(False)))


def classify_fetch_batch(df: DataFrame, domains: Sequence[str], most: int = 10_000_000) -> DataFrame:
    """The older order of tests (final_url, status, size); listed domains may stand anywhere in the URL."""
    code, url = F.col("status"), F.col("final_url")
    listed = F.exists(F.array(*[F.lit(d) for d in domains]), lambda d: url.contains(d)) if domains else F.lit(False)
    status = (
        F.when(url.isNull(), "no-url")
        .when(code.isNull(), "no-resp")
        .when(code == 200, F.when(F.col("size") > most, "oversized").when(listed, "non-news"))
        .when(code.isin(403, 404, 429), F.concat(F.lit("http-"), code.cast("string")))
        .otherwise(F.concat(F.lit("http-"), F.floor(code / 100).cast("string"), F.lit("xx")))
    )
    return disposed(df, status)


def gate_parsed(df: DataFrame, need_url: bool = False, sentinel: str = "", excluded: Sequence[str] = ()) -> DataFrame:
    """After extraction: canonical URL if it is needed, home page, text. Passing rows are OK-<method>."""
    status = F.when(F.coalesce("is_homepage", F.lit(False)), "homepage").when(F.coalesce("text_content", F.lit("")) == "", "no-text")
    if need_url:
        own = F.col("canonical_url")
        status = F.when(F.coalesce(own, F.lit("")).isin("", sentinel), "no-canonical-url").otherwise(F.coalesce(U.check_url(own, excluded), status))
    passed = F.concat(F.lit("OK-"), F.coalesce("text_extraction_method", F.lit("none")))
    out = df.withColumn("disposition", F.coalesce(status, passed))
    return out.withColumn("action", F.when(F.startswith("disposition", F.lit("OK-")), "pass").otherwise("discard"))


def adopt_canonical_url(df: DataFrame, sentinel: str, excluded: Sequence[str], public_suffixes: Sequence[str]) -> DataFrame:
    """Rows whose URL was unknown take the page's own; original_url stays."""
    own = F.col("canonical_url")
    status = F.when(F.coalesce(own, F.lit("")).isin("", sentinel), "no-canonical-url").otherwise(U.check_url(own, excluded))
    df = df.withColumn("__status", status)
    good = F.col("__status").isNull()
    df = df.withColumns(
        {
            "final_url": F.when(good, own).otherwise(F.col("final_url")),
            "url": F.when(good, own).otherwise(F.col("url")),
            "canonical_domain": F.when(good, U.canonical_domain(own, public_suffixes)).otherwise(F.col("canonical_domain")),
            "is_homepage": F.when(good, U.is_homepage(own)).otherwise(F.col("is_homepage")),
        }
    )
    return disposed(df, F.col("__status"), passed="adopted").drop("__status")


def gate_index(df: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("url").isNull() & F.col("text_content").isNull() & F.col("article_title").isNull(), "no-data")
        .when(F.coalesce("url", F.lit("")) == "", "no-url")
        .when(F.coalesce("text_content", F.lit("")) == "", "no-text")
    )
    return disposed(df, status, passed="index", quarantine=("no-data", "no-url", "no-text"))


def gate_producer(df: DataFrame, excluded: Sequence[str], check_html: bool = False, most: int = 10_000_000, passed: str = "queuing") -> DataFrame:
    """The URL checked is final_url, else link; the page's size on request."""
    url = F.coalesce(F.nullif("final_url", F.lit("")), F.nullif("link", F.lit("")), F.lit(""))
    status = U.check_url(url, excluded)
    if check_html:
        status = F.coalesce(status, X.check_length(F.col("html"), most))
    return disposed(df, status, passed=passed)


def in_epoch(day: Column, epochs: Sequence[tuple[str, str, str]]) -> Column:
    out = F.lit(None).cast("string")
    for name, first, last in epochs:
        out = F.when(day.between(F.to_date(F.lit(first)), F.to_date(F.lit(last))), name).otherwise(out)
    return out


def select_by_query(df: DataFrame, predicate: str) -> tuple[DataFrame, int]:
    """The rows that a predicate selects, and how many they are; a bad predicate fails before any work."""
    chosen = df.where(predicate)
    chosen.schema
    return chosen, chosen.count()
