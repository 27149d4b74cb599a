"""Columns over page and field text: sizes, truncation, feeds, metadata, names."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.config import FEED_TAGS

TAG = (
    r"^(?:<\?xml\s[^>]*\?>)?(?:\s+|<!--(?:(?!--)[\s\S])*-->|<\?(?!xml\s)[\s\S]*?\?>)*+"
    r"<([A-Za-z_][\w.:\-]*)((?:\s+[\w.:\-]+\s*=\s*(?:\"[^\"<]*\"|'[^'<]*'))*+)\s*/?>"
)


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(F.encode(text, "UTF-8"))


def check_length(html: Column, most: int = 10_000_000) -> Column:
    n = F.coalesce(F.octet_length(html), F.lit(0))
    return F.when(n == 0, "no-html").when(n > most, "oversized")


def is_redundant_feed(html: Column) -> Column:
    return F.coalesce(F.startswith(html.cast("binary"), F.lit(b"(redundant feed)")), F.lit(False))


def is_feed_document(html: Column) -> Column:
    """A document whose first tag is that of a feed and that doesn't say that it is HTML."""
    head = F.lower(F.substring(html, 1, 128))
    tag, attributes = F.lower(F.regexp_extract(html, TAG, 1)), F.regexp_extract(html, TAG, 2)
    prefix = F.when(tag.contains(":"), F.substring_index(tag, ":", 1))
    declared = prefix.isNull() | F.lower(attributes).contains(F.concat(F.lit("xmlns:"), prefix, F.lit("=")))
    named = tag.rlike("(" + "|".join(FEED_TAGS) + ")$")
    return F.coalesce(~head.contains("<!doctype") & named & declared, F.lit(False))


def _cut(raw: Column, n: int) -> Column:
    whole = [F.try_validate_utf8(F.substring(raw, 1, max(0, n - j)).cast("string")) for j in range(4) if n - j >= 0]
    return F.coalesce(*whole, F.lit(""))


def truncate_utf8(text: Column, n: int = 32_766, nfc: Column | None = None) -> Column:
    """Texts of up to n bytes as they are; longer ones cut to n bytes at a character. nfc: the normal form
    of the text, from which long ones are cut. Null stays null."""
    raw = F.encode(F.coalesce(nfc, text) if nfc is not None else text, "UTF-8")
    return F.when(text.isNull(), text).when(utf8_bytes(text) <= n, text).when(F.octet_length(raw) <= n, raw.cast("string")).otherwise(_cut(raw, n))


@F.pandas_udf(T.StringType())
def _normal_form(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def with_normal_form(df: DataFrame, text: str, n: int, out: str = "nfc") -> DataFrame:
    """Add the canonical composed form of texts of more than n bytes; null for the others."""
    return df.withColumn(out, _normal_form(F.when(utf8_bytes(F.col(text)) > n, F.col(text))))


def trunc_status(before: Column, after: Column) -> Column:
    return F.when(F.coalesce(before, F.lit("")) == "", "empty").when(F.char_length(after) < F.char_length(before), "trunc").otherwise("intact")


def metric_name(name: Column, labels: Column) -> Column:
    """name.label_value for each label, in order of labels."""
    pairs = F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit("_"), e["value"]))
    return F.concat_ws(".", name, F.nullif(F.array_join(pairs, "."), F.lit("")))


def metadata_json(columns: Sequence[Column]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def error_columns(what: Column, who: str, where: str, name: Column, when: Column) -> Column:
    """What is kept about a failed row; the message up to 100 characters."""
    return F.struct(F.lit(who).alias("who"), when.alias("when"), F.substring(what, 1, 100).alias("what"), F.lit(where).alias("where"), name.alias("name"))
