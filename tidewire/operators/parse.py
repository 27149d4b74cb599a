"""From pages to content: decoding, metadata by columns, body text by an Arrow pass."""

from __future__ import annotations

import codecs
import re
from collections.abc import Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions import urls as U
from tidewire.functions.encodings import likeliest

BOMS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
META = re.compile(rb"<meta[^>]{0,200}charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def _decode(raw: bytes | None, *known: str | None) -> tuple[str | None, str | None]:
    """Text and encoding: a known one, else by its mark, the page's own word, or the likeliest."""
    if not raw:
        return None, None
    marked = next(((m, e) for m, e in BOMS if raw.startswith(m)), None)
    body = raw[len(marked[0]) :] if marked else raw
    said = META.search(raw[:2048])
    tries = [*(k for k in known if k), marked and marked[1], said and said[1].decode("ascii"), "utf-8"]
    for name in filter(None, tries):
        try:
            return body.decode(name), codecs.lookup(name).name
        except (LookupError, ValueError):
            continue
    name = likeliest(body)
    return (body.decode(name), codecs.lookup(name).name) if name else (None, None)


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("encoding", T.StringType())]))
def _decoded(raw: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_decode(*x) for x in zip(raw, first, second)], columns=["text", "encoding"], dtype=object)


#: So marked, Spark evaluates it once.
_decoded = _decoded.asNondeterministic()


def decode_html(df: DataFrame, html: str = "html", raw_encoding: str = "raw_encoding", http_encoding: str = "http_encoding", where: Column | None = None) -> DataFrame:
    """Add text, encoding, disposition (no-html: discard; no-decode: quarantine; decoded). UTF-8 pages that
    nothing else is known of never leave the JVM. Pages outside of `where` aren't looked at: no-html."""
    raw = F.col(html) if where is None else F.when(where, F.col(html))
    plain = F.coalesce(F.col(raw_encoding), F.col(http_encoding)).isNull() & F.is_valid_utf8(raw.cast("string")) & ~F.startswith(raw, F.lit(codecs.BOM_UTF8))
    plain = plain & ~F.coalesce(F.lower(F.substring(raw, 1, 2048).cast("string")).contains("charset"), F.lit(False))
    df = df.withColumn("__plain", F.coalesce(plain, F.lit(False)))
    df = df.withColumn("__slow", _decoded(F.when(~F.col("__plain"), raw), F.col(raw_encoding), F.col(http_encoding)))
    df = df.withColumns(
        {
            "text": F.when(F.col("__plain"), raw.cast("string")).otherwise(F.col("__slow.text")),
            "encoding": F.when(F.col("__plain"), F.lit("utf-8")).otherwise(F.col("__slow.encoding")),
        }
    )
    status = F.when(F.coalesce(F.octet_length(raw), F.lit(0)) == 0, "no-html").when(F.col("text").isNull(), "no-decode").otherwise("decoded")
    action = F.when(F.col("disposition") == "decoded", "pass").when(F.col("disposition") == "no-decode", "quarantine").otherwise("discard")
    return df.withColumn("disposition", status).withColumn("action", action).drop("__plain", "__slow")


SKIPPED = {"script", "style", "noscript", "nav", "header", "footer", "aside", "form", "template", "svg"}
BLOCKS = {"p", "div", "li", "br", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "blockquote", "section", "article", "pre"}


#: A block is a list of links if links hold this share of its characters, and it has no more words than this.
LINK_SHARE, LINK_WORDS = 0.6, 25


class _Body(HTMLParser):
    """Text outside of skipped elements in blocks, each with whether it is within an article element and how many
    of its characters are links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.skip, self.article, self.inside, self.link = 0, 0, 0, 0
        self.blocks: list[tuple[str, bool, int]] = []
        self.parts: list[str] = []
        self.linked, self.owned = 0, False

    def flush(self):
        """End the block that is open."""
        if self.parts:
            self.blocks.append(("".join(self.parts), self.owned, self.linked))
        self.parts, self.linked, self.owned = [], 0, False

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
        self.skip += tag in SKIPPED
        self.article += tag == "article"
        self.inside += tag == "body"
        self.link += tag == "a"

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        self.skip -= tag in SKIPPED and self.skip > 0
        self.article -= tag == "article" and self.article > 0
        self.link -= tag == "a" and self.link > 0

    def handle_data(self, data):
        if not self.skip and self.inside:
            self.parts.append(data)
            self.linked += len(data.strip()) if self.link else 0
            self.owned = self.owned or self.article > 0


def _is_links(text: str, linked: int) -> bool:
    dense = len(text.strip())
    return dense > 0 and linked >= LINK_SHARE * dense and len(text.split()) <= LINK_WORDS


def body_text(html: str | None) -> str | None:
    """The text of the article elements, or of the whole body where they have none, without blocks that are little
    but links: menus, lists of other stories. A page that has nothing else keeps them."""
    if html is None:
        return None
    parser = _Body()
    parser.feed(html)
    parser.close()
    parser.flush()
    blocks = [x for x in parser.blocks if x[1]] if any(x[1] and x[0].strip() for x in parser.blocks) else parser.blocks
    told = [text for text, _, linked in blocks if not _is_links(text, linked)]
    if not any(text.strip() for text in told):
        told = [text for text, *_ in blocks]
    lines = (re.sub(r"[^\S\n]+", " ", x).strip() for text in told for x in text.split("\n"))
    return "\n".join(x for x in lines if x)


@F.pandas_udf(T.StringType())
def _body_text(html: pd.Series) -> pd.Series:
    return html.map(body_text)


#: So marked, Spark evaluates it once: conditions on what it gives aren't moved below it.
_body_text = _body_text.asNondeterministic()


def title(html: Column) -> Column:
    found = F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))
    return F.nullif(found, F.lit(""))


def language(html: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)), F.lit(""))


def full_language(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z0-9-]+)", 1), F.lit(""))


def canonical_url(html: Column) -> Column:
    link = F.regexp_extract(html, r"(?i)<link[^>]*?rel\s*=\s*[\"']?canonical[\"']?[^>]*?href\s*=\s*[\"']([^\"']+)", 1)
    og = F.regexp_extract(html, r"(?i)<meta[^>]*?property\s*=\s*[\"']og:url[\"'][^>]*?content\s*=\s*[\"']([^\"']+)", 1)
    return F.coalesce(F.nullif(link, F.lit("")), F.nullif(og, F.lit("")))


def publication_date(html: Column) -> Column:
    name = r"(?:article:published_time|datePublished|date|pubdate|publish[_-]?date)"
    meta = F.regexp_extract(html, rf"(?i)<meta[^>]*?(?:property|name|itemprop)\s*=\s*[\"']{name}[\"'][^>]*?content\s*=\s*[\"'](\d{{4}}-\d\d-\d\d)", 1)
    time = F.regexp_extract(html, r"(?i)<time[^>]*?datetime\s*=\s*[\"'](\d{4}-\d\d-\d\d)", 1)
    return F.coalesce(F.nullif(meta, F.lit("")), F.nullif(time, F.lit("")))


#: The columns that extract_content adds.
CONTENT = (
    "text_content", "original_url", "normalized_url", "canonical_domain", "publication_date", "language", "full_language", "text_extraction_method",
    "article_title", "normalized_article_title", "parsed_date", "canonical_url", "is_homepage", "is_shortened",
)


def extract_content(df: DataFrame, parsed_at: Column, public_suffixes: Sequence[str], html: str = "text", url: str = "url", least: int = 100, where: Column | None = None) -> DataFrame:
    """Add the fields of content_metadata and disposition: too-short for less than `least` characters of
    text, else extracted. Metadata by columns; the body in an Arrow pass. Pages outside of `where` aren't
    looked at: too-short."""
    page, at = (F.col(c) if where is None else F.when(where, F.col(c)) for c in (html, url))
    df = df.withColumn("text_content", _body_text(page))
    df = df.withColumns(
        {
            "original_url": at, "normalized_url": U.normalize_url(at), "canonical_domain": U.canonical_domain(at, public_suffixes),
            "publication_date": publication_date(page), "language": language(page), "full_language": full_language(page),
            "text_extraction_method": F.lit("article-text"), "article_title": title(page), "normalized_article_title": F.lower(F.regexp_replace(title(page), r"[^\p{L}\p{N}]+", " ")),
            "parsed_date": F.date_format(parsed_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "canonical_url": canonical_url(page), "is_homepage": U.is_homepage(at), "is_shortened": F.lit(False),
        }
    )
    short = F.char_length(F.coalesce("text_content", F.lit(""))) < least
    status = F.when(short, "too-short").otherwise("extracted")
    return df.withColumn("disposition", status).withColumn("action", F.when(short, "discard").otherwise("pass"))
