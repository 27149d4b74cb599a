"""Queries over page and field text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.config import FIXTURE
from tidewire.functions import text as X
from tidewire.operators import parse as P
from tidewire.shared import read_table

CAP = 4096


def o23_check_length(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    html = F.when(F.col("page_id") % 11 != 0, F.encode("html", "UTF-8"))
    return p.select("page_id", F.octet_length(html).cast("bigint").alias("size"), F.coalesce(X.check_length(html, 8000), F.lit("ok")).alias("status"))


def o29_is_feed_document(spark, sf_dir):
    p, k = read_table(spark, sf_dir, "pages"), F.col("page_id") % 8
    doc = (
        F.when(k == 0, F.concat(F.lit('<?xml version="1.0"?>\n<rss version="2.0"><channel><link>'), F.col("url"), F.lit("</link>")))
        .when(k == 1, F.concat(F.lit('<atom:feed xmlns:atom="a"><id>'), F.col("url"))).when(k == 2, F.concat(F.lit("<a:feed><id>"), F.col("url")))
        .when(k == 3, F.lit(' <?xml version="1.0"?><rss>')).when(k == 4, F.lit("<!-- x --><urlset>")).when(k == 5, F.lit("<html><body>")).otherwise(F.col("html"))
    )
    return p.select("page_id", X.is_feed_document(doc).alias("is_feed"))


def o39_truncate_utf8(spark, sf_dir):
    d = X.with_normal_form(read_table(spark, sf_dir, "documents"), "text", CAP)
    cut = X.truncate_utf8(F.col("text"), CAP, F.col("nfc"))
    return d.select("doc_id", X.utf8_bytes(cut).cast("bigint").alias("size"), F.md5(cut).alias("digest"))


def o40_trunc_status(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").withColumn("text", F.when(F.col("doc_id") % 19 == 0, F.lit("")).otherwise(F.col("text")))
    status = X.trunc_status(F.col("text"), X.truncate_utf8(F.col("text"), CAP))
    return d.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def o41_decode_html(spark, sf_dir):
    """Pages in several encodings, some without a word about theirs."""
    p, k = read_table(spark, sf_dir, "pages"), F.col("page_id") % 4
    html = F.when(k == 0, F.encode("html", "UTF-16")).when(k == 1, F.encode("html", "ISO-8859-1")).otherwise(F.encode("html", "UTF-8"))
    html = F.when(F.col("page_id") % 29 == 0, F.lit(b"")).otherwise(html)
    rows = p.select("page_id", html.alias("raw"), F.when(k == 1, F.lit("iso-8859-1")).when(k == 0, F.lit("utf-16")).alias("raw_encoding"), F.lit(None).cast("string").alias("http_encoding"))
    out = P.decode_html(rows, "raw")
    return out.select("page_id", "encoding", F.char_length("text").cast("bigint").alias("chars"), "disposition", "action")


def o42_page_metadata(spark, sf_dir):
    p, h = read_table(spark, sf_dir, "pages"), F.col("html")
    return p.select("page_id", P.title(h).alias("title"), P.language(h).alias("language"), P.canonical_url(h).alias("canonical_url"), P.publication_date(h).alias("publication_date"))


def o42_extract_content(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages").withColumnRenamed("html", "text")
    out = P.extract_content(p, F.to_timestamp(F.lit("2024-06-01 12:00:00")), FIXTURE.public_suffixes)
    return out.select("page_id", "article_title", "language", "canonical_domain", F.char_length("text_content").cast("bigint").alias("chars"), F.md5("text_content").alias("digest"), "parsed_date", "disposition")


#: Sentences and the code pages that they are put in, which nothing on the page tells.
SENTENCES = (
    ("Вчера вечером президент заявил, что новые правила вступят в силу в следующем году.", "koi8_r"),
    ("Жители города ждут перемен, но не все верят, что они скоро наступят.", "cp1251"),
    ("昨日の夜、首相は新しい政策について記者会見を開き、来年から実施すると発表しました。", "shift_jis"),
    ("昨天晚上，总理在北京宣布，新的政策将从明年开始实行。这是我们国家的一个重要的决定。", "gb18030"),
    ("Wczoraj wieczorem prezydent ogłosił, że będzie ubiegał się o reelekcję, choć źle się czuł.", "cp1250"),
    ("El niño cantó una canción en español mientras la señora preparaba el café.", "cp1252"),
    ("Ο πρόεδρος δήλωσε χθες το βράδυ ότι η νέα πολιτική θα ξεκινήσει την επόμενη εβδομάδα.", "cp1253"),
)


def o41_detect_code_page(spark, sf_dir):
    """A page for each of the pages, its sentence in a code page that is to be found out."""
    k = F.col("page_id")
    told = F.get(F.array(*[F.lit(bytearray(t.encode(p))) for t, p in SENTENCES]), (k % len(SENTENCES)).cast("int"))
    html = F.concat(F.encode(F.concat(F.lit("<p>"), k.cast("string"), F.lit(": ")), "UTF-8"), told, F.encode(F.lit("</p>"), "UTF-8"))
    none = F.lit(None).cast("string")
    out = P.decode_html(read_table(spark, sf_dir, "pages").select("page_id", html.alias("html"), none.alias("raw_encoding"), none.alias("http_encoding")))
    return out.select("page_id", "text", "disposition")


QUERIES = {f.__name__: f for f in (o23_check_length, o29_is_feed_document, o39_truncate_utf8, o40_trunc_status, o41_decode_html, o41_detect_code_page, o42_page_metadata, o42_extract_content)}

CUT = f"""nf AS (SELECT doc_id, text, nfc_normalize(text) AS n FROM src),
 places AS (SELECT *, octet_length(encode(text)) AS size FROM nf),
 cut AS (SELECT doc_id, text, CASE WHEN size <= {CAP} THEN text ELSE (SELECT substr(n, 1, max(k)::BIGINT) FROM (SELECT unnest(range({CAP} // 4, least({CAP}, length(n)) + 1)) AS k) WHERE octet_length(encode(substr(n, 1, k::BIGINT))) <= {CAP}) END AS c FROM places)"""

ORACLES = {
    "o41_detect_code_page": f"SELECT page_id, '<p>' || page_id || ': ' || ([{', '.join(repr(t) for t, _ in SENTENCES)}])[page_id % {len(SENTENCES)} + 1] || '</p>' AS text, 'decoded' AS disposition FROM pages",
    "o23_check_length": """WITH s AS (SELECT page_id, CASE WHEN page_id % 11 <> 0 THEN octet_length(encode(html)) END AS size FROM pages)
SELECT page_id, size, CASE WHEN coalesce(size, 0) = 0 THEN 'no-html' WHEN size > 8000 THEN 'oversized' ELSE 'ok' END AS status FROM s""",
    "o29_is_feed_document": "SELECT page_id, page_id % 8 IN (0, 1, 4) AS is_feed FROM pages",
    "o39_truncate_utf8": f"WITH src AS (SELECT doc_id, text FROM documents), {CUT} SELECT doc_id, octet_length(encode(c)) AS size, md5(c) AS digest FROM cut",
    "o40_trunc_status": f"""WITH src AS (SELECT doc_id, CASE WHEN doc_id % 19 = 0 THEN '' ELSE text END AS text FROM documents), {CUT}
SELECT CASE WHEN text = '' THEN 'empty' WHEN length(c) < length(text) THEN 'trunc' ELSE 'intact' END AS status, count(*) AS n FROM cut GROUP BY 1""",
    "o42_page_metadata": r"""SELECT page_id, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')), '') AS title,
 nullif(lower(regexp_extract(html, '(?i)<html[^>]*?\slang\s*=\s*["'']?([A-Za-z]{2,3})', 1)), '') AS language,
 coalesce(nullif(regexp_extract(html, '(?i)<link[^>]*?rel\s*=\s*["'']?canonical["'']?[^>]*?href\s*=\s*["'']([^"'']+)', 1), ''), nullif(regexp_extract(html, '(?i)<meta[^>]*?property\s*=\s*["'']og:url["''][^>]*?content\s*=\s*["'']([^"'']+)', 1), '')) AS canonical_url,
 nullif(regexp_extract(html, '(?i)<time[^>]*?datetime\s*=\s*["''](\d{4}-\d\d-\d\d)', 1), '') AS publication_date FROM pages""",
}
