"""Queries over index documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.config import FIXTURE
from tidewire.operators import index as I
from tidewire.queries.base import BATCH_TS, INDEX_DOCS, index_docs, sql_parts
from tidewire.queries.urls import NORMAL, REGISTERED
from tidewire.shared import new_path, read_table

STAMPS = ("Sun, 30 Apr 2023 23:30:00 -0500", "30 Apr 2023 01:02:03 +0000", "junk", "Mon, 01 May 2023 00:00:00 GMT", "", None)


def parsed(spark, sf_dir):
    """Documents as parsed content, with gaps."""
    d, k = read_table(spark, sf_dir, "documents"), F.col("doc_id")
    return d.select(
        "doc_id", F.when(k % 7 != 0, F.col("lang")).otherwise(F.lit("")).alias("language"), F.when(k % 5 != 0, F.col("source")).alias("canonical_domain"), F.col("text").alias("text_content"),
        F.when(k % 3 == 0, F.lit("2024-01-02")).when(k % 3 == 1, F.lit("None")).alias("publication_date"), F.when(k % 4 != 0, F.substring("text", 1, 20)).alias("article_title"),
        F.concat(F.lit("http://"), F.col("source"), F.lit(".example.com/"), k.cast("string")).alias("url"), F.get(F.array(*[F.lit(s) for s in STAMPS]), (k % 6).cast("int")).alias("pub_date"),
        F.when(k % 4 == 0, F.lit("2024-01-02")).when(k % 4 == 1, F.lit("2024-01-02T03:04:05")).when(k % 4 == 2, F.lit("2024-01-02T03:04:05.123456")).otherwise(F.lit("bad")).alias("parsed_date"),
    )


def o36_to_index_doc(spark, sf_dir):
    return I.to_index_doc(parsed(spark, sf_dir), keep=["doc_id"]).drop("text_content", "article_title")


def o37_resolve_pub_date(spark, sf_dir):
    return I.resolve_pub_date(parsed(spark, sf_dir)).select("doc_id", "publication_date", "pub_date_status")


def o38_resolve_indexed_date(spark, sf_dir):
    when = I.resolve_indexed_date(F.col("parsed_date"), F.to_timestamp(F.lit(BATCH_TS)))
    return parsed(spark, sf_dir).select("doc_id", F.date_format(when, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("indexed"))


def o75_field_counts(spark, sf_dir):
    rows = I.resolve_pub_date(parsed(spark, sf_dir))
    dates = [F.count_if(F.col("pub_date_status") == s).alias(f"dates_{s}") for s in ("extracted", "rss", "none", "retry")]
    return I.field_missing_counts(rows, more=dates)


def halves(spark, sf_dir):
    docs = index_docs(spark, sf_dir)
    return docs.where("seq % 2 = 0"), docs.where("seq % 2 = 1")


def o61_create_only(spark, sf_dir):
    index, batch = halves(spark, sf_dir)
    return I.create_only(batch, index, ["seq"]).select("seq", "doc_id", "disposition")


def o14_write_index(spark, sf_dir):
    """The batch written to the index's folder and counted from there, by day and language."""
    index, batch = halves(spark, sf_dir)
    path = new_path(spark)
    I.write_index(batch, index, path, ["seq"])
    written = spark.read.parquet(path)
    return written.groupBy(F.col("day").cast("date").alias("day"), "language").agg(F.count("*").alias("n"), F.sum("seq").alias("seqs"))


def urls_index(spark, sf_dir):
    from tidewire.functions import urls as U

    p = read_table(spark, sf_dir, "pages")
    return p.select(U.doc_id(F.col("url")).alias("doc_id"), "url", F.lit("old").alias("canonical_domain"), "page_id")


def o62_delete_by_urls(spark, sf_dir):
    index = urls_index(spark, sf_dir)
    gone = index.where("page_id % 10 = 0").select(F.concat("url", F.lit("#x")).alias("url"))
    return I.delete_by_urls(index, gone).select("page_id", "url")


def o62_delete_stats(spark, sf_dir):
    index = urls_index(spark, sf_dir)
    gone = index.where("page_id % 10 = 0").select("url").unionByName(index.where("page_id % 50 = 0").select(F.concat("url", F.lit("#x")).alias("url"))).unionByName(index.where("page_id % 25 = 1").select(F.concat("url", F.lit("/none")).alias("url")))
    return I.delete_stats(index, gone)


def o50_recompute_domain(spark, sf_dir):
    out = I.recompute_canonical_domain(urls_index(spark, sf_dir), F.col("page_id") % 3 == 0, FIXTURE.public_suffixes)
    return out.select("page_id", "canonical_domain", "update_status")


def o66_reindex_copy(spark, sf_dir):
    even, odd = halves(spark, sf_dir)
    return I.reindex_copy(odd.dropDuplicates(["doc_id"]), even, where="language = 'en'", max_docs=200).select("doc_id", "language")


def o66_reindex_copy_all(spark, sf_dir):
    """The same without a limit; of rows that share an id, the first."""
    even, odd = halves(spark, sf_dir)
    return I.reindex_copy(odd.groupBy("doc_id").agg(F.min_by("language", "seq").alias("language")), even, where="language = 'en'").select("doc_id", "language")


def o96_incremental_reindex(spark, sf_dir):
    even, odd = halves(spark, sf_dir)
    since, until = F.to_timestamp(F.lit("2024-01-01 00:01:00")), F.to_timestamp(F.lit("2024-01-01 00:10:00"))
    return I.incremental_reindex(odd, even, since, until, ["doc_id", "seq", "language", "indexed_date"]).select("doc_id", "seq", "language")


def o96_incremental_reindex_all(spark, sf_dir):
    """The window from the first to the last indexed_date of the table."""
    even, odd = halves(spark, sf_dir)
    window = index_docs(spark, sf_dir).agg(F.min("indexed_date").alias("since"), F.max("indexed_date").alias("until"))
    odd = odd.crossJoin(F.broadcast(window))
    return I.incremental_reindex(odd, even, F.col("since"), F.col("until"), ["doc_id", "seq", "language", "indexed_date"]).select("doc_id", "seq", "language")


def o96_run_window(spark, sf_dir):
    """The window that follows from a log of runs, one a day, made of events."""
    e = read_table(spark, sf_dir, "events")
    runs = e.groupBy(F.to_date("ts").alias("d")).agg(F.max("ts").alias("until")).select(F.col("d").cast("timestamp").alias("started"), "until", F.lit("done").alias("status"))
    out = I.incremental_window(runs, F.to_timestamp(F.lit(BATCH_TS)))
    return out.select(F.date_format("since", "yyyy-MM-dd HH:mm:ss").alias("since"), F.date_format("until", "yyyy-MM-dd HH:mm:ss").alias("until"))


def o85_scan_in_order(spark, sf_dir):
    from tidewire.operators.sampling import scan_in_order

    rows = scan_in_order(index_docs(spark, sf_dir))
    return rows.select("doc_id", F.date_format("indexed_date", "yyyy-MM-dd HH:mm:ss").alias("indexed"))


QUERIES = {
    f.__name__: f
    for f in (
        o36_to_index_doc, o37_resolve_pub_date, o38_resolve_indexed_date, o75_field_counts, o61_create_only, o14_write_index, o62_delete_by_urls, o62_delete_stats,
        o50_recompute_domain, o66_reindex_copy, o66_reindex_copy_all, o96_incremental_reindex, o96_incremental_reindex_all, o96_run_window, o85_scan_in_order,
    )
}

PARSED = """parsed AS (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN lang ELSE '' END AS language, CASE WHEN doc_id % 5 <> 0 THEN source END AS canonical_domain, text AS text_content,
 CASE doc_id % 3 WHEN 0 THEN '2024-01-02' WHEN 1 THEN 'None' END AS publication_date, CASE WHEN doc_id % 4 <> 0 THEN substr(text, 1, 20) END AS article_title,
 'http://' || source || '.example.com/' || doc_id AS url, doc_id % 6 AS s FROM documents)"""
DATED = """dated AS (SELECT *, CASE WHEN coalesce(publication_date, '') NOT IN ('', 'None') THEN 'extracted' WHEN s IN (4, 5) THEN 'none' WHEN s IN (0, 1) THEN 'rss' ELSE 'retry' END AS pub_date_status FROM parsed)"""
CREATED = f"""{INDEX_DOCS}, judged AS (SELECT seq, b.doc_id, language, indexed_date, CASE WHEN EXISTS (SELECT 1 FROM docs i WHERE i.seq % 2 = 0 AND i.doc_id = b.doc_id) THEN 'ilm-dups'
 WHEN row_number() OVER (PARTITION BY b.doc_id ORDER BY seq) > 1 THEN 'dups' ELSE 'created' END AS disposition FROM docs b WHERE seq % 2 = 1)"""

ORACLES = {
    "o36_to_index_doc": f"WITH {PARSED} SELECT doc_id, nullif(canonical_domain, '') AS canonical_domain, nullif(language, '') AS language, nullif(publication_date, '') AS publication_date, nullif(url, '') AS url FROM parsed",
    "o37_resolve_pub_date": f"WITH {PARSED}, {DATED} SELECT doc_id, CASE pub_date_status WHEN 'extracted' THEN publication_date WHEN 'rss' THEN '2023-04-30' END AS publication_date, pub_date_status FROM dated",
    "o38_resolve_indexed_date": f"SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '2024-01-02 00:00:00.000000' WHEN 1 THEN '2024-01-02 03:04:05.000000' WHEN 2 THEN '2024-01-02 03:04:05.123456' ELSE '{BATCH_TS}.000000' END AS indexed FROM documents",
    "o75_field_counts": f"""WITH {PARSED}, {DATED}, final AS (SELECT * REPLACE (CASE pub_date_status WHEN 'extracted' THEN publication_date WHEN 'rss' THEN '2023-04-30' END AS publication_date) FROM dated)
SELECT count_if(coalesce(article_title, '') = '')::BIGINT AS missing_article_title, count_if(coalesce(canonical_domain, '') = '')::BIGINT AS missing_canonical_domain, count_if(coalesce(language, '') = '')::BIGINT AS missing_language,
 count_if(coalesce(publication_date, '') = '')::BIGINT AS missing_publication_date, count_if(coalesce(text_content, '') = '')::BIGINT AS missing_text_content, count_if(coalesce(url, '') = '')::BIGINT AS missing_url,
 count_if(pub_date_status = 'extracted')::BIGINT AS dates_extracted, count_if(pub_date_status = 'rss')::BIGINT AS dates_rss, count_if(pub_date_status = 'none')::BIGINT AS dates_none, count_if(pub_date_status = 'retry')::BIGINT AS dates_retry FROM final""",
    "o61_create_only": f"WITH {CREATED} SELECT seq, doc_id, disposition FROM judged",
    "o14_write_index": f"WITH {CREATED} SELECT indexed_date::DATE AS day, language, count(*) AS n, sum(seq)::BIGINT AS seqs FROM judged WHERE disposition = 'created' GROUP BY ALL",
    "o62_delete_by_urls": f"""WITH {sql_parts('url', 'pages', 'page_id, url')}, {NORMAL} SELECT page_id, url FROM normal WHERE normalized NOT IN (SELECT normalized FROM normal WHERE page_id % 10 = 0)""",
    "o62_delete_stats": f"""WITH more AS (SELECT page_id, url FROM pages WHERE page_id % 25 = 1), asked AS (SELECT page_id, url FROM pages WHERE page_id % 10 = 0 UNION ALL SELECT page_id, url || '/none' FROM more),
 every AS (SELECT 'i' AS kind, page_id, url FROM pages UNION ALL SELECT 'a', page_id, url FROM asked), {sql_parts('url', 'every', 'kind, page_id, url')}, {NORMAL.replace('page_id, url', 'kind, page_id, url')}
SELECT (SELECT count(*) FROM normal WHERE kind = 'i' AND normalized IN (SELECT normalized FROM normal WHERE kind = 'a'))::BIGINT AS deleted, (SELECT count(DISTINCT normalized) FROM normal WHERE kind = 'a')::BIGINT AS requested""",
    "o50_recompute_domain": f"""WITH {sql_parts('url', 'pages', 'page_id')} SELECT page_id, CASE WHEN page_id % 3 = 0 THEN {REGISTERED.format(h='host')} ELSE 'old' END AS canonical_domain,
 CASE WHEN page_id % 3 = 0 THEN 'updated' ELSE 'untouched' END AS update_status FROM parts""",
    "o66_reindex_copy": f"""WITH {INDEX_DOCS}, o AS (SELECT DISTINCT ON (doc_id) doc_id, language FROM docs WHERE seq % 2 = 1 ORDER BY doc_id, seq), c AS (SELECT * FROM o WHERE language = 'en' ORDER BY doc_id LIMIT 200)
SELECT doc_id, language FROM c WHERE doc_id NOT IN (SELECT doc_id FROM docs WHERE seq % 2 = 0)""",
    "o96_incremental_reindex": f"""WITH {INDEX_DOCS} SELECT doc_id, seq, language FROM docs WHERE seq % 2 = 1 AND indexed_date > TIMESTAMP '2024-01-01 00:01:00' AND indexed_date <= TIMESTAMP '2024-01-01 00:10:00'
 AND doc_id NOT IN (SELECT doc_id FROM docs WHERE seq % 2 = 0)""",
    "o66_reindex_copy_all": f"""WITH {INDEX_DOCS}, o AS (SELECT DISTINCT ON (doc_id) doc_id, language FROM docs WHERE seq % 2 = 1 ORDER BY doc_id, seq)
SELECT doc_id, language FROM o WHERE language = 'en' AND doc_id NOT IN (SELECT doc_id FROM docs WHERE seq % 2 = 0)""",
    "o96_incremental_reindex_all": f"""WITH {INDEX_DOCS} SELECT doc_id, seq, language FROM docs WHERE seq % 2 = 1 AND indexed_date > (SELECT min(indexed_date) FROM docs) AND indexed_date <= (SELECT max(indexed_date) FROM docs)
 AND doc_id NOT IN (SELECT doc_id FROM docs WHERE seq % 2 = 0)""",
    "o96_run_window": "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS since, '2024-06-01 10:00:00' AS until FROM events",
    "o85_scan_in_order": f"WITH {INDEX_DOCS} SELECT doc_id, strftime(indexed_date, '%Y-%m-%d %H:%M:%S') AS indexed FROM docs ORDER BY indexed_date, doc_id",
}
