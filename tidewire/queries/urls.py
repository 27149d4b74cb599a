"""Queries over URLs and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.config import FIXTURE
from tidewire.functions import text as X
from tidewire.functions import urls as U
from tidewire.queries.base import EXCLUDED, ODD_URLS, odd_urls, sql_check, sql_parts
from tidewire.shared import read_table

SUFFIXES = FIXTURE.public_suffixes


def o20_check_url(spark, sf_dir):
    u = F.col("url")
    return odd_urls(spark, sf_dir).select("page_id", U.url_fqdn(u).alias("fqdn"), U.scheme(u).alias("scheme"), F.coalesce(U.check_url(u, FIXTURE.excluded_domains), F.lit("ok")).alias("status"))


def o22_non_news_join(spark, sf_dir):
    listed = read_table(spark, sf_dir, "pages").where(F.col("page_id") % 17 == 0).select(U.canonical_domain(F.col("url"), SUFFIXES).alias("domain"))
    rows = read_table(spark, sf_dir, "pages").select("page_id", U.url_fqdn(F.col("url")).alias("host"))
    return U.non_news(rows, "host", listed).select("page_id", "host", "is_non_news")


def o24_filter_domains(spark, sf_dir):
    rows = odd_urls(spark, sf_dir).withColumn("link", F.when(F.col("page_id") % 2 == 0, F.col("url")))
    return U.filter_domains(rows, ["url", "link"], exclude=FIXTURE.excluded_domains).select("page_id", "url")


def o27_classify_redirects(spark, sf_dir):
    p, n = read_table(spark, sf_dir, "pages"), F.col("page_id") % 33
    hop = F.transform(F.sequence(F.lit(1), (n + 1).cast("int")), lambda i: F.concat(F.lit("http://h"), i.cast("string"), F.lit(".example.com/")))
    chain = F.when(n == 5, F.concat(hop, F.array(F.lit("")))).when(n == 6, F.concat(hop, F.array(F.lit("http:///p")))).otherwise(F.concat(hop, F.array("url")))
    return p.select("page_id", F.size(chain).cast("bigint").alias("hops"), F.coalesce(U.classify_redirects(chain, FIXTURE.excluded_domains), F.lit("ok")).alias("status"))


def o28_redirects_registered(spark, sf_dir):
    p, k = read_table(spark, sf_dir, "pages"), F.col("page_id") % 4
    target = F.when(k == 0, F.concat(F.lit("//"), U.netloc(F.col("url")), F.lit("/moved"))).when(k == 1, F.lit("/top")).when(k == 2, F.lit("next")).otherwise(F.col("url"))
    listed = spark.createDataFrame([(d,) for d in FIXTURE.excluded_domains], "registered string")
    rows = p.withColumns({"location": target, "status": F.lit(301)})
    return U.classify_redirects_registered(rows, listed, SUFFIXES).select("page_id", "target", "registered", "dropped")


def o44_url_functions(spark, sf_dir):
    u = F.col("url")
    rows = odd_urls(spark, sf_dir).where(U.check_url(u).isNull())
    return rows.select("page_id", U.canonical_domain(u, SUFFIXES).alias("canonical_domain"), U.is_homepage(u).alias("is_homepage"), U.normalize_url(u).alias("normalized"), U.doc_id(u).alias("doc_id"))


def o45_story_id(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").select("page_id", U.story_id(F.col("url")).alias("story_id"))


def o46_names(spark, sf_dir):
    e, k = read_table(spark, sf_dir, "events"), F.col("event_id") % 4
    day = F.date_format("ts", "yyyy_MM_dd")
    name = F.when(k == 0, F.concat(day, F.lit(".csv"))).when(k == 1, F.concat(F.lit("s3://b/a/"), day, F.lit(".csv.gz"))).when(k == 2, F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("-x.GZIP"))).otherwise(F.lit("x.rss"))
    rows = e.select("event_id", name.alias("name"))
    o = U.split_object_url(F.col("name"))
    return rows.select(
        "event_id", U.date_from_name(F.col("name")).alias("day"), U.date_from_name(F.col("name"), True).alias("day_base"), U.file_key(F.col("name")).alias("key"),
        o["scheme"].alias("scheme"), o["bucket"].alias("bucket"), o["key"].alias("object_key"),
    )


def o21_url_fqdn(spark, sf_dir):
    return odd_urls(spark, sf_dir).groupBy(U.url_fqdn(F.col("url")).alias("fqdn")).agg(F.count("*").alias("n"))


def o47_file_key(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    path = F.concat(F.lit("in/"), F.col("event_type"), F.lit("/mc-"), F.date_format("ts", "yyyy-MM-dd"), F.when(F.col("event_id") % 2 == 0, F.lit(".rss.gz")).otherwise(F.lit(".csv.GZIP")))
    return e.groupBy(U.file_key(path).alias("key")).agg(F.count("*").alias("n"))


def o58_split_object_url(spark, sf_dir):
    o = U.split_object_url(F.when(F.col("page_id") % 4 == 0, F.lit("plain/path")).otherwise(F.col("url")))
    return read_table(spark, sf_dir, "pages").select("page_id", o["scheme"].alias("scheme"), o["bucket"].alias("bucket"), o["key"].alias("object_key"))


def o48_metric_names(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    labels = F.create_map(F.lit("status"), F.col("event_type"), F.lit("app"), F.concat(F.lit("a"), (F.col("user_id") % 3).cast("string")))
    return e.groupBy(X.metric_name(F.lit("stories"), labels).alias("metric")).agg(F.count("*").alias("n"))


def o49_metadata_json(spark, sf_dir):
    return o49_metadata_json_all(spark, sf_dir).where(F.col("doc_id") % 2 == 0)


def o49_metadata_json_all(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    none = F.lit(None).cast("string")
    doc = X.metadata_json([F.col("doc_id").alias("id"), F.col("lang").alias("language"), none.alias("via")])
    return d.select("doc_id", doc.alias("metadata"))


def o59_error_columns(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    e = X.error_columns(F.col("text"), "parser", "extract", F.col("source"), F.timestamp_seconds(F.lit(1.7e9)))
    return d.select("doc_id", e["who"].alias("who"), e["what"].alias("what"), e["where"].alias("place"), e["name"].alias("name"))


REGISTERED = "CASE WHEN regexp_matches({h}, '\\.example\\.(com|net|org)$') THEN regexp_extract({h}, '([^.]+\\.example\\.[a-z]+)$', 1) ELSE coalesce(nullif(regexp_extract({h}, '([^.]+\\.[^.]+)$', 1), ''), {h}) END"

#: CTEs from `parts` to `normal`: page_id, url, normalized.
NORMAL = """ports AS (SELECT *, regexp_extract(hp, ':([0-9]+)$', 1) AS port FROM parts),
 fronts AS (SELECT page_id, url, regexp_replace(host, '^www\\.', '') || CASE WHEN port = '' OR (scheme = 'http' AND port = '80') OR (scheme = 'https' AND port = '443') THEN '' ELSE ':' || port END
  || regexp_replace(regexp_extract(rest, '^//[^/?#]*([^?#]*)', 1), '/+$', '') AS front,
  list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_'))) AS q FROM ports),
 normal AS (SELECT page_id, url, front || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS normalized FROM fronts)"""

QUERIES = {f.__name__: f for f in (o20_check_url, o22_non_news_join, o24_filter_domains, o27_classify_redirects, o28_redirects_registered, o44_url_functions, o45_story_id, o46_names, o21_url_fqdn, o47_file_key, o58_split_object_url, o48_metric_names, o49_metadata_json, o49_metadata_json_all, o59_error_columns)}

ORACLES = {
    "o20_check_url": f"WITH {ODD_URLS}, {sql_parts('url', 'odd')} SELECT page_id, nullif(host, '') AS fqdn, scheme, coalesce({sql_check('url')}, 'ok') AS status FROM parts",
    "o22_non_news_join": f"""WITH {sql_parts('url', 'pages', 'page_id')}, reg AS (SELECT page_id, host, {REGISTERED.format(h='host')} AS domain FROM parts),
 listed AS (SELECT DISTINCT domain FROM reg WHERE page_id % 17 = 0)
SELECT page_id, host, EXISTS (SELECT 1 FROM listed l WHERE host = l.domain OR ends_with(host, '.' || l.domain)) AS is_non_news FROM reg""",
    "o24_filter_domains": f"""WITH {ODD_URLS}, {sql_parts('url', 'odd')}
SELECT page_id, url FROM parts WHERE NOT (NOT bad AND len(list_filter({EXCLUDED}, lambda d: host = d OR ends_with(host, '.' || d))) > 0)""",
    "o27_classify_redirects": f"""WITH c AS (SELECT page_id, page_id % 33 AS n, url FROM pages),
 chains AS (SELECT page_id, list_concat(list_transform(range(1, n + 2), lambda i: 'http://h' || i || '.example.com/'), [CASE n WHEN 5 THEN '' WHEN 6 THEN 'http:///p' ELSE url END]) AS chain FROM c),
 hops AS (SELECT page_id, len(chain) AS hops, unnest(chain) AS url, generate_subscripts(chain, 1) AS i FROM chains), {sql_parts('url', 'hops')},
 faults AS (SELECT page_id, hops, i, CASE WHEN url = '' THEN 'badredir' WHEN i >= 30 THEN 'maxredir' WHEN host = '' THEN 'badredir2'
  WHEN len(list_filter({EXCLUDED}, lambda d: host = d OR ends_with(host, '.' || d))) > 0 THEN 'non-news2' END AS fault FROM parts)
SELECT page_id, hops, coalesce(arg_min(fault, i) FILTER (WHERE fault IS NOT NULL), 'ok') AS status FROM faults GROUP BY page_id, hops""",
    "o28_redirects_registered": f"""WITH {sql_parts('url', 'pages', 'page_id, url')}, t AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN scheme || '://' || net || '/moved' WHEN 1 THEN scheme || '://' || net || '/top'
  WHEN 2 THEN scheme || '://' || net || coalesce(nullif(regexp_replace(regexp_extract(rest, '^//[^/?#]*([^?#]*)', 1), '[^/]*$', ''), ''), '/') || 'next' ELSE url END AS target, host FROM parts),
 r AS (SELECT page_id, target, {REGISTERED.format(h='host')} AS registered FROM t)
SELECT page_id, target, registered, list_contains({EXCLUDED}, registered) AS dropped FROM r""",
    "o44_url_functions": f"""WITH {ODD_URLS}, {sql_parts('url', 'odd')},
 ok AS (SELECT *, regexp_extract(hp, ':([0-9]+)$', 1) AS port FROM parts WHERE coalesce(url, '') <> '' AND NOT bad AND host <> '' AND scheme IN ('http', 'https') AND host NOT IN ('localhost', '127.0.0.1')),
 pre AS (SELECT page_id, {REGISTERED.format(h='host')} AS canonical_domain, regexp_matches(regexp_replace(regexp_extract(rest, '^//[^/?#]*(.*)$', 1), '#.*$', ''), '^(?:/?|/index\\.[A-Za-z]+)$') AS is_homepage,
  regexp_replace(host, '^www\\.', '') || CASE WHEN port = '' OR (scheme = 'http' AND port = '80') OR (scheme = 'https' AND port = '443') THEN '' ELSE ':' || port END
  || regexp_replace(regexp_extract(rest, '^//[^/?#]*([^?#]*)', 1), '/+$', '') AS front,
  list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_'))) AS q FROM ok),
 n AS (SELECT *, front || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS normalized FROM pre)
SELECT page_id, canonical_domain, is_homepage, normalized, sha256(normalized) AS doc_id FROM n""",
    "o45_story_id": """WITH h AS (SELECT page_id, md5(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(url)) AS h FROM pages)
SELECT page_id, substr(h, 1, 12) || '3' || substr(h, 14, 3) || substr('89ab', (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || substr(h, 18, 15) AS story_id FROM h""",
    "o46_names": """WITH n AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y_%m_%d') || '.csv' WHEN 1 THEN 's3://b/a/' || strftime(ts, '%Y_%m_%d') || '.csv.gz' WHEN 2 THEN strftime(ts, '%Y-%m-%d') || '-x.GZIP' ELSE 'x.rss' END AS name FROM events),
 b AS (SELECT *, list_last(string_split(name, '/')) AS base FROM n)
SELECT event_id, CASE WHEN regexp_matches(name, '^\\d{4}[_-]\\d\\d[_-]\\d\\d') THEN replace(substr(name, 1, 10), '_', '-') END AS day,
 CASE WHEN regexp_matches(base, '^\\d{4}[_-]\\d\\d[_-]\\d\\d') THEN replace(substr(base, 1, 10), '_', '-') END AS day_base, regexp_replace(base, '(?i)\\.(gz|gzip)$', '') AS key,
 CASE WHEN contains(name, '://') THEN 's3' END AS scheme, CASE WHEN contains(name, '://') THEN 'b' END AS bucket, CASE WHEN contains(name, '://') THEN substr(name, 8) END AS object_key FROM b""",
    "o21_url_fqdn": f"WITH {ODD_URLS}, {sql_parts('url', 'odd')} SELECT nullif(host, '') AS fqdn, count(*) AS n FROM parts GROUP BY 1",
    "o47_file_key": "SELECT 'mc-' || strftime(ts, '%Y-%m-%d') || CASE WHEN event_id % 2 = 0 THEN '.rss' ELSE '.csv' END AS key, count(*) AS n FROM events GROUP BY 1",
    "o58_split_object_url": r"""SELECT page_id, CASE WHEN page_id % 4 <> 0 THEN regexp_extract(url, '^([^:]+)://', 1) END AS scheme, CASE WHEN page_id % 4 <> 0 THEN regexp_extract(url, '^[^:]+://([^/]*)', 1) END AS bucket,
 CASE WHEN page_id % 4 <> 0 THEN regexp_extract(url, '^[^:]+://[^/]*/?(.*)$', 1) END AS object_key FROM pages""",
    "o48_metric_names": "SELECT 'stories.app_a' || (user_id % 3) || '.status_' || event_type AS metric, count(*) AS n FROM events GROUP BY 1",
    "o49_metadata_json": """SELECT doc_id, '{"id":' || doc_id || ',"language":' || CASE WHEN lang IS NULL THEN 'null' ELSE '"' || lang || '"' END || ',"via":null}' AS metadata FROM documents WHERE doc_id % 2 = 0""",
    "o49_metadata_json_all": """SELECT doc_id, '{"id":' || doc_id || ',"language":' || CASE WHEN lang IS NULL THEN 'null' ELSE '"' || lang || '"' END || ',"via":null}' AS metadata FROM documents""",
    "o59_error_columns": "SELECT doc_id, 'parser' AS who, substr(text, 1, 100) AS what, 'extract' AS place, source AS name FROM documents",
}
