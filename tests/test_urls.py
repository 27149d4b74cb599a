from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from tidewire.functions import urls as U

URLS = [
    "http://example.com/x", "HTTP://H/x", "https://user:pw@Host.Example.com:8080/a?b#c", "//foo.com/x", "mailto:x@y.z", "ftp://h/x", "http://localhost/", "http://127.0.0.1:80/",
    "http://[::1]/x", "http://[::1]:99/x", "http://[::1/x", "http://under_score.example.com/x", "  \thttp://a.b/c", "http://a.b/\tc d", "/just/path", "x", "http://", "http:///p", "http://a@b@c/d",
    "https://ä.example/ü", "http://h?q", "http://h#f", "1http://h/", "a+b.c-d://host/",
]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "url string")


def test_host_and_scheme_agree_with_urlsplit(spark):
    rows = frame(spark, URLS).select("url", U.host(F.col("url")).alias("h"), U.scheme(F.col("url")).alias("s"), U.is_bad(F.col("url")).alias("bad")).collect()
    for r in rows:
        try:
            want = urlsplit(r["url"].lstrip())
            assert not r["bad"], r["url"]
            assert (r["h"], r["s"]) == ((want.hostname or ""), want.scheme), r["url"]
        except ValueError:
            assert r["bad"], r["url"]


def test_order_of_checks(spark):
    want = {
        "": "no-url", None: "no-url", "http://[::1/x": "bad-url", "mailto:x@y.z": "no-host", "//foo.com/x": "bad-scheme", "ftp://h/x": "bad-scheme", "http://localhost/": "bad-host",
        "http://127.0.0.1:80/": "bad-host", "http://[::1]/x": None, "HTTP://H/x": None, "http://under_score.example.com/x": None, "http://a.bad.org/": "non-news", "http://notbad.org/": None,
    }
    rows = frame(spark, list(want)).select("url", U.check_url(F.col("url"), ["bad.org"]).alias("s")).collect()
    assert {r["url"]: r["s"] for r in rows} == want


def test_redirects(spark):
    hops = [f"http://h{i}/" for i in range(29)]
    cases = [(hops, None), ([*hops, "http://end/"], "maxredir"), (["http://a/", ""], "badredir"), (["http:///p"], "badredir2"), (["http://a/", "http://x.bad.org/"], "non-news2")]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, chain array<string>")
    got = {r["i"]: r["s"] for r in df.select("i", U.classify_redirects(F.col("chain"), ["bad.org"]).alias("s")).collect()}
    assert got == {i: s for i, (_, s) in enumerate(cases)}


def test_join_with_a_list_agrees_with_the_column(spark):
    hosts = spark.createDataFrame([("a.bad.org",), ("bad.org",), ("notbad.org",), (None,)], "host string")
    listed = spark.createDataFrame([("bad.org",), ("bad.org",)], "domain string")
    got = {r["host"]: r["is_non_news"] for r in U.non_news(hosts, "host", listed).collect()}
    assert got == {"a.bad.org": True, "bad.org": True, "notbad.org": False, None: False}


def test_names_and_keys(spark):
    import uuid

    link = "https://example.com/a?b=ü"
    row = spark.createDataFrame([(link, "a/mc-2024-01-01.rss.gz", "x.GZIP", "2023_01_02.csv", "s3://b/2023_01_02.csv")], "a string, b string, c string, d string, e string")
    c = {x: F.col(x) for x in "abcde"}
    r = row.select(U.story_id(c["a"]), U.file_key(c["b"]), U.file_key(c["c"]), U.date_from_name(c["d"]), U.date_from_name(c["e"]), U.date_from_name(c["e"], True)).first()
    assert tuple(r) == (uuid.uuid3(uuid.NAMESPACE_URL, link).hex, "mc-2024-01-01.rss", "x", "2023-01-02", None, "2023-01-02")


def test_filter_needs_one_list(spark):
    with pytest.raises(ValueError):
        U.filter_domains(frame(spark, URLS), ["url"], ["a"], ["b"])
