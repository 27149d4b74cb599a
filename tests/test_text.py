import random
import unicodedata

from pyspark.sql import functions as F

from tidewire.functions import text as X
from tidewire.operators import parse as P


def cut(text, n, nfc):
    if len(text.encode()) <= n:
        return text
    if nfc:
        text = unicodedata.normalize("NFC", text)
    return text.encode()[:n].decode("utf-8", "ignore")


def test_truncation_follows_the_rule(spark):
    rng = random.Random(1)
    texts = ["e\u0301", "", "abc", "é日𝄞", *("".join(rng.choice("ae\u0301é日𝄞 ") for _ in range(rng.randint(0, 12))) for _ in range(60))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in (0, 1, 2, 3, 5, 9):
        rows = X.with_normal_form(df, "t", n).select("t", X.truncate_utf8(F.col("t"), n).alias("plain"), X.truncate_utf8(F.col("t"), n, F.col("nfc")).alias("nfc")).collect()
        for r in rows:
            assert r["plain"] == cut(r["t"], n, False) and r["nfc"] == cut(r["t"], n, True), (n, r["t"])


def test_feeds(spark):
    want = {
        "<!DOCTYPE html><rss>": False, '<?xml version="1.0"?><rss>': True, '<atom:feed xmlns:atom="x">': True, ' <?xml version="1.0"?><rss>': False, "<a:feed>": False, "<html>": False,
        "\n<rss>": True, "<!-- c --><urlset a='b'>": True, "": False, "text": False, "<rdf:RDF xmlns:rdf='x'>": True,
    }
    df = spark.createDataFrame([(k,) for k in want], "h string")
    assert {r["h"]: r["f"] for r in df.select("h", X.is_feed_document(F.col("h")).alias("f")).collect()} == want


def test_decoding(spark):
    page = "<html><p>é ü 日</p></html>"
    latin = "<p>é ü</p>"
    rows = [
        (1, page.encode(), None, None), (2, b"\xef\xbb\xbf" + page.encode(), None, None), (3, latin.encode("latin-1"), "latin-1", None), (4, latin.encode("latin-1"), None, "iso-8859-1"),
        (5, b'<meta charset="windows-1252">' + latin.encode("cp1252"), None, None), (6, b"", None, None), (7, None, None, None), (8, page.encode("utf-16"), None, None), (9, latin.encode("cp1252"), None, None), (10, b"\x81\x8d", None, None),
    ]
    df = spark.createDataFrame(rows, "i int, html binary, raw_encoding string, http_encoding string")
    got = {r["i"]: r for r in P.decode_html(df).collect()}
    assert got[1]["text"] == got[2]["text"] == got[8]["text"] == page
    assert got[3]["text"] == got[4]["text"] == got[9]["text"] == latin and got[5]["text"].endswith(latin)
    assert [got[i]["disposition"] for i in (1, 6, 7, 10)] == ["decoded", "no-html", "no-html", "no-decode"]
    assert got[10]["action"] == "quarantine"


def test_content(spark):
    html = "<!doctype html><html lang='fr-CA'><head><title> A\n b </title><link rel='canonical' href='https://x.example.com/c'><script>no</script></head><body><nav>menu</nav><article><p>One two.</p><p>Three</p></article><footer>f</footer></body></html>"
    df = spark.createDataFrame([(html, "https://www.example.com/"), ("<p>short", "http://a.b.c.org/x")], "text string, url string")
    rows = P.extract_content(df, F.to_timestamp(F.lit("2024-01-02 03:04:05")), ("example.com",), least=10).collect()
    r = rows[0]
    assert (r["article_title"], r["language"], r["full_language"], r["canonical_url"], r["text_content"]) == ("A b", "fr", "fr-CA", "https://x.example.com/c", "One two.\nThree")
    assert r["is_homepage"] and r["canonical_domain"] == "www.example.com" and r["disposition"] == "extracted"
    assert rows[1]["disposition"] == "too-short" and rows[1]["canonical_domain"] == "c.org"
