"""End-to-end jobs on planted rows: each row has the disposition that the rules give it."""

import pytest
from pyspark.sql import functions as F

from tidewire.config import FIXTURE
from tidewire.functions import text as X
from tidewire.functions import urls as U
from tidewire.plans import jobs as J
from tidewire.queries.jobs import QUERIES, no_index
from tidewire.queries.sources import now
from tidewire.sources import feeds

WORDS = " ".join(f"word{i} of the story that is long enough" for i in range(30))


def page(text=WORDS, canonical=None):
    link = f'<link rel="canonical" href="{canonical}">' if canonical else ""
    return f"<html><head><title>A title</title>{link}</head><body><p>{text}</p></body></html>".encode()


ENTRIES = "link string, pub_date string, disposition string, pos int"
RESPONSES = "url string, status int, encoding string, content_type string, body binary, error_class string"


def test_feed_entries_to_index_and_archive(spark, tmp_path):
    good = "Sun, 30 Apr 2023 23:08:47 -0000"
    entries = [
        ("http://a.org/1", good, "queuing", 1), ("http://a.org/2", "no date at all", "queuing", 2), ("http://a.org/3", good, "queuing", 3), ("http://a.org/4", good, "queuing", 4),
        (None, good, "bad", 5), ("http://localhost/x", good, "queuing", 6), ("http://a.org/1#frag", good, "queuing", 7), ("http://a.org/8", None, "queuing", 8),
    ]
    ok = (200, None, "text/html")
    responses = [("http://a.org/1", *ok, page(), None), ("http://a.org/2", *ok, page(), None), ("http://a.org/3", 404, None, None, b"x", None), ("http://a.org/4", *ok, page("short"), None), ("http://a.org/1#frag", *ok, page(), None), ("http://a.org/8", 503, None, None, b"x", None)]
    out = J.crawl_feed_job(spark.createDataFrame(entries, ENTRIES), spark.createDataFrame(responses, RESPONSES), no_index(spark), FIXTURE, now(), "pos", str(tmp_path / "w"))
    got = {r["pos"]: (r["disposition"], r["action"]) for r in out.collect()}
    assert len(got) == len(entries)
    assert got[1] == ("created", "pass") and got[2] == ("bad-pub-date", "retry") and got[3] == ("http-404", "discard") and got[8] == ("http-5xx", "retry")
    assert got[4] == ("too-short", "discard") and got[5] == ("bad", "discard") and got[6] == ("bad-host", "discard") and got[7] == ("dups", "discard")
    back = J.archive_replay(spark, str(tmp_path / "w"), no_index(spark), FIXTURE, now()).collect()
    first = out.where("pos = 1").first()
    assert [(r["disposition"], r["text_content"], r["url"], r["publication_date"]) for r in back] == [("created", first["text_content"], first["url"], first["publication_date"])]


def test_replay_without_text_goes_to_quarantine(spark, tmp_path):
    rows = spark.createDataFrame([("http://a.org/1", bytearray(page()))], "url string, html binary")
    J.archive_stories(J.to_stories(rows), str(tmp_path / "w"), now(), FIXTURE)
    assert [(r["disposition"], r["action"]) for r in J.archive_replay(spark, str(tmp_path / "w"), no_index(spark), FIXTURE, now()).collect()] == [("no-text", "quarantine")]


def test_history_by_versions_and_without_urls(spark, tmp_path):
    mark = FIXTURE.need_canonical_url
    rows = [("f", 1, mark, "7", "2021-10-01 00:00:00"), ("f", 2, mark, "8", "2021-10-01 00:00:00"), ("f", 3, mark, "x", "2021-10-01 00:00:00"), ("f", 4, mark, "70", "2021-10-01 00:00:00"), ("f", 5, mark, "71", "2021-10-01 00:00:00")]
    df = spark.createDataFrame([(*r, None) for r in rows], "file string, pos int, url string, dlid string, collect_date string, fetch_timestamp double")
    df = df.withColumn("final_url", F.col("url"))
    versions = spark.createDataFrame([(7, 100, 1, "2021-10-02"), (7, 101, 2, "2022-01-01")], "key long, version_id long, listed int, last_modified string").withColumn("last_modified", F.to_date("last_modified"))
    objects = [(7, 100, page(canonical="http://b.org/old"), 1.0), (7, 101, page(canonical="http://b.org/new"), 2.0), (70, None, page(canonical="http://b.org/other"), 3.0), (71, None, page(), 4.0)]
    out = J.history_job(df, spark.createDataFrame(objects, "key long, version_id long, body binary, modified_at double"), no_index(spark), FIXTURE, now(), versions, (0, 9), str(tmp_path / "w"), need_url=True)
    got = {r["pos"]: (r["disposition"], r["url"]) for r in out.collect()}
    assert got == {1: ("created", "http://b.org/old"), 2: ("epoch-err", mark), 3: ("bad-dlid", mark), 4: ("created", "http://b.org/other"), 5: ("no-canonical-url", mark)}
    assert {r["url"] for r in J.archive_replay(spark, str(tmp_path / "w"), no_index(spark), FIXTURE, now()).collect()} == {"http://b.org/old", "http://b.org/other"}


@pytest.mark.parametrize("job", ["list", "batch"])
def test_lists_to_archives(spark, tmp_path, job):
    rows = spark.createDataFrame([("f", 1, "http://a.org/1", "a.org"), ("f", 2, "http://a.org/1", "a.org"), ("f", 3, "http://c.org/2", "c.org")], "file string, pos int, url string, domain string")
    responses = spark.createDataFrame([("http://a.org/1", 200, None, "text/html", page(), None), ("http://c.org/2", 403, None, None, b"x", None)], RESPONSES)
    run = J.url_list_job if job == "list" else J.batch_feed_job
    out = run(rows, responses, no_index(spark), FIXTURE, now(), archive=str(tmp_path / "w"))
    assert {r["pos"]: r["disposition"] for r in out.collect()} == {1: "created", 2: "dups", 3: "http-403"}
    assert J.archive_replay(spark, str(tmp_path / "w"), no_index(spark), FIXTURE, now()).count() == 1


def test_rows_without_id_are_not_lost(spark):
    df = spark.createDataFrame([(1, "http://a.org/"), (None, "http://b.org/"), (2, None)], "id long, url string")
    for c in ("title", "domain", "published_at", "feed_url"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.withColumns({"feed_id": F.lit(1), "sources_id": F.lit(2)})
    assert [(r["id"], r["disposition"]) for r in feeds.read_feed_entries(df, 0, 10, "h").collect()] == [(1, "queuing"), (2, "no-url"), (None, "bad-id")]


def test_null_texts_stay_null_when_cut(spark):
    df = spark.createDataFrame([(None,), ("",), ("é" * 9,)], "t string")
    assert [r[0] for r in df.select(X.truncate_utf8(F.col("t"), 5)).collect()] == [None, "", "éé"]


def test_only_redirects_are_dropped_by_registered_domain(spark):
    rows = spark.createDataFrame([(1, "http://a.org/", "http://www.bad.org/x", 301), (2, "http://a.org/", "http://www.bad.org/x", 200), (3, "http://a.org/", "/y", 308), (4, "http://a.org/", None, 302)], "i int, url string, location string, status int")
    listed = spark.createDataFrame([("bad.org",), ("bad.org",)], "registered string")
    got = U.classify_redirects_registered(rows, listed, ()).orderBy("i").collect()
    assert [r["dropped"] for r in got] == [True, False, False, False] and len(got) == 4


@pytest.mark.parametrize("name", ["j1_dispositions", "j1_flagship", "j2_history", "j4_url_list", "j5_batch_feed", "o100_stage_protocol"])
def test_each_page_is_parsed_once(spark, sf_dir, name):
    """One decoding and one body pass in the whole plan; the disposition goes along as a column."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [_decoded") == 1 and plan.count("ArrowEvalPython [_body_text") == 1


def test_rows_that_were_refused_keep_what_they_had(spark):
    rows = spark.createDataFrame([(1, "a", "pass", "ok"), (2, "b", "discard", "bad")], "i int, x string, action string, disposition string")
    out = J.carry_on(rows, lambda df: df.withColumns({"x": F.lit("new"), "y": F.lit("more"), "disposition": F.lit("done"), "action": F.lit("retry")}), changes=("x",))
    assert sorted(map(tuple, out.select("i", "x", "y", "action", "disposition").collect())) == [(1, "new", "more", "retry", "done"), (2, "b", None, "discard", "bad")]


def test_known_documents_are_duplicates(spark):
    entries = spark.createDataFrame([(f"http://a.org/{i}", None, "queuing", i) for i in range(3)], ENTRIES)
    responses = spark.createDataFrame([(f"http://a.org/{i}", 200, None, "text/html", page(), None) for i in range(3)], RESPONSES)
    known = no_index(spark).select("doc_id").unionByName(entries.where("pos = 1").select(U.doc_id(F.col("link")).alias("doc_id")))
    out = J.crawl_feed_job(entries, responses, known, FIXTURE, now(), "pos")
    assert {r["pos"]: r["disposition"] for r in out.collect()} == {0: "created", 1: "ilm-dups", 2: "created"}
