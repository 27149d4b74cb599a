import gzip
import zlib

import pytest
from pyspark.sql import functions as F

from tidewire import schema
from tidewire.config import FIXTURE
from tidewire.plans import jobs
from tidewire.sources import disk, feeds, inputs, warc

NOW = "2024-01-02 03:04:05"


def now():
    return F.to_timestamp(F.lit(NOW))


def some_stories(spark, n=7):
    rows = []
    for i in range(n):
        rows.append(((f"http://l{i}.example.com/", "t", "d", None, "2023-05-01", None, i, None, "v"), (f"<p>{i} é</p>\r\n\r\nWARC/1.0 inside".encode(), "x"), (200 if i else 404, 1.7e9 + i, f"http://f{i}.example.com/", "utf-8"), None))
    s = f"rss_entry struct<{schema.RSS_ENTRY}>, raw_html struct<{schema.RAW_HTML}>, http_metadata struct<{schema.HTTP_METADATA}>, content_metadata struct<{schema.CONTENT_METADATA}>"
    return spark.createDataFrame(rows, s)


def test_warc_round_trip(spark, tmp_path):
    stories, path = some_stories(spark), str(tmp_path / "w")
    done = warc.write_warc(stories.coalesce(1), path, now(), max_rows=3).collect()
    assert sorted(r["stories"] for r in done) == [1, 3, 3] and all(r["bytes"] > 0 for r in done)
    back = {r["rss_entry"]["link"]: r for r in warc.read_warc(spark, path, schema.PARTS).collect()}
    for r in stories.collect():
        b = back[r["rss_entry"]["link"]]
        assert b["rss_entry"] == r["rss_entry"] and b["http_metadata"] == r["http_metadata"]
        assert bytes(b["raw_html"]["html"]) == bytes(r["raw_html"]["html"]) and b["raw_html"]["encoding"] == "utf-8"
        assert b["parsed_date"].startswith("2023-11-14T22:13:2")
    data = b"".join(gzip.open(f).read() for f in (tmp_path / "w").rglob("*.gz"))
    assert data.count(b"WARC-Type: warcinfo") == 3 and b"HTTP/1.0 404 HUH?" in data and b"Content-Type: text/html; encoding=utf-8" in data
    assert warc.pair_records(spark, path).count() == 7


def test_a_gzip_member_for_each_record(spark, tmp_path):
    stories, path = some_stories(spark), tmp_path / "w"
    warc.write_warc(stories.repartition(2), str(path), now(), max_rows=3)
    files = list(path.rglob("*.warc.gz"))
    assert files and all(f.parent.relative_to(path).as_posix() == "2024/01/02" for f in files) and not (path / "_temporary").exists()
    for f in files:
        rest, members = f.read_bytes(), 0
        while rest:
            one = zlib.decompressobj(wbits=31)
            assert one.decompress(rest).startswith(b"WARC/1.0\r\n") and one.eof
            rest, members = one.unused_data, members + 1
        assert members == len([*warc.records(open(f, "rb", buffering=0))])
    with pytest.raises(FileExistsError):
        warc.write_warc(stories, str(path), now())
    warc.write_warc(stories.limit(2), str(path), now(), mode="overwrite")
    assert warc.read_warc(spark, str(path), schema.PARTS).count() == 2


def test_archives_of_other_writers(spark, tmp_path):
    """One gzip stream over all records, a plain file, a truncated tail of blank lines, an empty archive."""
    warc.write_warc(some_stories(spark).coalesce(1), str(tmp_path / "w"), now())
    data = gzip.decompress(next((tmp_path / "w").rglob("*.gz")).read_bytes())
    other = tmp_path / "o o"
    other.mkdir()
    (other / "one stream.gz").write_bytes(gzip.compress(data))
    (other / "plain.gz").write_bytes(data.rstrip())
    (other / "empty.gz").write_bytes(b"")
    back = warc.read_warc(spark, str(other), schema.PARTS).groupBy("rss_entry.link").count().collect()
    assert sorted(r["count"] for r in back) == [2] * 7


def test_stories_that_cannot_be_archived(spark, tmp_path):
    bad = some_stories(spark, 2).withColumn("raw_html", F.lit(None).cast(f"struct<{schema.RAW_HTML}>"))
    with pytest.raises(ValueError, match="no-html"):
        warc.write_warc(bad, str(tmp_path / "a"), now())
    assert warc.write_warc(bad, str(tmp_path / "b"), now(), raise_errors=False).count() == 0


def test_disk_round_trip(spark, tmp_path):
    stories = some_stories(spark)
    refused = disk.write_disk_stories(stories.unionByName(stories.limit(1).withColumn("rss_entry", F.lit(None).cast(f"struct<{schema.RSS_ENTRY}>"))), str(tmp_path / "d"))
    assert [r["disposition"] for r in refused.collect()] == ["no-link"]
    back = disk.read_disk_stories(spark, str(tmp_path / "d"), {k: schema.PARTS[k] for k in ("rss_entry", "http_metadata")}).collect()
    assert {r["rss_entry"] for r in back} == {r["rss_entry"] for r in stories.collect()}
    assert (tmp_path / "d" / "_rss_entry" / "year=2023" / "month=05" / "day=01").is_dir()


def test_feed_files(spark, tmp_path):
    body = "<rss><channel><lastBuildDate>bad date</lastBuildDate><item><link> http://a/?x=1&amp;y </link><title></title><source url='u' mcFeedId='7' mcSourceId='q'>n</source></item><item><title>t</title></item></channel></rss>"
    with gzip.open(tmp_path / "mc.rss.gz", "wt") as f:
        f.write(body)
    rows = sorted(feeds.read_daily_feed(spark, str(tmp_path / "mc.rss.gz")).collect(), key=lambda r: r["link"] or "")
    assert [(r["link"], r["title"], r["source_feed_id"], r["source_source_id"], r["fetch_date"], r["via"], r["disposition"]) for r in rows] == [
        (None, "t", None, None, "bad date", "mc.rss.gz", "bad"), ("http://a/?x=1&y", None, 7, None, "bad date", "mc.rss.gz", "queuing"),
    ]


def test_every_story_has_one_disposition(spark, sf_dir):
    from tidewire.queries.jobs import captured, no_index

    rows = captured(spark, sf_dir)
    out = jobs.feed_job(rows, no_index(spark), FIXTURE, now(), "page_id").select("page_id", "disposition", "action").collect()
    assert len(out) == rows.count() and len({r["page_id"] for r in out}) == len(out)
    assert all(r["disposition"] and r["action"] for r in out)
    created = {r["page_id"] for r in out if r["disposition"] == "created"}
    assert created and all(r["page_id"] < 1_000_000_000 for r in out if r["disposition"] == "created")


def test_replay_gives_what_the_first_job_gave(spark, sf_dir):
    from tidewire.queries.jobs import j1_dispositions, j3_archive_replay

    first = {r["status"]: r["stories"] for r in j1_dispositions(spark, sf_dir).collect()}
    again = j3_archive_replay(spark, sf_dir).groupBy("disposition").agg(F.sum("stories").alias("n")).collect()
    assert {r["disposition"]: r["n"] for r in again}["created"] == first["created"]


def test_a_cursor_that_another_pull_moved_stays(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://a.org/{i}", *[None] * 4, 1, 2) for i in range(1, 11)]
    entries = spark.createDataFrame(rows, "id long, url string, title string, domain string, published_at string, feed_url string, feed_id int, sources_id int")
    state = str(tmp_path / "state")
    pull = lambda n, **more: sorted(r["id"] for r in feeds.resume_entries(spark, entries, state, n, "h", **more).collect())
    assert pull(3) == [1, 2, 3] and pull(2, dry_run=True) == [4, 5]
    read = feeds.read_feed_entries

    def slow(*args, **kwargs):
        monkeypatch.setattr(feeds, "read_feed_entries", read)
        assert pull(4) == [4, 5, 6, 7]  # another pull, in the meantime
        return read(*args, **kwargs)

    monkeypatch.setattr(feeds, "read_feed_entries", slow)
    assert pull(1) == [4]
    assert pull(9) == [8, 9, 10]
    files = len(list((tmp_path / "state").glob("*.parquet")))
    assert pull(9) == [] and len(list((tmp_path / "state").glob("*.parquet"))) == files == 3


def test_a_mark_holds_whatever_the_times_of_earlier_entries(spark):
    manifest = spark.createDataFrame([("a", "NOT_STARTED", 900), ("b", "STARTED", 900), ("b", "NOT_STARTED", 950), ("c", "FINISHED", 50), ("d", "NOT_STARTED", 100)], "name string, status string, ts bigint")
    files = spark.createDataFrame([(f"in/{n}.gz",) for n in "abcde"], "path string")

    def pending(m):
        return sorted(r["name"] for r in inputs.pending_inputs(files, m, 100).collect())

    todo = inputs.pending_inputs(files, manifest, 100)
    assert pending(manifest) == ["a", "b", "d", "e"]
    started = inputs.mark_inputs(manifest, todo, "STARTED", 100)
    assert pending(started) == []
    failed = inputs.mark_inputs(started, todo.where("name <> 'a'"), "NOT_STARTED", 100)
    assert pending(failed) == ["b", "d", "e"]
    assert pending(inputs.mark_inputs(failed, todo, "STARTED", 100)) == []
    assert sorted(map(tuple, inputs.mark_inputs(manifest, todo, "FINISHED", 100).collect())) == [(n, "FINISHED", 50 if n == "c" else 100) for n in "abcde"]
