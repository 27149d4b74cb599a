"""Batches by number and by time, over triggers that fall anywhere."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidewire import schema
from tidewire.config import FIXTURE
from tidewire.plans import jobs as J
from tidewire.sources import warc
from tidewire.streaming import batches as S
from tidewire.streaming import jobs

ROW = "id long, channel int, arrived timestamp, url string, html string"


def feed(spark, path, rows, part):
    """One file, which one trigger reads."""
    df = spark.createDataFrame(rows, "id long, channel int, seconds double")
    url = F.concat(F.lit("http://a.org/"), F.col("id").cast("string"))
    df.select("id", "channel", F.timestamp_seconds("seconds").alias("arrived"), url.alias("url"), F.lit("<p>words</p>").alias("html")).coalesce(1).write.mode("append").json(f"{path}/{part:03d}")


def by_the_rule(parts, most, seconds):
    """What a worker does that takes the stories one by one."""
    out, state = {}, {}
    for rows in parts:
        for i, channel, at in sorted(rows, key=lambda r: r[2]):
            number, n, first = state.get(channel, (0, 0, 0.0))
            if n and at >= first + seconds:
                number, n = number + 1, 0
            first = at if n == 0 else first
            out[i] = f"{channel}-{number}"
            state[channel] = (number + 1, 0, 0.0) if n + 1 == most else (number, n + 1, first)
    return out


def write(rows, to):
    stories = J.to_stories(rows.select("url", F.encode("html", "UTF-8").alias("html"), F.lit("utf-8").alias("raw_encoding"), F.lit(1.7e9).alias("fetch_timestamp"), "batch", "first"), "batch", "first")
    J.archive_stories(stories, to, F.timestamp_millis("first"), FIXTURE, mode="replace", batch="batch")


def archived(spark, path):
    """batch and id of each archived story."""
    back = warc.read_warc(spark, f"{path}/archives", schema.PARTS)
    name = F.regexp_extract("file", r"archive-\d{14}-(.+)-0-spark", 1)
    return sorted((r[0], r[1]) for r in back.select(name, F.regexp_extract("http_metadata.final_url", r"(\d+)$", 1).cast("long")).collect())


def start(spark, tmp_path, write=write, most=7, seconds=60.0, trigger=jobs.ALL):
    stream = jobs.stream_files(spark, f"{tmp_path}/in/*", ROW, 1)
    return S.archive_in_batches(stream, f"{tmp_path}/out", f"{tmp_path}/point", write, F.col("channel"), "arrived", most, seconds, trigger)


@pytest.fixture(scope="module")
def parts():
    rng, clock, out, i = random.Random(2), 0.0, [], 0
    for _ in range(6):
        rows = []
        for _ in range(rng.randint(5, 30)):
            clock += rng.choice([0.0, 1.0, 3.0, 45.0])
            rows.append((i, rng.choice([0, 0, 1]), clock))
            i += 1
        out.append(rows)
    return out


def test_batches_are_those_of_the_rule(spark, tmp_path, parts):
    """Closed by number and by time; a failed trigger and a restart change nothing; open ones on demand."""
    want, failed = by_the_rule(parts, 7, 60.0), []

    def once(rows, to):
        write(rows, to)
        if not failed:
            failed.append(to)
            raise RuntimeError("after the archives were written")

    for k, rows in enumerate(parts[:4]):
        feed(spark, f"{tmp_path}/in", rows, k)
    with pytest.raises(Exception, match="after the archives"):
        start(spark, tmp_path, once).awaitTermination()
    start(spark, tmp_path, once).awaitTermination()
    got = archived(spark, f"{tmp_path}/out")
    open_now = {b for c in "01" for b in [max((x for x in by_the_rule(parts[:4], 7, 60.0).values() if x.startswith(c)), key=lambda x: int(x[2:]))]}
    sizes = [list(want.values()).count(b) for b in set(want.values())]
    assert got and all(want[i] == b for b, i in got) and {b for b, _ in got} >= set(by_the_rule(parts[:4], 7, 60.0).values()) - open_now
    assert max(sizes) == 7 and min(sizes) < 7
    for k, rows in enumerate(parts[4:]):
        feed(spark, f"{tmp_path}/in", rows, 4 + k)
    start(spark, tmp_path).awaitTermination()
    assert S.archive_open(spark, f"{tmp_path}/out", write) <= 2
    assert archived(spark, f"{tmp_path}/out") == sorted((b, i) for i, b in want.items())
    feed(spark, f"{tmp_path}/in", [(1000, 0, parts[-1][-1][2])], 9)
    start(spark, tmp_path).awaitTermination()
    S.archive_open(spark, f"{tmp_path}/out", write)
    more = by_the_rule([*parts, [(1000, 0, parts[-1][-1][2])]], 7, 60.0)
    assert archived(spark, f"{tmp_path}/out") == sorted((b, i) for i, b in more.items())


def test_a_timer_closes_a_batch_without_new_stories(spark, tmp_path):
    feed(spark, f"{tmp_path}/in", [(1, 0, 10.0), (2, 0, 11.0), (3, 0, None)], 0)
    stream = start(spark, tmp_path, seconds=3.0, trigger={"processingTime": "1 second"})
    try:
        until = time.time() + 90
        while time.time() < until and not (tmp_path / "out" / "archives").exists():
            time.sleep(1)
        time.sleep(2)
    finally:
        stream.stop()
    assert [i for _, i in archived(spark, f"{tmp_path}/out")][:2] == [1, 2]
