"""Archives by ranges of bytes: every record in one range, whatever the size of ranges."""

import gzip
import random
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewire import schema
from tidewire.config import FIXTURE
from tidewire.plans import jobs as J
from tidewire.queries.sources import now
from tidewire.sources import ranges as R
from tidewire.sources import warc


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    """One archive of 60 stories; some pages don't compress, and some hold what looks like a member."""
    rng, path = random.Random(1), str(tmp_path_factory.mktemp("a") / "w")
    rows = [(f"http://a.org/{i}", bytearray(rng.randbytes(rng.choice([10, 3000])) + (gzip.compress(b"WARC/1.0 no record") if i % 7 == 0 else b"x"))) for i in range(60)]
    df = spark.createDataFrame(rows, "url string, html binary").withColumn("fetch_timestamp", F.lit(1.7e9)).coalesce(1)
    J.archive_stories(J.to_stories(df), path, now(), FIXTURE)
    return path


def stories(df):
    return sorted((r["target_uri"], bytes(r["raw_html"]["html"])) for r in df.collect())


@pytest.mark.parametrize("size,index", [(997, True), (20_000, True), (997, False), (20_000, False), (64 << 20, True)])
def test_every_story_once(spark, archive, tmp_path, size, index):
    want = stories(warc.read_warc(spark, archive, schema.PARTS))
    if not index:
        shutil.copytree(archive, tmp_path / "w", ignore=shutil.ignore_patterns("*.members"))
        archive = str(tmp_path / "w")
    df = R.read_ranges(spark, archive, schema.PARTS, size)
    assert stories(df) == want and len(want) == 60
    if size == 20_000:
        tasks = df.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 3  # one archive, several tasks
    heads = R.read_heads(spark, archive, size)
    assert heads.groupBy("kind").count().count() == 3 and heads.where("kind = 'response'").count() == heads.where("kind = 'metadata'").count() == 60


def test_an_archive_of_one_member(spark, archive, tmp_path):
    one = next(Path(archive).rglob("*.gz"))
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(gzip.decompress(one.read_bytes())))
    (tmp_path / "other.txt").write_text("not an archive")
    assert stories(R.read_ranges(spark, str(tmp_path), schema.PARTS, 5_000)) == stories(warc.read_warc(spark, archive, schema.PARTS))


def test_empty_and_cut_off(spark, archive, tmp_path):
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    assert R.read_ranges(spark, str(tmp_path), schema.PARTS).count() == 0
    one = next(Path(archive).rglob("*.gz")).read_bytes()
    (tmp_path / "cut.warc.gz").write_bytes(one[: len(one) // 2])
    got = stories(R.read_ranges(spark, str(tmp_path), schema.PARTS, 4_000))
    want = stories(warc.read_warc(spark, archive, schema.PARTS))
    assert 10 < len(got) < 60 and set(got) <= set(want)
