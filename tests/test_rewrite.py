"""Changes in place, keys in buckets, and sums that a stream keeps."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidewire.functions import urls as U
from tidewire.operators import crumbs as B
from tidewire.operators import rewrite as R
from tidewire.operators.keys import KeyStore
from tidewire.queries.jobs import json_stream
from tidewire.streaming import jobs as S


def files(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}


@pytest.fixture
def index(spark, tmp_path):
    """Twelve documents a day for five days, and three of no day."""
    rows = [(i, f"http://site{i}.example.com/p", date(2024, 1, 1 + i // 12) if i < 60 else None, "old") for i in range(63)]
    df = spark.createDataFrame(rows, "n int, url string, day date, canonical_domain string").withColumn("doc_id", U.doc_id(F.col("url")))
    df.repartition(2, "day").write.partitionBy("day").parquet(str(tmp_path / "index"))
    return tmp_path / "index"


def test_only_touched_folders_are_written(spark, index):
    before = files(index)
    gone = spark.createDataFrame([("http://site3.example.com/p#x",), ("http://site15.example.com/p",), ("http://nowhere.org/",)], "url string")
    assert sorted(R.delete_in_place(spark, str(index), gone)) == [date(2024, 1, 1), date(2024, 1, 2)]
    after = files(index)
    assert {f for f in before if not f.startswith(("day=2024-01-01", "day=2024-01-02"))} == {f for f in after if not f.startswith(("day=2024-01-01", "day=2024-01-02"))}
    assert not before & {f for f in after if f.startswith(("day=2024-01-01", "day=2024-01-02"))}
    assert sorted(r["n"] for r in spark.read.parquet(str(index)).collect()) == [i for i in range(63) if i not in (3, 15)]
    assert R.delete_in_place(spark, str(index), gone) == [] and files(index) == after


def test_a_folder_without_rows_goes(spark, index):
    gone = spark.createDataFrame([(f"http://site{i}.example.com/p",) for i in [*range(24, 36), 60, 61, 62]], "url string")
    R.delete_in_place(spark, str(index), gone)
    assert sorted({r["day"] for r in spark.read.parquet(str(index)).collect()}) == [date(2024, 1, d) for d in (1, 2, 4, 5)]
    assert not [f for f in files(index) if f.startswith(("day=2024-01-03", "day=__HIVE"))]


def test_domains_are_recomputed_where_they_change(spark, index):
    before = files(index)
    values = R.recompute_in_place(spark, str(index), F.col("n").between(12, 20), ("example.com",))
    assert values == [date(2024, 1, 2)]
    got = {r["n"]: r["canonical_domain"] for r in spark.read.parquet(str(index)).collect()}
    assert got == {i: f"site{i}.example.com" if 12 <= i <= 20 else "old" for i in range(63)}
    assert {f for f in before if "01-02" not in f} == {f for f in files(index) if "01-02" not in f}
    assert R.recompute_in_place(spark, str(index), F.col("n").between(12, 20), ("example.com",)) == []


def test_crumbs_are_pruned_in_place(spark, tmp_path):
    rng, path = random.Random(1), str(tmp_path / "crumbs")
    rows = [(f"2024-01-{d:02d}", rng.choice([None, 1, 2]), 1, None, "a", "s", k) for k, d in enumerate([*range(1, 21)] * 3)]
    table = spark.createDataFrame(rows, "date string, feed_id long, source_id long, domain string, app string, status string, count long")
    table.write.partitionBy("date").parquet(path)
    R.prune_in_place(spark, path, 5)
    want = sorted(r["count"] for r in B.prune_crumbs(table, 5).collect())
    assert sorted(r["count"] for r in spark.read.parquet(path).collect()) == want and len(want) < 60
    assert R.prune_in_place(spark, path, 5) == []


def test_keys_in_buckets(spark, tmp_path):
    """Keys known to a batch are those of before; its files have a bound; a batch that comes again sees the same."""
    rng, store = random.Random(2), KeyStore(str(tmp_path / "keys"), buckets=8, most=3)
    store.start(spark.createDataFrame([(f"k{i}",) for i in range(0, 400, 50)], "doc_id string"))
    seen, counts = {f"k{i}" for i in range(0, 400, 50)}, []
    for number in range(9):
        batch = [f"k{rng.randrange(400)}" for _ in range(30)]
        df = spark.createDataFrame([(k,) for k in [*batch, None]], "doc_id string")
        for again in range(2):
            known = store.known(df, number)
            counts.append(len(known.inputFiles()))
            assert {r[0] for r in known.collect()} & set(batch) == seen & set(batch)
            new = sorted(set(batch) - seen)
            store.add(spark.createDataFrame([(k,) for k in new], "doc_id string"), number)
        seen |= set(new)
        assert {r[0] for r in store.every(spark, number + 1).collect()} == seen
    assert max(counts) <= 8 * 4
    one = spark.createDataFrame([("k1",)], "doc_id string")
    assert "PartitionFilters: [isnotnull(bucket" in store.known(one, 9)._jdf.queryExecution().toString()
    buckets = {r[0] for r in spark.range(400).select(F.concat(F.lit("k"), "id").alias("doc_id")).select(store.bucket()).distinct().collect()}
    assert len(buckets) > 4 and len(store.known(one, 9).collect()) < len(seen) / 2


def test_index_stream_refuses_what_it_has_seen(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i % 40}", i) for i in range(100)], "doc_id string, seq int")
    seed = spark.createDataFrame([("k0", -1), ("k1", -1)], "doc_id string, seq int")
    stream = json_stream(spark, rows, 12, "seq")
    path = str(tmp_path / "index")
    S.stream_dedup_index(stream, path, seed, str(tmp_path / "point"), ["seq"]).awaitTermination()
    assert sorted(r["doc_id"] for r in spark.read.parquet(path).collect()) == sorted(f"k{i}" for i in range(2, 40))


def test_sums_have_one_row_for_each_key(spark, tmp_path):
    rng = random.Random(3)
    lines = [{"date": f"2024-01-0{rng.randint(1, 3)}", "feed_id": rng.choice([None, 1]), "source_id": 1, "domain": rng.choice([None, "d"]), "app": "a", "status": rng.choice("st"), "count": k} for k in range(60)]
    import json

    bodies = [(k, "\n".join(['{"version":[1,0,0],"app":"a"}', *map(json.dumps, lines[k * 5 : k * 5 + 5])])) for k in range(12)]
    path = str(tmp_path / "table")
    stream = json_stream(spark, spark.createDataFrame(bodies, "k int, body string"), 6, "k")
    S.crumb_stream(stream, path, str(tmp_path / "point")).awaitTermination()
    want: dict = {}
    for r in lines:
        key = tuple(r[k] for k in B.KEYS)
        want[key] = want.get(key, 0) + r["count"]
    got = S.crumb_table(spark, path).collect()
    assert len(got) == len(want) and {tuple(r[k] for k in B.KEYS): r["count"] for r in got} == want
