import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewire.llm import mixing, sharding
from tidewire.llm.common import stash


def test_key_law_and_gapless_slots(spark, awkward):
    rows = sharding.shard_documents(awkward).collect()
    assert len(rows) == awkward.count()
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "key" and 0 <= r["shard"] < 8
        assert r["grown_shard"] in (r["shard"], 8)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_key = defaultdict(set)
    for r in rows:
        by_key[r["doc_id"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_key.values())
    texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in awkward.collect())
    assert texts == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)


def test_growth_moves_few_rows_and_shards_are_even(spark):
    rows = sharding.shard_documents(spark.range(8000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))).collect()
    moved = sum(r["grown_shard"] == 8 for r in rows)
    assert abs(moved - 8000 / 9) < 150
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) < 1.15 * 1000 and min(counts.values()) > 0.85 * 1000


def test_weights_share_out(spark):
    df = spark.range(20000).select(sharding.rendezvous(F.col("id"), {0: 1.0, 1: 3.0}).alias("s"))
    counts = {r["s"]: r["count"] for r in df.groupBy("s").count().collect()}
    assert 2.7 < counts[1] / counts[0] < 3.3
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), {0: 0.0})


def test_sharding_of_nothing(empty):
    assert sharding.shard_documents(empty).count() == 0


def reshared(sizes, weights, share=1.5, ceiling=2.0):
    """Targets by resharing the excess again and again."""
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[n] for n in open_)
        over = {n for n in open_ if level * weight[n] > ceiling * sizes[n]}
        if not over:
            target |= {n: level * weight[n] for n in open_}
            break
        target |= {n: ceiling * sizes[n] for n in over}
        left -= sum(ceiling * sizes[n] for n in over)
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_taken_words(spark, seed):
    rng = random.Random(seed)
    names = ["a", "b", "é", "z", None, "c d"][: rng.randint(1, 6)]
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 50, 400])), rng.choice(names)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in mixing.plan_mix(docs).collect()}
    sizes = Counter()
    for i, t, s in rows:
        sizes[s] += len(t.split())
    want, taken = reshared({s: sizes[s] for s in {r[2] for r in rows}}, mixing.WEIGHTS), Counter()
    for i, t, s in rows:
        r = got[i]
        assert r["size"] == len(t.split()) and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in want:
        assert abs(taken[s] - want[s]) <= 1
    again = {r["doc_id"]: (r["taken"], r["first_position"]) for r in mixing.plan_mix(docs.repartition(7)).collect()}
    assert again == {i: (r["taken"], r["first_position"]) for i, r in got.items()}


def test_inverted_demand_is_the_inverse(spark):
    for knots in mixing.SCHEDULES:
        shares = [i / 20 for i in range(21)]
        df = spark.createDataFrame([(s,) for s in shares], "s double")
        times = [r[0] for r in df.select(mixing.invert_demand(F.col("s"), knots)).collect()]
        assert times == sorted(times) and times[0] == 0 and times[-1] == pytest.approx(1)

        def integral(t):
            total = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                e = min(max(t, t0), t1)
                we = w0 + (w1 - w0) * (e - t0) / (t1 - t0)
                total += (e - t0) * (w0 + we) / 2
            return total

        for s, t in zip(shares, times):
            assert integral(t) / integral(1.0) == pytest.approx(s, abs=1e-9)


def test_curriculum_order_and_copies(spark, awkward, empty):
    out = mixing.curriculum(awkward)
    assert out.columns == awkward.columns
    words = sum(len((r["text"] or "").split()) for r in out.collect())
    plan = mixing.plan_mix(awkward)
    assert words == plan.agg(F.sum("taken")).first()[0]
    assert plan.count() == awkward.count()
    assert mixing.curriculum(empty).count() == 0 and mixing.plan_mix(empty).count() == 0


def test_equal_rows_share_no_window(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 50)
    rows = [(7, "a hot row", "s")] * 400 + [(None, None, "s")] * 300 + [(None, "x y", None)] * 30 + [(1000 + i, "w " * (i % 9), "t") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    plan = mixing._plan(stash(docs.select(*mixing._sized(docs, "doc_id", "text", "source"))))
    hot = [r for r in plan.collect() if r["doc_id"] == 7]
    assert len(hot) == 5 and sum(r["__copies"] for r in hot) == 400
    got = mixing.plan_mix(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len((t or "").split())) for i, t, _ in rows)
    taken, target = Counter(), {}
    for r in got:
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    places = [r["first_position"] for r in got if r["first_position"] is not None]
    assert places == sorted(places) and all(r["first_position"] is None for r in got[len(places) :])
    out = mixing.curriculum(docs)
    assert sum(len((r["text"] or "").split()) for r in out.collect()) == sum(taken.values())


def test_cut_texts_keep_their_white_space(spark):
    text = "\n\ta  b\r\n c\n\nd e"
    df = spark.createDataFrame([(n, text) for n in (1, 3, 5)], "n long, text string")
    got = {r[0]: r[1] for r in df.select("n", mixing.first_words(F.col("text"), F.col("n"))).collect()}
    assert got == {1: "\n\ta", 3: "\n\ta  b\r\n c", 5: text}


def test_the_chosen_shard_is_the_best_draw(spark):
    weights = {0: 1.0, 1: 2.5, 4: 0.5}
    draws = [(F.log((F.shiftrightunsigned(F.xxhash64(F.lit("shard"), F.lit(s), F.col("id")), 11).cast("double") + 0.5) / 2.0**53) / w).alias(str(s)) for s, w in weights.items()]
    for r in spark.range(500).select("id", sharding.rendezvous(F.col("id"), weights).alias("got"), *draws).collect():
        assert r["got"] == max(weights, key=lambda s: r[str(s)])


def test_rows_that_are_split_otherwise_are_an_error(spark, awkward, monkeypatch):
    """A table that isn't the same in two passes fails; it doesn't lose rows."""
    sized, calls = mixing._sized, []

    def moved(*args):
        calls.append(args)
        return [*sized(*args)[:-1], (F.spark_partition_id() + len(calls)).alias("__part")]

    monkeypatch.setattr(mixing, "_sized", moved)
    with pytest.raises(Exception, match="a row has no plan"):
        mixing.curriculum(stash(awkward), written=True).collect()
