import random

from pyspark.sql import functions as F

from tidewire.llm.common import DRAW_BITS, cut_of, distinct_sample, labelled_sample


def test_the_share_is_never_nothing():
    for n in (1, 10, 10**6, 10**11, 10**15):
        for bound in (1, 2_000, 20_000):
            cut = cut_of(bound, n)
            assert 0 < cut < 1 << DRAW_BITS
            assert n <= bound or abs(cut / (1 << DRAW_BITS) * n - bound) < 1e-3 * bound + 1
    assert cut_of(2_000, 0) == (1 << DRAW_BITS) - 1


def test_any_partitioning_gives_the_same_values(spark):
    rng = random.Random(1)
    rows = [(f"text {rng.randrange(4000)}",) for _ in range(9000)] + [("hot",)] * 3000 + [(None,)] * 50
    df = spark.createDataFrame(rows, "text string")
    drawn = []
    for p in (1, 3, 11):
        sample, stands = distinct_sample(df.repartition(p), "text", 500)
        drawn.append(sorted(r[0] for r in sample.collect()))
        assert len(set(drawn[-1])) == len(drawn[-1]) and 350 < len(drawn[-1]) < 650 and 6 < stands < 9
    assert drawn[0] == drawn[1] == drawn[2]
    assert distinct_sample(df, "text", 10_000)[0].count() == len({r[0] for r in rows}) - 1
    assert distinct_sample(df.limit(0), "text", 5)[0].count() == 0
    few = distinct_sample(df, "text", 500, n=10**11)[0]  # as if this were one part of very many
    assert few.count() <= 1


def test_labelled_rows_have_a_bound_and_weights(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 10 == 0).cast("int").alias("toxic"))
    rows = labelled_sample(docs.unionByName(docs), labels, "toxic", "doc_id", "text", lambda c: c < 0, 300).collect()
    clean = [r for r in rows if not r["label"]]
    assert 220 < len(clean) < 380 and abs(sum(r["weight"] for r in clean) - 3600) < 800
    assert len({r["text"] for r in rows}) == len(rows)
