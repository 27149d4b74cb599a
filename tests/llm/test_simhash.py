import random
import re
from collections import defaultdict

import xxhash
from pyspark.sql import functions as F

from tidewire.llm import simhash
from tidewire.llm.components import components


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def roots_of(nodes, linked):
    root = {n: n for n in nodes}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(spark, awkward):
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdef") for _ in range(4)) for _ in range(300)]
    texts = []
    for _ in range(60):
        t = list(base)
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(300)] = "changed"
        texts.append(" ".join(t))
    texts += [texts[0]] * 5 + ["", None, " ", "A B", "a b", "tschüß ÄÖ é"]
    docs = spark.createDataFrame(list(enumerate(texts, 10)), "doc_id long, text string")
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts)
    prints = {r["doc_id"]: r["fingerprint"] & (2**64 - 1) for r in rows}
    assert prints == {i: brute_print(t) for i, t in enumerate(texts, 10)}
    root = roots_of(set(prints.values()), lambda a, b: bin(a ^ b).count("1") <= 2)
    least = defaultdict(lambda: 1 << 60)
    for i, p in prints.items():
        least[root[p]] = min(least[root[p]], i)
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: least[root[p]] for i, p in prints.items()}
    kept = {r["doc_id"] for r in simhash.deduplicate(docs).collect()}
    assert kept == set(least.values())


def test_dense_and_sparse_buckets_lose_no_link(spark, monkeypatch):
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    prints = {centre}
    for _ in range(250):
        p = rng.choice(sorted(prints))
        prints.add(p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    prints |= {rng.getrandbits(64) for _ in range(100)}
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    want = roots_of(signed, lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= 2)
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    for dense in (1, 4, 10_000):
        monkeypatch.setattr(simhash, "DENSE", dense)
        got = {r["node"]: r["root"] for r in components(simhash.near_pairs(df)).collect()}
        assert {p: got.get(p, p) for p in signed} == want


def test_pigeonring_keeps_every_pair_within_the_distance(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(400):
        a, b = rng.getrandbits(64), 0
        for bit in rng.sample(range(64), rng.randint(0, 2)):
            b |= 1 << bit
        x, y = a, a ^ b
        rows.append(tuple(v - 2**64 if v >= 2**63 else v for v in (x, y)))
    df = spark.createDataFrame(rows, "a long, b long")
    held = [simhash.chain_holds(df["a"], df["b"], s).alias(f"s{s}") for s in range(4)]
    assert all(any(r) for r in df.select(*held).collect())
    for segments in simhash.LEVELS:
        keys = [F.transform(simhash.ring_keys(df[c], segments), lambda k: F.struct(k["tag"], k["key"])) for c in "ab"]
        meets = F.arrays_overlap(*keys) & (F.size(F.array_distinct(keys[0])) == segments * segments // 2)
        held = [simhash.chain_holds(df["a"], df["b"], s, segments).alias(f"s{s}") for s in range(segments)]
        assert all(r[0] and any(r[1:]) for r in df.select(meets, *held).collect())


def test_the_last_level_has_small_buckets(spark):
    rng = random.Random(11)
    prints = [rng.getrandbits(8) << 40 | rng.getrandbits(4) for _ in range(3000)]
    df = spark.createDataFrame([(p,) for p in set(prints)], "fingerprint long")
    keyed = df.select(F.inline(simhash.ring_keys(F.col("fingerprint"), simhash.LEVELS[-1])))
    assert keyed.groupBy("tag", "key").count().agg(F.max("count")).first()[0] <= 256


def test_awkward_rows(awkward, empty):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    zero = [r for r in rows if r["fingerprint"] == 0]
    assert len(zero) == 4 and {r["component_id"] for r in zero} == {1}
    kept = simhash.deduplicate(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == len({r["root"] for r in rows})
    assert simhash.near_duplicates(empty).count() == 0 and simhash.deduplicate(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(500, i) for i in range(501, 700)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and all(got[i] == 500 for i in range(501, 700))
