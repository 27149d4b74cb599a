import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.llm import runs as R


def plain_runs(w, times=4, least=6):
    """For each distance, the longest stretches of equal words; the smallest period decides."""
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, times * q):
                part = w[i : i + size]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def made(rng):
    w = []
    for _ in range(rng.randint(0, 5)):
        if rng.random() < 0.4:
            w += [rng.randint(0, rng.choice([1, 2, 5, 30])) for _ in range(rng.randint(0, 15))]
        else:
            block = [rng.randint(0, rng.choice([1, 3, 9])) for _ in range(rng.randint(1, 9))]
            w += block * rng.randint(1, 7) + block[: rng.randint(0, len(block))]
    return w


@pytest.mark.parametrize("times,least", [(4, 6), (2, 2), (3, 2), (2, 5), (5, 20)])
def test_runs_are_those_of_a_plain_search(times, least):
    rng = random.Random(times * 100 + least)
    for _ in range(500):
        docs = [made(rng) for _ in range(rng.randint(1, 5))]
        starts = np.concatenate([[0], np.cumsum([len(d) for d in docs], dtype=np.int64)])
        want = {k: r for k, d in enumerate(docs) if (r := plain_runs(d, times, least))}
        assert R.runs_of_texts(np.array([x for d in docs for x in d], np.int32), starts, times, least) == want
        assert [R.runs_of(d, times, least) for d in docs] == [plain_runs(d, times, least) for d in docs]


def test_the_sieve_loses_nothing_when_keys_meet(monkeypatch):
    """Grams of one word make many parts to look at; the runs stay the same."""
    rng = random.Random(3)
    docs = [made(rng) + [rng.randint(0, 400) for _ in range(60)] + made(rng) for _ in range(200)]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs], dtype=np.int64)])
    words = np.array([x for d in docs for x in d], np.int32)
    found, parts = R.runs_of_texts(words, starts), R.stretches(words, starts)
    monkeypatch.setattr(R, "GRAM", 1)
    more = R.stretches(words, starts)
    assert R.runs_of_texts(words, starts) == found and (more[1] - more[0]).sum() > (parts[1] - parts[0]).sum()


def test_colours_are_last_ends():
    """Each state on the path of a prefix says where its words ended last before."""
    rng = random.Random(4)
    for _ in range(200):
        words = [rng.randint(0, 2) for _ in range(rng.randint(1, 40))]
        tree = R.LinkTree(words)
        for i in range(len(words)):
            reach = dict.fromkeys(range(1, i + 2))
            for size in reach:
                ends = [e for e in range(size - 1, i) if words[e - size + 1 : e + 1] == words[i - size + 1 : i + 1]]
                reach[size] = max(ends, default=None)
            longest = {}
            for size, end in reach.items():
                if end is not None:
                    longest[end] = size
            assert {e: n for e, n in tree.access(i) if n} == longest


def test_long_periodic_text():
    block = [k * 7919 % 1000 for k in range(1000)]
    assert R.runs_of(block * 12 + block[:7]) == [(0, 12007, 1000)]
    assert R.runs_of([5] * 30_000) == [(0, 30_000, 1)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def dropped(words, runs):
    gone = {p for s, n, q in runs for p in range(s + q, s + n)}
    return " ".join(w for p, w in enumerate(words) if p not in gone)


def test_rows(spark, awkward, empty):
    more = spark.createDataFrame([(70, "x a b a b a b a b y " + "z " * 9), (71, "  " * 8), (72, "q\x1cr " * 6)], "doc_id long, text string")
    docs = awkward.unionByName(more, allowMissingColumns=True)
    rows = R.find_runs(docs, ["doc_id", "text", F.col("score").alias("period")]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        words = words_of(r["text"])
        want = plain_runs(words[:500]) if len(words) > 1000 else plain_runs(words)
        assert r["n_words"] == len(words) and [tuple(x) for x in r["runs"]] == want and r["collapsed"] == dropped(words, want)
    assert {r["doc_id"]: len(r["runs"]) for r in rows if r["doc_id"] in (70, 71, 72)} == {70: 2, 71: 1, 72: 1}
    assert R.find_runs(empty, ["text"]).count() == 0
    with pytest.raises(ValueError, match="two periods"):
        R.find_runs(docs, [], times=1)


def planted(words, key):
    h, n = zlib.crc32(str(key).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_query_against_a_plain_search(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = R.op12_automaton_runs(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    some = 0
    for r in rows:
        words = planted(words_of(texts[r["doc_id"]]), r["doc_id"])
        if len(words) > 3000:
            continue
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == want and r["n_runs"] == len(runs)
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)) and r["collapsed_sha256"] == sha(dropped(words, runs))
        some += bool(runs)
    assert some > 10
