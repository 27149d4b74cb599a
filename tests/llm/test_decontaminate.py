import random
import re
import tracemalloc

import pytest

from tidewire.llm import decontaminate as D


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(text, items):
    w, hit, found = words_of(text), set(), set()
    for name, item in items:
        v = words_of(item)
        n = min(13, len(v))
        windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if v else set()
        for k in range(len(w) - n + 1) if n else ():
            if tuple(w[k : k + n]) in windows:
                hit.update(range(k, k + n))
                if name is not None:
                    found.add(str(name))
    return len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block_words", [D.BLOCK_WORDS, 30])
def test_against_brute_force(spark, block_words, monkeypatch):
    monkeypatch.setattr(D, "SHARD_WORDS", 500)
    rng = random.Random(1)
    pool = ["alpha", "Beta", "c3", "é", "dd", "e-f", "g"]

    def text(n):
        return " ".join(rng.choice(pool) for _ in range(n))

    items = [(k, text(rng.choice([3, 12, 13, 14, 40]))) for k in range(12)] + [(None, text(20)), (3, text(15)), (98, None), (99, "--")]
    docs = []
    for i in range(80):
        t = text(rng.randint(0, 60))
        if i % 3 == 0:
            t += ". " + (rng.choice(items)[1] or "").upper() + " , " + text(5)
        docs.append((i, t))
    docs += [(100, None), (101, ""), (101, ""), (102, items[4][1] * 3)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = D.find_matches(df, bench, ["doc_id", df["text"].alias("t")], block_words=block_words).withColumn("bad", D.contaminated()).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["n_words"], r["n_hit"], r["items"], r["bad"]) == brute(r["t"], items)
        assert sum(b - a for a, b in r["spans"]) == r["n_hit"]
        assert (r["longest_match"] > 0) == (r["n_hit"] > 0)


def test_longest_match(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(1, "x " + item + " y"), (2, "x " + " ".join(f"w{i}" for i in range(5, 22)) + " y")]
    rows = D.find_matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"), ["doc_id"]).collect()
    assert {r["doc_id"]: (r["longest_match"], [list(s) for s in r["spans"]]) for r in rows} == {1: (30, [[1, 31]]), 2: (17, [[1, 18]])}


def longest_of(text, items):
    """The longest run of words from a window on that an item has too."""
    w, best = words_of(text), 0
    for _, item in items:
        v = words_of(item)
        n = min(13, len(v))
        for k in range(len(v) - n + 1) if v else ():
            for p in range(len(w) - n + 1):
                d = 0
                while p + d < len(w) and k + d < len(v) and w[p + d] == v[k + d]:
                    d += 1
                best = max(best, d if d >= n else 0)
    return best


def test_longest_match_against_all_places():
    rng = random.Random(4)
    pool = ["a", "b", "c"]
    for _ in range(40):
        items = [(str(k), " ".join(rng.choice(pool) for _ in range(rng.choice([2, 9, 13, 14, 30, 70])))) for k in range(6)]
        items += [(str(9), items[0][1] + " " + items[3][1])]
        texts = []
        for _ in range(5):
            a, b = rng.choice(items)[1].split(), rng.choice(items)[1].split()
            texts.append(" ".join([rng.choice(pool), *a[rng.randrange(len(a)) :], *b[: rng.randint(1, len(b))], rng.choice(pool)]).encode())
        block = D.Block.of([(n, [x.encode() for x in words_of(t)]) for n, t in items])
        for _, _, found in D._match(block, texts, None):
            assert found[3].to_pylist() == [longest_of(t.decode(), items) for t in texts]


def test_a_phrase_of_all_items_in_all_documents_stays_small():
    rng = random.Random(7)
    phrase = " ".join(f"p{i}" for i in range(13))

    def with_phrase(n):
        return " ".join(f"x{rng.randrange(50)}" for _ in range(n)) + " " + phrase + " " + " ".join(f"x{rng.randrange(50)}" for _ in range(n))

    n = 3000
    block = D.Block.of([(f"{k:05d}", [x.encode() for x in with_phrase(3).split()]) for k in range(n)])
    texts = [with_phrase(4).encode() for _ in range(n)]
    tracemalloc.start()
    rows = 0
    for a, b, found in D._match(block, texts, None):
        rows += b - a
        assert set(len(x) for x in found[2].to_pylist()) == {n} and min(found[1].to_pylist()) >= 13
    assert rows == n and tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()


def test_awkward_rows(spark, awkward, empty):
    bench = spark.createDataFrame([(1, "one")], "item_id long, text string")
    out = D.remove_contaminated(awkward, bench)
    assert out.columns == awkward.columns and out.count() == awkward.count() - 1
    none = bench.limit(0)
    assert D.remove_contaminated(awkward, none).count() == awkward.count()
    assert D.find_matches(empty, bench, ["doc_id"]).count() == 0
