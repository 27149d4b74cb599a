import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np

from tidewire.llm import rules
from tidewire.llm.components import components
from tidewire.llm.simhash import near_pairs


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    counts, hit = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7)), set()
    for k in range(len(w) - 7):
        if counts[tuple(w[k : k + 8])] > 1:
            hit.update(range(k, k + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_base_counts():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b ", " ", "é ", "\n", "#", "a\n", "\x0b", "\x85", "x y z x y z x y "]) for _ in range(rng.randint(0, 120)))
        raw = text.encode()
        assert rules.base_counts(raw, raw.split(b"\n"), raw.split()) == brute(text)


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n = int(rng.integers(1, 7))
        emit, move = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))

        def score(y):
            return sum(emit[t, y[t]] for t in range(n)) + sum(move[a, b] for a, b in zip(y, y[1:]))

        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert rules.viterbi(emit.tolist(), move.tolist()) == list(best)


def test_expectations_are_those_of_all_labellings():
    rng = np.random.default_rng(3)
    emit, move, mask = rng.normal(size=(1, 4, 2)), rng.normal(size=(2, 2)), np.ones((1, 4, 2))
    mask[0, 2, 1] = 0
    one, two = rules._expectations(emit, move, mask)
    weight, w1, w2 = 0.0, np.zeros((4, 2)), np.zeros((3, 2, 2))
    for y in itertools.product((0, 1), repeat=4):
        if y[2] == 1:
            continue
        p = np.exp(sum(emit[0, t, y[t]] for t in range(4)) + sum(move[a, b] for a, b in zip(y, y[1:])))
        weight += p
        for t in range(4):
            w1[t, y[t]] += p
        for t in range(3):
            w2[t, y[t], y[t + 1]] += p
    assert np.allclose(one[0], w1 / weight) and np.allclose(two[0], w2 / weight)


def test_whole_query_and_content_share(spark):
    rng = random.Random(4)

    def line(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)).capitalize() + "."

    docs = []
    for i in range(300):
        good = "\n".join(line(18) for _ in range(4))
        footer = "\nShare\nAll rights reserved\nCookie policy"
        junk = "\n".join("*** $$$ " + " ".join("#" + "".join(rng.choice("abc") for _ in range(3)) for _ in range(12)) for _ in range(4))
        docs.append((i, junk if i % 6 == 5 else good + footer if i % 2 else good))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in rules.label_quality(df, ["doc_id"]).collect()}
    for i, t in docs:
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(t)
        assert r["kept"] == (i % 6 != 5)
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
    assert all(rows[i]["content_share"] < 1 for i in range(1, 300, 6))


def test_lines_that_copies_share_are_not_frequent(spark):
    copies = [(i, "first line here.\nsecond line there.\nthird one.") for i in range(100)]
    spread = [(100 + i, f"text {i} begins.\nread our terms\nand {i} ends.") for i in range(60)]
    found = rules.frequent_lines(spark.createDataFrame(copies + spread, "doc_id long, text string"))
    assert len(found) == 1


def test_the_bar_of_frequent_lines_does_not_follow_the_corpus(spark, monkeypatch):
    filler = "\n".join(f"only {k} once" for k in range(9_000))
    rows = [(i, f"text {i} begins.\nread our terms\nand {i} ends.") for i in range(25)] + [(100 + i, filler.replace("once", f"once {i}")) for i in range(70)]
    assert len(rules.frequent_lines(spark.createDataFrame(rows, "doc_id long, text string"))) == 1
    for hot in (1, 20_000):  # all by shuffle, all by broadcast
        monkeypatch.setattr(rules, "HOT", hot)
        table = rules.read_lines(spark.createDataFrame(rows[:25] * 2, "doc_id long, text string"), ["doc_id"])
        marks = rules.frequent_marks(table, rules.frequent_table(rules.read_lines(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]))).collect()
        assert len(marks) == 50 and len({r["row"] for r in marks}) == 50 and all(len(r["frequent"]) == 1 for r in marks)


def test_every_line_of_a_shared_block_is_frequent(spark):
    rng = random.Random(6)

    def line(n=9):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))

    block = ["Share this page", "All rights reserved", "Cookie policy", "Terms of use"]
    pages = [(i, "\n".join([line(), line(), *block, line()])) for i in range(40)]
    base = [line(12) for _ in range(12)]
    near = [(100 + i, "\n".join([*base, f"seen {i}"])) for i in range(60)]  # what copies share is not
    table = rules.read_lines(spark.createDataFrame(pages + near, "doc_id long, text string"), ["doc_id"])
    counts = {r["hash"]: r["n"] for r in rules.frequent_table(table).collect()}
    assert set(rules.line_features([x.encode() for x in block])[2]) <= set(counts)
    roots = dict(components(near_pairs(table.select("fingerprint").distinct())).collect())
    want = defaultdict(set)
    for r in table.collect():
        for h in r["hashes"]:
            want[h].add(roots.get(r["fingerprint"], r["fingerprint"]))
    assert counts == {h: len(c) for h, c in want.items() if len(c) >= rules.FREQUENT_LEAST}
    assert len(counts) == 4


def test_awkward_rows(awkward, empty):
    rows = rules.label_quality(awkward, ["doc_id", awkward["text"].alias("t")]).collect()
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(r["t"])
        assert r["kept"] is not None and (r["n_words"] or (r["base_failed"] and not r["kept"] and r["content_share"] == 0))
    assert rules.label_quality(empty, ["doc_id"]).count() == 0


def test_training_reads_whole_texts_and_no_partitioning_matters(spark, monkeypatch):
    monkeypatch.setattr(rules, "MAX_TRAIN", 40)
    rng = random.Random(8)
    rows = [(i, "\n".join(f"{rng.choice('abcdef')} {i} {k} words stand here ." for k in range(rng.randint(1, 300)))) for i in range(60)] + [(70, None), (71, "")]
    df = spark.createDataFrame(rows * 2, "doc_id long, text string")
    found = []
    for part in (1, 7):
        table = rules.read_lines(df.repartition(part), ["doc_id"])
        got = rules.training_sequences(table, rules.frequent_table(table))
        assert all(0 < len(s) <= rules.MAX_LINES for s in got) and 10 <= len(got) <= 90
        found.append(sorted(got))
    assert found[0] == found[1]
    last = 1 << rules.FEATURES.index("last")
    assert any(s[-1] & last and not s[0] & 1 << rules.FEATURES.index("first") for s in found[0])
    out = [{(r["doc_id"], r["content_share"], r["kept"]) for r in rules.label_quality(df.repartition(p), ["doc_id"]).collect()} for p in (1, 7)]
    assert out[0] == out[1]
