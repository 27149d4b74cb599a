import random
import re

import pytest
from pyspark.sql import functions as F

from tidewire.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    d = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = sum(int(c) for c in d[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in d[-2::-2])
        return 13 <= len(d) <= 19 and twice % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


TEXTS = [
    "a@b.c_d@e.f x@y a@b..c @ a@ @b.c %@-.-", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 1.2.3 1..2.3.4 255.255.255.256", "+1 (552) 555-3899 and +12 +1234567890123456 +1-2",
    "4971479635890992 4971-4796-3589-0992 4971 4796 3589 0992 4971479635890993 12 3", "é" * 10 + " z@é.com q@w.eu" + " 12" * 500 + " a.b@c.de " + "a@b.c " * 200,
    "日本 user.name+tag@mail.example.com; tel +49 (0)30 123456-78 ip 10.0.0.1, card 4111 1111 1111 1111.", None, "", "no data at all", "1" * 30_000, "a" * 30_000 + "@", "+" * 2000,
]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    return {r["doc_id"]: r for r in pii.find_personal_data(docs, pii.Redactor(), [F.col("doc_id")]).collect()}


def test_base_spans(found):
    for i, text in enumerate(TEXTS):
        want = brute(text)
        assert [tuple(s) for s in found[i]["base"]] == want
        assert [tuple(s) for s in found[i]["spans"]] == want
        assert [found[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in want) for k in pii.KINDS]


def test_trees_add_spans_and_keep_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, "write to jane.roe at mail7 dot example dot com or 4971 4796 3589 0992 4971-4796-3589-0992 today")], "doc_id long, text string")
    docs = docs.unionByName(extra)
    model = pii.fit(docs)
    assert model.trees and model.thresholds
    rows = {r["doc_id"]: r for r in pii.find_personal_data(docs, model, [F.col("doc_id")]).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i, r in rows.items():
        base = [tuple(s) for s in r["base"]]
        spans = [tuple(s) for s in r["spans"]]
        assert base == brute(texts[i]) and set(base) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        added = sorted(s[1:] for s in set(spans) - set(base))
        assert all(a[1] <= b[0] for a, b in zip(added, added[1:]))
        assert all(e <= s[1] or s[2] <= b for b, e in added for s in base)
    assert len(rows[-1]["spans"]) > len(rows[-1]["base"])


#: Formats that are not among those learned from; none for look-alikes.
OTHER = (
    ("email", "~~~~~ (at) ~~~~~~.com"), ("email", "~~~~.~~~ at ~~~~~~ dot net"), ("email", "~~~~~ [at] ~~~~ dot org"), ("email", "~~@ ~~~~~~~.de"), ("email", "~~~~~~ @ ~~~~ . com"),
    ("ip", "& ,&, & ,&"), ("ip", "&[dot]&[dot]&[dot]&"), ("ip", "^^^:^^^^:^^:^^^^:^^^^:^^^^:^:^^^^"), ("ip", "fe80::^^^^:^^"), ("card", "####. ####. ####. ###*"), ("card", "#### / #### / #### / ###*"),
    ("phone", "00%# %## ######"), ("phone", "0%###/######"), ("phone", "(0%##) ######"), ("phone", "0%# ### ## ##"), ("phone", "%## ### ####"), ("phone", "0%#-###-####"),
    (None, "20##/0%/1# 1#"), (None, "%# %# %#"), (None, "%## ## %##"), (None, "~~~~ at ~~~~ dot"), (None, "~~~ at ~~~.And"), (None, "2#:1#:0#.###"), (None, "%#,###,###.##"), (None, "&, &, &, &, &"),
    (None, "%-%%%-%####-%"), (None, "20##-20##"), (None, "0%.1#.20## 1#:2#"), (None, "%# x %# x %#"), (None, "^^^^^^^-^^^^^^^"), (None, "%### %### %### %### %###"),
)


def test_recall_and_precision_of_other_formats(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = pii.fit(docs)
    assert set(model.thresholds) == set(pii.KINDS)
    made = pii.made_texts(docs, "text", OTHER, seed="held out", bound=3000).withColumn("doc_id", F.monotonically_increasing_id())
    rows = pii.find_personal_data(made, model, ["doc_id", "kind", "pattern", "start", F.length("value").alias("n")], "__text").collect()
    real = [r for r in rows if r["kind"]]
    hit = [any(s["start"] < r["start"] + r["n"] and r["start"] < s["end"] for s in r["spans"]) for r in real]
    wrong = [len(r["spans"]) > 0 for r in rows if not r["kind"]]
    recall, precision = sum(hit) / len(real), sum(hit) / (sum(hit) + sum(wrong))
    assert recall >= 0.9 and precision >= 0.9, (recall, precision)
    named = sum(any(s["kind"] == r["kind"] for s in r["spans"]) for r in real) / len(real)
    assert named >= 0.85


def test_spans_by_hand(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    real = ["call 0049 30 1234567 now", "tel 07700 900123", "2001:0db8:85a3:0000:0000:8a2e:0370:7334 up", "from 192,168,0,1 today", "jane@ example.com wrote", "john [at] mail [dot] org", "z" * 90 + " at example dot com"]
    none = ["on 2024-01-02 10 he", "12 34 56 78 90", "see 1,234,567.89", "at home.Then we", ""]
    df = spark.createDataFrame(list(enumerate(real + none)), "doc_id long, text string")
    rows = {r["doc_id"]: len(r["spans"]) for r in pii.find_personal_data(df, pii.fit(docs), [F.col("doc_id")]).collect()}
    assert [rows[i] for i in range(len(real))] == [1] * len(real)
    assert all(rows[i] == 0 for i in range(len(real), len(rows)))


def plain_greedy(spans):
    kept = []
    for less, start, end, nth in sorted((less, start, end, nth) for start, less, end, nth in spans):
        if not any(k[1] < end and start < k[2] for k in kept):
            kept.append((less, start, end, nth))
    return sorted(kept)


def test_overlaps_are_settled_by_score(spark):
    rng = random.Random(3)
    rows = [[(0, -0.9, 10, 0), (8, -0.8, 20, 1), (18, -0.7, 30, 2)], [(0, -0.7, 10, 0), (8, -0.8, 20, 1), (18, -0.9, 30, 2)], []]
    for _ in range(200):
        rows.append(sorted((s := rng.randrange(60), -rng.randrange(30, 100) / 100, s + rng.randint(1, 15), rng.randrange(4)) for _ in range(rng.randrange(14))))
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s array<struct<start:long,less:double,end:long,nth:int>>")
    for r in df.select("i", pii.greedy(F.col("s")).alias("kept")).collect():
        assert sorted(tuple(k) for k in r["kept"]) == plain_greedy(rows[r["i"]])


def test_awkward_rows(awkward, empty):
    rows = pii.find_personal_data(awkward, pii.fit(awkward), [F.col("doc_id")]).collect()
    assert len(rows) == awkward.count() and all(r["spans"] == [] for r in rows)
    assert pii.find_personal_data(empty, pii.fit(empty), [F.col("doc_id")]).count() == 0


def test_words_around_made_up_spans_come_from_anywhere(spark):
    rows = [(i, "early " * 900 + f"late{'x' * i} " * 900) for i in range(1, 40)]
    made = pii.made_texts(spark.createDataFrame(rows, "doc_id long, text string"), "text", bound=400).select("__text").collect()
    late = sum("late" in r[0] for r in made)
    assert 0.1 < late / len(made) < 0.95 and any("early" in r[0] for r in made)
