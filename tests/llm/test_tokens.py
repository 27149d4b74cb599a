import random
import re

import pytest
from pyspark.sql import functions as F

from tidewire.llm import tokens as K

PIECES = ["a", "b", "é", " ", "  ", "\n", "1", "23", "'s", "'", "ll", "!?", "word", " the", "\t", "x y", "日本", "'re"]


@pytest.mark.parametrize("block", [1, 2, 5, 64])
def test_edits_agree_with_counting_anew(block, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", block)
    of, rng = K.counter(), random.Random(block)
    for _ in range(400):
        text = "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 1, 3, 20, 80])))
        tree = K.Tree.of(*of.blocks(text))
        for _ in range(rng.randint(1, 5)):
            a = rng.randint(0, len(text))
            b = min(len(text), a + rng.choice([0, 1, 2, 5, 30]))
            text, _ = K.apply_edit(tree, text, a, b, "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 0, 1, 4, 30]))), of)
            assert tree.total == len(of.encoding.encode_ordinary(text))
            assert tree.chars[1] == len(text)


def test_only_the_region_is_encoded_again():
    of = K.counter()
    text = "some words and more words here " * 5000
    tree = K.Tree.of(*of.blocks(text))
    at = len(text) // 2
    edited, touched = K.apply_edit(tree, text, at, at + 5, "other", of)
    assert touched < 2000 and tree.total == len(of.encoding.encode_ordinary(edited))


def test_documents_and_edits(spark, awkward, empty):
    one = spark.createDataFrame([(50, "A title\nwrite to a.b@c.de or 123456789012 now")], "doc_id long, text string")
    docs = K.add_redactions(awkward.unionByName(one, allowMissingColumns=True))
    trees = K.build_trees(docs, ["doc_id", "text", "edits"])
    rows = K.apply_edits(trees, ["doc_id", "text", "n_tokens", trees["edits"].alias("was")], "edits").collect()
    assert len(rows) == docs.count()
    count = K.counter().encoding.encode_ordinary
    for r in rows:
        text = r["text"] or ""
        assert r["n_tokens"] == len(count(text))
        for e in reversed(r["was"] or []):
            text = text[: e["start"]] + e["new"] + text[e["end"] :]
        assert r["n_tokens_edited"] == len(count(text))
    last = next(r for r in rows if r["doc_id"] == 50)
    assert [tuple(e) for e in last["was"]] == [(0, 8, ""), (17, 25, "[removed]"), (29, 41, "[removed]")]
    assert K.apply_edits(K.build_trees(K.add_redactions(empty), ["text", "edits"]), [], "edits").count() == 0


def plain_edits(text):
    """The edits, character by character: the longest local part that reaches an @, or the digits."""
    local, host = re.compile(r"[A-Za-z0-9._%+-]"), re.compile(r"[A-Za-z0-9.-]")
    first, newline, _ = text.partition("\n")
    line = len(first) + 1 if newline and 1 <= len(re.findall(r"[^\x20\x09-\x0D]+", first)) <= 8 else 0
    edits, at = [(0, line, "")] if line else [], 0
    while at < len(text):
        end = at
        while end < len(text) and local.match(text[end]):
            end += 1
        stop = end + 1
        while end > at and text[end : end + 1] == "@" and stop < len(text) and host.match(text[stop]):
            stop += 1
        if stop == end + 1:
            stop = at
            while stop < len(text) and "0" <= text[stop] <= "9":
                stop += 1
            stop = stop if stop - at >= 9 else at
        if stop > at:
            if at >= line:
                edits.append((at, stop, "[removed]"))
            at = stop
        else:
            at += 1
    return edits


def test_edits_agree_with_a_plain_search(spark):
    rng, pieces = random.Random(9), ["a", "b.c", "@", "@d.e", "_", "%", " ", "  ", "\n", "\t", "\r", "é", "1234567", "123456789", "7" * 70, "x" * 70, "h" * 260, "two words "]
    texts = ["l" * 100 + "@b.c now", "a@b.c_d@e", "A title \nrest", "w" * 80 + "\nrest", "x@" + "h" * 300 + "@c", "9" * 1000, "x@" + "h" * 1000 + ".com now", "y" * 70 + "7" * 1000 + "@z", "@123456789_z@q", "one two three four five six seven eight nine\nrest"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(600)]
    rows = K.add_redactions(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        assert [tuple(e) for e in r["edits"]] == plain_edits(r["text"]), r["text"]


def test_trees_take_edits_in_turn(spark):
    docs = spark.createDataFrame([(1, "one two three four five")], "doc_id long, text string")
    bad = K.build_trees(docs.withColumn("edits", F.expr("array(struct(5L as start, 2L as end, '' as new))")), ["text", "edits"])
    with pytest.raises(Exception, match="overlaps or leaves"):
        K.apply_edits(bad, [], "edits").collect()


def test_edits_at_one_place_stay_local():
    of = K.counter()
    text = "some words and more words here " * 3000
    document = K.Document(K.Tree.of(*of.blocks(text)), text)
    at, touched = len(text) // 2, []
    for k in range(40):
        touched.append(document.edit(at, at, f"another {k} thing is put in here " * 40, of))
    assert document.tree.total == len(of.encoding.encode_ordinary(document.text()))
    assert max(touched) < 3 * 40 * 35 and max(map(len, document.parts)) < 2000


@pytest.mark.parametrize("block", [1, 3, 64])
def test_many_edits_of_one_document(block, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", block)
    of, rng = K.counter(), random.Random(block)
    for _ in range(60):
        text = "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 10, 200])))
        document = K.Document(K.Tree.of(*of.blocks(text)), text)
        for _ in range(30):
            a = rng.randint(0, len(text))
            b, new = min(len(text), a + rng.choice([0, 1, 9, 60])), "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 1, 8, 90])))
            text = text[:a] + new + text[b:]
            document.edit(a, b, new, of)
            assert document.text() == text and document.tree.chars[1] == len(text)
            assert document.tree.total == len(of.encoding.encode_ordinary(text))


def test_bad_edits_are_a_disposition(spark):
    docs = spark.createDataFrame([(1, "one two three", 5, 2), (2, "one two three", 3, 99), (3, "one two three", 0, 3), (4, None, 0, 1)], "doc_id long, text string, a long, b long")
    trees = K.build_trees(docs.withColumn("edits", F.expr("array(struct(a as start, b as end, 'x' as new))")), ["doc_id", "text", "edits", F.lit(7).alias("n_reencoded")])
    rows = {r["doc_id"]: r for r in K.apply_edits(trees, ["doc_id", "n_tokens"], "edits", mark=True).collect()}
    assert {i: r["edits_ok"] for i, r in rows.items()} == {1: False, 2: False, 3: True, 4: False}
    assert all(rows[i]["n_tokens_edited"] == rows[i]["n_tokens"] and rows[i]["n_reencoded"] == 0 for i in (1, 2, 4))
