import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from tidewire.llm import bpe as B

PARTS = [
    "a", "B", " ", "  ", "\n", " \n", "\t", "é", "é", "日本", "1", "23", "!", "?!", "'s", "'S", "'", "ll", "\x00", " ", " ", "\x1c", "▁", "😀", "É", "the", "THE", "　", "﻿",
    "<|startoftext|>", "<|endoftext|>", "<|EndOfText|>", "<|", "​", "᠎", "\x85", "ﬁ", "İ", "Σ", "ΑΣ", "́", "aaaa", "ß", "ǅ", "ẞ", "Ⅷ", "Ა", "\U00010400", "ñ", "ŉ", "×", "ª",
]


def library():
    own = Tokenizer.from_file(B.WORDS)
    own.no_truncation()
    own.no_padding()
    return own


def of_library(own, text):
    ids = own.encode(text or "", add_special_tokens=False).ids
    return ids, own.decode(ids, skip_special_tokens=False)


def test_numbers_are_those_of_the_library():
    rng, own, encoder = random.Random(1), library(), B.Encoder(B.vocabulary())
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(4000)] + ["a" * 5001, "ab" * 3001, "", None]
    for part in (texts[:1000], texts[1000:], texts[:10], []):
        ids, ends = encoder.encode([None if t is None else t.encode() for t in part])
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [of_library(own, t)[0] for t in part]


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 5)
    encoder, own = B.Encoder(B.vocabulary()), library()
    for text in ("one two three four five six", "seven two <|endoftext|> nine", "one é x y z 12"):
        ids, _ = encoder.encode([text.encode()])
        assert ids.tolist() == of_library(own, text)[0]
        assert len(encoder.words) <= 5 + 7  # and those of one block


@pytest.mark.parametrize("seed", range(8))
def test_any_order_of_merges(seed):
    """Made-up merges, some of which join what a later one makes, against the library's own merging."""
    rng, letters = random.Random(seed), list(B.byte_letters())
    vocab = {c: i for i, c in enumerate(letters)} | {c + "$": 256 + i for i, c in enumerate(letters)}
    merges: list[tuple[str, str]] = []
    names = [c + e for c in "ab" for e in ("", "$")]
    while len(merges) < 40:
        a, b = rng.choice(names), rng.choice(names)
        if a.endswith("$") or (a, b) in merges or len(a + b) > 9:
            continue
        merges.append((a, b))
        vocab.setdefault(a + b, len(vocab))
        names.append(a + b)
    early = merges[:]
    rng.shuffle(early)
    early_found = False
    for order in (merges, early):
        own = Tokenizer(models.BPE(vocab=vocab, merges=order, end_of_word_suffix="$"))
        table = B.Merges(vocab, order, "$")
        early_found |= bool(table.early.any())
        words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 14))) for _ in range(300)] + ["a" * 40, "ab" * 30]
        ids, sizes = B.PairIndex(table, [w.encode() for w in words]).apply()
        got = [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == [own.encode(w, add_special_tokens=False).ids for w in words]
    assert early_found


def test_rows_there_and_back(spark, awkward, empty):
    own = library()
    more = spark.createDataFrame([(60, "A<|endoftext|>b c d"), (61, "x" * 3000)], "doc_id long, text string")
    docs = awkward.unionByName(more, allowMissingColumns=True)
    coded = B.encode(docs, ["doc_id", "text", F.col("score").alias("ids_of")])
    rows = B.decode(coded, ["doc_id", "text", "ids"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r["ids"], r["decoded"]) == of_library(own, r["text"])
    assert B.decode(B.encode(empty, ["doc_id"]), ["doc_id"]).count() == 0


def test_numbers_that_are_no_tokens(spark):
    rows = spark.createDataFrame([(1, [320, None, -1, 10**6, 49407]), (2, []), (3, None), (4, [None]), (5, [320, 320])], "k int, ids array<int>")
    got = {r["k"]: r["decoded"] for r in B.decode(rows, ["k"]).collect()}
    assert got == {1: "a</w> <|endoftext|>", 2: "", 3: None, 4: "", 5: "a</w> a</w>"}


def test_query_against_the_library(spark, sf_dir):
    own = library()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = B.op11_pair_index_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids, text = of_library(own, texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(text))


def test_parts_of_batches_are_bounded(monkeypatch, spark):
    monkeypatch.setattr(B, "BLOCK_BYTES", 40)
    docs = spark.createDataFrame([(i, "word " * (i % 20)) for i in range(200)], "doc_id long, text string").coalesce(1)
    assert all(len(r["ids"]) == r["doc_id"] % 20 for r in B.encode(docs, ["doc_id"]).collect())
