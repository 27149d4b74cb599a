import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewire.llm import alignment as A
from tidewire.llm.common import blocks_of

PARTS = [
    "a", "b", " ", "  ", "\n", " \n", "\t", "é", "日本", "1", "23", "!", "?!", "'s", "'", "\x00", " ", " ", "\x1c", "😀", "é", "<s>", "</s>", "<unk>", "<0x41>", "the", "　", "﻿",
    "​", "\x85", "ﬁ", "<|endoftext|>", "tokenizer", "Überraschung", " the", " of", "antidisestablishment", "\n\n", "      ",
]


class Plain:
    """Both libraries over whole texts; groups and links token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(A.BYTES)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=A.PIECES)
        self.of = A.pair()

    def tokens(self, text):
        if not text:
            return [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        raw = (" " + text).encode()
        if b"".join(self.of.a_bytes[i] for i in a) != raw or b"".join(self.of.b_bytes[i] for i in b) != raw:
            return [], []
        return a, b

    def align(self, text):
        a, b = self.tokens(text)
        spans = []
        for ids, names in ((a, self.of.a_bytes), (b, self.of.b_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(names[i]), i))
                at += len(names[i])
            spans.append(own)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        place = {cut: k for k, cut in enumerate(cuts)}
        parts = [([], []) for _ in cuts]
        for side, own in enumerate(spans):
            at = 0
            for _, e, i in own:
                parts[at][side].append(str(i))
                at += e in place
        groups = ["|".join(map(",".join, p)) for p in parts]
        links = [(i, j) for s, e, i in spans[0] for t, f, j in spans[1] if s < f and t < e] if len(text or "") < 5000 else None
        return len(a), len(b), groups, links


@pytest.fixture(scope="module")
def plain():
    return Plain()


def test_bytes_of_tokens_are_the_libraries_own(plain):
    text = " Überraschung 日本 😀 x\n"
    assert b"".join(plain.of.a_bytes[i] for i in plain.a.encode(text).ids).decode() == text
    assert all(plain.of.b_bytes[i] == (bytes([int(p[1:-1], 16)]) if plain.b.is_byte(i) else p.replace("▁", " ").encode()) for i in range(32000) for p in [plain.b.id_to_piece(i)])


@pytest.mark.parametrize("together", [1, 3, 1000])
def test_chunks_against_whole_texts(plain, together, monkeypatch):
    monkeypatch.setattr(A, "TOGETHER", together)
    rng = random.Random(together)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 25))) for _ in range(1500)] + [" ", "  ", "\n", "x▁y z", "▁", "a ▁", " ▁ b c"]
    chunks = A.Chunks(plain.of)
    for part in (texts[:700], texts[700:]):
        chunks.cut([t.encode() for t in part])
    block, number = A.Block(chunks, np.arange(len(chunks.table))), chunks.table
    groups = block.groups.to_pylist()
    for t in texts:
        own = [number[c] for c in A.CUT.split(t)]
        n_a, n_b, want, links = plain.align(t)
        if not n_a:
            assert not block.whole[own].all()
            continue
        assert block.whole[own].all() and ";".join(groups[k] for k in own) == ";".join(want), repr(t)
        assert [sum(block.sums[c][own]) for c in A.TOTALS] == [n_a, n_b, len(want), len(links)]
        got = [divmod(int(block.pairs[p]), block.pair_base) for k in own for p in block.link[block.link_starts[k] : block.link_starts[k] + block.link_sizes[k]]]
        assert sorted(got) == sorted(links)


def test_pointer_jumping_over_long_components():
    """One component of many tokens: the two sequences of ends meet only at the last byte."""
    a, b = np.append(np.arange(2, 20_000, 2), 20_001), np.append(np.arange(1, 20_001, 2), 20_001)
    assert set(A.terminals(a, b).tolist()) == {len(a) - 1}
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = rng.integers(1, 60)
        a, b = (np.append(np.flatnonzero(rng.random(n) < 0.5), n) for _ in range(2))
        cuts = np.intersect1d(a, b)
        to = A.terminals(a, b)
        assert (a[to] == cuts[np.searchsorted(cuts, np.concatenate([a, b]))]).all()


def digest(groups):
    return hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""


def held(plain, rows, got):
    """The rows of a query against plain counting."""
    found = {k: plain.align(t) for k, t in rows}
    counts = Counter(x for *_, links in found.values() for x in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for r in got:
        n_a, n_b, groups, links = found[r["key"]]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (n_a, n_b, len(groups), len(links)), r
        assert (r["n_best"], r["count_sum"]) == (sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links))
        if "groups_sha256" in r:
            assert r["groups_sha256"] == digest(groups)


@pytest.mark.parametrize("bytes_of_block", [300, 8 << 20])
def test_rows_and_counts(spark, plain, awkward, empty, monkeypatch, bytes_of_block):
    monkeypatch.setattr(A, "BLOCK_BYTES", bytes_of_block)
    monkeypatch.setattr(A, "REMEMBERED", bytes_of_block // 10)
    rng = random.Random(6)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(90)] + ["x▁y z", "the x▁y", None, "", "the same"] * 2
    made = spark.createDataFrame([(100 + k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    small = awkward.where("coalesce(length(text), 0) < 1500").unionByName(made, allowMissingColumns=True)
    docs = small.withColumns({"key": F.monotonically_increasing_id(), "block": F.lit(1), "n_a": F.lit(2)})
    docs = A.stash(docs)
    blocks = A.stash(A.align_blocks(docs, ["key"]))
    scored = A.score_blocks(blocks, ["key"], A.link_counts(A.block_pairs(blocks))).collect()
    rows = [(r["key"], r["text"]) for r in docs.select("key", "text").collect()]
    assert len(scored) == len(rows)
    held(plain, rows, [r.asDict() for r in scored])
    spelled = {r["key"]: r["groups"] for r in A.align(docs, ["key"]).collect()}
    assert spelled == {k: ";".join(plain.align(t)[2]) for k, t in rows}
    none = A.stash(A.align_blocks(empty, ["doc_id"]))
    assert A.score_blocks(none, ["doc_id"], A.link_counts(A.block_pairs(none))).count() == 0


def test_long_text(spark, plain, awkward):
    row = A.align(awkward.where("doc_id = 6"), ["text"]).first()
    n_a, n_b, groups, _ = plain.align(row["text"])
    assert (row["n_a"], row["n_b"], row["n_groups"], row["groups"]) == (n_a, n_b, len(groups), ";".join(groups))


def test_query_against_plain_counting(spark, sf_dir, plain):
    """All of a small table, through the query itself."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = A.op13_pointer_jumping_alignment(spark, sf_dir).collect()
    assert len(got) == len(rows)
    found = {}
    for k, t in rows:
        a, b = plain.tokens(t)
        a_ends, b_ends = (np.cumsum([len(names[i]) for i in ids], dtype=np.int64) for ids, names in ((a, plain.of.a_bytes), (b, plain.of.b_bytes)))
        own, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            own.append((a[i], b[j]))
            i, j = i + (a_ends[i] <= b_ends[j]), j + (b_ends[j] <= a_ends[i])
        found[k] = own
    counts = Counter(x for links in found.values() for x in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for r in got:
        links = found[r["doc_id"]]
        assert r["n_links"] == len(links) and r["count_sum"] == sum(counts[x] for x in links)
        assert r["n_best"] == sum(counts[x] == most[x[1]] for x in links)
        assert (r["groups_sha256"] == "") == (r["n_a"] == 0)


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_blocks_do_not_depend_on_batches(rows):
    """Blocks are as full as they can be, whatever the batches; a longer value stands alone; no row is lost."""
    rng = random.Random(rows)
    texts = [None if k % 11 == 0 else b"x" * rng.choice([0, 3, 40, 99, 100, 101, 500]) for k in range(400)]
    whole = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts, pa.binary())], names=["key", "text"])
    batches = [whole.slice(0, 0), *(whole.slice(k, rows) for k in range(0, 400, rows)), whole.slice(0, 0)]
    blocks = [b.column(1).to_pylist() for b in blocks_of(batches, 100) if b.num_rows]
    assert [t for b in blocks for t in b] == texts
    want, room = [], -1
    for t in texts:
        if (n := len(t or b"")) > room:
            want.append([])
            room = 100
        want[-1].append(t)
        room -= n
    assert blocks == want


def test_the_query_holds_few_rows_in_a_batch(spark, sf_dir, tmp_path, monkeypatch):
    """Batches of rows to Python are bounded by bytes, so that long texts don't make them large; blocks stay as
    large, and the session as it was."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    longest, total = docs.agg(F.max(F.octet_length("text")), F.sum(F.octet_length("text"))).first()
    most = max(longest, total // 20)

    def watched(batches, size):
        def each():
            for b in batches:
                assert b.nbytes < most + longest + 50_000, b.nbytes
                yield b

        yield from blocks_of(each(), size)

    made = []
    monkeypatch.setattr(A, "BATCH_BYTES", most)
    monkeypatch.setattr(A, "blocks_of", watched)
    monkeypatch.setattr(A, "stash", lambda df, own=A.stash: made.append(own(df)) or made[-1])
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    assert total > 3 * (most + longest + 50_000)
    assert A.op13_pointer_jumping_alignment(spark, str(tmp_path)).count() == docs.count()
    assert spark.conf.get(name, None) == before
    assert made[0].where("pair_a is not null").count() == -(-total // A.BLOCK_BYTES)
