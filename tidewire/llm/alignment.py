"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping, with corpus-wide link counts.

Every token points to its farthest-right overlapping token of the other tokenizer; where the two end together,
the token of A points to itself. Doubling the successors of all tokens at once takes each to the terminal token
of its component, which labels its group.

Texts are cut before blanks between two characters that aren't white space: both tokenizers cut there whatever
stands around. A block of texts so has few different chunks, which are aligned once and counted.
"""

from __future__ import annotations

import itertools
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidewire.llm.bpe import Lists, byte_letters, numbering
from tidewire.llm.common import arrow_batches, blocks_of, read_table, stash

#: Tokenizer files that every executor has: byte-level pairs (A) and pieces with byte fallback (B).
BYTES, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of a batch of rows that the query passes to Python.
BATCH_BYTES = 1 << 20
#: Bytes of text in a block, chunks that go through a tokenizer in one text, and the chunks and bytes of chunks
#: that a task remembers.
BLOCK_BYTES, TOGETHER, REMEMBERED, REMEMBERED_BYTES = 3 << 20, 1000, 200_000, 16 << 20
#: Where both tokenizers cut.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: The character that B writes for a blank; texts that hold it don't come back from B's pieces.
BLANK = "▁"


class Pair:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a: str, b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        letters, marks = byte_letters(), {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        tokens = {i: marks[i] if i in marks else bytes(map(letters.__getitem__, t)) for t, i in self.a.get_vocab().items()}
        self.a_bytes = [tokens.get(i, b"") for i in range(1 + max(tokens))]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        if any(BLANK in p.lstrip(BLANK) for p in map(self.b.id_to_piece, range(len(self.b_bytes)))):
            raise ValueError(f"pieces with a blank inside: texts can't be cut before blanks: {b}")

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:-1], 16)])
        return self.b.id_to_piece(i).replace(BLANK, " ").encode()

    def _encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Numbers of A over a blank and each text, and of B, which puts the blank itself."""
        of_a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in of_a], self.b.encode(texts, num_threads=1)

    def _whole(self, text: str, a: list[int], b: list[int]) -> bool:
        raw = (" " + text).encode()
        return b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of A and of B over all chunks that come back whole from both, one behind the other, and which
        chunks these are.

        Chunks without white space at their ends are encoded many in one text, and one by one where such a text
        doesn't come back; the others one by one.
        """
        whole = np.ones(len(chunks), bool)
        a_parts, b_parts, at = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], 0
        groups: list[list[int]] = []
        open_group: list[int] = []
        for k, c in enumerate(chunks):
            if c and c == c.strip() and BLANK not in c:
                open_group.append(k)
                if len(open_group) < TOGETHER:
                    continue
            else:
                groups += [open_group] if open_group else []
                open_group = [k]
            groups.append(open_group)
            open_group = []
        groups += [open_group] if open_group else []
        while at < len(groups):
            some = groups[at : at + 16]
            at += 16
            texts = [" ".join(map(chunks.__getitem__, g)) for g in some]
            for g, text, a, b in zip(some, texts, *self._encode(texts)):
                if self._whole(text, a, b):
                    a_parts.append(np.array(a, np.int32))
                    b_parts.append(np.array(b, np.int32))
                    continue
                for k, own_a, own_b in zip(g, *self._encode([chunks[k] for k in g])):
                    whole[k] = self._whole(chunks[k], own_a, own_b)
                    if whole[k]:
                        a_parts.append(np.array(own_a, np.int32))
                        b_parts.append(np.array(own_b, np.int32))
        return np.concatenate(a_parts), np.concatenate(b_parts), whole


@lru_cache(maxsize=1)
def pair(a: str = BYTES, b: str = PIECES) -> Pair:
    return Pair(a, b)


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For each token of A, then of B, the token of A that ends its component; ends: bytes, the last ones equal."""
    n = len(a_ends)
    over_a, over_b = np.searchsorted(b_ends, a_ends), np.searchsorted(a_ends, b_ends)
    own = np.arange(n)
    to = np.concatenate([np.where(b_ends[over_a] == a_ends, own, n + over_a) if n else own, over_b])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to
        to = further


def links(a_ends: np.ndarray, b_ends: np.ndarray, a_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a token of A and one of B whose bytes overlap."""
    first, last = np.searchsorted(b_ends, a_ends - a_sizes, "right"), np.searchsorted(b_ends, a_ends)
    n = last - first + 1
    return np.repeat(np.arange(len(a_ends)), n), np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


class Chunks:
    """The different chunks met so far with their numbers of A and B, in bounded memory. Chunks that don't come
    back whole from both have no numbers."""

    def __init__(self, of: Pair):
        self.of = of
        self._forget()

    def _forget(self) -> None:
        self.table, self.a, self.b = numbering(), Lists(), Lists()
        self.whole, self.sizes = np.zeros(0, bool), np.zeros(0, np.int64)

    def cut(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The chunks of each text, by their places in the table."""
        if len(self.table) > REMEMBERED or self.sizes.sum() > REMEMBERED_BYTES:
            self._forget()
        known, seen, found = len(self.table), self.table.__getitem__, []
        for raw in texts:
            parts = CUT.split(raw.decode("utf-8", "replace")) if raw else []
            found.append(np.fromiter(map(seen, parts), np.int32, len(parts)))
        self._learn(list(itertools.islice(self.table, known, None)))
        return found

    def _learn(self, fresh: list[str]) -> None:
        a, b, whole = self.of.encode(fresh)
        sizes = np.fromiter((1 + len(c.encode()) for c in fresh), np.int64, len(fresh))
        edges = np.cumsum(sizes[whole])
        for held, ids, token_sizes in ((self.a, a, self.of.a_sizes), (self.b, b, self.of.b_sizes)):
            counts = np.zeros(len(fresh), np.int64)
            counts[whole] = np.bincount(np.searchsorted(edges, np.cumsum(token_sizes[ids])), minlength=len(edges))
            held.add(ids, counts)
        self.whole, self.sizes = np.concatenate([self.whole, whole]), np.concatenate([self.sizes, sizes])


class Block:
    """Some different chunks, aligned: sums and groups of each, its links as pairs of numbers."""

    def __init__(self, chunks: Chunks, chosen: np.ndarray):
        """chosen: places in the table of chunks, each once."""
        of, self.whole, self.n = chunks.of, chunks.whole[chosen], len(chosen)
        a, b, edges = chunks.a.take(chosen)[0], chunks.b.take(chosen)[0], np.cumsum(chunks.sizes[chosen][self.whole])
        a_sizes, b_sizes = of.a_sizes[a], of.b_sizes[b]
        a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
        to = terminals(a_ends, b_ends)
        ends = np.unique(to)
        group = np.searchsorted(ends, to)
        a_chunk, b_chunk = np.searchsorted(edges, a_ends), np.searchsorted(edges, b_ends)
        group_chunk = np.searchsorted(edges, a_ends[ends])
        link_a, link_b = links(a_ends, b_ends, a_sizes)
        self.sums = {"n_a": self._count(a_chunk), "n_b": self._count(b_chunk), "n_groups": self._count(group_chunk), "n_links": self._count(a_chunk[link_a])}
        self.groups = self._spell(a, b, group, group_chunk)
        del group, to
        self.pair_base = len(of.b_bytes)
        self.pairs, self.link = np.unique(a[link_a].astype(np.int64) * self.pair_base + b[link_b], return_inverse=True)
        self.link_sizes = self.sums["n_links"]
        self.link_starts = np.cumsum(self.link_sizes) - self.link_sizes

    def _count(self, chunk: np.ndarray) -> np.ndarray:
        """How many there are of each chunk; chunk: numbers among the whole ones."""
        out = np.zeros(self.n, np.int64)
        out[self.whole] = np.bincount(chunk, minlength=int(self.whole.sum()))
        return out

    def _spell(self, a: np.ndarray, b: np.ndarray, group: np.ndarray, group_chunk: np.ndarray) -> pa.Array:
        """a1,a2|b1;a3|b2,b3 of each chunk; the empty text for those that aren't whole."""
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(2 * group + side, kind="stable")
        group, side = group[order], side[order]
        last = np.ones(len(order), np.int8)
        last[:-1] = (group[1:] != group[:-1]) | (side[1:] != side[:-1])
        mark = np.where(last == 0, 0, 1 + side)  # a comma, a bar or a semicolon behind it
        chunk = group_chunk[group]
        mark[np.concatenate([chunk[1:] != chunk[:-1], [True]]) if len(chunk) else slice(0)] = 3
        numbers = pc.cast(pa.array(np.concatenate([a, b])[order]), pa.string())
        spelled = pc.binary_join_element_wise(numbers, pa.array([",", "|", ";", ""]).take(pa.array(mark)), "")
        ends = np.concatenate([[0], np.cumsum(self._count(chunk))])
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spelled), "")


TOTALS = ("n_a", "n_b", "n_groups", "n_links")
#: A row of a text, then of its block: the pairs of numbers that are linked in it and how often, and the places
#: of each chunk's links among them.
FIELDS = [
    T.StructField("block", T.LongType()), *[T.StructField(c, T.LongType()) for c in TOTALS], T.StructField("groups", T.StringType()), T.StructField("chunks", T.ArrayType(T.IntegerType())),
    T.StructField("pair_a", T.ArrayType(T.IntegerType())), T.StructField("pair_b", T.ArrayType(T.IntegerType())), T.StructField("pair_n", T.ArrayType(T.LongType())),
    T.StructField("chunk_links", T.ArrayType(T.IntegerType())), T.StructField("link_pairs", T.ArrayType(T.IntegerType())),
]


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def align_blocks(docs: DataFrame, keep: list[str | Column], text: str = "text", a: str = BYTES, b: str = PIECES) -> DataFrame:
    """Rows of texts, and one row of each block of texts of a task, with nulls in the other's columns. To be
    written before it is read more than once: a block is what a task met in turn."""
    source = docs.select(*keep, F.col(text).cast("binary").alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], *FIELDS])
    names, kept = schema.names, len(source.schema.fields) - 1

    def rows(chunks: Chunks, part: pa.RecordBatch, number: int) -> list[pa.RecordBatch]:
        cut = chunks.cut(part.column(kept).to_pylist())
        cut = [c if chunks.whole[c].all() else c[:0] for c in cut]
        chosen, flat = np.unique(np.concatenate(cut), return_inverse=True)
        block = Block(chunks, chosen)
        ends = np.concatenate([[0], np.cumsum([len(c) for c in cut], dtype=np.int64)])
        upto = {k: np.concatenate([[0], np.cumsum(v[flat])]) for k, v in block.sums.items()}
        totals = [pa.array(np.diff(upto[k][ends])) for k in TOTALS]
        groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), block.groups.take(pa.array(flat))), ";")
        n = len(cut)
        mark = pa.array(np.full(n, number))
        empty = [pa.nulls(n, pa.list_(k)) for k in (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32())]
        texts = pa.RecordBatch.from_arrays([*part.columns[:kept], mark, *totals, groups, _lists(flat, ends, pa.int32()), *empty], names=names)
        used = np.bincount(flat, minlength=block.n)
        times = np.bincount(block.link, weights=np.repeat(used, block.link_sizes), minlength=len(block.pairs)).astype(np.int64)
        own = [(block.pairs // block.pair_base, pa.int32()), (block.pairs % block.pair_base, pa.int32()), (times, pa.int64()), (block.link_sizes, pa.int32()), (block.link, pa.int32())]
        nulls = [pa.nulls(1, f.type) for f in part.schema][:kept] + [pa.array([number])] + [pa.nulls(1, pa.int64())] * 4 + [pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.int32()))]
        return [texts, pa.RecordBatch.from_arrays([*nulls, *(_lists(v, np.array([0, len(v)]), kind) for v, kind in own)], names=names)]

    def run(batches):
        chunks, first = Chunks(pair(a, b)), TaskContext.get().partitionId() << 32
        for k, part in enumerate(p for p in blocks_of(batches, BLOCK_BYTES) if p.num_rows):
            yield from rows(chunks, part, first + k)

    return source.mapInArrow(run, schema)


def block_pairs(blocks: DataFrame) -> DataFrame:
    """block, k, a, b, n: each block's linked pairs, k its place among them; those that only broken texts have
    have n = 0 there and are left out."""
    zipped = F.posexplode(F.arrays_zip("pair_a", "pair_b", "pair_n"))
    rows = blocks.where(F.col("pair_a").isNotNull()).select("block", zipped.alias("k", "__pair"))
    return rows.select("block", "k", F.col("__pair.pair_a").alias("a"), F.col("__pair.pair_b").alias("b"), F.col("__pair.pair_n").alias("n")).where("n > 0")


def link_counts(pairs: DataFrame) -> DataFrame:
    """a, b, n, best: how many links of all texts hold a pair of numbers, and whether no other pair of b has
    more. The table of each b's highest count has a row for each piece of B at most, so it is broadcast."""
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))
    highest = counts.groupBy("b").agg(F.max("n").alias("__most"))
    return counts.join(F.broadcast(highest), "b").select("a", "b", "n", (F.col("n") == F.col("__most")).alias("best"))


def score_blocks(blocks: DataFrame, keep: list[str], counts: DataFrame) -> DataFrame:
    """The columns of `keep` with n_a, n_b, n_groups, n_links, n_best, count_sum, for each row of a text.

    Counts meet the pairs of a block, not of each text; a block's counts then meet its rows in one group,
    whose size is that of a block.
    """
    held = block_pairs(blocks).join(counts.withColumnRenamed("n", "__n"), ["a", "b"]).select(F.col("block").alias("of_block"), "k", F.col("__n").alias("n"), "best")
    rows = blocks.select(*keep, "block", *TOTALS, "chunks", "chunk_links", "link_pairs")
    out = T.StructType([*(rows.schema[c] for c in keep), *[T.StructField(c, T.LongType()) for c in (*TOTALS, "n_best", "count_sum")]])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        own = left.filter(pc.is_valid(left["link_pairs"]))
        texts = left.filter(pc.is_valid(left["chunks"]))
        sizes, link = (own[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("chunk_links", "link_pairs"))
        chunks = texts["chunks"].combine_chunks()
        flat, ends = chunks.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(pc.list_value_length(chunks).to_numpy(zero_copy_only=False))])
        sums = []
        for c in ("best", "n"):
            value = np.zeros(1 + int(link.max(initial=0)), np.int64)
            value[right["k"].to_numpy()] = right[c].cast(pa.int64()).to_numpy()
            each = np.diff(np.concatenate([[0], np.cumsum(value[link])])[np.concatenate([[0], np.cumsum(sizes)])])
            sums.append(pa.array(np.diff(np.concatenate([[0], np.cumsum(each[flat])])[ends])))
        return pa.Table.from_arrays([*(texts[c] for c in (*keep, *TOTALS)), *sums], names=out.names)

    return rows.groupBy("block").cogroup(held.groupBy("of_block")).applyInArrow(score, out)


def align(docs: DataFrame, keep: list[str | Column], text: str = "text", a: str = BYTES, b: str = PIECES) -> DataFrame:
    """The columns of `keep` with n_a, n_b, n_groups, n_links and groups (`a1,a2|b1;a3|b2,b3`) of each text.

    Tokens are those of a blank and the text under A, and of the text under B, which puts the blank itself.
    Null and empty texts have none, nor have texts that don't come back from both: zeros and an empty text.
    Equal texts have equal groups; long texts are aligned whole; an empty table gives no rows; columns that
    aren't in `keep` are ignored, so clashing names do no harm. The tokenizer files lie on every executor.
    """
    rows = align_blocks(docs, keep, text, a, b)
    return rows.where(F.col("chunks").isNotNull()).select(*rows.columns[: len(keep)], *TOTALS, "groups")


def op13_pointer_jumping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row; texts without tokens,
    as align() has them, have zeros and an empty digest, and no part in the counts."""
    blocks = align_blocks(read_table(spark, sf_dir, "documents"), ["doc_id"])
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.when(F.col("groups").isNotNull(), F.lit("")))
    with arrow_batches(spark, BATCH_BYTES):
        blocks = stash(blocks.withColumn("groups_sha256", digest).drop("groups"))
    rows = score_blocks(blocks, ["doc_id", "groups_sha256"], link_counts(block_pairs(blocks)))
    return rows.select("doc_id", *TOTALS, "n_best", "count_sum", "groups_sha256")


QUERIES = {"op13_pointer_jumping_alignment": op13_pointer_jumping_alignment}
ORACLES: dict[str, str] = {}
