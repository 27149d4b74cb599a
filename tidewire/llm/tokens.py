"""Edit-aware token counts: a segment tree of pre-token blocks for each document; an edit re-encodes the
blocks that it touches, with boundary context, and updates the sums above them."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.common import map_texts, read_table
from tidewire.llm.pii import add_spans

#: A rank file that every executor has.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern that goes with it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens of a block when it is made; pre-tokens whose counts a task remembers, and their longest.
BLOCK, REMEMBERED, LONGEST = 64, 200_000, 64
#: What a pre-token's end depends on behind it: the next character, and one more after white space.
CONTEXT = 2


class Counter:
    """Pre-tokens and their token counts under one rank file."""

    def __init__(self, ranks: str, pattern: str):
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        """Tokens of each pre-token."""
        out = list(map(self.known.get, pieces))
        if None in out:
            for i, n in enumerate(out):
                if n is None:
                    out[i] = self.known.get(pieces[i]) or self._count(pieces[i])
        return out

    def _count(self, piece: str) -> int:
        n = len(self.encoding.encode_ordinary(piece))
        if len(piece) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[piece] = n
        return n

    def blocks(self, text: str) -> tuple[list[int], list[int]]:
        """Characters and tokens of each block of a text."""
        pieces = self.pattern.findall(text)
        if not pieces:
            return [], []
        at = np.arange(0, len(pieces), BLOCK)
        sizes = np.add.reduceat(np.fromiter(map(len, pieces), np.int64, len(pieces)), at)
        return sizes.tolist(), np.add.reduceat(np.array(self.counts(pieces)), at).tolist()


@lru_cache(maxsize=2)
def counter(ranks: str = RANKS, pattern: str = PATTERN) -> Counter:
    return Counter(ranks, pattern)


class Tree:
    """Sums over leaves, each pair of nodes below its parent: node i has the children 2i and 2i + 1."""

    def __init__(self, chars: list[int], tokens: list[int]):
        """From all nodes, as nodes() gives them."""
        self.chars, self.tokens, self.leaves = chars, tokens, len(chars) // 2

    @staticmethod
    def of(sizes: list[int], tokens: list[int]) -> Tree:
        tree = Tree([], [])
        tree.build(sizes, tokens)
        return tree

    def build(self, sizes: list[int], tokens: list[int]) -> None:
        n = 1
        while n < len(sizes):
            n *= 2
        self.chars, self.tokens, self.leaves = [0] * n + sizes + [0] * (n - len(sizes)), [0] * n + tokens + [0] * (n - len(tokens)), n
        for i in range(n - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character `at`, and where it starts."""
        i, start = 1, 0
        while i < self.leaves:
            i *= 2
            if at - start >= self.chars[i]:
                start += self.chars[i]
                i += 1
        return i - self.leaves, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        i = leaf + self.leaves
        self.chars[i], self.tokens[i] = chars, tokens
        i //= 2
        while i:
            self._sum(i)
            i //= 2


class Document:
    """A tree with the text of each leaf beside it, so that an edit copies the leaves it touches only."""

    def __init__(self, tree: Tree, text: str):
        self.tree, self.parts, at = tree, [], 0
        for n in tree.chars[tree.leaves :]:
            self.parts.append(text[at : at + n])
            at += n

    def text(self) -> str:
        return "".join(self.parts)

    def edit(self, start: int, end: int, new: str, of: Counter) -> int:
        """Replace [start, end), bring the tree up to date, and say how many characters were cut again.

        Pre-tokens are cut from left to right, so a block that starts CONTEXT characters or more before the
        edit starts where it did. From there the new text is cut until a cut falls on the old start of a
        block behind the edit: all that follows is as it was. What a cut needs of the text behind it is
        within CONTEXT of its end, so leaves are read one by one until that is there.
        """
        tree, parts = self.tree, self.parts
        total = tree.chars[1]
        if not total:
            self._replace(0, tree.leaves, of.pattern.findall(new), of)
            return len(new)
        first, begin = tree.find(min(max(0, start - CONTEXT), total - 1))
        read, upto, pieces = first, begin, []  # leaves before `read`, up to the old character `upto`, are in `held`
        held: list[str] = []
        while read < tree.leaves and (upto < end or read == first):
            held.append(parts[read])
            upto += tree.chars[tree.leaves + read]
            read += 1
        old = "".join(held)
        now, shift = old[: start - begin] + new + old[end - begin :], len(new) - (end - start)
        at, leaf, place = 0, first, begin  # `place`: the old block start behind the edit that the cuts may meet next
        while True:
            while leaf < read and (leaf == first or place < end or place - begin + shift < at):
                place += tree.chars[tree.leaves + leaf]
                leaf += 1
            if leaf == read and read < tree.leaves and place - begin + shift < at:
                now, upto, read = now + parts[read], upto + tree.chars[tree.leaves + read], read + 1
                continue
            if at == place - begin + shift:
                break
            piece = of.pattern.match(now, at)
            while read < tree.leaves and (piece is None or piece.end() + CONTEXT > len(now)):
                now, upto, read = now + parts[read], upto + tree.chars[tree.leaves + read], read + 1
                piece = of.pattern.match(now, at)
            pieces.append(piece[0])
            at = piece.end()
        self._replace(first, leaf, pieces, of)
        return at

    def _replace(self, first: int, leaf: int, pieces: list[str], of: Counter) -> None:
        """Put pieces in place of the leaves [first, leaf). What is over two blocks' size is split, so that no
        leaf grows with the number of edits; only then are sums built anew, no text is encoded again."""
        cuts = range(0, len(pieces), BLOCK) if len(pieces) > 2 * BLOCK else range(min(1, len(pieces)))
        size = BLOCK if len(pieces) > 2 * BLOCK else len(pieces)
        fresh = [pieces[i : i + size] for i in cuts]
        texts, counts = ["".join(p) for p in fresh], [sum(of.counts(p)) for p in fresh]
        tree, parts = self.tree, self.parts
        if len(fresh) <= leaf - first:
            for k in range(first, leaf):
                own = k - first < len(fresh)
                text, n = (texts[k - first], counts[k - first]) if own else ("", 0)
                if own or parts[k]:
                    parts[k] = text
                    tree.put(k, len(text), n)
            return
        tokens = tree.tokens[tree.leaves :]
        held = [(t, n) for t, n in zip(parts[:first], tokens[:first]) if t] + list(zip(texts, counts)) + [(t, n) for t, n in zip(parts[leaf:], tokens[leaf:]) if t]
        self.parts = [t for t, _ in held]
        tree.build([len(t) for t in self.parts], [n for _, n in held])
        self.parts += [""] * (tree.leaves - len(self.parts))


def apply_edit(tree: Tree, text: str, start: int, end: int, new: str, of: Counter) -> tuple[str, int]:
    """One edit of a text: the new text, and the characters cut again. The tree is brought up to date."""
    document = Document(tree, text)
    n = document.edit(start, end, new, of)
    return document.text(), n


EDITS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("new", T.StringType())]))
STATE = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("tree_chars", T.ArrayType(T.LongType())),
    T.StructField("tree_tokens", T.ArrayType(T.LongType())),
]


def build_trees(docs: DataFrame, keep: list, text: str = "text", ranks: str = RANKS) -> DataFrame:
    """The columns of `keep` with n_tokens and the nodes of each document's tree, for every row of docs.

    Null and empty texts have 0 tokens and a tree of one empty leaf; equal texts have equal trees; an empty
    table gives no rows; columns that aren't in `keep` are ignored, so clashing names do no harm.
    """

    def make():
        of = counter(ranks)

        def work(texts):
            trees = [Tree.of(*of.blocks((t or b"").decode("utf-8", "replace"))) for t in texts]
            many = pa.list_(pa.int64())
            return [pa.array([t.total for t in trees], pa.int64()), pa.array([t.chars for t in trees], many), pa.array([t.tokens for t in trees], many)]

        return work

    return map_texts(docs, keep, make, STATE, text)


def fit_together(edits: list, size: int) -> bool:
    """Whether edits stand in order, without overlap, inside a text of so many characters."""
    last = 0
    for e in edits:
        if e["start"] is None or e["end"] is None or not last <= e["start"] <= e["end"] <= size:
            return False
        last = e["end"]
    return True


def apply_edits(trees: DataFrame, keep: list, edits: str, text: str = "text", ranks: str = RANKS, mark: bool = False) -> DataFrame:
    """The columns of `keep` with n_tokens_edited, n_reencoded (characters) and the new trees, for every row.

    trees has the columns of build_trees, the text and `edits`, an array of (start, end, new) in code
    points of the text, in order of start and not overlapping; null or empty: nothing changes. Edits that
    overlap or leave the text are an error, or with `mark` a disposition: such a row keeps its tree and
    count, and edits_ok is false. Equal rows are edited each for itself; an empty table gives no rows.
    """
    columns = ["tree_chars", "tree_tokens", edits]
    source = trees.select(*keep, *[F.col(c).alias(f"__{c}") for c in columns], F.col(text).cast("binary").alias("__text"))
    kept = source.schema.fields[: -len(columns) - 1]
    fields = [T.StructField("n_tokens_edited", T.LongType()), T.StructField("n_reencoded", T.LongType()), *STATE[1:]]
    fields += [T.StructField("edits_ok", T.BooleanType())] if mark else []
    names = [f.name for f in (*kept, *fields)]

    def run(batches):
        of = counter(ranks)
        for batch in batches:
            out = []
            for row in batch.select([f"__{c}" for c in columns] + ["__text"]).to_pylist():
                tree, touched, shift = Tree(row["__tree_chars"], row["__tree_tokens"]), 0, 0
                asked = row[f"__{edits}"] or []
                ok = fit_together(asked, tree.chars[1])
                if not ok and not mark:
                    raise ValueError("an edit overlaps or leaves the text")
                if asked and ok:
                    document = Document(tree, (row["__text"] or b"").decode("utf-8", "replace"))
                    for edit in asked:
                        touched += document.edit(edit["start"] + shift, edit["end"] + shift, edit["new"] or "", of)
                        shift += len(edit["new"] or "") - (edit["end"] - edit["start"])
                out.append((tree.total, touched, tree.chars, tree.tokens, ok))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.bool_()][: len(fields)]
            found = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *found], names=names)

    return source.mapInArrow(run, T.StructType([*kept, *fields]))


def add_redactions(docs: DataFrame, text: str = "text", out: str = "edits") -> DataFrame:
    """Add edits of the texts: long numbers and addresses at hosts give way to a mark, and a first line of
    one to eight words goes if others follow.

    An address starts where no character of its class stands before, or where a match ended: the patterns
    don't backtrack, nothing is lost between adjacent addresses, and numbers and hosts of any length go whole.
    """
    mask = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]++|[0-9]{9,}+"
    blank = r"[\x20\x09\x0B-\x0D]"
    head = rf"^{blank}*+[^\x20\x09-\x0D]++(?:{blank}++[^\x20\x09-\x0D]++){{0,7}}+{blank}*+\n"
    docs = add_spans(docs, text, mask, r"@|[0-9]{9}", "__redact")
    line = F.length(F.regexp_extract(F.col(text), head, 0)).cast("long")
    docs = docs.withColumn("__redact_line", F.coalesce(line, F.lit(0).cast("long")))
    masks = F.transform("__redact", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("[removed]").alias("new")))
    masks = F.coalesce(F.filter(masks, lambda e: e["start"] >= F.col("__redact_line")).cast(EDITS), F.array().cast(EDITS))
    first = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("__redact_line").alias("end"), F.lit("").alias("new"))).cast(EDITS)
    docs = docs.withColumn(out, F.when(F.col("__redact_line") > 0, F.concat(first, masks)).otherwise(masks))
    return docs.drop("__redact", "__redact_hits", "__redact_gaps", "__redact_line")


def op8_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_edited, n_reencoded for every row: counts before and after the
    edits of add_redactions(), the latter from the trees."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = build_trees(add_redactions(docs), ["doc_id", "text", "edits"])
    keep = ["doc_id", "n_tokens", F.coalesce(F.size("edits"), F.lit(0)).cast("long").alias("n_edits")]
    return apply_edits(trees, keep, "edits", mark=True).drop("tree_chars", "tree_tokens")


QUERIES = {"op8_edit_aware_counts": op8_edit_aware_counts}
ORACLES: dict[str, str] = {}
