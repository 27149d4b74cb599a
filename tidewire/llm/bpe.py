"""BPE encoding and decoding by an index of pair occurrences.

A task lays the different words of its texts end to end and maps each pair of neighbouring symbols to all the
places where it stands. Active ranks are taken in ascending order; one rank joins its pairs at all their places
at once and puts the new pairs on either side on the lists of their own ranks.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidewire.llm.common import map_texts, read_table

#: A tokenizer file that every executor has.
WORDS = "/opt/tokenizers/word_bpe_49k.json"
#: Bytes of text that are encoded together, and the words and bytes of words that a task remembers.
BLOCK_BYTES, REMEMBERED, REMEMBERED_BYTES = 4 << 20, 250_000, 16 << 20
#: Letters beyond ASCII that are composed, letters in every version of Unicode, and lower-case one by one.
LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
#: Words of ASCII and these letters; the others go through the tokenizer file's own normal form and split.
PLAIN = re.compile(rf"[\x00-\x7f{LATIN}]+")
#: Pre-tokens of plain words in lower case, one word a line.
PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|\n|[^a-z0-9\n{LATIN}]+")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: its own if it can be printed, else the
    next one from U+0100 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printed)]
    return {chr(b): b for b in printed} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Merges:
    """The pairs of a vocabulary, in order of rank, and the symbols that words begin as."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.size = 1 + max(vocab.values())
        letters = byte_letters()
        self.first, self.last = np.zeros(256, np.int32), np.zeros(256, np.int32)
        for letter, b in letters.items():
            self.first[b], self.last[b] = vocab[letter], vocab[letter + suffix]
        parts = np.array([(vocab[a], vocab[b]) for a, b in merges], np.int64).reshape(-1, 2)
        self.left, self.right = parts[:, 0].astype(np.int32), parts[:, 1].astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        codes = parts[:, 0] * self.size + parts[:, 1]
        self.order = np.argsort(codes, kind="stable").astype(np.int32)
        self.codes = codes[self.order]
        # Ranks whose symbol is part of a pair of a lower rank: that pair goes first, as soon as it is there.
        use = np.full(self.size, len(merges), np.int64)
        np.minimum.at(use, parts.ravel(), np.repeat(np.arange(len(merges)), 2))
        self.early = use[self.made] < np.arange(len(merges))

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs, -1 where there is none."""
        if not len(self.codes):
            return np.full(len(a), -1, np.int32)
        wanted = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        return np.where(self.codes[at] == wanted, self.order[at], -1)


class PairIndex:
    """Words laid end to end as symbols, and for each active rank the places of its pair."""

    def __init__(self, merges: Merges, words: list[bytes]):
        """Words are not empty."""
        self.merges = merges
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.cumsum(sizes) - sizes
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = self.starts + sizes - 1
        self.symbols = merges.first[raw]
        self.symbols[ends] = merges.last[raw[ends]]
        place = np.arange(len(raw), dtype=np.int32)
        self.next, self.before = place + 1, place - 1
        self.next[ends], self.before[self.starts] = -1, -1
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self.joined = np.zeros(len(raw), bool)
        self._list(place[self.next >= 0])

    def _list(self, at: np.ndarray) -> None:
        """Put the pairs that start at these places on the lists of their ranks."""
        ranks = self.merges.ranks(self.symbols[at], self.symbols[self.next[at]])
        has = ranks >= 0
        at, ranks = at[has], ranks[has]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(at)] if len(at) else [0]
        for a, b in zip(cuts, cuts[1:]):
            rank = int(ranks[a])
            held = self.places.get(rank)
            if held is None:
                self.places[rank] = [at[a:b]]
                heapq.heappush(self.active, rank)
            else:
                held.append(at[a:b])

    def _standing(self, rank: int) -> np.ndarray:
        """The places of a rank's list where its pair still stands, those that overlap taken from the left."""
        held = self.places.pop(rank)
        at = held[0] if len(held) == 1 else np.concatenate(held)
        a, b = self.merges.left[rank], self.merges.right[rank]
        at = at[self.symbols[at] == a]
        after = self.next[at]
        at = at[(after >= 0) & (self.symbols[after] == b)]
        if a != b and not self.merges.early[rank]:
            return at
        at = np.sort(at)
        if self.merges.early[rank]:
            _, firsts = np.unique(np.searchsorted(self.starts, at, "right"), return_index=True)
            rest = np.delete(at, firsts)
            if len(rest):
                self.places[rank] = [rest]
                heapq.heappush(self.active, rank)
            return at[firsts]
        fresh = np.ones(len(at), bool)
        fresh[1:] = at[1:] != self.next[at[:-1]]
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        return at[(np.arange(len(at)) - run) % 2 == 0]

    def apply(self) -> tuple[np.ndarray, np.ndarray]:
        """Join all pairs by rank; the symbols of all words, and how many each word has."""
        symbols, nxt, before, joined = self.symbols, self.next, self.before, self.joined
        while self.active:
            rank = heapq.heappop(self.active)
            at = self._standing(rank)
            if not len(at):
                continue
            gone = nxt[at]
            after = nxt[gone]
            symbols[at], symbols[gone], nxt[at] = self.merges.made[rank], -1, after
            inside = after >= 0
            before[after[inside]] = at[inside]
            joined[at] = True
            left = before[at]
            left = left[left >= 0]
            left = left[~joined[left]]
            joined[at] = False
            self._list(np.concatenate([at[inside], left]))
        stands = symbols >= 0
        return symbols[stands], np.add.reduceat(stands, self.starts, dtype=np.int64)


def gather(starts: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the members of the chosen lists stand, list after list, and the offsets of the lists."""
    n = sizes[chosen]
    offsets = np.concatenate([[0], np.cumsum(n)])
    return np.repeat(starts[chosen] - offsets[:-1], n) + np.arange(offsets[-1]), offsets


class Lists:
    """Lists of numbers that only grow in number."""

    def __init__(self):
        self.values, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values = np.concatenate([self.values, values.astype(np.int32)])
        self.sizes = np.concatenate([self.sizes, sizes])

    def take(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, offsets = gather(np.cumsum(self.sizes) - self.sizes, self.sizes, chosen)
        return self.values[at], offsets


def numbering() -> defaultdict:
    """A table that gives each new key the next number."""
    return defaultdict(itertools.count().__next__)


class Vocabulary:
    """What a tokenizer file of this kind says: normal form, split, byte-level pairs with ends of words, marks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        if odd or spec["decoder"] is not None or not model["end_of_word_suffix"]:
            raise ValueError(f"not a tokenizer of words with ends: {path} {odd}")
        self.merges = Merges(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"])
        self.marks = {m["content"].encode(): m["id"] for m in spec["added_tokens"]}
        self.mark = re.compile(b"(" + b"|".join(re.escape(m) for m in sorted(self.marks, key=len, reverse=True)) + b")") if self.marks else None
        names = {i: t for t, i in model["vocab"].items()} | {m["id"]: m["content"] for m in spec["added_tokens"]}
        self.names = pa.array([names.get(i) for i in range(1 + max(names))], pa.string())
        own = Tokenizer.from_str(json.dumps(spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []}))
        self.normal, self.split = own.normalizer.normalize_str, own.pre_tokenizer.pre_tokenize_str
        self.letters = byte_letters()

    def odd_pieces(self, word: str) -> list[str]:
        """Pre-tokens of one word that isn't plain."""
        return [bytes(map(self.letters.__getitem__, p)).decode() for p, _ in self.split(self.normal(word))]

    def words(self, text: bytes) -> list:
        """Words of a text, and the numbers of the marks that stand in it as they are written."""
        if self.mark is None or not self.mark.search(text):
            return text.split()
        out: list = []
        for part in self.mark.split(text):
            out += [self.marks[part]] if part in self.marks else part.split()
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str = WORDS) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Texts to numbers; the different words seen so far keep theirs, in bounded memory."""

    def __init__(self, of: Vocabulary):
        self.of = of
        self._forget()

    def _forget(self) -> None:
        self.words, self.pieces, self.held = numbering(), numbering(), 0
        self.of_word, self.of_piece = Lists(), Lists()

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all texts, and where each text's begin and end."""
        if len(self.words) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self._forget()
        known, seen = len(self.words), self.words.__getitem__
        found = []
        for t in texts:
            words = self.of.words(t) if t else []
            found.append(np.fromiter(map(seen, words), np.int32, len(words)))
        self._learn(known)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids, ends = self.of_word.take(np.concatenate(found) if found else np.zeros(0, np.int32))
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]

    def _learn(self, known: int) -> None:
        """Numbers of the words from the `known`th on: plain ones first cut together, then the odd ones, then marks."""
        fresh = list(itertools.islice(self.words, known, None))
        if not fresh:
            return
        before, piece = len(self.pieces), self.pieces.__getitem__
        texts = ["" if isinstance(w, int) else w.decode("utf-8", "replace") for w in fresh]
        self.held += sum(map(len, texts))
        plain = np.fromiter((PLAIN.fullmatch(w) is not None for w in texts), bool, len(texts))
        found = PIECES.findall("\n".join(itertools.compress(texts, plain)).lower())
        cut = np.fromiter(map(piece, found), np.int32, len(found))
        ends = cut == piece("\n")
        at = np.flatnonzero(plain)
        odd = [(k, [piece(fresh[k])] if isinstance(fresh[k], int) else list(map(piece, self.of.odd_pieces(texts[k])))) for k in np.flatnonzero(~plain)]
        sizes = np.zeros(len(fresh), np.int64)
        if len(at):
            sizes[at] = np.diff(np.concatenate([[-1], np.flatnonzero(ends), [len(cut)]])) - 1
        for k, parts in odd:
            sizes[k] = len(parts)
        starts = np.cumsum(sizes) - sizes
        flat = np.zeros(sizes.sum(), np.int32)
        flat[gather(starts, sizes, at)[0]] = cut[~ends]
        for k, parts in odd:
            flat[starts[k] : starts[k] + len(parts)] = parts
        self._encode_pieces(list(itertools.islice(self.pieces, before, None)))
        ids, edges = self.of_piece.take(flat)
        self.of_word.add(ids, np.diff(edges[np.concatenate([[0], np.cumsum(sizes)])]))

    def _encode_pieces(self, new: list) -> None:
        """Numbers of new pre-tokens, through the index of their pairs; a mark is its own number."""
        marks = np.fromiter((isinstance(p, int) for p in new), bool, len(new))
        sizes, plain = np.ones(len(new), np.int64), [p.encode() for p in new if not isinstance(p, int)]
        ids = np.zeros(0, np.int32)
        if plain:
            ids, sizes[~marks] = PairIndex(self.of.merges, plain).apply()
        values, inside = np.zeros(sizes.sum(), np.int32), np.repeat(~marks, sizes)
        values[inside], values[~inside] = ids, [p for p in new if isinstance(p, int)]
        self.of_piece.add(values, sizes)


IDS = T.ArrayType(T.IntegerType(), False)


def spell(tokens: pa.Array, ids: pa.Array, ends: np.ndarray) -> pa.Array:
    """The texts of lists of numbers: their tokens with a blank between. What has no token is passed over."""
    good = pc.fill_null(pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(tokens))), False)
    taken = tokens.take(pc.if_else(good, ids, None))
    if taken.null_count:
        stands = taken.is_valid().to_numpy(zero_copy_only=False)
        ends, taken = np.concatenate([[0], np.cumsum(stands)])[ends], taken.drop_null()
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), taken), " ")


def encode(docs: DataFrame, keep: list[str | Column], text: str = "text", path: str = WORDS, out: str = "ids", decoded: str | None = None) -> DataFrame:
    """The columns of `keep` with the numbers of each text's tokens, for every row of docs, and under the name
    `decoded`, if one is given, what the numbers decode to, in the same pass.

    Null, empty and wordless texts have no numbers (an empty array) and decode to the empty text; marks written
    out in a text are their own number; equal texts have equal numbers; long texts are encoded whole; an empty
    table gives no rows; columns that aren't in `keep` are ignored, so clashing names do no harm. The tokenizer
    file lies on every executor.
    """

    def make():
        of = vocabulary(path)
        encoder = Encoder(of)

        def work(texts):
            ids, ends = encoder.encode(texts)
            numbers = pa.array(ids, pa.int32())
            made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), numbers)
            return [made] if decoded is None else [made, spell(of.names, numbers, ends)]

        return work

    fields = [T.StructField(out, IDS)] + ([] if decoded is None else [T.StructField(decoded, T.StringType())])
    return map_texts(docs, keep, make, fields, text, BLOCK_BYTES)


def decode(rows: DataFrame, keep: list[str | Column], ids: str = "ids", path: str = WORDS, out: str = "decoded") -> DataFrame:
    """The columns of `keep` with the text of each row's numbers: their tokens, marks too, with a blank between.

    A null array gives a null, an empty one the empty text; numbers without a token and nulls inside are passed
    over; an empty table gives no rows.
    """
    source = rows.select(*keep, F.col(ids).cast(T.ArrayType(T.IntegerType())).alias("__ids"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(out, T.StringType())])
    names = schema.names

    def run(batches):
        tokens = vocabulary(path).names
        for batch in batches:
            held = batch.column(batch.num_columns - 1)
            sizes = pc.fill_null(pc.list_value_length(held), 0).to_numpy(zero_copy_only=False)
            texts = spell(tokens, held.flatten(), np.concatenate([[0], np.cumsum(sizes)]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pc.if_else(held.is_valid(), texts, None)], names=names)

    return source.mapInArrow(run, schema)


def op11_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row: digests of the numbers of the whole text and
    of the text that they decode to. Null and wordless texts have no tokens and the digests of the empty text."""
    texts = encode(read_table(spark, sf_dir, "documents"), ["doc_id"], decoded="decoded")
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return texts.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(written, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


QUERIES = {"op11_pair_index_bpe": op11_pair_index_bpe}
ORACLES: dict[str, str] = {}
