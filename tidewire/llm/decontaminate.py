"""Benchmark decontamination: suffix arrays over shards of the training text, searched for every suffix of
the benchmark items."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.common import read_table, stash

#: Words of a window, and the share of hit words from which a document is contaminated.
WINDOW, SHARE = 13, 20
#: Words of one suffix array, and of the benchmark items searched in one pass: a block with its ranks, some
#: 20 bytes a word for each power of two up to its longest item, is broadcast.
SHARD_WORDS, BLOCK_WORDS = 2_000_000, 500_000
#: Item names that leave a task in one Arrow batch.
BATCH_NAMES = 200_000

#: Bytes to words: A-Z in lower case, other ASCII than letters and digits to spaces.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

HITS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest_match", T.LongType()),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
]


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


@dataclass
class Block:
    """Benchmark items as word numbers (from 1) in one row, each item followed by a 0."""

    vocabulary: dict[bytes, int]
    ids: np.ndarray
    left: np.ndarray  # words from here to the item's end
    names: np.ndarray  # different names in order
    least: int  # words of the shortest window
    ranks: list[np.ndarray]  # by level j: the order of the 2 ** j words from each place; 0 at the zeros
    tables: list[np.ndarray]  # by level j > 0: the sorted pairs of ranks that its own ranks number
    order: np.ndarray  # the suffixes of all items in order, to their full length
    at: np.ndarray  # a start of each different window
    size: np.ndarray  # and its words
    bearers: np.ndarray  # names that have the windows, one window behind the other
    first: np.ndarray  # where those of each window begin

    @staticmethod
    def of(rows: list[tuple[str | None, list[bytes]]]) -> Block:
        vocabulary: dict[bytes, int] = {}
        ids, item, left = [], [], []
        for k, (_, words) in enumerate(rows):
            ids += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words] + [0]
            item += [k] * len(words) + [-1]
            left += [*range(len(words), -1, -1)]
        ids, item, left = np.array(ids, np.int64), np.array(item, np.int64), np.array(left, np.int64)
        least = min((min(WINDOW, len(w)) for _, w in rows), default=WINDOW)
        names = sorted({n for n, _ in rows if n is not None})
        number = {n: i for i, n in enumerate(names)}
        named = np.array([number.get(n, -1) for n, _ in rows], np.int64)

        ranks, tables, reach = [ids], [np.zeros(0, np.int64)], 1
        while reach < (left.max() if len(left) else 0):
            behind = np.where(left > reach, np.r_[ranks[-1][reach:], np.zeros(min(reach, len(ids)), np.int64)][: len(ids)], 0)
            table, rank = np.unique(pair(ranks[-1], behind)[ids > 0], return_inverse=True)
            ranks.append(np.zeros(len(ids), np.int64))
            ranks[-1][ids > 0] = rank + 1
            tables.append(table)
            reach *= 2
        real = np.flatnonzero(ids > 0)
        order = real[np.argsort(ranks[-1][real], kind="stable")]

        starts = np.flatnonzero((ids > 0) & ((left >= WINDOW) | np.r_[True, ids[:-1] == 0][: len(ids)]))
        size = np.minimum(left[starts], WINDOW)
        level = np.array([int(n).bit_length() - 1 for n in range(WINDOW + 1)])[size]  # two windows of this power cover it
        own, end = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        for j in np.unique(level):
            rows_ = np.flatnonzero(level == j)
            own[rows_], end[rows_] = ranks[j][starts[rows_]], ranks[j][starts[rows_] + size[rows_] - (1 << j)]
        by_window = np.lexsort([end, own, size])
        starts, size, key = starts[by_window], size[by_window], np.array([size, own, end]).T[by_window]
        new = np.r_[True, (key[1:] != key[:-1]).any(axis=1)][: len(key)]
        window = np.cumsum(new) - 1
        bearer = named[item[starts]]
        both = np.unique(np.array([window, bearer]).T[bearer >= 0].reshape(-1, 2), axis=0)
        first = np.searchsorted(both[:, 0], np.arange(int(new.sum()) + 1))
        return Block(vocabulary, ids, left, np.array(names, object), least, ranks, tables, order, starts[new], size[new], both[:, 1], first)

    def ranks_of(self, ids: np.ndarray) -> list[np.ndarray]:
        """Ranks of other words under this block, 0 where no item has them. ids: word numbers and zeros."""
        out, reach = [ids], 1
        for table in self.tables[1:]:
            behind = np.r_[out[-1][reach:], np.zeros(min(reach, len(ids)), np.int64)][: len(ids)]
            sought = pair(out[-1], behind)
            at = np.minimum(np.searchsorted(table, sought), max(len(table) - 1, 0))
            out.append(np.where((out[-1] > 0) & (behind > 0) & (table[at] == sought), at + 1, 0))
            reach *= 2
        return out

    def agree(self, ranks: list[np.ndarray], place: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Words that agree from each place of a text (with its ranks) and each place of the block on."""
        long = np.zeros(len(place), np.int64)
        for j in range(len(ranks) - 1, -1, -1):
            p, q = place + long, at + long
            inside = (p < len(ranks[j])) & (q < len(self.ids))
            mine = ranks[j][np.where(inside, p, 0)]
            same = inside & (mine > 0) & (mine == self.ranks[j][np.where(inside, q, 0)])
            long += same << j
        return long

    def longest(self, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Words of the longest match of each place with any suffix of the block, which stands next to it in
        the order of the suffixes. ids ends with a 0."""
        if not len(place) or not len(self.order):
            return np.zeros(len(place), np.int64)
        ranks = self.ranks_of(ids)
        low, high = np.zeros(len(place), np.int64), np.full(len(place), len(self.order), np.int64)
        while (low < high).any():
            mid = (low + high) // 2
            at = self.order[np.minimum(mid, len(self.order) - 1)]
            long = self.agree(ranks, place, at)
            before = self.ids[at + long] < ids[np.minimum(place + long, len(ids) - 1)]
            open_ = low < high
            low, high = np.where(open_ & before, mid + 1, low), np.where(open_ & ~before, mid, high)
        near = [self.order[np.clip(low + d, 0, len(self.order) - 1)] for d in (-1, 0)]
        return np.maximum(*(self.agree(ranks, place, at) for at in near))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a << 32 | b


def suffix_array(ids: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """`starts` in the order of the words that follow, up to `depth` of them. ids ends with `depth` zeros."""
    keys = [ids[starts + d] for d in range(depth)]
    return starts[np.lexsort(keys[::-1])]


def _bound(ids: np.ndarray, order: np.ndarray, query: np.ndarray, at: np.ndarray, size: np.ndarray, upper: bool) -> np.ndarray:
    """For every query (size words of `query` from `at`), by binary search: how many suffixes of `order`
    stand before all that begin with it, or (upper) before all that stand behind those."""
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(order), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        place, a, n = order[mid], at[open_], size[open_]
        sign = np.zeros(len(open_), np.int8)
        for d in range(int(n.max())):
            same = (sign == 0) & (d < n)
            if not same.any():
                break
            sign[same] = np.sign(ids[place[same] + d] - query[a[same] + d])
        right = sign <= 0 if upper else sign < 0
        low[open_[right]] = mid[right] + 1
        high[open_[~right]] = mid[~right]
    return low


def search(block: Block, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of the block's different windows in a shard (word numbers, 0 for words outside the
    vocabulary and behind each document): arrays of places and windows. Windows of one length have ranges
    of their own in the order of suffixes, so there are at most WINDOW times as many as words."""
    known = ids > 0
    ends = np.flatnonzero(~known)
    run = ends[np.searchsorted(ends, np.arange(len(ids)))] - np.arange(len(ids)) if len(ids) else np.zeros(0, np.int64)
    # a suffix that leaves the vocabulary before the shortest window ends can't hold one
    starts = np.flatnonzero(run >= block.least)
    padded = np.r_[ids, np.zeros(WINDOW, ids.dtype)]
    order = suffix_array(padded, starts, WINDOW)
    low = _bound(padded, order, block.ids, block.at, block.size, False)
    high = _bound(padded, order, block.ids, block.at, block.size, True)
    found = np.flatnonzero(high > low)
    count = (high - low)[found]
    rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[found], count)
    return order[rank], np.repeat(found, count)


def _longest(block: Block, ids: np.ndarray, place: np.ndarray, window: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """Words of the longest match at each occurrence: as far as some item goes on, or a whole short item.
    covered: the hit places, which hold all of every match."""
    long = block.size[window].copy()
    full = np.flatnonzero(long == WINDOW)
    if full.size:
        # the hit words alone, a 0 behind each run of them
        keep = np.flatnonzero(covered | np.r_[False, covered[:-1]])
        sub = np.where(covered[keep], ids[keep], 0).astype(np.int64)
        different, back = np.unique(place[full], return_inverse=True)
        long[full] = np.maximum(WINDOW, block.longest(np.r_[sub, 0], np.searchsorted(keep, different))[back])
    return long


def _shards(texts: list, block: Block) -> Iterator[tuple[int, list[int], np.ndarray]]:
    """(first document, words of each document, word numbers with a 0 behind each document)."""
    get, first, sizes, parts, total = block.vocabulary.get, 0, [], [], 0
    for k, text in enumerate(texts):
        words = words_of(text)
        parts += [np.fromiter(map(get, words, repeat(0)), np.int32, len(words)), np.zeros(1, np.int32)]
        sizes.append(len(words))
        total += len(words)
        if total >= SHARD_WORDS:
            yield first, sizes, np.concatenate(parts)
            first, sizes, parts, total = k + 1, [], [], 0
    if sizes:
        yield first, sizes, np.concatenate(parts)


def _match(block: Block, texts: list, before: list | None) -> Iterator[tuple[int, int, list[pa.Array]]]:
    """Results of the rows [from, to), some at a time, so that items of one batch are bounded."""
    n = len(texts)
    words, longest, spans, none = [0] * n, [0] * n, [[] for _ in range(n)], np.zeros(0, np.int64)
    items = [none] * n
    for first, sizes, ids in _shards(texts, block):
        words[first : first + len(sizes)] = sizes
        place, window = search(block, ids)
        if not len(place):
            continue
        begins = np.cumsum([0, *(s + 1 for s in sizes)])
        mark = np.zeros(len(ids) + 1, np.int64)
        np.add.at(mark, place, 1)
        np.add.at(mark, place + block.size[window], -1)
        covered = np.cumsum(mark[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.r_[0, covered.astype(np.int8), 0])).reshape(-1, 2)
        for d, (a, b) in zip(np.searchsorted(begins, edges[:, 0], side="right") - 1, edges):
            spans[first + d].append([int(a - begins[d]), int(b - begins[d])])
        doc = np.searchsorted(begins, place, side="right") - 1
        long = _longest(block, ids, place, window, covered)
        by_doc = np.argsort(doc, kind="stable")
        listed: dict[bytes, np.ndarray] = {}
        for own in np.split(by_doc, np.flatnonzero(np.diff(doc[by_doc])) + 1):
            d, held = first + int(doc[own[0]]), np.unique(window[own])
            longest[d] = int(long[own].max())
            key = held.tobytes()  # copies of a passage share one list
            if key not in listed:
                listed[key] = np.unique(np.concatenate([block.bearers[block.first[w] : block.first[w + 1]] for w in held]))
            items[d] = listed[key]
    begin = 0
    while begin < n:
        end, total = begin, 0
        while end < n and (end == begin or total + len(items[end]) <= BATCH_NAMES):
            total += len(items[end])
            end += 1
        names = [block.names[c].tolist() if len(c) else [] for c in items[begin:end]]
        part_long, part_spans = longest[begin:end], spans[begin:end]
        for k, old in enumerate((before or [])[begin:end]):
            names[k] = sorted({*names[k], *old["items"]})
            part_long[k] = max(part_long[k], old["longest_match"])
            part_spans[k] = _union([*part_spans[k], *old["spans"]])
        yield begin, end, [
            pa.array(words[begin:end], pa.int64()),
            pa.array([sum(b - a for a, b in s) for s in part_spans], pa.int64()),
            pa.array(names, pa.list_(pa.string())),
            pa.array(part_long, pa.int64()),
            pa.array(part_spans, pa.list_(pa.list_(pa.int64()))),
        ]
        begin = end


def _union(spans: list) -> list:
    out: list = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items in blocks of about block_words words, read one partition at a time. The stated query set."""
    rows, total = [], 0
    for name, raw in benchmark.select(F.col(item).cast("string"), F.col(text).cast("binary")).toLocalIterator():
        words = words_of(bytes(raw) if raw is not None else None)
        if words:
            rows.append((name, words))
            total += len(words)
        if total >= block_words:
            yield Block.of(rows)
            rows, total = [], 0
    if rows:
        yield Block.of(rows)


def find_matches(docs: DataFrame, benchmark: DataFrame, keep: list, text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The columns of `keep` with n_words, n_hit, items, longest_match, spans, for every row of docs.

    Tasks build a suffix array over each shard of their own texts and search every different benchmark
    window in it, so no text is shuffled. spans are the hit words ([from, to) in words), longest_match the
    words of the longest verbatim match that begins with a window. Benchmarks above block_words go in
    blocks, one at a time, with a written table after each; spans of the passes are united. Null and wordless documents have no words and no hits; null or wordless items
    have no windows; an item without id hits but isn't listed; items with equal ids count once; an empty
    benchmark hits nothing; equal rows are judged each for itself; an empty table gives no rows.
    """
    names, out, shared = [f.name for f in HITS], None, None
    for block in blocks(benchmark, block_words=block_words):
        if out is not None:
            out = stash(out)
            shared.unpersist()
        shared = docs.sparkSession.sparkContext.broadcast(block)
        if out is None:
            out = _pass(docs, keep, shared, text, False, names)
        else:
            out = _pass(out, [c for c in out.columns if c != "__text_again"], shared, "__text_again", True, names)
    if out is None:
        out = _pass(docs, keep, docs.sparkSession.sparkContext.broadcast(Block.of([])), text, False, names)
    return out.drop("__text_again")


def _pass(docs: DataFrame, keep: list, shared, text: str, again: bool, names: list[str]) -> DataFrame:
    source = docs.select(*keep, F.col(text).cast("binary").alias("__text_again"))
    fixed = [f for f in source.schema.fields if f.name != "__text_again" and f.name not in (names if again else [])]
    schema = T.StructType([*fixed, *HITS, T.StructField("__text_again", T.BinaryType())])

    def run(batches):
        block = shared.value
        for batch in batches:
            texts = batch.column("__text_again")
            before = batch.select(names).to_pylist() if again else None
            for a, b, found in _match(block, texts.to_pylist(), before):
                kept = [batch.column(f.name).slice(a, b - a) for f in fixed]
                yield pa.RecordBatch.from_arrays([*kept, *found, texts.slice(a, b - a)], names=schema.names)

    return source.mapInArrow(run, schema)


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    return (F.col(n_hit) > 0) & (F.col(n_hit) * SHARE >= F.col(n_words))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """docs without the contaminated rows; the columns stay."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    found = find_matches(docs, benchmark, [row], text)
    return found.where(~contaminated()).select("__row.*")


def op3_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_matches(docs, read_table(spark, sf_dir, "benchmark"), ["doc_id"])
    ids = F.array_join("items", ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), contaminated().alias("contaminated"), "longest_match",
    )


QUERIES = {"op3_suffix_decontamination": op3_suffix_decontamination}

#: Words as DuckDB cuts them.
SQL_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: Windows as strings, joined; a longest match is the longest run of windows on one diagonal.
ORACLES = {
    "op3_suffix_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {SQL_WORDS} AS w FROM documents),
 i AS (SELECT row_number() OVER () AS n, item_id::VARCHAR AS id, {SQL_WORDS} AS w FROM benchmark),
 k AS (SELECT n, id, w, least({WINDOW}, len(w)) AS l FROM i WHERE len(w) > 0),
 iw AS (SELECT n, id, l, q, array_to_string(w[q:q + l - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - l + 2)) AS q FROM k)),
 dw AS (SELECT r, p, l, array_to_string(w[p:p + l - 1], ' ') AS s FROM (SELECT r, w, l, unnest(range(1, greatest(len(w) - l + 2, 1))) AS p FROM d, (SELECT DISTINCT l FROM k))),
 m AS (SELECT r, p, l, n, id, q FROM dw JOIN iw USING (l, s)),
 h AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + l)) AS place FROM (SELECT DISTINCT r, p, l FROM m)) GROUP BY r),
 t AS (SELECT r, list_sort(list(DISTINCT id) FILTER (WHERE id IS NOT NULL)) AS ids FROM m GROUP BY r),
 runs AS (SELECT r, n, l, p - q AS g, p - row_number() OVER (PARTITION BY r, n, p - q ORDER BY p) AS run FROM m),
 lm AS (SELECT r, max(c + l - 1) AS longest_match FROM (SELECT r, n, l, g, run, count(*) AS c FROM runs GROUP BY ALL) GROUP BY r),
 a AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(ids, []) AS ids, coalesce(longest_match, 0)::BIGINT AS longest_match FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r) LEFT JOIN lm USING (r))
SELECT doc_id, n_words, n_hit, len(ids)::BIGINT AS n_items, sha256(array_to_string(ids, ',')) AS items_sha256, n_hit > 0 AND {SHARE} * n_hit >= n_words AS contaminated, longest_match FROM a""",
}
