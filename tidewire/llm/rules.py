"""Quality rules by line labelling: a linear-chain conditional random field marks the lines of a text as
content or boilerplate (Viterbi decoding), and the share of content decides whether it stays."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.common import distinct_sample, map_texts, read_table, stash
from tidewire.llm.components import components
from tidewire.llm.simhash import fingerprint, near_pairs

#: The base rules: fewest words, words of a repeated window, and their largest share in percent.
LEAST_WORDS, REPEAT_WINDOW, MOST_REPEATED = 20, 8, 30
#: Content must hold so much of a text's characters in lines with words.
CONTENT_SHARE = 0.5
#: Sequences that the field is trained on, chosen by a hash of what they hold, and their lines: texts are cut
#: into such sequences from end to end, so lines from anywhere in a text can be among them.
MAX_TRAIN, MAX_LINES = 2_000, 64
#: A line is frequent from so many documents on, copies and near copies counted once, however large the corpus is.
FREQUENT_LEAST = 20
#: A frequent line with more than 1 in so many of their occurrences is joined by broadcast (there are fewer than
#: HOT of them), the others by a shuffle, where none of them can fill a task.
HOT = 20_000

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
NOT_CHARACTERS = SPACE + bytes(range(0x80, 0xC0))  # white space and all but the first byte of a character
CUE = re.compile(rb"(?i)licen[cs]e|copyright|all rights|subscribe|sign up|cookie|click here|terms of|privacy")


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of REPEAT_WINDOW words that occur twice or more. Windows are numbered exactly,
    by pairs: numbers of 2-word windows from words, of 4 from 2, of 8 from 4."""
    n = len(words)
    if n <= REPEAT_WINDOW:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    step = 1
    while step < REPEAT_WINDOW:
        _, ids = np.unique(ids[:-step] * (int(ids.max()) + 1) + ids[step:], return_inverse=True)
        step *= 2
    again = np.bincount(ids)[ids] > 1
    edges = np.zeros(n + 1, np.int32)
    edges[: len(ids)] += again
    edges[REPEAT_WINDOW : REPEAT_WINDOW + len(ids)] -= again
    return int((np.cumsum(edges[:n]) > 0).sum())


def base_counts(text: bytes, lines: list[bytes], words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    seen: set[bytes] = set()
    repeats = 0
    for line in lines:
        if line in seen:
            repeats += not line.isspace() and line != b""
        else:
            seen.add(line)
    return len(words), len(text.translate(None, NOT_CHARACTERS)), len(text) - len(text.translate(None, SYMBOLS)), repeats, repeated_words(words)


FEATURES = (
    "bias", "frequent", "repeated", "symbols", "cue", "one_or_two_words", "few_words", "many_words", "ends_sentence",
    "digits", "capitals", "monotone", "first", "last",
)
FREQUENT, REPEATED, SYMBOL, CUED, TINY, SHORT, LONG, SENTENCE = range(1, 9)


def line_features(lines: list[bytes]) -> tuple[list[int], list[int], list[int]]:
    """For every line with a word: its features as bits (but FREQUENT), its characters, and its hash."""
    bits, sizes, hashes = [], [], []
    seen: set[bytes] = set()
    for line in lines:
        words = line.split()
        if not words:
            continue
        n = len(words)
        size = len(line.translate(None, NOT_CHARACTERS))
        strip = line.rstrip()
        got = (
            1
            | (line in seen) << REPEATED
            | ((len(line) - len(line.translate(None, SYMBOLS))) * 10 > size) << SYMBOL
            | (CUE.search(line) is not None) << CUED
            | (n <= 2) << TINY
            | (2 < n < 6) << SHORT
            | (n >= 15) << LONG
            | (strip[-1:] in b".!?:\"'") << SENTENCE
            | (sum(line.count(b"%d" % d) for d in range(10)) * 5 > size) << 9
            | (sum(map(str.isupper, line.decode("utf-8", "replace"))) * 3 > size) << 10
            | (n >= 6 and len(set(words)) * 2 < n) << 11
        )
        seen.add(line)
        bits.append(got)
        sizes.append(size)
        whole = xxhash.xxh64_intdigest(line, 42)  # as F.xxhash64 has it
        hashes.append(whole - (whole >> 63 << 64))
    if bits:
        bits[0] |= 1 << 12
        bits[-1] |= 1 << 13
    return bits, sizes, hashes


def mark_frequent(bits: list[int], hashes: list[int], frequent: set[int] | list[int] | None) -> list[int]:
    """The bits with FREQUENT for the hashes in `frequent`."""
    if not frequent:
        return bits
    known = frequent if isinstance(frequent, set) else set(frequent)
    return [b | (h in known) << FREQUENT for b, h in zip(bits, hashes)]


def expand(bits: np.ndarray) -> np.ndarray:
    return (bits[..., None] >> np.arange(len(FEATURES)) & 1).astype(np.float64)


def seeds(bits: np.ndarray) -> np.ndarray:
    """What is taken as known in training: 1 boilerplate, 0 content, -1 open. Two signs of boilerplate, or
    heavy symbols, make a line boilerplate; long lines of sentences without any sign are content."""
    sign = [(bits >> k & 1) for k in (FREQUENT, REPEATED, CUED, TINY, 9, 10, 11)]
    signs = sum(sign)
    plain = (signs == 0) & ((bits >> SYMBOL & 1) == 0)
    return np.where((signs >= 2) | (bits >> SYMBOL & 1 == 1), 1, np.where(plain & ((bits >> LONG & 1) | (bits >> SENTENCE & 1)).astype(bool), 0, -1))


def _expectations(emit: np.ndarray, move: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward sums over padded sequences (sequences, steps, 2): chances of labels and of pairs."""
    n, steps, _ = emit.shape
    score = np.exp(emit - emit.max(axis=2, keepdims=True)) * mask
    go = np.exp(move)
    ahead, back = np.zeros_like(score), np.ones_like(score)
    ahead[:, 0] = score[:, 0]
    ahead[:, 0] /= ahead[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, steps):
        ahead[:, t] = score[:, t] * (ahead[:, t - 1] @ go)
        ahead[:, t] /= ahead[:, t].sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        back[:, t] = (score[:, t + 1] * back[:, t + 1]) @ go.T
        back[:, t] /= back[:, t].sum(axis=1, keepdims=True)
    one = ahead * back
    one /= one.sum(axis=2, keepdims=True)
    two = ahead[:, :-1, :, None] * go * (score[:, 1:] * back[:, 1:])[:, :, None, :]
    two /= two.sum(axis=(2, 3), keepdims=True)
    return one, two


def fit_field(sequences: list[list[int]], rounds: int = 150, rate: float = 2.0, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features, 2) and transitions (2, 2) by gradient ascent on the likelihood of the known labels,
    with the open ones summed out. Sequences over MAX_LINES are cut; equal ones are taken once, with their
    number as a weight, and those of about the same length go through the sums together."""
    weights, move = np.zeros((len(FEATURES), 2)), np.zeros((2, 2))
    often = Counter(tuple(s[i : i + MAX_LINES]) for s in sequences for i in range(0, len(s), MAX_LINES))
    if not often:
        return weights, move
    by_length: dict[int, list] = {}
    for s, n in sorted(often.items()):
        by_length.setdefault((len(s) - 1).bit_length(), []).append((s, n))
    groups = []
    for rows in by_length.values():
        steps = max(len(s) for s, _ in rows)
        bits, real, weigh = np.zeros((len(rows), steps), np.int64), np.zeros((len(rows), steps)), np.array([float(n) for _, n in rows])
        for i, (s, n) in enumerate(rows):
            bits[i, : len(s)], real[i, : len(s)] = s, n
        known = seeds(bits)
        held = np.stack([known != 1, known != 0], axis=2).astype(float)
        both = (real[:, 1:] > 0) * weigh[:, None]
        groups.append((expand(bits), held, np.ones_like(held), real[..., None], both[..., None, None]))
    total = sum(real.sum() for *_, real, _ in groups)
    for _ in range(rounds):
        up, go = np.zeros_like(weights), np.zeros_like(move)
        for x, held, free, real, both in groups:
            emit = x @ weights
            one1, two1 = _expectations(emit, move, held)
            one0, two0 = _expectations(emit, move, free)
            up += np.tensordot(x, (one1 - one0) * real, axes=((0, 1), (0, 1)))
            go += ((two1 - two0) * both).sum(axis=(0, 1))
        weights += rate * (up / total - ridge * weights)
        move += rate * (go / total - ridge * move)
    return weights, move


def viterbi(emit: list[list[float]], move: list[list[float]]) -> list[int]:
    """The best labels, 1 for boilerplate."""
    c, b = emit[0]
    back = []
    for e0, e1 in emit[1:]:
        c0, c1 = c + move[0][0], b + move[1][0]
        b0, b1 = c + move[0][1], b + move[1][1]
        back.append((c1 > c0, b1 > b0))
        c, b = max(c0, c1) + e0, max(b0, b1) + e1
    label = int(b > c)
    out = [label]
    for step in reversed(back):
        label = int(step[label])
        out.append(label)
    return out[::-1]


def frequent_table(rows: DataFrame) -> DataFrame:
    """(hash, n, occurrences) of the lines that are frequent in the whole corpus. rows: fingerprint, hashes.

    n counts the documents with the line, those of one component of near duplicates once: lines that only
    copies of one text share are not frequent, wherever they stand; a block of boilerplate on different
    pages is, with every line of it.
    """
    nodes = stash(rows.select("fingerprint").distinct())
    roots = stash(components(near_pairs(nodes)))
    lines = rows.select("fingerprint", F.array_distinct("hashes").alias("hashes"))
    lines = lines.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    found = lines.select(F.coalesce("root", "fingerprint").alias("root"), F.explode("hashes").alias("hash"))
    found = found.groupBy("hash", "root").agg(F.count("*").alias("occurrences"))
    counts = found.groupBy("hash").agg(F.count("*").alias("n"), F.sum("occurrences").alias("occurrences"))
    return counts.where(F.col("n") >= FREQUENT_LEAST)


def frequent_lines(docs: DataFrame, text: str = "text") -> list[int]:
    """The hashes of frequent_table() in the driver, for small tables."""
    return [r["hash"] for r in frequent_table(read_lines(docs, [F.lit(0)], text)).select("hash").collect()]


def frequent_marks(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """(row, frequent): the hashes of the frequent lines of each row that has any. rows: row, hashes."""
    pairs = rows.select("row", F.explode(F.array_distinct("hashes")).alias("hash"))
    total = frequent.agg(F.sum("occurrences")).first()[0] or 0
    hot = F.col("occurrences") * HOT > total
    often, seldom = F.broadcast(frequent.where(hot).select("hash")), frequent.where(~hot).select("hash")
    found = pairs.join(often, "hash", "left_semi").unionByName(pairs.join(often, "hash", "left_anti").join(seldom, "hash", "left_semi"))
    return found.groupBy("row").agg(F.collect_list("hash").alias("frequent"))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def read_lines(docs: DataFrame, keep: list, text: str = "text") -> DataFrame:
    """A written table with one row for each row of docs: row (its number), keep (a struct), COUNTS, the
    fingerprint of op10, and bits, sizes and hashes of its lines with words."""

    def make():
        def work(texts):
            out = []
            for text in texts:
                text = text or b""
                lines, words = text.split(b"\n"), text.split()
                out.append((*base_counts(text, lines, words), fingerprint(text), *line_features(lines)))
            columns = list(zip(*out)) if out else [()] * 9
            kinds = [pa.int64()] * 6 + [pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            return [pa.array(c, k) for c, k in zip(columns, kinds)]

        return work

    many = [T.StructField(n, T.ArrayType(t)) for n, t in (("bits", T.IntegerType()), ("sizes", T.IntegerType()), ("hashes", T.LongType()))]
    fields = [*(T.StructField(n, T.LongType()) for n in (*COUNTS, "fingerprint")), *many]
    rows = map_texts(docs, [F.struct(*keep).alias("keep")], make, fields, text)
    return stash(rows.withColumn("row", F.monotonically_increasing_id()))


def training_sequences(rows: DataFrame, frequent: DataFrame) -> list[list[int]]:
    """The features of about MAX_TRAIN sequences of lines from all texts, FREQUENT among them. Both tables
    that come to the driver are bounded by the sample. rows: bits, hashes."""
    pieces = F.sequence(F.lit(0), F.ceil(F.size("bits") / MAX_LINES).cast("int") - 1)
    piece = F.transform(pieces, lambda i: F.struct(*[F.slice(F.col(c), i * MAX_LINES + 1, F.lit(MAX_LINES)).alias(c) for c in ("bits", "hashes")]))
    cut = rows.where(F.size("bits") > 0).select(F.explode(piece).alias("piece"))
    sample = stash(distinct_sample(cut, "piece", MAX_TRAIN)[0].select("piece.*"))
    seen = sample.select(F.explode("hashes").alias("hash")).distinct()
    known = {r["hash"] for r in frequent.select("hash").join(F.broadcast(seen), "hash", "left_semi").collect()}
    return [mark_frequent(r["bits"], r["hashes"], known) for r in sample.collect()]


def label_quality(docs: DataFrame, keep: list, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of `keep` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    content_share and kept, for every row of docs.

    Null, empty and wordless texts have counts of 0, fail the base rules and have a content share of 0;
    equal rows are judged alike; an empty table gives no rows and trains nothing. Texts are read into
    features of lines once; whether a line is frequent comes by joins, so no list of lines has to fit in a task.
    """
    spark = docs.sparkSession
    rows = read_lines(docs, keep, text)
    frequent = stash(frequent_table(rows))
    marks = stash(frequent_marks(rows, frequent))
    field = spark.sparkContext.broadcast(fit_field(training_sequences(rows, frequent)))

    marked = rows.join(marks, "row", "left").select("keep", *COUNTS, "bits", "sizes", "hashes", "frequent")
    kept = marked.schema.fields[: 1 + len(COUNTS)]
    names = [*(f.name for f in kept), "content_share"]

    def judge(batches):
        weights, move = field.value
        moves = move.tolist()
        emitted: dict[int, list[float]] = {}

        def content(bits: list[int], sizes: list[int]) -> float:
            if not bits:
                return 0.0
            for b in bits:
                if b not in emitted:
                    emitted[b] = (expand(np.array(b)) @ weights).tolist()
            marks = viterbi([emitted[b] for b in bits], moves)
            return sum(s for s, m in zip(sizes, marks) if not m) / max(1, sum(sizes))

        for batch in batches:
            lists = zip(*(batch.column(c).to_pylist() for c in ("bits", "sizes", "hashes", "frequent")))
            shares = [content(mark_frequent(b, h, f), s) for b, s, h, f in lists]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(shares, pa.float64())], names=names)

    judged = marked.mapInArrow(judge, T.StructType([*kept, T.StructField("content_share", T.DoubleType())])).select("keep.*", *COUNTS, "content_share")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    judged = judged.withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= CONTENT_SHARE))


def op2_line_field_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return label_quality(docs, ["doc_id"])


QUERIES = {"op2_line_field_rules": op2_line_field_rules}
ORACLES: dict[str, str] = {}
