"""Language identification with hyperdimensional profiles: permuted random letter vectors are bound into
n-gram vectors and bundled; texts and language prototypes are compared by cosine."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.common import DRAW_BITS, crc_bucket, draw, map_texts, read_table

#: Size of the vectors, letters of an n-gram, seed of the letters' vectors.
DIMENSION, GRAM, SEED = 1024, 3, 20
#: Training rows of each language at most, chosen by a hash of their id.
MAX_PER_LANG = 2_000
#: Rows of the table of languages up to which it is broadcast.
MAX_BROADCAST = 10_000
#: Texts and n-grams handled at once.
TEXTS, GRAMS = 256, 8_192
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=20_000)
def letter_vector(code: int) -> np.ndarray:
    """The random vector of -1 and 1 of a letter; 0 stands for the edge of a word."""
    return (np.random.default_rng([SEED, code]).integers(0, 2, DIMENSION, np.int8) * 2 - 1).astype(np.int8)


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """Product of the letters' vectors, each rotated by its place in the n-gram."""
    out = np.ones((len(grams), DIMENSION), np.int8)
    for place in range(GRAM):
        codes, row = np.unique((grams >> np.uint64(21 * (GRAM - 1 - place))) & np.uint64(0x1FFFFF), return_inverse=True)
        out *= np.array([np.roll(letter_vector(int(c)), GRAM - 1 - place) for c in codes])[row]
    return out


def gram_counts(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and how often they occur. Letters in lower case; runs of others are one edge."""
    raw = (text or b"").decode("utf-8", "replace").lower().encode("utf-32-le", "replace")
    codes = np.frombuffer(raw, np.uint32)
    letter = letters()[codes]
    if not letter.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes = np.where(letter, codes, 0)
    codes = np.r_[0, codes[letter | np.r_[False, letter[:-1]]], 0].astype(np.uint64)
    windows = (codes[:-2] << np.uint64(42)) | (codes[1:-1] << np.uint64(21)) | codes[2:]
    return np.unique(windows[codes[1:-1] > 0], return_counts=True)


def profiles(texts: list) -> np.ndarray:
    """One bundle for each text, of length 1 (0 for texts without letters)."""
    counted = [gram_counts(t) for t in texts]
    grams = np.unique(np.concatenate([g for g, _ in counted])) if counted else np.zeros(0, np.uint64)
    out = np.zeros((len(texts), DIMENSION), np.float32)
    for first in range(0, len(grams), GRAMS):
        part = grams[first : first + GRAMS]
        counts = np.zeros((len(texts), len(part)), np.float32)
        for i, (g, n) in enumerate(counted):
            a, b = np.searchsorted(g, [part[0], part[-1] + np.uint64(1)])
            counts[i, np.searchsorted(part, g[a:b])] = n[a:b]
        out += counts @ gram_vectors(part).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def held_out(doc_id):
    return crc_bucket(doc_id, 5) == 0


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", bound: int = MAX_PER_LANG) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes: the sums of their training texts' profiles, from which the common
    direction of all prototypes is taken away. Tasks sum what they see; Spark sums the sums.

    A language learns from about `bound` different texts at most, chosen by a hash of the text, so copies
    and hot ids count once. A table without a known language gives no prototype.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & ~held_out(F.col("id")))
    drawn = draw(F.lit("train"), "text")
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n"))
    cut = F.least(F.lit(1.0), F.lit(float(bound)) / F.col("n")) * float(1 << DRAW_BITS)
    few = sizes.count() <= MAX_BROADCAST
    rows = rows.join(F.broadcast(sizes) if few else sizes, "lang").withColumn("draw", drawn).where(F.col("draw") <= cut)
    rows = rows.dropDuplicates(["lang", "draw"])

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for first in range(0, batch.num_rows, TEXTS):
                part = batch.slice(first, TEXTS)
                found, langs = profiles(part["text"].to_pylist()), np.array(part["lang"].to_pylist(), object)
                for name in set(langs):
                    sums[name] = sums.get(name, 0) + found[langs == name].sum(axis=0, dtype=np.float64)
        for name, vector in sums.items():
            arrays = [pa.array([name] * DIMENSION, pa.string()), pa.array(range(DIMENSION), pa.int32()), pa.array(np.rint(vector * 1e6).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "at", "value"])

    parts = rows.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(bundle, "lang string, at int, value long")
    sums = parts.groupBy("lang", "at").agg(F.sum("value").alias("value")).collect()
    names = sorted({r["lang"] for r in sums})
    out = np.zeros((len(names), DIMENSION))
    for r in sums:
        out[names.index(r["lang"]), r["at"]] = r["value"]
    return names, _centred(out)


def _centred(sums: np.ndarray) -> np.ndarray:
    unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    mean = unit.mean(axis=0) if len(unit) > 1 else np.zeros(DIMENSION)
    unit = unit - mean
    return (unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list, text: str = "text") -> DataFrame:
    """The columns of `keep` with lang_pred and score (the best cosine, from -1..1 to 0..1) for every row.

    Null texts and texts without a letter get `und` and 0, and so do all if no language was learned. Equal
    texts get equal answers, whatever their ids; of languages with equal cosines the first by name is taken;
    an empty table gives no rows; columns that aren't in `keep` are ignored, clashing names too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        names, prototypes = shared.value

        def work(texts):
            langs, scores = [], []
            for first in range(0, len(texts), TEXTS):
                found = profiles(texts[first : first + TEXTS])
                none = ~found.any(axis=1)
                cosine = found @ prototypes.T if names else np.zeros((len(found), 1), np.float32)
                best = cosine.argmax(axis=1)
                top = np.where(none | (not names), 0.0, np.clip((1 + cosine.max(axis=1)) / 2, 0, 1))
                langs += [UNKNOWN if n or not names else names[b] for n, b in zip(none, best)]
                scores += top.tolist()
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

        return work

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return map_texts(docs, keep, make, fields, text)


def op5_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    keep = [F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out")]
    return predict(docs, fit(docs), keep)


QUERIES = {"op5_hyperdimensional_language": op5_hyperdimensional_language}
ORACLES: dict[str, str] = {}
