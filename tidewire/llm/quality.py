"""Quality by a sparse rule ensemble: the paths of small trees over text statistics are conjunctive rules, a
lasso picks and weighs them, and the rules that remain are Spark column expressions."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.common import crc_bucket, labelled_sample, map_texts, read_table
from tidewire.llm.rules import base_counts

#: Labelled rows to learn from: so many of each class at most, chosen by a hash of their id.
MAX_PER_CLASS = 8_000
TREES, DEPTH, BINS, LEAST_LEAF, SHRINK = 24, 3, 32, 20, 0.3
LASSO, STEPS, SEED = 0.002, 400, 4
THRESHOLD = 0.3

STATISTICS = (
    "log_words", "mean_word", "longest_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
    "top_share", "twice_share", "upper_share", "digit_share", "stop_share", "comma_share", "line_words", "short_lines",
    "beyond_ascii", "short_words",
)
DIGITS, UPPER = b"0123456789", bytes(range(65, 91))


def statistics(text: bytes | None) -> list[float]:
    """The STATISTICS of a whole text; all 0 for null, empty and wordless ones."""
    text = text or b""
    words, lines = text.split(), text.split(b"\n")
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    _, chars, symbols, dup_lines, repeated = base_counts(text, lines, words)
    counts = Counter(words)
    sizes = [len(x.split()) for x in lines]
    full = [s for s in sizes if s]

    def without(chars: bytes) -> int:
        return len(text) - len(text.translate(None, chars))

    return [
        float(np.log1p(n)), chars / n, float(max(map(len, counts))), symbols / chars, dup_lines / len(full), repeated / n, len(counts) / n,
        counts.most_common(1)[0][1] / n, sum(a == b for a, b in zip(words, words[1:])) / n, without(UPPER) / chars, without(DIGITS) / chars,
        without(b".!?") / n, without(b",;:") / n, n / len(full), sum(s < 5 for s in full) / len(full),
        1 - len(text.translate(None, bytes(range(128)))) / len(text), sum(c for w, c in counts.items() if len(w) <= 3) / n,
    ]


def with_statistics(docs: DataFrame, keep: list, text: str = "text") -> DataFrame:
    def make():
        def work(texts):
            table = np.array([statistics(t) for t in texts]).reshape(-1, len(STATISTICS))
            return [pa.array(np.ascontiguousarray(c)) for c in table.T]

        return work

    return map_texts(docs, keep, make, [T.StructField(f"__{s}", T.DoubleType()) for s in STATISTICS], text)


#: A rule: (statistic, above?, limit) conditions that all hold.
Rule = tuple[tuple[int, bool, float], ...]


def _best_split(codes: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[float, int, int]:
    """The gain, statistic and bin of the best cut; codes are bins of the statistics."""
    best = (1e-6, -1, -1)
    total_g, total_h = grad.sum(), hess.sum()
    for j in range(codes.shape[1]):
        g = np.cumsum(np.bincount(codes[:, j], grad, BINS))[:-1]
        h = np.cumsum(np.bincount(codes[:, j], hess, BINS))[:-1]
        n = np.cumsum(np.bincount(codes[:, j], minlength=BINS))[:-1]
        gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
        gain[(n < LEAST_LEAF) | (len(grad) - n < LEAST_LEAF)] = 0
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), j, k)
    return best


def grow_rules(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[Rule]:
    """All paths of a few boosted trees, each on half of the rows."""
    rng = np.random.default_rng(SEED)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    codes = np.array([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)]).T
    odds = np.full(len(y), np.log((weight @ y + 1) / (weight @ (1 - y) + 1)))
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        grad, hess = weight * (y - p), weight * p * (1 - p)
        half = rng.random(len(y)) < 0.5
        step = np.zeros(len(y))
        open_ = [(np.ones(len(y), bool), ())]
        while open_:
            rows, path = open_.pop()
            own = rows & half
            gain, j, k = _best_split(codes[own], grad[own], hess[own]) if len(path) < DEPTH and own.sum() >= 2 * LEAST_LEAF else (0, -1, -1)
            if path:
                rules[tuple(sorted(path))] = None
            if j < 0:
                step[rows] = grad[own].sum() / (hess[own].sum() + 1)
                continue
            above = codes[:, j] > k
            open_ += [(rows & above, (*path, (j, True, float(cuts[j][k])))), (rows & ~above, (*path, (j, False, float(cuts[j][k]))))]
        odds = odds + SHRINK * step
    return list(rules)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, above, limit in rule:
        out &= (x[:, j] > limit) == above
    return out


def lasso(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights (the bias last) of a logistic regression with an absolute penalty, by proximal gradient steps."""
    share = weight / weight.sum()
    z = np.c_[z, np.ones(len(z))]
    top = np.ones(z.shape[1])
    for _ in range(20):
        top = z.T @ (share * (z @ top))
        top /= np.linalg.norm(top)
    rate = 4 / max(float(top @ (z.T @ (share * (z @ top)))), 1e-9)
    w, before = np.zeros(z.shape[1]), np.zeros(z.shape[1])
    for k in range(STEPS):
        look = w + k / (k + 3) * (w - before)
        p = 1 / (1 + np.exp(-np.clip(z @ look, -30, 30)))
        moved = look - rate * (z.T @ (share * (p - y)))
        shrunk = np.sign(moved) * np.maximum(np.abs(moved) - rate * LASSO, 0)
        w, before = np.r_[shrunk[:-1], moved[-1]], w
    return w


@dataclass
class RuleEnsemble:
    rules: list[Rule]
    weights: list[float]
    bias: float

    def score(self) -> Column:
        """Chance of label 1 as a column over the statistics' columns."""
        odds = F.lit(float(self.bias))
        for rule, weight in zip(self.rules, self.weights):
            odds = odds + F.when(rule_column(rule), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))

    def describe(self) -> list[str]:
        said = [" and ".join(f"{STATISTICS[j]} {'>' if up else '<='} {v:.4g}" for j, up, v in r) for r in self.rules]
        return [f"{w:+.3f} if {r}" for w, r in sorted(zip(self.weights, said), key=lambda x: -abs(x[0]))]


def rule_column(rule: Rule) -> Column:
    out = F.lit(True)
    for j, above, limit in rule:
        column = F.col(f"__{STATISTICS[j]}")
        out = out & ((column > F.lit(limit)) if above else (column <= F.lit(limit)))
    return out


def fit(train: DataFrame) -> RuleEnsemble:
    """From (text, label, weight), a bounded sample whose statistics come to the driver. Without rows of
    both classes there is no rule, and every score is the share of label 1 (1/2 without any row)."""
    rows = with_statistics(train, ["label", "weight"]).collect()
    data = np.array(sorted(tuple(r) for r in rows)).reshape(-1, 2 + len(STATISTICS))
    y, weight, x = data[:, 0], data[:, 1], data[:, 2:]
    prior = float(np.log((weight @ y + 0.5) / (weight @ (1 - y) + 0.5)))
    if not 0 < y.sum() < len(y):
        return RuleEnsemble([], [], prior)
    rules = grow_rules(x, y, weight)
    w = lasso(np.array([holds(r, x) for r in rules], float).T.reshape(len(x), len(rules)), y, weight)
    kept = [i for i in range(len(rules)) if abs(w[i]) > 1e-6]
    return RuleEnsemble([rules[i] for i in kept], [float(w[i]) for i in kept], float(w[-1]))


def held_out(doc_id):
    return crc_bucket(doc_id, 5) == 0


def score_quality(docs: DataFrame, model: RuleEnsemble, keep: list, text: str = "text") -> DataFrame:
    """The columns of `keep` with score and predicted, for every row of docs.

    Null and empty texts have statistics of 0 and a score like any other; equal texts get equal scores,
    whatever their ids; a statistic that ties with a rule's limit is not above it; an empty table gives no
    rows; columns that aren't in `keep` are ignored, so names that clash with results do no harm.
    """
    scored = with_statistics(docs, keep, text).withColumn("score", model.score())
    return scored.drop(*(f"__{s}" for s in STATISTICS)).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op4_rule_ensemble_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    train = labelled_sample(docs, read_table(spark, sf_dir, "labels"), "quality", "doc_id", "text", held_out, MAX_PER_CLASS)
    return score_quality(docs, fit(train), [F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out")])


QUERIES = {"op4_rule_ensemble_quality": op4_rule_ensemble_quality}
ORACLES: dict[str, str] = {}
