"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model of their
accuracies and correlations, and a linear classifier trained on its posterior labels."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.common import crc_bucket, distinct_sample, labelled_sample, map_texts, read_table, stash

#: Labelled rows to learn lexicons from, so many of each class at most, and texts without a label that the
#: label model and the classifier learn from beside them. Chosen by hashes.
MAX_PER_CLASS, MAX_UNLABELLED = 10_000, 10_000
#: Entries of all lexicons together. An entry is scored by its log odds, half a document added on each side,
#: less SURE standard errors and half the log of the number of toxic texts (as the Bayesian criterion charges
#: a parameter), MARGIN at most; those above zero are entries, the best first.
MAX_ENTRIES, SURE, MARGIN = 2_000, 1.0, 3.0
THRESHOLD = 0.3
#: Words remembered by a task with the entries that they match.
REMEMBERED = 300_000

TOKEN = re.compile(r"[^\W\d_]+")
#: Kinds of lexicon entries: whole words, and beginnings of words of so many letters.
KINDS = ("w", 4, 5, 6)
#: An entry can ask for so many of its words in a text: families of words say more together than alone.
OFTEN = (1, 2, 3)
#: Pattern voters, each a name and what it looks for in the text as written.
PATTERNS = (
    ("shouting", re.compile(r"(?:\b[A-Z]{4,}\b[^\w]*){3}")),
    ("exclaiming", re.compile(r"!{2,}|!\?|\?!")),
    ("drawn_out", re.compile(r"([^\W\d_])\1{3}")),
    ("addressing", re.compile(r"(?i)\byou(?:'re| are| all)?\s+(?:an?\s+)?\w+!")),
    ("masked_word", re.compile(r"\b\w[*@#$%]{2,}\w*")),
)
#: Signs of which a text must hold one for a pattern to be in it.
NEEDS = {"exclaiming": "!", "addressing": "!", "masked_word": "*@#$%"}


def shown_patterns(text: str, numbers=range(len(PATTERNS))) -> list[int]:
    """Those of the patterns (by number) that a text shows."""
    out = []
    for k in numbers:
        name, pattern = PATTERNS[k]
        needs = NEEDS.get(name)
        if (needs is None or any(sign in text for sign in needs)) and pattern.search(text):
            out.append(k)
    return out


def decode(text: bytes | None) -> str:
    return (text or b"").decode("utf-8", "replace")


def stems_of(word: str) -> list[str]:
    """The word itself and its beginnings, by kind."""
    return [f"w:{word}", *(f"{k}:{word[:k]}" for k in KINDS[1:] if len(word) >= k)]


def entries_of(text: str) -> set[str]:
    """All lexicon entries (times|kind:letters) that a text could match."""
    counts: Counter = Counter()
    for word, n in Counter(TOKEN.findall(text.lower())).items():
        for stem in stems_of(word):
            counts[stem] += n
    return {f"{m}|{stem}" for stem, n in counts.items() for m in OFTEN if n >= m}


class Matcher:
    """Entries of the lexicons that a text matches, by their numbers."""

    def __init__(self, entries: list[str]):
        self.numbers: dict[str, list[tuple[int, int]]] = {}
        for i, entry in enumerate(entries):
            often, stem = entry.split("|", 1)
            self.numbers.setdefault(stem, []).append((int(often), i))
        self.known: dict[str, tuple[str, ...]] = {}

    def __call__(self, text: str) -> set[int]:
        counts: dict[str, int] = {}
        known = self.known
        for word, n in Counter(TOKEN.findall(text.lower())).items():
            stems = known.get(word)
            if stems is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                stems = known[word] = tuple(x for x in stems_of(word) if x in self.numbers)
            for stem in stems:
                counts[stem] = counts.get(stem, 0) + n
        return {i for stem, n in counts.items() for often, i in self.numbers[stem] if n >= often}


def learn_entries(train: DataFrame) -> list[str]:
    """Words and beginnings of words that stand out in toxic texts, best first. Counted over all of train.

    Rare entries pay by the width of their interval, so a few labels give a few sure entries and many give
    the rarer ones too; there is no fixed number of documents below which nothing is learned.
    """

    def count(batches):
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for raw, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
                (toxic if label else clean).update(entries_of(decode(raw)))
        both = list(toxic)  # what no toxic text of this task holds only counts against entries of others
        both += [e for e in clean if e not in toxic]
        columns = {"entry": both, "toxic": [toxic[e] for e in both], "clean": [clean[e] for e in both]}
        kinds = {"entry": pa.string(), "toxic": pa.int64(), "clean": pa.int64()}
        yield pa.RecordBatch.from_pydict(columns, schema=pa.schema(kinds))

    sums = train.select(F.col("text").cast("binary").alias("text"), "label").mapInArrow(count, "entry string, toxic long, clean long")
    sums = sums.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic > 1")
    n = {r[0]: r[1] for r in train.groupBy("label").count().collect()}
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(toxic / (n.get(1, 0) + 1.0)) - F.log(clean / (n.get(0, 0) + 1.0))
    sure = odds - SURE * F.sqrt(1 / toxic + 1 / clean) - min(MARGIN, 0.5 * float(np.log(max(1, n.get(1, 0)))))
    best = sums.where(sure > 0).orderBy((F.col("toxic") * sure).desc(), "entry").limit(MAX_ENTRIES)
    return [r["entry"] for r in best.select("entry").collect()]


def voter_of(entry: str) -> int:
    """Entries make a lexicon for each kind, single or repeated, and half: split by a checksum, so that
    voters of one kind can disagree."""
    often, stem = entry.split("|", 1)
    kind = [str(k) for k in KINDS].index(stem.split(":", 1)[0])
    return 4 * kind + 2 * (often != "1") + zlib.crc32(entry.encode()) % 2


LEXICONS = 4 * len(KINDS)
VOTERS = LEXICONS + len(PATTERNS)


@dataclass
class LabelModel:
    """A hidden class with voters on a tree: each voter's chance to fire depends on the class and on the vote
    of its parent, the voter that it goes together with most beyond the class."""

    prior: float
    fires: np.ndarray  # (2, voters): how often a voter fires for each true class
    parent: np.ndarray  # of each voter, -1 for none
    given: np.ndarray  # (2, 2, voters): how often it fires for each class and vote of its parent
    trust: np.ndarray  # share of its evidence that is its own, given all that it goes together with

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        votes = votes.astype(bool)
        above = np.where(self.parent >= 0, votes[:, self.parent], False).astype(int)
        at = np.arange(votes.shape[1])
        odds = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for y, sign in ((1, 1), (0, -1)):
            chance = self.given[y][above, at]
            odds += sign * np.log(np.where(votes, chance, 1 - chance)).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _strongest_tree(votes: np.ndarray, shares: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Parents of the tree that keeps most of the voters' mutual information within the classes (Chow and
    Liu 1968, with the class given), grown from the first voter."""
    x, n = votes.astype(float), votes.shape[1]
    told = np.zeros((n, n))
    for q in shares:
        total = max(q.sum(), 1e-9)
        both = (x.T * q) @ x / total
        one = np.diag(both)
        for joint, free in (
            (both, np.outer(one, one)),
            (one[:, None] - both, np.outer(one, 1 - one)),
            (one[None, :] - both, np.outer(1 - one, one)),
            (1 - one[:, None] - one[None, :] + both, np.outer(1 - one, 1 - one)),
        ):
            joint = np.clip(joint, 1e-12, 1)
            told += total * joint * np.log(joint / np.clip(free, 1e-12, 1))
    parent, inside = np.full(n, -1), np.zeros(n, bool)
    best, best_from = told[0].copy(), np.zeros(n, int)
    inside[0] = True
    for _ in range(n - 1):
        k = int(np.where(inside, -np.inf, best).argmax())
        inside[k], parent[k] = True, best_from[k]
        closer = told[k] > best
        best, best_from = np.where(closer, told[k], best), np.where(closer, k, best_from)
    return parent


def fit_label_model(votes: np.ndarray, weight: np.ndarray, rounds: int = 60) -> LabelModel:
    """Expectation maximisation over a hidden class; no label is looked at.

    The first third of the rounds takes voters as independent within a class. Then the tree of their
    correlations is set, and the other rounds estimate the prior, and how often each voter fires for each
    class and vote of its parent.
    """
    votes = votes.astype(bool)
    n = votes.shape[1]
    belief = np.clip(votes[:, :LEXICONS].sum(axis=1) * 0.3, 0.02, 0.98)
    parent = np.full(n, -1)
    for k in range(rounds):
        shares = weight * (1 - belief), weight * belief
        if k == rounds // 3:
            parent = _strongest_tree(votes, shares)
        above = np.where(parent >= 0, votes[:, parent], False)
        fires = np.array([(q @ votes + 0.5) / (q.sum() + 1.0) for q in shares])
        given = np.empty((2, 2, n))
        for y, q in enumerate(shares):
            for a in (0, 1):
                held = above == bool(a)
                # a vote that the parent rarely casts tells little: it is drawn to the voter's own rate
                given[y, a] = (q @ (votes & held) + 2.0 * fires[y]) / (q @ held + 2.0)
        given = np.clip(given, 1e-4, 1 - 1e-4)
        prior = float(np.clip((weight * belief).sum() / max(weight.sum(), 1e-9), 1e-4, 1 - 1e-4))
        model = LabelModel(prior, np.clip(fires, 1e-4, 1 - 1e-4), parent, given, np.ones(n))
        belief = model.posterior(votes)
    rest = votes - np.where((belief >= 0.5)[:, None], model.fires[1], model.fires[0])
    scaled = rest * np.sqrt(weight / max(weight.sum(), 1e-9))[:, None]
    cov = scaled.T @ scaled
    size = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
    model.trust = 1 / np.clip(cov / np.outer(size, size), 0, 1).sum(axis=1).clip(1, None)
    return model


def fit_linear(rows: list[list[int]], target: np.ndarray, weight: np.ndarray, width: int, steps: int = 400, ridge: float = 1e-4) -> np.ndarray:
    """Weights (the bias last) of a logistic regression on soft labels, by accelerated gradient steps."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    to = np.fromiter((i for r in rows for i in r), np.int64, len(at))
    share = weight / max(weight.sum(), 1e-9)
    positive = (share * target).sum()
    share = np.where(target >= 0.5, share * min(20.0, 0.5 / max(positive, 1e-6)), share)  # rare classes count more
    w, before = np.zeros(width + 1), np.zeros(width + 1)
    counts = np.bincount(at, minlength=len(rows)) + 1.0
    rate = 4 / max((share * counts).sum(), 1e-9)
    for k in range(steps):
        look = w + k / (k + 3) * (w - before)
        odds = np.bincount(at, look[to], minlength=len(rows)) + look[-1]
        error = share * (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - target)
        grad = np.r_[np.bincount(to, error[at], minlength=width), error.sum()] + ridge * np.r_[look[:-1], 0]
        w, before = look - rate * grad, w
    return w


@dataclass
class ToxicityModel:
    entries: list[str]
    weights: np.ndarray
    labels: LabelModel | None
    base: float

    def scorer(self):
        """From texts in bytes to scores."""
        bias, w = self.weights[-1], self.weights
        if not self.entries:
            chance = float(1 / (1 + np.exp(-np.clip(bias, -30, 30))))
            return lambda text: chance
        match, patterns = Matcher(self.entries), self.patterns()

        def score(text: bytes | None) -> float:
            read = decode(text)
            hit = [*match(read), *patterns(read)]
            return float(1 / (1 + np.exp(-np.clip(bias + w[hit].sum(), -30, 30))))

        return score

    def patterns(self):
        """The patterns that a text shows, as features behind the entries."""
        n, weighed = len(self.entries), [k for k in range(len(PATTERNS)) if self.weights[len(self.entries) + k] != 0]
        return lambda text: [n + k for k in shown_patterns(text, weighed)]


def fit(train: DataFrame, unlabelled: DataFrame | None = None) -> ToxicityModel:
    """From (text, label, weight): lexicons, votes, label model, classifier, the latter two from the texts
    without a label (text, weight) too. Features of the classifier are entries and patterns.

    Where the labels give no entry (no toxic row, or too few to stand out), all scores are the share of
    toxic rows, or 0 without any.
    """
    train = stash(train)
    entries = learn_entries(train)
    if not entries:
        n = {r[0]: r[1] for r in train.groupBy("label").agg(F.sum("weight")).collect()}
        share = n.get(1, 0.0) / max(1.0, sum(n.values()))
        return ToxicityModel([], np.array([np.log(share / (1 - share)) if 0 < share < 1 else 30.0 if share else -30.0]), None, share)

    def vote(batches):
        match = Matcher(entries)
        voters = np.array([voter_of(e) for e in entries])
        for batch in batches:
            rows, votes = [], []
            for raw in batch["text"].to_pylist():
                text = decode(raw)
                hit = sorted(match(text))
                shown = shown_patterns(text)
                rows.append(hit + [len(entries) + k for k in shown])
                votes.append(sorted({*voters[hit].tolist(), *(LEXICONS + k for k in shown)}))
            arrays = [pa.array(rows, pa.list_(pa.int32())), pa.array(votes, pa.list_(pa.int32())), batch["weight"]]
            yield pa.RecordBatch.from_arrays(arrays, names=["hit", "fired", "weight"])

    source = train.select("text", "weight")
    if unlabelled is not None:
        source = source.unionByName(unlabelled.select("text", "weight"))
    source = source.select(F.col("text").cast("binary").alias("text"), "weight")
    seen = sorted(map(tuple, source.mapInArrow(vote, "hit array<int>, fired array<int>, weight double").collect()))
    votes = np.zeros((len(seen), VOTERS), bool)
    for i, (_, fired, _) in enumerate(seen):
        votes[i, fired] = True
    weight = np.array([r[2] for r in seen])
    labels = fit_label_model(votes, weight)
    target = labels.posterior(votes)
    weights = fit_linear([r[0] for r in seen], target, weight, len(entries) + len(PATTERNS))
    return ToxicityModel(entries, weights, labels, float(target.mean()))


def score_documents(docs: DataFrame, model: ToxicityModel, keep: list, text: str = "text") -> DataFrame:
    """The columns of `keep` with score and predicted, for every row of docs.

    Null, empty and wordless texts match nothing and get the bias as their score; equal texts get equal
    scores, whatever their ids; an empty table gives no rows; columns that aren't in `keep` are ignored, so
    names that clash with results do no harm.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        score = shared.value.scorer()
        return lambda texts: [pa.array([score(t) for t in texts], pa.float64())]

    scored = map_texts(docs, keep, make, [T.StructField("score", T.DoubleType())], text)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def held_out(doc_id):
    return crc_bucket(doc_id, 4) == 2


def train_on(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> ToxicityModel:
    """The model of a table: lexicons from its labelled rows, and beside them texts of all its rows but the
    held-out ones, each text once, so copies and hot ids weigh no more than others."""
    train = labelled_sample(docs, labels, "toxic", key, text, held_out, MAX_PER_CLASS)
    open_ = docs.where(~held_out(F.col(key))).select(F.col(text).alias("text"))
    sample, stands = distinct_sample(open_, "text", MAX_UNLABELLED)
    return fit(train, sample.withColumn("weight", F.lit(stands)))


def remove_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the rows predicted toxic; the columns stay."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    return score_documents(docs, train_on(docs, labels, key, text), [row], text).where("predicted = 0").select("__row.*")


def op1_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; a null doc_id is held out as the empty text is."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_on(docs, read_table(spark, sf_dir, "labels"))
    keep = [F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out")]
    return score_documents(docs, model, keep)


QUERIES = {"op1_weak_toxicity": op1_weak_toxicity}
ORACLES: dict[str, str] = {}
