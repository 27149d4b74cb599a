"""Periodic runs of words, by a suffix automaton whose link tree is held as link-cut paths.

With each appended word, access() recolours the path from the state of the prefix to the root. The path falls
into segments that ended last at the same earlier word. Where the distance to that end is within the longest
length of a segment, the two copies are a square; at its last word, the square has grown to its run.

Only stretches that can hold a run go to the automaton. In a run of period q each gram of words, after the
first q words, stood within q words before. So stretches of such grams, for each power of two that q may be
up to, cover all runs with a word to spare on either side.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.common import WORD, map_texts, read_table

#: Periods that a run has at least, and words.
TIMES, LEAST = 4, 6
#: Longest gram of the sieve, and bytes of text that pass through it together.
GRAM, BLOCK_BYTES = 4, 8 << 20


class LinkTree:
    """The suffix automaton of some words: its states' longest lengths and links, and the paths of its link
    tree as splay trees by depth. A path's colour, the last word at which its states ended, is kept at the root
    of its splay tree. State 1 is the root of the links; 0 is none."""

    def __init__(self, words: list[int]):
        length, link, steps, ends, last = [0, 0], [0, 0], [{}, {}], [], 1
        for word in words:
            state = len(length)
            length.append(length[last] + 1)
            steps.append({})
            at = last
            while at and word not in steps[at]:
                steps[at][word] = state
                at = link[at]
            if not at:
                link.append(1)
            else:
                to = steps[at][word]
                if length[to] == length[at] + 1:
                    link.append(to)
                else:
                    twin = state + 1
                    link.append(twin)
                    length.append(length[at] + 1)
                    link.append(link[to])
                    steps.append(steps[to].copy())
                    link[to] = twin
                    while at and steps[at].get(word) == to:
                        steps[at][word] = twin
                        at = link[at]
            ends.append(state)
            last = state
        n = len(length)
        self.length, self.ends = length, ends
        self.up, self.shallow, self.deep, self.colour = link, [0] * n, [0] * n, [-1] * n

    def _splay(self, x: int) -> None:
        """Bring x to the root of its path's tree; the root's colour goes with it."""
        up, shallow, deep = self.up, self.shallow, self.deep
        while True:
            y = up[x]
            if not y or (shallow[y] != x and deep[y] != x):
                return
            z = up[y]
            inner = z and (shallow[z] == y or deep[z] == y)
            if inner and (shallow[z] == y) == (shallow[y] == x):
                self._rotate(y)
            elif inner:
                self._rotate(x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, shallow, deep = self.up, self.shallow, self.deep
        y = up[x]
        z = up[y]
        if shallow[y] == x:
            child = shallow[y] = deep[x]
            deep[x] = y
        else:
            child = deep[y] = shallow[x]
            shallow[x] = y
        if child:
            up[child] = y
        up[y], up[x] = x, z
        if z and shallow[z] == y:
            shallow[z] = x
        elif z and deep[z] == y:
            deep[z] = x
        else:
            self.colour[x] = self.colour[y]

    def access(self, i: int) -> list[tuple[int, int]]:
        """Colour the path of the prefix that ends with word i; (last end, longest length) of its segments that
        had a colour, the deepest first."""
        up, deep, colour, length = self.up, self.deep, self.colour, self.length
        found, below, x = [], 0, self.ends[i]
        while x:
            self._splay(x)
            if colour[x] >= 0:
                found.append((colour[x], length[x]))
            if deep[x]:
                colour[deep[x]] = colour[x]
            deep[x] = below
            below, x = x, up[x]
        self._splay(self.ends[i])
        colour[self.ends[i]] = i
        return found


def runs_of(words: list[int], times: int = TIMES, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the words, by start and period.

    A segment's longest length is as far as its square goes to the left, and if the next word ends the period,
    as far as it goes to the right. Its distance is the smallest period: with a smaller one, the segment would
    have ended later before.
    """
    tree, found, n = LinkTree(words), [], len(words)
    for i in range(n):
        for end, longest in tree.access(i):
            period = i - end
            if longest >= (times - 1) * period and longest + period >= least and (i + 1 == n or words[i + 1] != words[i + 1 - period]):
                found.append((end - longest + 1, longest + period, period))
    return sorted(found)


def _need(q: int, times: int, least: int) -> int:
    """Words of a run of period q after its first q."""
    return max(least - q, (times - 1) * q)


def stretches(words: np.ndarray, starts: np.ndarray, times: int = TIMES, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and ends of the parts of texts that can hold runs; each run lies within one part, with a word
    to spare on either side if its text has one. words: all texts' words end to end; starts: where texts begin,
    and where the last ends."""
    none = np.zeros(0, np.int64)
    gram = min(GRAM, *(_need(q, times, least) for q in range(1, least + 2)))
    sizes = np.diff(starts)
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(words)) - starts[text]
    at = np.flatnonzero(place >= gram - 1)
    if not len(at):
        return none, none
    key = text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(gram):  # equal grams of a text have equal keys; others that have add parts to look at, and lose none
        key = (key ^ words[at - k].astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        key ^= key >> np.uint64(33)
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero((key[order[1:]] == key[order[:-1]]) & (text[at[order[1:]]] == text[at[order[:-1]]]))
    here, gap = at[order[same + 1]], at[order[same + 1]] - at[order[same]]
    by_place = np.argsort(here)
    here, gap = here[by_place], gap[by_place]
    begins, ends, scale = [none], [none], 1
    while len(here) and scale <= sizes.max():
        close = here[gap <= scale]
        if len(close):
            cuts = np.flatnonzero(np.diff(close) != 1) + 1
            first, last = close[np.concatenate([[0], cuts])], close[np.concatenate([cuts - 1, [len(close) - 1]])]
            need = min(_need(q, times, least) for q in range(scale // 2 + 1, min(scale, scale // 2 + 1 + least) + 1)) - gram + 1
            long = last - first + 1 >= need
            first, last = first[long], last[long]
            begins.append(np.maximum(first - gram - scale, starts[text[first]]))
            ends.append(np.minimum(last + 2, starts[text[first] + 1]))
        scale *= 2
    begin, end = np.concatenate(begins), np.concatenate(ends)
    if not len(begin):
        return none, none
    order = np.argsort(begin, kind="stable")
    begin, upto = begin[order], np.maximum.accumulate(end[order])
    fresh = np.concatenate([[True], begin[1:] >= upto[:-1]])
    return begin[fresh], upto[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(begin) - 1]])]


def runs_of_texts(words: np.ndarray, starts: np.ndarray, times: int = TIMES, least: int = LEAST) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of each text that has any, by start and period."""
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for begin, end in zip(*(x.tolist() for x in stretches(words, starts, times, least))):
        runs = runs_of(words[begin:end].tolist(), times, least)
        if runs:
            text = int(np.searchsorted(starts, begin, "right")) - 1
            found[text] += [(s + begin - int(starts[text]), n, q) for s, n, q in runs]
    return {k: sorted(v) for k, v in found.items()}


RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())]


def find_runs(docs: DataFrame, keep: list[str | Column], text: str = "text", times: int = TIMES, least: int = LEAST) -> DataFrame:
    """The columns of `keep` with n_words, runs (start, length, period, by start and period) and collapsed: the
    words joined by blanks, without those that stand in a run behind its first period. For every row of docs.

    A run is a stretch of words with smallest period q, of `times` q and `least` words at least, that no
    neighbouring word extends. Null and wordless texts have 0 words, no runs and an empty text; equal texts
    have equal runs; long texts are searched whole; an empty table gives no rows; columns that aren't in
    `keep` are ignored, so clashing names do no harm.
    """
    if times < 2 or least < 2:
        raise ValueError("a run has two periods and two words at least")

    def make():
        def work(texts):
            number: defaultdict = defaultdict(itertools.count().__next__)
            known, ids = number.__getitem__, []
            for t in texts:
                words = (t or b"").split()
                ids.append(np.fromiter(map(known, words), np.int32, len(words)))
            starts = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
            found = runs_of_texts(np.concatenate(ids), starts, times, least)
            spelled, collapsed = list(number), []
            for k, t in enumerate(texts):
                if k not in found:
                    collapsed.append(b" ".join((t or b"").split()))
                    continue
                edges = np.zeros(len(ids[k]) + 1, np.int64)
                for s, n, q in found[k]:
                    edges[s + q] += 1
                    edges[s + n] -= 1
                collapsed.append(b" ".join(map(spelled.__getitem__, ids[k][np.cumsum(edges[:-1]) == 0].tolist())))
            flat = np.array([r for k in range(len(texts)) for r in found.get(k, ())], np.int64).reshape(-1, 3)
            ends = np.concatenate([[0], np.cumsum([len(found.get(k, ())) for k in range(len(texts))], dtype=np.int64)])
            runs = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=[pa.field(f.name, pa.int64(), False) for f in RUN])
            kind = pa.list_(pa.field("element", runs.type, False))
            return [pa.array(np.diff(starts)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs, type=kind), pa.array(collapsed, pa.binary()).cast(pa.string())]

        return work

    return map_texts(docs, keep, make, FIELDS, text, BLOCK_BYTES)


def plant(text: Column, key: Column) -> Column:
    """The text whose words from word a on repeat the first p of them: a and p follow from the CRC-32 of the key
    written out; one text in ten, the others and wordless ones stay as they are."""
    h = F.crc32(F.coalesce(key.cast("string"), F.lit("")))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))

    def planted(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)).cast("long") + 1
        return F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int"))))

    chosen = (h % 10 == 0) & text.rlike(WORD)
    made = F.array_join(F.get(F.transform(F.array(words), planted), F.lit(0)), " ")
    return F.when(F.coalesce(chosen, F.lit(False)), made).otherwise(text)


def op12_automaton_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli of the run with the greatest exponent (ties: the
    first by start, then period), runs_sha256, collapsed_sha256, for every row; no run: four nulls. Runs of the
    texts with planted() repeats; null and wordless texts have none and the digests of the empty text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", plant(F.col("text"), F.col("doc_id")).alias("text"))
    rows = find_runs(docs, ["doc_id"])
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")
    )
    milli = F.expr("best.length * 1000 div best.period")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES = {"op12_automaton_runs": op12_automaton_runs}
ORACLES: dict[str, str] = {}
