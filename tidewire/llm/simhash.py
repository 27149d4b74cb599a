"""Near duplicates: SimHash fingerprints, candidates by pigeonring filtering, exact Hamming links."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewire.llm.common import map_texts, read_table, stash
from tidewire.llm.components import components

BITS, SHINGLE, SEED = 64, 3, 42
#: Fingerprints link at so many differing bits or fewer.
DISTANCE = 2
#: Segments of the ring, level by level: the members of a bucket of over DENSE go to the next level, whose more
#: and finer segments give longer keys (32, 48, 56 bits). A bucket of the last has 256 fingerprints at most.
LEVELS = (4, 8, 16)
DENSE = 32


def fingerprint(text: bytes | None) -> int:
    """The 64 bits, as a signed number. bytes.lower() and bytes.split() know ASCII only."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))) if len(words) >= SHINGLE else [b" ".join(words)]
    n = max(1, len(words) - SHINGLE + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 8192):
        part = hashes[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints():
    return lambda texts: [pa.array([fingerprint(t) for t in texts], pa.int64())]


def with_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_key (a hash of the text), fingerprint, one row for each row of docs."""
    keep = [F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key")]
    return map_texts(docs, keep, _fingerprints, [T.StructField("fingerprint", T.LongType())], text)


def mask(segments: int, width: int) -> int:
    """The bits of the first segments, as a signed number."""
    ones = (1 << segments * width) - 1
    return ones - (ones >> 63 << 64)


def turned(fp: Column, bits: int) -> Column:
    """The ring turned, so that the segment which starts at this bit is the first."""
    return fp if bits == 0 else F.shiftrightunsigned(fp, bits).bitwiseOR(F.shiftleft(fp, BITS - bits))


def ring_keys(fp: Column, segments: int) -> Column:
    """Keys of which linked fingerprints share one, under the chain that starts at the same segment.

    On a ring of m segments with tau differences in all, some chain of consecutive segments keeps every
    prefix of length l within floor(l * tau / m) differences (pigeonring principle). For 2 differences the
    budgets are 0 up to l = m/2 - 1 and 1 up to l = m - 1: the first m/2 - 1 segments agree, and of the next
    m/2 all but one do. A key is the turned ring without its last segment and without one of those.
    """
    width, half, keys = BITS // segments, segments // 2, []
    for start in range(segments):
        ring = turned(fp, start * width)
        for out in range(half - 1, segments - 1):
            kept = mask(segments - 1, width) & ~(mask(1, width) << out * width)
            tag = F.lit(start * half + out - half + 1)
            keys.append(F.struct(F.lit(start).alias("start"), tag.alias("tag"), ring.bitwiseAND(F.lit(kept)).alias("key")))
    return F.array(*keys)


def chain_holds(a: Column, b: Column, start: int, segments: int = LEVELS[0]) -> Column:
    """All prefixes of the chain from `start` are within their budgets."""
    width, within = BITS // segments, F.lit(True)
    apart = turned(a.bitwiseXOR(b), start * width)
    for length in range(1, segments):
        budget = length * DISTANCE // segments
        if budget < (length + 1) * DISTANCE // segments:  # the last prefix under a budget implies those before
            within = within & (F.bit_count(apart.bitwiseAND(F.lit(mask(length, width)))) <= budget)
    return within


def near_pairs(prints: DataFrame) -> DataFrame:
    """All linked pairs (u, v), u < v, of distinct fingerprints (column fingerprint), some more than once.

    A pair within DISTANCE shares a key at every level. Where that bucket has DENSE members or fewer, or the
    level is the last, the pair meets there: the chain is checked first, then the full distance. Where it
    is denser both go to the next level, so no link is lost and no bucket is compared in all pairs but
    those of bounded size.
    """
    out = None
    for level, segments in enumerate(LEVELS):
        last = level == len(LEVELS) - 1
        keyed = prints.select("fingerprint", F.inline(ring_keys(F.col("fingerprint"), segments)))
        sizes = keyed.groupBy("tag", "key").agg(F.count("*").alias("n")).where("n > 1")
        members = keyed.join(sizes, ["tag", "key"])
        met = members if last else members.where(F.col("n") <= DENSE)
        a, b = met.alias("a"), met.select("tag", "key", F.col("fingerprint").alias("other")).alias("b")
        mine, other = F.col("fingerprint"), F.col("other")
        chain = F.lit(False)
        for start in range(segments):
            chain = chain | ((F.col("start") == start) & chain_holds(mine, other, start, segments))
        full = F.bit_count(mine.bitwiseXOR(other)) <= DISTANCE
        pairs = a.join(b, (F.col("a.tag") == F.col("b.tag")) & (F.col("a.key") == F.col("b.key")) & (mine < other) & chain & full)
        pairs = pairs.select(mine.alias("u"), other.alias("v"))
        out = pairs if out is None else out.unionByName(pairs)
        if last:
            break
        prints = stash(members.where(F.col("n") > DENSE).select("fingerprint").distinct())
        if prints.isEmpty():
            break
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_key, fingerprint (signed long), root, component_id for every row of docs.

    component_id is the smallest doc_id of the component, root its smallest fingerprint. Null, empty and
    wordless texts have fingerprint zero and link like any other; equal rows share a component; a null id
    counts only where a component has no other (component_id is null then); an empty table gives no rows.
    """
    prints = stash(with_fingerprints(docs, key, text))
    groups = stash(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    linked = components(near_pairs(groups))
    linked = linked.unionByName(linked.select(F.col("root").alias("node"), "root").distinct())
    linked = linked.withColumnRenamed("node", "fingerprint").join(groups, "fingerprint")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(least, "root").select("fingerprint", "root", "component_id")
    known = groups.join(linked, "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), F.coalesce("component_id", "least").alias("component_id")
    )
    known = stash(known)  # so that the join below is of two plain shuffles, whose hot keys Spark can split
    return prints.join(known, "fingerprint")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each component, that of its smallest doc_id; the columns stay.

    A component without ids keeps one row too; of equal rows one stays; an empty table stays empty.
    """
    found = near_duplicates(docs, key, text)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_key").alias("text")))
    best = found.groupBy("root").agg(first.alias("best")).select(F.col("best.id").alias("__id"), F.col("best.text").alias("__text"))
    best = best.select(named(F.col("__id")).alias("__id"), "__text")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("__row"), named(F.col(key)).alias("__id"), F.xxhash64(F.col(text)).alias("__text"))
    rows = rows.join(best, ["__id", "__text"], "left_semi")
    once = Window.partitionBy("__id", "__text").orderBy("__text")
    return rows.withColumn("__nth", F.row_number().over(once)).where("__nth = 1").select("__row.*")


def named(key: Column) -> Column:
    """An id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("-"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op10_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


QUERIES = {"op10_simhash_pigeonring": op10_simhash_pigeonring}
ORACLES: dict[str, str] = {}
