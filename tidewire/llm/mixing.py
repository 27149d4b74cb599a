"""Mixing of sources to target weights along a time-varying curriculum; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.llm.common import ORDER_BITS, WORD, hash_order, read_table, running_sum, stash, word_count

#: Weights of the sources, in their order and repeating.
WEIGHTS = (5, 2, 1)
#: How often the mix is to hold all words together, and one source at most.
SHARE, CEILING = 1.5, 2.0
#: Copies of one row that are written out by one task in one go.
CHUNK = 1_000
#: Schedule of each weight over training time: (time, weight) knots, linear in between.
SCHEDULES = (
    ((0.0, 1.5), (0.6, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
)

Knots = Sequence[tuple[float, float]]


def invert_demand(share: Column, knots: Knots) -> Column:
    """The time in 0..1 at which a source with this schedule has met `share` of its whole demand.

    Demand is the integral of the schedule: quadratic between knots, so each piece has a closed inverse.
    """
    pieces, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        if t1 <= t0 or w0 <= 0 or w1 <= 0:
            raise ValueError("knots need rising times and positive weights")
        pieces.append((t0, t1, w0, w1, total))
        total += (t1 - t0) * (w0 + w1) / 2
    out: Column | None = None
    for t0, t1, w0, w1, met in reversed(pieces):
        rest = F.greatest(share * F.lit(total) - F.lit(met), F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        step = rest / F.lit(w0)
        if abs(slope) > 1e-12:
            step = (F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0))) - F.lit(w0)) / F.lit(slope)
        time = F.least(F.lit(t0) + step, F.lit(t1))
        out = time if out is None else F.when(share * F.lit(total) < F.lit(met + (t1 - t0) * (w0 + w1) / 2), time).otherwise(out)
    return out


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """One row for each source: __source (not null), source_size, target, __class.

    Filling all sources by weight and resharing what stands over a ceiling ends at one common level: with
    the sources sorted by ceiling per weight, those below the level hold their ceiling and the rest share
    what is left by weight. Rows here are sources, already summed, so the windows over all of them hold one
    short row for each source.
    """
    sums = sized.groupBy("__source").agg(F.first("__name").alias("__name"), F.sum("size").alias("source_size"))
    all_rows = Window.partitionBy(F.lit(0))
    sums = sums.withColumn("__nth", F.row_number().over(Window.orderBy(F.col("__name").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("__nth") % len(weights) + 1).cast("int"))
    sums = sums.withColumns({"__class": (F.col("__nth") % len(weights)).cast("int"), "__weight": weight, "__cap": F.col("source_size") * F.lit(ceiling)})
    by_ratio = Window.partitionBy(F.lit(0)).orderBy(F.col("__cap") / F.col("__weight"), "__nth")
    sums = sums.withColumns(
        {
            "__capped": F.sum("__cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__cap"),
            "__open": F.sum("__weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
            "__demand": F.sum("source_size").over(all_rows) * F.lit(share),
        }
    )
    # the level, if this source and all behind it were the ones that are not full
    level = (F.col("__demand") - F.col("__capped")) / F.col("__open")
    fits = level * F.col("__weight") <= F.col("__cap")
    sums = sums.withColumn("__level", F.max(F.when(fits, level)).over(all_rows))  # the first that fits
    target = F.least(F.col("__cap"), F.coalesce(F.col("__level") * F.col("__weight"), F.col("__cap")))
    return sums.select("__source", "source_size", target.alias("target"), "__class")


def _sized(docs: DataFrame, key: str, text: str, source: str) -> list[Column]:
    """What the plan of a row depends on, and the number of its input partition."""
    return [
        F.col(key).alias("doc_id"),
        word_count(F.col(text)).alias("size"),
        F.col(source).alias("__name"),
        F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("-")).alias("__source"),
        hash_order(F.col(key), F.col(text)).alias("__order"),
        F.spark_partition_id().alias("__part"),
    ]


def _plan(sized: DataFrame) -> DataFrame:
    """A written table with one row for each set of equal rows of an input partition: doc_id, size, __source,
    __order, __part, __copies, the columns of source_targets(), and __before, the words of the source that
    stand before the first of the copies.

    Equal rows are counted before anything is shuffled, so thousands of them are as many rows here as they
    have partitions, and none of them meets the others in one window. sized: columns of _sized(), written.
    """
    targets = source_targets(sized.select("__source", "__name", "size"))
    same = sized.groupBy("__source", "__order", "doc_id", "size", "__part").agg(F.count("*").alias("__copies"))
    same = same.withColumn("__words", F.col("__copies") * F.col("size"))
    bits = max(10, (sized.count() >> 16).bit_length())
    order = ["__order", "doc_id", "size", "__part"]
    return stash(running_sum(same, ["__source"], order, "__words", "__before", bits=bits, width=ORDER_BITS, per_group=targets).drop("__words"))


def _rounds(schedules: Sequence[Knots]) -> Column:
    """(round, words, position) for each round that takes a row, from the columns of _plan() and __copy."""
    whole = F.round(F.col("target")).cast("long")
    rounds = []
    for k in (0, 1):
        start = F.col("source_size") * k + F.col("__before") + F.col("__copy") * F.col("size")
        words = F.greatest(F.least(F.col("size"), whole - start), F.lit(0)).cast("long")
        share = (start + words / 2) / F.greatest(F.col("target"), F.lit(1.0))
        time = invert_demand(share, schedules[-1])
        for c in range(len(schedules) - 2, -1, -1):
            time = F.when(F.col("__class") % len(schedules) == c, invert_demand(share, schedules[c])).otherwise(time)
        rounds.append(F.struct(F.lit(k).alias("round"), words.alias("words"), time.alias("position")))
    return F.filter(F.array(*rounds), lambda x: x["words"] > 0)


def plan_mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", schedules: Sequence[Knots] = SCHEDULES) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_position, positions for every row of docs, range-sorted
    by first_position, rows that are not taken last.

    The documents of a source stand in a fixed hash order and are read in rounds until the target is met;
    the document at the end is taken in part. taken is the number of words over all rounds, positions has
    (round, words, position in 0..1) for each round that takes the document. Null texts and texts without
    words have size 0, are never taken and have no position; null sources are one source, the last; equal
    rows are taken each for itself; an empty table gives no rows; other columns are ignored.
    """
    plan = _plan(stash(docs.select(*_sized(docs, key, text, source))))
    # rows with many copies are dealt out in chunks over all tasks before they are written out one by one
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1, F.lit(CHUNK).cast("long"))).alias("__from")
    some = plan.where(F.col("__copies") <= CHUNK).withColumn("__from", F.lit(0).cast("long"))
    many = plan.where(F.col("__copies") > CHUNK).select("*", chunk).repartition("__part", "__from", "__order")
    one = F.sequence(F.col("__from"), F.least(F.col("__from") + CHUNK, F.col("__copies")) - 1)
    rows = some.unionByName(many).withColumn("__copy", F.explode(one)).withColumn("positions", _rounds(schedules))
    taken = F.aggregate("positions", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    first = F.get(F.col("positions"), 0)["position"]
    rows = rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), first.alias("first_position"), "positions", "__order")
    by = [F.col("first_position").asc_nulls_last(), F.col("__order")]
    return rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("__order")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space as it is."""
    n = n.cast("int")
    pieces = F.arrays_zip(
        F.slice(F.split(text, WORD, -1), F.lit(1), n).alias("gap"), F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), n).alias("word")
    )
    return F.array_join(F.transform(pieces, lambda p: F.concat(p["gap"], p["word"])), "")


def curriculum(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", written: bool = False) -> DataFrame:
    """The mix itself, with the columns of docs: one row for each time a document is taken, range-sorted by
    position. A document that the end of its source's target cuts keeps its first words only. Each row with words
    meets its plan, or the job fails: a row is never lost in silence.

    Null and wordless texts are in no mix; the rest is as in plan_mix(). The plan is made over narrow rows;
    whole rows move twice, to meet their plan and to their place in the order. written: docs is a written
    table, whose partitions are the same in every pass.
    """
    docs = docs if written else stash(docs)
    plan = _plan(stash(docs.select(*_sized(docs, key, text, source)))).withColumn("__id", _named("doc_id"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *_sized(docs, key, text, source))
    packed = packed.where("size > 0").withColumn("__id", _named("doc_id")).drop("doc_id", "__name")
    keys = ["__order", "__part", "__source", "__id", "size"]
    copies = packed.join(plan.where("size > 0").drop("doc_id"), keys, "left")
    lost = F.raise_error("a row has no plan: docs isn't split alike in two passes, so it isn't a written table").cast("long")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("__order")) - F.when(F.col("__copies").isNull(), lost).otherwise(1)
    copies = copies.withColumn("__copy", nth).select("__row", "size", "__order", F.explode(_rounds(SCHEDULES)).alias("__at"))
    cut = F.when(F.col("__at")["words"] < F.col("size"), first_words(F.col("__row")[text], F.col("__at")["words"])).otherwise(F.col("__row")[text])
    columns = [cut.alias(c) if c == text else F.col("__row")[c].alias(c) for c in docs.columns]
    copies = copies.select(F.col("__at")["position"].alias("__position"), "__order", *columns)
    return copies.repartitionByRange("__position", "__order").sortWithinPartitions("__position", "__order").drop("__position", "__order")


def _named(key: str) -> Column:
    """An id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-"))


def op6_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return plan_mix(docs).drop("positions")


QUERIES = {"op6_mix_curriculum": op6_mix_curriculum}


def _sql_time(share: str, knots: Knots) -> str:
    """invert_demand in SQL."""
    met, pieces = 0.0, []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        pieces.append((t0, t1, w0, w1, met))
        met += (t1 - t0) * (w0 + w1) / 2
    out = ""
    for t0, t1, w0, w1, before in reversed(pieces):
        rest = f"greatest({share} * {met!r}::DOUBLE - {before!r}::DOUBLE, 0::DOUBLE)"
        slope = (w1 - w0) / (t1 - t0)
        step = f"{rest} / {w0!r}::DOUBLE"
        if abs(slope) > 1e-12:
            step = f"(sqrt(greatest({w0 * w0!r}::DOUBLE + {2 * slope!r}::DOUBLE * {rest}, 0::DOUBLE)) - {w0!r}::DOUBLE) / {slope!r}::DOUBLE"
        time = f"least({t0!r}::DOUBLE + {step}, {t1!r}::DOUBLE)"
        end = before + (t1 - t0) * (w0 + w1) / 2
        out = time if not out else f"CASE WHEN {share} * {met!r}::DOUBLE < {end!r}::DOUBLE THEN {time} ELSE {out} END"
    return out


_TIMES = " ".join(f"WHEN {c} THEN {_sql_time('share', k)}" for c, k in enumerate(SCHEDULES))
_WEIGHTS = ", ".join(f"{float(w)}::DOUBLE" for w in WEIGHTS)
ORACLES = {
    "op6_mix_curriculum": f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || chr(1) || md5(coalesce(text, ''))), 1, 15))::BIGINT AS ord FROM documents),
 s0 AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
 s1 AS (SELECT *, nth % {len(WEIGHTS)} AS class, ([{_WEIGHTS}])[nth % {len(WEIGHTS)} + 1] AS weight, source_size * {CEILING}::DOUBLE AS cap FROM s0),
 s2 AS (SELECT *, sum(cap) OVER w - cap AS capped, sum(weight) OVER (ORDER BY cap / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_, sum(source_size) OVER () * {SHARE}::DOUBLE AS demand
  FROM s1 WINDOW w AS (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
 s3 AS (SELECT *, max(CASE WHEN (demand - capped) / open_ * weight <= cap THEN (demand - capped) / open_ END) OVER () AS level FROM s2),
 s AS (SELECT source, source_size, class, least(cap, coalesce(level * weight, cap)) AS target FROM s3),
 r AS (SELECT d.doc_id, d.size, s.source_size, s.target, s.class, round(s.target)::BIGINT AS whole, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY ord, d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
 t AS (SELECT *, greatest(least(size, whole - before), 0) AS first, greatest(least(size, whole - source_size - before), 0) AS second FROM r),
 u AS (SELECT *, (before + first / 2) / greatest(target, 1::DOUBLE) AS share FROM t)
SELECT doc_id, size, source_size, target, (first + second)::BIGINT AS taken, CASE WHEN first > 0 THEN CASE class {_TIMES} END END AS first_position FROM u""",
}
