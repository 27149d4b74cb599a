"""Crawl arithmetic over logs and plans: paced release, per-host intervals, domain packing."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.shared import stash


def paced_release(df: DataFrame, host: str, arrival: str, interval: float, order: tuple[str, ...] = ()) -> DataFrame:
    """issued_at: the first slot of its host that isn't before arrival, slots `interval` apart."""
    by = Window.partitionBy(host).orderBy(arrival, *order)
    df = df.withColumn("__rn", F.row_number().over(by) - 1)
    late = F.max(F.col(arrival) - F.col("__rn") * interval).over(by.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("issued_at", F.col("__rn") * interval + late).drop("__rn")


@dataclass(frozen=True)
class Pacing:
    alpha: float = 0.25
    target: float = 4.0
    least: float = 5.0
    throttle: float = 30.0
    doubling: int = 8  # refusals in a row that double the average
    block_seconds: float = 600.0


def fold(avg: float, blocked: float, outcome: str, seconds: float, at: float, cfg: Pacing) -> tuple[float, float]:
    """The average fetch time and block of a host after one more fetch (DATA, NODATA, THROTTLE, NOCONN).

    Only data lowers the average; a refused request raises it; a failed connection blocks the host.
    """
    if outcome == "NOCONN":
        return avg, at + cfg.block_seconds
    if outcome == "THROTTLE":
        fresh = avg * 2 ** (1 / cfg.doubling) if avg >= cfg.throttle else cfg.throttle
    else:
        fresh = seconds if avg == 0 else avg + cfg.alpha * (seconds - avg)
    return (fresh if fresh > avg or outcome == "DATA" else avg), blocked


def host_interval_state(log: DataFrame, cfg: Pacing = Pacing(), host: str = "host") -> DataFrame:
    """(host, fetches, avg, interval, blocked_until) after the log (host, at, seq, seconds, outcome).

    The fold goes through one host's log in order, in batches: Spark sorts by host, and state is carried
    from row to row, so a busy host never has to fit in memory.
    """
    schema = "host string, fetches bigint, avg double, interval double, blocked_until double"
    ordered = log.select(F.col(host).cast("string").alias("host"), "at", "seq", "seconds", "outcome").repartition("host").sortWithinPartitions("host", "at", "seq")

    def run(frames):
        name, n, avg, blocked = None, 0, 0.0, 0.0
        done: list[tuple] = []

        def row():
            return (name, n, avg, max(avg / cfg.target, cfg.least), blocked)

        for frame in frames:
            for h, at, seconds, outcome in zip(frame["host"], frame["at"], frame["seconds"], frame["outcome"]):
                if h != name:
                    if name is not None:
                        done.append(row())
                    name, n, avg, blocked = h, 0, 0.0, 0.0
                avg, blocked = fold(avg, blocked, outcome, seconds, at, cfg)
                n += 1
            if done:
                yield pd.DataFrame(done, columns=["host", "fetches", "avg", "interval", "blocked_until"])
                done = []
        if name is not None:
            yield pd.DataFrame([row()], columns=["host", "fetches", "avg", "interval", "blocked_until"])

    return ordered.mapInPandas(run, schema)


def domain_counts(df: DataFrame, domain: str = "domain", pos: str = "pos") -> DataFrame:
    return df.groupBy(F.col(domain).alias("domain")).agg(F.count("*").alias("stories"), F.min(pos).alias("first_pos"))


#: Not used any more, as all domains are packed by the rule; a test still sets it.
HEAD = 1_000


def deal(filled: list[int], size: int, count: int) -> tuple[list[int], list[list[int]]]:
    """Hand `count` domains of one size to the least filled batches in turn; `filled` is brought up to date.

    Gives the ranks at which runs start, and the batches that take turns in each run. Batches within one size
    of the least filled get one each, in order of (fill, number), and again until another batch is as low; so
    there is at most one run for each batch, however many domains there are.
    """
    starts, turns, done = [], [], 0
    while done < count:
        low = min(filled)
        turn = sorted((b for b, f in enumerate(filled) if f < low + size), key=lambda b: (filled[b], b))
        above = [f for f in filled if f >= low + size]
        given = count - done
        if above:
            given = min(given, (min(above) - low) // size * len(turn))
        starts.append(done)
        turns.append(turn)
        for i, b in enumerate(turn):
            filled[b] += size * (given // len(turn) + (i < given % len(turn)))
        done += given
    return starts, turns


def pack_domains(df: DataFrame, n: int = 20, domain: str = "domain", pos: str = "pos") -> DataFrame:
    """(domain, stories, batch): largest domains first into the least filled of n batches, domains whole.

    Among equals the later first-seen domain goes first, and the lowest of equally filled batches. The fold
    sees one row for each size, of which there are about sqrt(2 * stories) at most; the domains of a size
    take their batches by their rank in it, which comes from a range partitioning and sums of its parts.
    """
    counts = domain_counts(df, domain, pos).repartitionByRange(F.col("stories").desc(), F.col("first_pos").desc(), "domain")
    counts = counts.sortWithinPartitions(F.col("stories").desc(), F.col("first_pos").desc(), "domain")
    local = stash(counts.withColumn("__at", F.monotonically_increasing_id())).withColumn("__part", F.shiftright("__at", 33))
    parts = local.groupBy("stories", "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("stories").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stash(parts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))))

    def fold_sizes(frame: pd.DataFrame) -> pd.DataFrame:
        filled, out = [0] * n, []
        for size, count in frame.sort_values("stories", ascending=False)[["stories", "count"]].itertuples(index=False):
            out.append((size, *deal(filled, int(size), int(count))))
        return pd.DataFrame(out, columns=["stories", "starts", "turns"])

    sizes = parts.groupBy("stories").agg(F.sum("__n").alias("count")).withColumn("__all", F.lit(0))
    runs = sizes.groupBy("__all").applyInPandas(lambda f: fold_sizes(f), "stories bigint, starts array<bigint>, turns array<array<int>>")
    plan = parts.join(stash(runs), "stories").select("stories", "__part", "__first", "__before", "starts", "turns")
    ranked = local.join(plan, ["stories", "__part"]).withColumn("__rank", F.col("__before") + F.col("__at") - F.col("__first"))
    ranked = ranked.withColumn("__run", F.size(F.filter("starts", lambda x: x <= F.col("__rank"))) - 1)
    turn, step = F.get("turns", F.col("__run")), F.col("__rank") - F.get("starts", F.col("__run"))
    return ranked.select("domain", "stories", F.get(turn, (step % F.size(turn)).cast("int")).alias("batch"))


def attach_batch(df: DataFrame, packed: DataFrame, domain: str = "domain") -> DataFrame:
    """The batch of each story by its domain; the planner broadcasts the map if it is small."""
    return df.join(packed.select(F.col("domain").alias("__domain"), "batch"), F.col(domain).eqNullSafe(F.col("__domain")), "left").drop("__domain")


def batch_stats(df: DataFrame, domain: str = "domain") -> DataFrame:
    out = df.groupBy("batch").agg(F.count("*").alias("stories"), F.countDistinct(domain).alias("domains"))
    return out.withColumn("stories_per_domain", F.round(F.col("stories") / F.col("domains"), 6))
