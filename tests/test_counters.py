"""Counts made by the pass itself equal those of a group-by."""

import time

from pyspark.sql import functions as F

from tidewire.operators import counters as C
from tidewire.operators.crumbs import disposition_counts
from tidewire.queries.jobs import json_stream
from tidewire.streaming import jobs as S

ROWS = [("created", "u", "t"), ("created", None, "t"), ("dups", "", None), ("a new one", "u", "t"), (None, "u", "t")] * 20


def test_one_run_counts_all(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "disposition string, url string, text_content string")
    out, seen = C.count_dispositions(df, fields=("url", "text_content"))
    out.write.parquet(str(tmp_path / "out"))
    counts = seen.get
    want = {r["status"]: r["stories"] for r in disposition_counts(df, F.lit("a")).collect()}
    assert {k: n for k, n in counts.items() if n} == {"created": want["created"], "dups": want["dups"], "other": want["a new one"] + want[None], "missing_url": 40, "missing_text_content": 20}
    table = C.as_table(spark, {k: n for k, n in counts.items() if not k.startswith("missing")}, "a").collect()
    assert sorted((r["status"], r["stories"]) for r in table) == [("created", 40), ("dups", 20), ("other", 40)]


def test_missing_fields(spark):
    out, seen = C.count_missing(spark.createDataFrame(ROWS, "disposition string, url string, text_content string"), ("url", "text_content"))
    assert out.count() == 100 and seen.get == {"rows": 100, "missing_url": 40, "missing_text_content": 20}


def test_a_stream_counts_over_its_batches(spark, tmp_path):
    rows = spark.createDataFrame([(i, s) for i, (s, *_) in enumerate(ROWS)], "i int, disposition string")
    counts = C.StreamCounts()
    spark.streams.addListener(counts)
    try:
        stream = C.count_stream(json_stream(spark, rows, 4, "i"), "all")
        S.run_batches(stream, str(tmp_path / "point"), lambda batch, n: batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}")).awaitTermination()
        until = time.time() + 20
        while time.time() < until and sum(counts.totals.get("all", {}).values()) < 100:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(counts)
    assert {k: n for k, n in counts.totals["all"].items() if n} == {"created": 40, "dups": 20, "other": 40}
