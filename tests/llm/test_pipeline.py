import corpus_pipeline
from tidewire.llm import decontaminate, registry, simhash

ROOT = "/root/testdata/sf0.001"


def test_registry_has_each_operator_once():
    names = sorted(int(n[2:].split("_")[0]) for n in registry.queries())
    assert names == list(range(1, 14))
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns, kept = docs.columns, {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = kept[name] = stage(spark, docs, ROOT).persist()
        if name != "sharding":
            assert docs.columns == columns
    ids = {k: [r["doc_id"] for r in v.select("doc_id").collect()] for k, v in kept.items()}
    assert len(ids["toxicity"]) <= len(ids["documents"])
    assert len(ids["near_duplicates"]) == len(set(ids["near_duplicates"])) < len(ids["toxicity"])
    again = simhash.near_duplicates(kept["near_duplicates"])
    assert again.select("root").distinct().count() == len(ids["near_duplicates"])
    bench = spark.read.parquet(f"{ROOT}/benchmark.parquet")
    assert decontaminate.find_matches(kept["decontamination"], bench, ["doc_id"]).where(decontaminate.contaminated()).count() == 0
    assert len(ids["decontamination"]) < len(ids["near_duplicates"])
    assert set(ids["mixing"]) <= set(ids["decontamination"]) and len(ids["mixing"]) > len(set(ids["mixing"]))
    assert sorted(ids["sharding"]) == sorted(ids["mixing"])
    for df in kept.values():
        df.unpersist()


def test_run(spark):
    out = corpus_pipeline.run(spark, ROOT)
    assert {"doc_id", "text", "shard", "slot", "size"} <= set(out.columns) and out.count() > 0


def test_awkward_tables_go_through(spark, awkward, empty, tmp_path):
    base = "doc_id text lang source n_chars".split()
    for k, df in enumerate((awkward, empty)):
        root = str(tmp_path / str(k))
        df.select(*base, "score", "fingerprint").write.parquet(f"{root}/documents.parquet")
        spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
        spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
        rows = corpus_pipeline.run(spark, root).collect()
        assert (len(rows) > 0) == (k == 0)
