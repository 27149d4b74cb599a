import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.llm import language, quality, toxicity

ROOT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{ROOT}/documents.parquet"), spark.read.parquet(f"{ROOT}/labels.parquet")


def test_label_model_finds_accuracies_without_labels():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    hit = [0.9, 0.8, 0.7, 0.6] * 4 + [0.5] * 5
    votes = np.array([np.where(y, rng.random(4000) < h, rng.random(4000) < (0.02 if h > 0.5 else 0.5)) for h in hit]).T
    votes[:, 1] = votes[:, 0]  # a voter that only repeats another
    model = toxicity.fit_label_model(votes, np.ones(4000))
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.98
    assert np.allclose(model.fires[1][[0, 2, 3]], [0.9, 0.7, 0.6], atol=0.05)
    assert model.trust[0] < 0.7 and model.trust[1] < 0.7 and model.trust[2] > 0.75


def test_toxicity_on_held_out_rows(spark, tables):
    docs, labels = tables
    rng = random.Random(3)
    plain = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    bad = ["zzgrub", "zzgrubber", "zzgrubs", "qvile"]
    rows = []
    for i in range(600):
        w = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        if i % 5 == 0:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w), int(i % 5 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train_on(df, df.select("doc_id", "toxic"))
    out = toxicity.score_documents(df, model, ["doc_id", "toxic", toxicity.held_out(F.col("doc_id")).alias("held")]).where("held").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out)


#: The insults that the given tables were made with. The other toxic rows have words of certain beginnings.
INSULTS = set("trash pathetic idiot worthless disgusting stupid clown scum loser moron".split())


@pytest.mark.parametrize("sf, recall, clean", [("0.01", 0.9, 0.95), ("0.1", 0.9, 0.98)])
def test_toxicity_of_the_given_tables(spark, sf, recall, clean):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train_on(docs, labels)
    out = toxicity.score_documents(docs.join(labels, "doc_id", "left"), model, ["doc_id", "text", "toxic", toxicity.held_out(F.col("doc_id")).alias("held")])
    rows = out.select("*", F.col("toxic").isNotNull().alias("known")).collect()
    held = [r for r in rows if r["held"] and r["known"]]
    assert np.mean([r["predicted"] for r in held if r["toxic"]]) >= recall
    assert np.mean([not r["predicted"] for r in held if not r["toxic"]]) >= clean
    insulting = [r for r in rows if INSULTS & set(toxicity.TOKEN.findall(r["text"].lower()))]
    assert len(insulting) > 50 and np.mean([r["predicted"] for r in insulting]) >= 0.95


def test_toxicity_scores_are_those_of_a_plain_sum(spark, tables):
    docs, labels = tables
    model = toxicity.train_on(docs, labels)
    assert model.entries and any(model.weights[len(model.entries) : -1])
    for r in toxicity.score_documents(docs.limit(150), model, ["text"]).collect():
        words, odds = [w.lower() for w in toxicity.TOKEN.findall(r["text"])], model.weights[-1]
        for entry, weight in zip(model.entries, model.weights):
            often, stem = entry.split("|")
            kind, letters = stem.split(":")
            odds += weight * (sum(w == letters if kind == "w" else w.startswith(letters) for w in words) >= int(often))
        for (_, pattern), weight in zip(toxicity.PATTERNS, model.weights[len(model.entries) :]):
            odds += weight * bool(pattern.search(r["text"]))
        assert abs(r["score"] - 1 / (1 + np.exp(-np.clip(odds, -30, 30)))) < 1e-9


def test_label_model_of_a_tree_has_the_posterior_of_its_tables():
    rng = np.random.default_rng(5)
    votes = rng.random((500, toxicity.VOTERS)) < 0.4
    votes[:, 3] = votes[:, 2] ^ (rng.random(500) < 0.1)
    model = toxicity.fit_label_model(votes, rng.random(500) + 0.5, rounds=9)
    assert model.parent[3] == 2 or model.parent[2] == 3
    for v, p in zip(votes[:20], model.posterior(votes[:20])):
        chance = np.array([1 - model.prior, model.prior])
        for y in (0, 1):
            for j, parent in enumerate(model.parent):
                fires = model.given[y, int(parent >= 0 and v[parent]), j]
                chance[y] *= fires if v[j] else 1 - fires
        assert abs(p - chance[1] / chance.sum()) < 1e-6


def test_toxicity_of_awkward_rows(spark, awkward, empty, labels):
    model = toxicity.train_on(awkward, labels)
    rows = toxicity.score_documents(awkward, model, ["doc_id"]).collect()
    assert len(rows) == awkward.count() and all(r["score"] is not None for r in rows)
    assert toxicity.remove_toxic(awkward, labels.limit(0)).columns == awkward.columns
    assert toxicity.remove_toxic(awkward, labels.limit(0)).count() == awkward.count()
    assert toxicity.remove_toxic(empty, labels).count() == 0


def test_held_out_labels_are_not_used(spark):
    df = spark.createDataFrame([(i, "word " * 10 + ("evil" if i % 2 else "fine"), i % 2) for i in range(200)], "doc_id long, text string, toxic int")
    lied = df.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train_on(df, df), toxicity.train_on(lied, lied)
    assert a.entries == b.entries and np.allclose(a.weights, b.weights)


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    train = toxicity.labelled_sample(docs, labels, "quality", "doc_id", "text", quality.held_out, 8000)
    model = quality.fit(train)
    assert model.rules and all(w for w in model.weights) and len(model.describe()) == len(model.rules)
    scored = quality.score_quality(docs, model, ["doc_id", quality.held_out(F.col("doc_id")).alias("held")])
    rows = scored.join(labels, "doc_id").where("held").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93


def test_compiled_rules_agree_with_the_arrays(tables):
    docs, labels = tables
    model = quality.fit(toxicity.labelled_sample(docs, labels, "quality", "doc_id", "text", quality.held_out, 8000))
    rows = quality.with_statistics(docs.limit(200), ["doc_id"]).withColumn("score", model.score()).collect()
    x = np.array([[r[f"__{s}"] for s in quality.STATISTICS] for r in rows])
    odds = model.bias + sum(w * quality.holds(r, x) for r, w in zip(model.rules, model.weights))
    assert np.allclose([r["score"] for r in rows], 1 / (1 + np.exp(-odds)))


def test_quality_of_awkward_rows(awkward, empty, labels):
    train = toxicity.labelled_sample(awkward, labels, "quality", "doc_id", "text", quality.held_out, 100)
    rows = quality.score_quality(awkward, quality.fit(train), ["doc_id"]).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score_quality(empty, quality.RuleEnsemble([], [], 0.0), ["doc_id"]).count() == 0
    assert quality.fit(train.limit(0)).rules == []


def test_language_on_held_out_rows(tables):
    docs, _ = tables
    out = language.predict(docs, language.fit(docs), ["doc_id", "lang", language.held_out(F.col("doc_id")).alias("held")]).where("held").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_profiles_are_bundles_of_bound_vectors():
    grams, counts = language.gram_counts("Abc abc é".encode())
    code = [ord(c) for c in "abc"]
    want = np.roll(language.letter_vector(code[0]), 2) * np.roll(language.letter_vector(code[1]), 1) * language.letter_vector(code[2])
    gram = code[0] << 42 | code[1] << 21 | code[2]
    assert counts[list(grams).index(gram)] == 2
    assert (language.gram_vectors(np.array([gram], np.uint64))[0] == want).all()
    whole = (counts[:, None] * language.gram_vectors(grams).astype(float)).sum(axis=0)
    assert np.allclose(language.profiles(["Abc abc é".encode()])[0], whole / np.linalg.norm(whole), atol=1e-5)


def test_language_of_awkward_rows(awkward, empty):
    rows = language.predict(awkward, language.fit(awkward), ["doc_id", awkward["text"].alias("t")]).collect()
    for r in rows:
        if not any(c.isalpha() for c in r["t"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "de", "fr")
    names, vectors = language.fit(empty)
    assert names == [] and language.predict(empty, (names, vectors), ["doc_id"]).count() == 0
    assert {r["lang_pred"] for r in language.predict(awkward, (names, vectors), ["doc_id"]).collect()} == {"und"}
