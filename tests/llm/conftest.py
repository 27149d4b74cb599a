import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Null, empty and wordless texts, ties, repeated rows, a long text, null ids, and columns whose names
    clash with results."""
    rng = random.Random(5)
    same = words(rng, 60)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (4, same, "en", "b"), (5, same, "en", "b"), (5, same, "en", "b"), (5, same + " x", "de", "b"),
        (6, words(rng, 20_000), "de", None), (7, "é ñ 日本 ß", "fr", "c"), (None, words(rng, 30), None, "c"), (None, None, None, None), (8, "one", "en", "a"), (9, "a\nb\n\nb\n", "en", "é"),
    ]
    df = spark.createDataFrame([(i, t, l, s, len(t or "")) for i, t, l, s in rows], DOCS)
    extra = {c: df["n_chars"] for c in ("score", "size", "shard", "slot", "fingerprint", "kept", "__text", "__row", "n_words", "label", "predicted", "spans", "target", "items", "root")}
    return df.withColumns(extra)


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(12)], "doc_id long, quality int, toxic int")
