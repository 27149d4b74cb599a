"""Each registered query with a SQL twin gives what the twin gives."""

import duckdb
import pytest

from tidewire import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    return "~" if v is None else repr(round(v, 6)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, sf_dir, con, name):
    df = queries.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    cur = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_query_without_twin(spark, sf_dir, name):
    assert queries.queries()[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", ["o49_metadata_json", "o66_reindex_copy", "o96_incremental_reindex"])
def test_whole_table_forms(con, name):
    """They give all that the forms over a part of the table give, and more on a larger table."""
    con.execute("CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    try:
        part, whole = (set(con.execute(queries.oracle_sql()[n]).fetchall()) for n in (name, f"{name}_all"))
    finally:
        con.execute("DROP VIEW temp.documents")
    assert part < whole
