"""Every query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def rows(values, names):
    order = [names.index(c) for c in sorted(names)]
    return sorted(tuple(repr(v[i]) for i in order) for v in values)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, duck, data, name):
    df = entry.queries()[name](spark, data)
    cur = duck.execute(SQL[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(cur.fetchall(), names)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n not in SQL and not n.startswith(("op", "pipeline"))))
def test_other_queries_run(spark, data, name):
    assert entry.queries()[name](spark, data).count() >= 0


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "subj", "category", "obj", "context_md5"] and df.count() > 0
