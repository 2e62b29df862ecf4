"""Every query with SQL beside it gives the same rows, columns and values on the smallest tables."""

import duckdb
import pytest

from edutide.plans import basics, facts, inventory, layout, products, relations, sequences, streams, usage

PARTS = (basics, sequences, relations, usage, facts, products, inventory, layout, streams)
QUERIES = {n: q for p in PARTS for n, q in p.QUERIES.items()}
SQL = {n: s for p in PARTS for n, s in p.SQL.items()}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def shown(value):
    if value is None or value != value:
        return "null"
    return repr(round(value, 6)) if isinstance(value, float) else str(value)


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(shown(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    answer = duck.execute(SQL[name])
    columns = [c[0] for c in answer.description]
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, answer.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
