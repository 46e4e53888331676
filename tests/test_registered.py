"""Each registered query against its SQL, on the smallest tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

# The training-data queries have tests of their own.
OWN = re.compile(r"(?!op\d+_|pipeline$)")
QUERIES = {k: q for k, q in entry.queries().items() if OWN.match(k)}
SQL = {k: q for k, q in entry.oracle_sql().items() if OWN.match(k)}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in os.listdir(small):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{name}'")
    return con


def test_every_query_has_sql():
    # A longest common subsequence is too slow in SQL; ``test_align`` has its own.
    assert set(QUERIES) - {"align_tokens"} == set(SQL)


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, small, duck, name):
    result = QUERIES[name](spark, small)
    columns = sorted(result.columns)
    got = sorted(map(repr, (tuple(r) for r in result.select(*columns).collect())))
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted(repr(tuple(row[i] for i in places)) for row in cursor.fetchall())
    assert got == want
    assert got


def test_entry(spark):
    rows = entry.entry(spark).collect()
    # No kind is empty, so every branch of the lookup is used.
    assert len(rows) == 4 and all(r.n_words > 0 for r in rows)
