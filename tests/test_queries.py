"""Every registered query equals its SQL on DuckDB."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
#: The training-data queries have their own tests, beside that part of the library.
OWN = re.compile(r"op\d+_|pipeline$")
QUERIES = {name: query for name, query in entry.queries().items() if not OWN.match(name)}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if not OWN.match(name)}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value) if isinstance(value, float) else str(value)


def table_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = table_of(df.columns, df.collect())
    if name not in ORACLES:
        assert got[1]
        return
    cursor = duck.execute(ORACLES[name])
    want = table_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_only_known_queries_have_sql():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"logistic"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
