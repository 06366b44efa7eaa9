"""Every registered query against its DuckDB oracle on the smallest data set
(the driver does the same at sf0.01)."""

import pytest

import __spark_entry__ as entry
from tidewater.plans import registry
from tests.conftest import SMALL
from tools.check_oracle import multiset

QUERIES = {name: fn for name, fn in entry.queries().items() if name in registry.load_all()}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    d_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert multiset(rows, list(df.columns)) == multiset(cur.fetchall(), d_cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_column_types_match_oracle(spark, duck, name):
    spark_types = dict(QUERIES[name](spark, SMALL).dtypes)
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in spark_types.items()} == duck_types
