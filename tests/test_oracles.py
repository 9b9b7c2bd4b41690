"""Every query with SQL gives the rows that its SQL gives on the same tables."""

import os

import duckdb
import pytest

from cohortlake import queries, queries_contract, queries_derived, queries_distributed, queries_review  # noqa: F401  the others register their queries

DATA = "/root/testdata/sf0.001"


def show(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for name in os.listdir(DATA):
        c.sql(f"create view {name.removesuffix('.parquet')} as select * from '{DATA}/{name}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sql, name):
    df = queries.QUERIES[name](spark, DATA)
    there = sql.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(there.columns)
    order = sorted(df.columns)
    mine = sorted(tuple(show(r[c]) for c in order) for r in df.collect())
    places = [there.columns.index(c) for c in order]
    assert mine == sorted(tuple(show(r[i]) for i in places) for r in there.fetchall())


def test_entry_works_without_the_training_data_folder():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
