"""Every query with SQL against DuckDB on the smallest tables, and the others for rows."""

import os

import duckdb
import pytest

from mediasieve.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr([round(r[k], 6) if isinstance(r[k], float) else r[k] for k in order]) for r in data)


def oracle(sql):
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    got = c.execute(sql)
    return [x[0] for x in got.description], got.fetchall()


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_equals_sql(spark, name):
    df = catalogue.QUERIES[name](spark, DATA)
    columns, want = oracle(catalogue.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, want)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_has_rows(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).count() > 0
