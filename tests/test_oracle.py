"""Every named query against its comparison SQL on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from cornermart.testbed import oracle
from cornermart.testbed.queries import QUERIES as NAMED
from cornermart.testbed.queries import runnable

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
QUERIES, ORACLE = {name: runnable(name) for name in NAMED}, oracle.statements()


@pytest.fixture(scope="module")
def engine(testdata):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{testdata}/sf0.001/{name}.parquet'")
    yield con
    con.close()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 9)
        return v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=str)


def test_every_query_has_its_statement():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, engine, testdata, name):
    df = QUERIES[name](spark, f"{testdata}/sf0.001")
    result = engine.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, result.fetchall())


def test_entry_is_the_flagship(spark, testdata):
    df = entry.entry(spark)
    assert df.columns == ["week_start_date", "channel", "total_revenue"]
    assert df.count() > 0
