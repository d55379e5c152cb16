import pathlib

import duckdb
import pytest

import __spark_entry__ as contract

SF = pathlib.Path("/root/testdata/sf0.001")
ORACLES = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def key(row):
    return tuple("" if v is None else str(v) for v in row)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, str(SF))
    expected = db.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    want = sorted(expected.project(", ".join(f'"{c}"' for c in columns)).fetchall(), key=key)
    assert got == want
    assert got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, str(SF)).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 5
