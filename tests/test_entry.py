"""Driver contract: entry smoke check and every query against its DuckDB
statement at sf0.001 (the driver repeats this at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from tokenloom import queries as Q
from tokenloom.sources.tables import TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_every_query_has_an_oracle():
    assert set(Q.REGISTRY) <= set(E.queries()) and set(Q.REGISTRY) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return con


def _norm(df):
    df = df.copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6)
    df = df[sorted(df.columns)].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(Q.REGISTRY))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF001).toPandas()
    exp = duck.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert _norm(got).equals(_norm(exp))
