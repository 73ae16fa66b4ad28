"""Every registered query with SQL gives the rows that DuckDB gives."""

import os

import duckdb
import pandas as pd
import pytest

from gristmill.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set TimeZone='UTC'")
    for name in os.listdir(SF):
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return con


def _rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or not hasattr(v, "__len__") and pd.isna(v):
            return "~"
        if isinstance(v, (int, float)) or hasattr(v, "item") and isinstance(v.item(), (int, float)) and not isinstance(v.item(), bool):
            return repr(round(float(v), 9))
        return str(v).removesuffix(" 00:00:00")

    df = df[sorted(df.columns)]
    return sorted(tuple(plain(v) for v in row) for row in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_sql(spark, duck, name):
    got, expected = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert len(got) > 0
    assert sorted(got.columns) == sorted(expected.columns)
    assert _rows(got) == _rows(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_other_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
