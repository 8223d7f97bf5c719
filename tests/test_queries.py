"""Every registered query of the library that has SQL gives what DuckDB gives on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df: pd.DataFrame) -> list[tuple]:
    plain = lambda x: None if pd.isna(x) else round(float(x), 6) + 0.0 if isinstance(x, float) else str(x)
    return sorted((tuple(plain(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", [k for k, (_, sql) in entry.PLANS.items() if sql])
def test_query_equals_sql(spark, db, name):
    query, sql = entry.PLANS[name]
    assert rows(query(spark, SF).toPandas()) == rows(db.execute(sql).df())


@pytest.mark.parametrize("name", [k for k, (_, sql) in entry.PLANS.items() if not sql])
def test_query_runs(spark, name):
    assert entry.PLANS[name][0](spark, SF).collect()


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()
