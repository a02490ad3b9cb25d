"""Every registered query against its SQL at the smallest scale, and its plan."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from tests.conftest import DATA

QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()
TABLES = ["documents", "benchmark", "conversations", "embeddings"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


OWN = {f.__name__ for f in entry_points.QUERIES}


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(ORACLE) >= OWN


@pytest.mark.parametrize("name", sorted(OWN & set(ORACLE)))
def test_same_rows(spark, duck, name):
    ours = QUERIES[name](spark, DATA).toPandas()
    theirs = duck.sql(ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    columns = sorted(ours.columns)
    ours, theirs = (
        df[columns].sort_values(columns).reset_index(drop=True) for df in (ours, theirs)
    )
    pd.testing.assert_frame_equal(ours, theirs, check_exact=True)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
