"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from shelfwise import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return None
    if hasattr(x, "year"):
        return str(x)
    return x.item() if hasattr(x, "item") else x


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    return sorted(repr([float(v) if isinstance(v := plain(x), (int, float)) and not isinstance(v, bool) else v for x in r]) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, duck, name):
    got, want = queries.queries()[name](spark, FOLDER).toPandas(), duck.sql(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_sql():
    """The two matchers are held against a plain restatement in test_matching."""
    assert set(queries.queries()) - set(queries.oracle_sql()) == {"direct_crosswalk", "alias_pairs"}
