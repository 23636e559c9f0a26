"""Every registered feed query against its SQL in DuckDB, over the smallest tables."""

import os

import duckdb
import pytest

from feedloom import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    found = catalog.QUERIES[name](spark, DATA).toPandas()
    assert rows(found) == rows(duck.sql(catalog.SQL[name]).df())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(catalog.SQL) <= set(__spark_entry__.oracle_sql())
