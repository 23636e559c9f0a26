"""The queries that SQL expresses, against DuckDB over the smallest tables."""

import duckdb
import pytest

from feedloom.llm import catalog

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    a, b = catalog.QUERIES[name](spark, DATA).toPandas(), con.sql(catalog.SQL[name]).df()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns) and sorted(map(repr, a[cols].values.tolist())) == sorted(map(repr, b[cols].values.tolist()))
