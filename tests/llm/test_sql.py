"""The registered SQL against the queries, on the smallest tables."""

import duckdb
import pytest

from voltaic.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(map(tuple, df.select(*want.columns).collect())) == sorted(want.fetchall())
