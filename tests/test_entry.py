"""Driver contract: the flagship runs on sf0.001, every registered query has
an oracle, and a few queries agree with their DuckDB oracle at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")


@needs_data
def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"date", "mae_mw", "rmse_mw", "observation_count"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


@needs_data
@pytest.mark.parametrize("qid", ["AGG-4", "AGG-8", "AGG-14", "AGG-20", "PIP-12", "PIP-15",
                                 "RSH-1", "SNK-5", "SNK-6", "QC-8", "RPT-6"])
def test_matches_oracle(spark, qid):
    con = duckdb.connect()
    for t in ("events", "orders", "customer", "nation", "region", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[qid](spark, SF)
    res = con.sql(E.oracle_sql()[qid])
    assert sorted(sdf.columns) == sorted(res.columns)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    idx = [res.columns.index(c) for c in cols]
    drows = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert srows == drows
