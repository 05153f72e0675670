"""Distributed exact quantiles equal Spark's percentile, also for a group
that holds a third of the rows and for NULL group keys."""

import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltaic.operators.metrics import daily_price_statistics
from voltaic.operators.quantiles import exact_quantiles
from voltaic.plans.catalog import Frames

QS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _rows():
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(-500, 500)) / 4) for _ in range(3000)]   # many repeats
    rows += [("hot", None)] * 20
    rows += [(f"g{i}", rnd.uniform(-10, 10)) for i in range(40) for _ in range(rnd.randint(1, 60))]
    rows += [("one", 5.0), ("two", 1.0), ("two", 4.0), ("nulls", None), ("nulls", None)]
    rows += [(None, float(i)) for i in range(7)]
    return rows


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_equals_percentile(spark, parts):
    df = spark.createDataFrame(_rows(), "g STRING, v DOUBLE").repartition(5)
    names = [f"q{i}" for i in range(len(QS))]
    got = {r.g: [r[n] for n in names]
           for r in exact_quantiles(df, ["g"], "v", QS, names=names, partitions=parts).collect()}
    want = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", QS).alias("p")).collect()}
    assert "nulls" not in got and want["nulls"] is None      # no non-NULL value: no row
    del want["nulls"]
    assert set(got) == set(want)
    for g, ps in want.items():
        assert got[g] == pytest.approx(ps, rel=1e-12, abs=1e-12), g


def test_global_quantiles(spark):
    df = spark.createDataFrame([(float(x),) for x in range(101)], "v DOUBLE")
    r = exact_quantiles(df, [], "v", [0.5, 0.333], names=["med", "q"], partitions=4).first()
    assert r.med == 50.0 and r.q == pytest.approx(33.3)


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")
def test_price_statistics_distributed_equals_default(spark):
    lmp = Frames(spark, SF).lmp
    cols = ["date", "settlement_point", "p25_price", "median_price", "p75_price", "avg_price"]

    def rows(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                      for r in df.select(*cols).collect())

    assert rows(daily_price_statistics(lmp, exact="distributed")) == \
        rows(daily_price_statistics(lmp))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                               st.one_of(st.none(), st.integers(-20, 20).map(lambda x: x / 4))),
                     min_size=1, max_size=120),
       parts=st.integers(1, 9))
def test_equals_percentile_property(spark, rows, parts):
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    qs = [0.0, 0.3, 0.5, 0.95, 1.0]
    names = [f"q{i}" for i in range(len(qs))]
    got = {r.g: [r[n] for n in names]
           for r in exact_quantiles(df, ["g"], "v", qs, names=names, partitions=parts).collect()}
    want = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", qs).alias("p")).collect()
            if r.p is not None}
    assert set(got) == set(want)
    for g, ps in want.items():
        assert got[g] == pytest.approx(ps, rel=1e-12, abs=1e-12)
