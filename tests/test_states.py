"""Mergeable states against aggregates over all rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from voltaic.operators import states


def _df(spark, n=4000):
    rng = random.Random(4)
    rows = [(rng.randrange(9), rng.choice(["a", "b", None]), None if rng.random() < 0.1 else 1e6 + rng.gauss(0, 1)) for _ in range(n)]
    return spark.createDataFrame(rows + [(3, "one", 5.0), (4, "none", None)], "part int, g string, v double")


def test_merged_states(spark):
    df = _df(spark)
    kept = states.state(df, ["part"], ["g"], {"v": F.col("v")}, quantiles={"v": "values"})
    got = states.merged(kept, ["g"], ["v"]).select("g", "rows", "v_n", states.mean("v").alias("m"), states.stddev("v").alias("s"), "v_min", "v_max")
    q = states.quantiles(kept, ["g"], "v", (0.1, 0.5), ["p10", "p50"])
    got = {r.g: r for r in states.with_quantiles(got, q, ["g"]).collect()}
    want = df.groupBy("g").agg(F.count(F.lit(1)).alias("rows"), F.count("v").alias("n"), F.avg("v").alias("m"), F.stddev_samp("v").alias("s"),
                               F.min("v").alias("lo"), F.max("v").alias("hi"), F.percentile("v", [0.1, 0.5]).alias("q")).collect()
    assert {r.g for r in want} == set(got) == {"a", "b", None, "one", "none"}
    for r in want:
        own = got[r.g]
        assert (own.rows, own.v_n, own.v_min, own.v_max) == (r.rows, r.n, r.lo, r.hi)
        assert [own.p10, own.p50] == (r.q or [None, None])
        for a, b in ((own.m, r.m), (own.s, r.s)):
            assert (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9))


def test_sketches_are_within_their_rank_error(spark):
    df = _df(spark, 30_000).where("g = 'a' AND v IS NOT NULL")
    kept = states.state(df, ["part"], ["g"], {"v": F.col("v")}, quantiles={"v": "sketch"})
    assert kept.count() == 9
    row = states.quantiles(kept, ["g"], "v", (0.1, 0.5, 0.9), ["a", "b", "c"], "sketch").first()
    values = sorted(r.v for r in df.collect())
    for q, v in zip((0.1, 0.5, 0.9), (row.a, row.b, row.c)):
        assert abs(sum(x <= v for x in values) / len(values) - q) < states.RANK_ERROR
    # a new day is a row more, the others stay
    more = states.state(df.withColumn("part", F.lit(99)), ["part"], ["g"], {"v": F.col("v")}, quantiles={"v": "sketch"})
    both = states.quantiles(kept.unionByName(more), ["g"], "v", (0.5,), ["m"], "sketch").first()
    assert abs(sum(x <= both.m for x in values) / len(values) - 0.5) < states.RANK_ERROR
    with pytest.raises(ValueError):
        states.state(df, ["part"], ["g"], {"v": F.col("v")}, quantiles={"v": "list"})
