"""RANGE frames over cells of a second equal those over rows."""

import datetime as dt
import math
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from voltaic.operators import series

BASE = dt.datetime(2024, 1, 1)
FRAMES = {"n": ("count", -3600, -1), "s": ("sum", -7200, 0), "a": ("avg", -1800, 0), "lo": ("min", -86400, -600), "hi": ("max", -600, 0),
          "d": ("stddev", -7200, -1)}


@pytest.mark.parametrize("hot", [False, True])
def test_cells_equal_rows(spark, hot):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        t = BASE + dt.timedelta(seconds=rng.choice([rng.randrange(3 * 86400), 3600 * rng.randrange(72)]), milliseconds=rng.randrange(1000))
        rows.append((i, rng.choice(["a", "b", None]), None if i % 50 == 0 else t, None if i % 17 == 0 else 1e5 + rng.gauss(0, 1)))
    if hot:  # a third of the rows in one hour of one entity, most of them in one second
        rows += [(1000 + i, "a", BASE + dt.timedelta(hours=30, seconds=0 if i % 3 else i), 1e5 + rng.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, e string, t timestamp_ntz, v double")
    one, other = ({r.id: r for r in series.range_roll(df, "t", "v", FRAMES, by=["e"], block_seconds=100_000, method=m).collect()}
                  for m in ("rows", "cells"))
    assert set(one) == set(other) == {r[0] for r in rows}
    for i, r in one.items():
        for n in FRAMES:
            a, b = r[n], other[i][n]
            assert (a is None) == (b is None), (i, n)
            assert a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6), (i, n, a, b)


def test_a_hot_second_is_one_row_before_the_window(spark):
    df = spark.range(5000).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, 0, id % 3) AS t", "CAST(id AS DOUBLE) AS v")
    cells = series._cells(df.selectExpr("*", "CAST(id % 3 AS BIGINT) AS _at"), "v", [])
    assert cells.count() == 3
    out = series.range_roll(df, "t", "v", {"n": ("count", -1, 0)}, method="cells")
    assert {r["n"] for r in out.select("n").distinct().collect()} == {1667, 3334, 3333}
    with pytest.raises(ValueError):
        series.range_roll(df, "t", "v", {}, method="other")


@pytest.mark.parametrize("method", ["rows", "cells"])
def test_no_frame_is_gone_through_row_by_row(spark, method):
    """A frame of a day over a dense series would be read again for each row."""
    rows = [(i, BASE + dt.timedelta(seconds=20 * i), float(i % 97)) for i in range(2000)]
    rows += [(2000 + i, BASE + dt.timedelta(days=9, hours=i), v) for i, v in enumerate([1.0, float("inf"), 2.0, float("nan"), 3.0])]
    df = spark.createDataFrame(rows, "id int, t timestamp_ntz, v double")
    frames = {"hi": ("max", -86400, -1), "n": ("count", -86400, -3600), "one": ("count", 0, 0), "lo": ("min", -7200, -7200)}
    out = series.range_roll(df, "t", "v", frames, method=method)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    found = set(re.findall(r"specifiedwindowframe\(([^)]*)\)", plan, re.I))
    assert found and all("unboundedpreceding$" in f for f in found), found
    got = {r.id: r for r in out.collect()}
    bigger = lambda x: (math.isnan(x), x)  # noqa: E731 - NaN is the greatest
    for i, t, _ in rows[::37] + rows[-5:]:
        ago = [((u - t).total_seconds(), v) for _, u, v in rows]
        inside = lambda lo, hi: [v for s, v in ago if lo <= s <= hi]
        hi, lo = max(inside(-86400, -1), key=bigger, default=None), min(inside(-7200, -7200), key=bigger, default=None)
        assert (got[i].n, got[i].one) == (len(inside(-86400, -3600)), 1)
        assert str(got[i].hi) == str(hi) and str(got[i].lo) == str(lo), (i, got[i], hi, lo)


def test_types_are_those_of_the_plain_window(spark):
    df = spark.sql("SELECT id, TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, 0, id * 700) AS t, CAST(id AS INT) AS a, "
                   "CAST(id / 4 AS DECIMAL(9, 2)) AS b, TIMESTAMP_NTZ '2024-01-01' AS c, 0 AS e FROM range(30)")
    w = Window.partitionBy("e").orderBy(F.unix_seconds(F.col("t").cast("timestamp"))).rangeBetween(-5000, 0)
    for col, fns in (("a", ("sum", "avg", "min", "count", "stddev")), ("b", ("sum", "avg", "max")), ("c", ("max", "count"))):
        mine = series.range_roll(df, "t", col, {f: (f, -5000, 0) for f in fns}, by=["e"])
        plain = df.withColumns({f: series._FUNCS[f](F.col(col)).over(w) for f in fns})
        assert [(f.name, f.dataType) for f in mine.schema] == [(f.name, f.dataType) for f in plain.schema]
        for x, y in zip(mine.orderBy("id").collect(), plain.orderBy("id").collect(), strict=True):
            for f in fns:
                assert x[f] == y[f] or math.isclose(x[f], y[f], rel_tol=1e-12), (col, f, x, y)
