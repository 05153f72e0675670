"""Properties: upsert is idempotent, dedupe leaves unique keys, the blocked
window equals the global window, unpivot round-trips, shares add up."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from voltaic.operators import merge, reshape, series
from voltaic.plans import silver

BASE = dt.datetime(2024, 1, 1)
S = "k LONG, v DOUBLE, _ingested_at TIMESTAMP_NTZ"


def _rows(draw_keys, values):
    return [(k, float(v), BASE + dt.timedelta(hours=i)) for i, (k, v) in enumerate(zip(draw_keys, values))]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=0, max_size=12),
       st.lists(st.integers(0, 5), min_size=1, max_size=12))
def test_upsert_twice_equals_once(spark, tkeys, bkeys):
    target = merge.dedupe_latest(spark.createDataFrame(_rows(tkeys, range(len(tkeys))), S), ["k"])
    batch = spark.createDataFrame(_rows(bkeys, range(100, 100 + len(bkeys))), S)
    once = merge.upsert(target, batch, ["k"])
    twice = merge.upsert(once, batch, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.k for r in once.collect()} == set(tkeys) | set(bkeys)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 9)),
                min_size=1, max_size=30))
def test_dedupe_unique_keys_and_newest(spark, rows):
    df = spark.createDataFrame(
        [(a, b, BASE + dt.timedelta(days=d), float(i)) for i, (a, b, d) in enumerate(rows)],
        "a INT, b INT, _ingested_at TIMESTAMP_NTZ, v DOUBLE")
    out = merge.dedupe_latest(df, ["a", "b"]).collect()
    keys = [(r.a, r.b) for r in out]
    assert len(keys) == len(set(keys)) == len({(a, b) for a, b, _ in rows})
    newest = {}
    for i, (a, b, d) in enumerate(rows):
        cand = (d, float(i))
        newest[(a, b)] = max(newest.get((a, b), cand), cand)
    assert {(r.a, r.b): ((r._ingested_at - BASE).days, r.v) for r in out} == newest


@pytest.mark.parametrize("method", ["bucket", "range"])
@pytest.mark.parametrize("block_rows", [24, 50, 1000])
def test_blocked_window_equals_global_window(spark, block_rows, method):
    rnd = random.Random(7)
    rows = []
    for ent in ("A", "B", "C", None):          # a NULL entity is an entity too
        t = BASE
        for _ in range(rnd.randint(50, 160)):
            t += dt.timedelta(hours=rnd.choice([1, 1, 1, 2, 30]))
            rows.append((ent, t, rnd.choice([None, round(rnd.uniform(-50, 500), 2)])))
    # an entity whose rows all fall in one day: a third of all rows in one bucket
    rows += [("H", BASE + dt.timedelta(minutes=m), float(m % 17)) for m in range(len(rows) // 2)]
    df = spark.createDataFrame(rows, "e STRING, ts TIMESTAMP_NTZ, v DOUBLE").repartition(4)
    lags = {"l1": 1, "l7": 7, "l24": 24}
    frames = {"a24": ("avg", -24, -1), "s7": ("stddev", -6, 0), "mx": ("max", -24, -1),
              "mn": ("min", -12, 0), "c": ("count", -24, -1), "sm": ("sum", -3, -1)}
    got = series.lag_roll(df, ["ts"], "v", lags=lags, frames=frames, by=["e"],
                          block_rows=block_rows, bucket=F.date_trunc("day", "ts"),
                          method=method)
    w = Window.partitionBy("e").orderBy("ts")
    fn = {"avg": F.avg, "stddev": F.stddev_samp, "max": F.max, "min": F.min,
          "count": F.count, "sum": F.sum}
    cols = {n: F.lag("v", k).over(w) for n, k in lags.items()}
    cols.update({n: fn[f]("v").over(w.rowsBetween(lo, hi)) for n, (f, lo, hi) in frames.items()})
    want = df.withColumns(cols)

    def norm(rs):
        return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rs),
                      key=lambda t: tuple((x is None, str(x)) for x in t))

    names = ["e", "ts", "v", *lags, *frames]
    assert norm(got.select(*names).collect()) == norm(want.select(*names).collect())


def test_unpivot_round_trip(spark):
    wide = spark.createDataFrame(
        [(BASE, 1.0, 2.0, None, None), (BASE + dt.timedelta(days=1), None, 3.0, 4.0, 5.0)],
        "ts TIMESTAMP_NTZ, GEN_NORTH DOUBLE, STPPF_NORTH DOUBLE, GEN_WEST DOUBLE, STPPF_WEST DOUBLE")
    long = reshape.unpivot_regions(wide, ["ts"])
    assert long.count() == 4
    kept = reshape.unpivot_regions(wide, ["ts"], keep_all_null=False)
    assert kept.count() == 3
    back = reshape.pivot_first(kept.withColumn("o", F.col("ts")), ["ts"], "region",
                               ["NORTH", "WEST"], "gen_mw", "o")
    got = {r.ts: (r.NORTH, r.WEST) for r in back.collect()}
    assert got == {BASE: (1.0, None), BASE + dt.timedelta(days=1): (None, 4.0)}


def test_shares_add_up_to_100(spark):
    def feed(scale):
        rows = [(BASE + dt.timedelta(hours=h), BASE + dt.timedelta(hours=h + 1), BASE,
                 scale * (h + 1), 1.0, 2.0, 3.0, 4.0) for h in range(48)]
        return rows
    cols = ("Interval_Start TIMESTAMP_NTZ, Interval_End TIMESTAMP_NTZ, Publish_Time TIMESTAMP_NTZ, "
            "GEN_SYSTEM_WIDE DOUBLE, HSL_SYSTEM_WIDE DOUBLE, {f} DOUBLE, {p} DOUBLE, "
            "COP_HSL_SYSTEM_WIDE DOUBLE")
    solar = silver.transform_solar_hourly(spark.createDataFrame(
        feed(3.0), cols.format(f="STPPF_SYSTEM_WIDE", p="PVGRPP_SYSTEM_WIDE")))
    wind = silver.transform_wind_hourly(spark.createDataFrame(
        feed(5.0), cols.format(f="STWPF_SYSTEM_WIDE", p="WGRPP_SYSTEM_WIDE")))
    totals = silver.renewable_totals({"solar": solar, "wind": wind}).collect()
    assert len(totals) == 48
    for r in totals:
        assert r.solar_pct + r.wind_pct == pytest.approx(100.0)
        assert r.solar_pct == pytest.approx(37.5)
