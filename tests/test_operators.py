"""Hand-computed cases for the column expressions and operators, including
the hazards of the source pipeline (see README, "Decisions")."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from voltaic.functions import classify_point, curtailment, forecast_error, forecast_error_pct, pct_of
from voltaic.operators import merge, metrics, reshape, series
from voltaic.plans import gold, silver


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_error_and_curtailment_edges(spark):
    df = spark.createDataFrame(
        [(None, 10.0, 5.0), (0.0, 10.0, 5.0), (8.0, 10.0, 5.0), (4.0, 10.0, None), (4.0, 6.0, 9.0)],
        "a DOUBLE, f DOUBLE, h DOUBLE")
    got = df.select(forecast_error("a", "f").alias("e"), forecast_error_pct("a", "f").alias("p"),
                    curtailment("a", "h").alias("c")).collect()
    assert got[0].e is None and got[0].p is None and got[0].c == 0.0   # NULL actual
    assert got[1].e == 10.0 and got[1].p is None                      # actual 0: no percentage
    assert got[2].c == 0.0                                            # hsl < actual
    assert got[3].c == 0.0                                            # hsl NULL
    assert got[4].c == 5.0 and got[4].p == pytest.approx(50.0)


def test_point_classifier_literal_underscore(spark):
    names = ["HB_WEST", "LZ_NORTH", "ZONE_A", "RN_1", "HBX1", "AHBONE", "XLZ_1"]
    df = spark.createDataFrame([(n,) for n in names], "p STRING")
    got = {r.p: r.c for r in df.select("p", classify_point("p").alias("c")).collect()}
    assert got == {"HB_WEST": "Hub", "LZ_NORTH": "Load Zone", "ZONE_A": "Load Zone",
                   "RN_1": "Resource Node", "HBX1": "Resource Node",
                   "AHBONE": "Resource Node", "XLZ_1": "Load Zone"}


def test_zero_total_ratio_is_null(spark):
    r = spark.createDataFrame([(5.0, 0.0)], "a DOUBLE, t DOUBLE").select(
        pct_of("a", "t").alias("p")).first()
    assert r.p is None


def test_single_row_stddev_is_null(spark):
    df = spark.createDataFrame([(_ts("2024-01-01 00:00:00"), "HB_A", 5.0)],
                               "interval_start TIMESTAMP_NTZ, settlement_point STRING, lmp_price DOUBLE")
    df = df.withColumns({"delivery_date": F.to_date("interval_start"),
                         "hour_of_day": F.hour("interval_start"), "is_peak_hour": F.lit(False),
                         "point_type": F.lit("Hub")})
    st = metrics.daily_price_statistics(df).first()
    assert st.stddev_price is None and st.hours_count == 1
    vol = gold.lmp_volatility(metrics.daily_price_statistics(df)).first()
    assert vol.rolling_7d_stddev is None and vol.cv_7d is None


def test_daily_curtailment_is_not_multiplied(spark):
    rows = [(_ts("2024-01-01 00:00:00") + dt.timedelta(hours=h), 1.0, 1.0) for h in range(24)]
    df = spark.createDataFrame(rows, "interval_start TIMESTAMP_NTZ, actual_mw DOUBLE, "
                                     "estimated_curtailment_mw DOUBLE")
    r = metrics.daily_curtailment(df, df).first()
    assert r.solar_curtailment_mwh == 24.0 and r.wind_generation_mwh == 24.0
    assert r.curtailment_rate_pct == pytest.approx(50.0)


def test_batch_with_repeated_key_keeps_newest(spark):
    s = "k LONG, v DOUBLE, _ingested_at TIMESTAMP_NTZ"
    target = spark.createDataFrame([(1, 1.0, _ts("2024-01-01 00:00:00")),
                                    (2, 2.0, _ts("2024-01-01 00:00:00"))], s)
    batch = spark.createDataFrame([(2, 20.0, _ts("2024-01-02 00:00:00")),
                                   (2, 21.0, _ts("2024-01-03 00:00:00")),
                                   (3, 3.0, _ts("2024-01-02 00:00:00"))], s)
    got = sorted((r.k, r.v) for r in merge.upsert(target, batch, ["k"]).collect())
    assert got == [(1, 1.0), (2, 21.0), (3, 3.0)]


def test_null_key_upserted_twice_is_one_row(spark):
    s = "k LONG, v DOUBLE, _ingested_at TIMESTAMP_NTZ"
    batch = spark.createDataFrame([(None, 1.0, _ts("2024-01-01 00:00:00"))], s)
    once = merge.upsert(spark.createDataFrame([], s), batch, ["k"])
    twice = merge.upsert(once, batch.withColumn("v", F.lit(2.0)), ["k"])
    assert [(r.k, r.v) for r in twice.collect()] == [(None, 2.0)]


def test_upsert_keeps_columns_the_batch_lacks(spark):
    target = spark.createDataFrame([(1, 1.0, "x", _ts("2024-01-01 00:00:00"))],
                                   "k LONG, v DOUBLE, extra STRING, _ingested_at TIMESTAMP_NTZ")
    batch = spark.createDataFrame([(1, 5.0, _ts("2024-01-02 00:00:00")),
                                   (2, 6.0, _ts("2024-01-02 00:00:00"))],
                                  "k LONG, v DOUBLE, _ingested_at TIMESTAMP_NTZ")
    got = sorted((r.k, r.v, r.extra) for r in merge.upsert(target, batch, ["k"]).collect())
    assert got == [(1, 5.0, "x"), (2, 6.0, None)]


def test_upsert_carry_with_a_key_stored_twice(spark):
    # the target holds key 1 twice (an earlier append); the batch row for key 1
    # stays one row and carries the newest stored value of the missing column
    target = spark.createDataFrame([(1, 1.0, "old", _ts("2024-01-01 00:00:00")),
                                    (1, 2.0, "new", _ts("2024-01-01 06:00:00"))],
                                   "k LONG, v DOUBLE, extra STRING, _ingested_at TIMESTAMP_NTZ")
    batch = spark.createDataFrame([(1, 5.0, _ts("2024-01-02 00:00:00"))],
                                  "k LONG, v DOUBLE, _ingested_at TIMESTAMP_NTZ")
    got = [(r.k, r.v, r.extra) for r in merge.upsert(target, batch, ["k"]).collect()]
    assert got == [(1, 5.0, "new")]


def test_upsert_missing_key_raises(spark):
    df = spark.createDataFrame([(1, 1.0)], "k LONG, v DOUBLE")
    with pytest.raises(ValueError):
        merge.upsert(df, df.drop("k"), ["k"])


def test_rows_frame_spans_a_gap(spark):
    # one missing day: lag 24 of the first hour after the gap is 48 hours back
    start = _ts("2024-01-01 00:00:00")
    hours = [start + dt.timedelta(hours=h) for h in range(72) if not 24 <= h < 48]
    df = spark.createDataFrame([(t, float(i)) for i, t in enumerate(hours)], "ts TIMESTAMP_NTZ, v DOUBLE")
    out = series.lag_roll(df, ["ts"], "v", lags={"lag24": 24}, block_rows=32)
    got = {r.ts: r.lag24 for r in out.collect()}
    assert got[_ts("2024-01-03 00:00:00")] == 0.0


def test_repeated_local_hour_pivot_takes_earliest(spark):
    s = "delivery_date DATE, hour_of_day INT, settlement_point STRING, lmp_price DOUBLE, interval_start TIMESTAMP_NTZ"
    d = dt.date(2024, 11, 3)
    df = spark.createDataFrame([(d, 1, "HB_A", 7.0, _ts("2024-11-03 07:00:00")),
                                (d, 1, "HB_A", 9.0, _ts("2024-11-03 06:00:00")),
                                (d, 1, "HB_B", 4.0, _ts("2024-11-03 06:00:00"))], s)
    r = reshape.pivot_first(df, ["delivery_date", "hour_of_day"], "settlement_point",
                            ["HB_A", "HB_B", "HB_C"], "lmp_price", "interval_start").first()
    assert (r.HB_A, r.HB_B, r.HB_C) == (9.0, 4.0, None)


def test_169_rows_give_exactly_one_feature_row(spark):
    start = _ts("2024-01-01 00:00:00")
    rows = [(start + dt.timedelta(hours=h), float(h)) for h in range(169)]
    df = spark.createDataFrame(rows, "interval_start TIMESTAMP_NTZ, actual_mw DOUBLE")
    df = df.withColumns({"hour_of_day": F.hour("interval_start"), "is_weekend": F.lit(False),
                         "stppf_forecast_mw": F.lit(1.0), "year": F.year("interval_start"),
                         "month": F.month("interval_start"), "day": F.dayofmonth("interval_start")})
    out = gold.solar_features(df, block_rows=200).collect()
    assert len(out) == 1
    r = out[0]
    assert r.actual_lag_168h == 0.0 and r.actual_lag_1h == 167.0
    assert r.actual_avg_24h == pytest.approx(sum(range(144, 168)) / 24)
    assert r.actual_max_24h == 167.0 and r.actual_min_24h == 144.0
    assert r.day_of_year == 8 and r.hour_sin == pytest.approx(math.sin(0.0), abs=1e-12)


def test_block_smaller_than_reach_is_rejected(spark):
    df = spark.createDataFrame([(_ts("2024-01-01 00:00:00"), 1.0)], "ts TIMESTAMP_NTZ, v DOUBLE")
    with pytest.raises(ValueError):
        series.lag_roll(df, ["ts"], "v", lags={"l": 168}, block_rows=100)


def test_all_spread_columns_get_min_and_max(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0, 5.0), (dt.date(2024, 1, 1), 3.0, -5.0)],
                               "delivery_date DATE, a_spread DOUBLE, b_spread DOUBLE")
    r = reshape.daily_spreads(df).first()
    assert (r.min_a_spread, r.max_a_spread, r.min_b_spread, r.max_b_spread) == (1.0, 3.0, -5.0, 5.0)
    assert reshape.daily_spreads(df.drop("a_spread", "b_spread")) is None


def test_missing_required_column_raises(spark):
    df = spark.createDataFrame([(_ts("2024-01-01 00:00:00"), 1.0)],
                               "Interval_Start TIMESTAMP_NTZ, ACTUAL_SYSTEM_WIDE DOUBLE")
    with pytest.raises(ValueError):
        silver.transform_solar_hourly(df)


def test_calendar_and_peak_flags(spark):
    df = spark.createDataFrame([(_ts("2024-01-06 06:00:00"), _ts("2024-01-06 07:00:00")),
                                (_ts("2024-01-08 21:00:00"), _ts("2024-01-08 22:00:00")),
                                (_ts("2024-01-08 23:00:00"), _ts("2024-01-09 00:00:00"))],
                               "Interval_Start TIMESTAMP_NTZ, Interval_End TIMESTAMP_NTZ")
    df = df.withColumns({"Location": F.lit("HB_X"), "Location_Type": F.lit("SP"),
                         "Market": F.lit("DAM"), "LMP": F.lit(1.0)})
    got = silver.transform_lmp_dam(df).orderBy("interval_start").collect()
    assert [(r.day_of_week, r.is_weekend, r.is_peak_hour, r.hour_ending) for r in got] == [
        ("Saturday", True, False, 7), ("Monday", False, True, 22), ("Monday", False, False, 0)]


def test_hot_key_dedupe_keeps_newest_with_total_order(spark):
    # one key holds a third of the rows, all with the same ingest time (one batch)
    t = _ts("2024-01-01 00:00:00")
    rows = [(0, float(i), t) for i in range(300)] + [(k, 1.0, t) for k in range(1, 601)]
    df = spark.createDataFrame(rows, "k LONG, v DOUBLE, _ingested_at TIMESTAMP_NTZ").repartition(7)
    out = merge.dedupe_latest(df, ["k"]).collect()
    assert len(out) == 601
    assert {r.k: r.v for r in out}[0] == 299.0     # tie on the ingest time -> greatest remaining column


def test_skill_score_against_persistence(spark):
    rows = [(_ts("2024-01-01 00:00:00") + dt.timedelta(hours=h), 100.0 + h, 100.0 + h + 1.0, 100.0 + h - 2.0)
            for h in range(24)]
    df = spark.createDataFrame(rows, "interval_start TIMESTAMP_NTZ, actual_mw DOUBLE, "
                                     "forecast DOUBLE, persist DOUBLE")
    r = metrics.skill_score(df, actual="actual_mw", forecast="forecast", floor=10.0,
                            persistence="persist").first()
    assert r.mse_forecast == pytest.approx(1.0) and r.mse_persistence == pytest.approx(4.0)
    assert r.skill_score == pytest.approx(0.75)


def test_feature_table_same_with_range_numbering(spark):
    start = _ts("2024-01-01 00:00:00")
    rows = [(start + dt.timedelta(hours=h), float(h % 37)) for h in range(400)]
    df = spark.createDataFrame(rows, "interval_start TIMESTAMP_NTZ, actual_mw DOUBLE")
    df = df.withColumns({"hour_of_day": F.hour("interval_start"), "is_weekend": F.lit(False),
                         "stppf_forecast_mw": F.lit(1.0), "year": F.year("interval_start"),
                         "month": F.month("interval_start"), "day": F.dayofmonth("interval_start")})

    def rows_of(out):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in out.collect())

    assert rows_of(gold.solar_features(df, block_rows=200, method="range")) == \
        rows_of(gold.solar_features(df, block_rows=200))
