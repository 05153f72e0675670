"""Nothing is dropped between landing and gold, and writes leave tables as they should be."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from voltaic.operators import merge, quality, reshape, series
from voltaic.plans import bronze, gold, silver
from voltaic.session import checkpoint_root
from voltaic.sources import files, landing, tables
from voltaic.sources.registry import (
    DAM, FUEL_MIX, LMP_SETTLEMENT_POINT, LOAD_FORECAST, SOLAR, SOLAR_REGIONAL, SOURCES, WIND, WIND_REGIONAL,
)
from voltaic.streaming.incremental import start_incremental_upsert

BASE = dt.datetime(2024, 1, 30)
HOUR = dt.timedelta(hours=1)


def _df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------------ hubs, regions

def test_every_hub_is_a_column_and_lone_hours_are_rows(spark):
    rows = [(BASE + i * HOUR, BASE.date(), i, p, "Hub", float(i + k)) for i in range(3)
            for k, p in enumerate(("HB_WEST", "HB_HOUSTON", "HB_PAN")) if i < 2 or p == "HB_PAN"]
    rows.append((BASE, BASE.date(), 0, "RN_1", "Resource Node", 9.0))
    lmp = _df(spark, rows, "interval_start TIMESTAMP_NTZ, delivery_date DATE, hour_of_day INT, settlement_point STRING, "
                           "point_type STRING, lmp_price DOUBLE")
    out = {r.hour_of_day: r for r in gold.hub_hourly_comparison(lmp).collect()}
    assert set(out) == {0, 1, 2}
    assert out[2].HB_PAN == 4.0 and out[2].HB_WEST is None and out[1].houston_west_spread == 1.0
    assert "RN_1" not in out[0].asDict() and "north_south_spread" not in out[0].asDict()
    given = reshape.pivot_first(lmp, ["hour_of_day"], "settlement_point", ["HB_WEST"], "lmp_price", "interval_start")
    assert given.count() == 3 and given.columns == ["hour_of_day", "HB_WEST"]
    assert reshape.pivot_first(lmp.limit(0), ["hour_of_day"], "settlement_point", None, "lmp_price", "interval_start").count() == 0


def test_regional_unpivot_carries_all_metrics_and_columns(spark):
    wide = _df(spark, [(BASE, BASE + HOUR, BASE, "api", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)],
               "Interval_Start TIMESTAMP_NTZ, Interval_End TIMESTAMP_NTZ, Publish_Time TIMESTAMP_NTZ, _source STRING, "
               "GEN_WEST DOUBLE, STWPF_WEST DOUBLE, COP_HSL_WEST DOUBLE, `GEN_MIDDLE EAST` DOUBLE, HSL_NORTH DOUBLE, OWN_WEST DOUBLE")
    out = {r.region: r for r in silver.transform_regional(wide, WIND_REGIONAL).collect()}
    assert set(out) == {"WEST", "MIDDLE_EAST", "NORTH"}
    w = out["WEST"]
    assert (w.gen_mw, w.stwpf_mw, w.cop_hsl_mw, w.own_mw, w.hsl_mw) == (1.0, 2.0, 3.0, 6.0, None)
    assert (out["MIDDLE_EAST"].gen_mw, out["NORTH"].hsl_mw) == (4.0, 5.0)
    assert w.Publish_Time == BASE and w._source == "api"


def test_long_regional_feed_is_keyed_by_region(spark, scratch):
    path, table = scratch("landing-long"), scratch("bronze-long")
    rows = [(BASE + i * HOUR, r, float(i)) for i in range(4) for r in ("WEST", "NORTH", "SOUTH")]
    _df(spark, rows, "Interval_Start TIMESTAMP_NTZ, Geographic_Region STRING, GEN_MW DOUBLE").write.parquet(path)
    for _ in range(2):
        bronze.land(spark, path, table, SOLAR_REGIONAL)
    assert tables.read_table(spark, table).count() == 12
    long = silver.transform_regional(tables.read_table(spark, table))
    assert {r.region for r in long.select("region").distinct().collect()} == {"WEST", "NORTH", "SOUTH"}


# ------------------------------------------------------------------------ landing

def _solar_rows(hours, gen=1.0):
    return [(BASE + h * HOUR, BASE + (h + 1) * HOUR, BASE, gen + h, 1.0, 2.0, 3.0, 4.0) for h in hours]


def test_raw_names_extra_columns_and_later_regions_are_kept(spark, scratch):
    path = scratch("landing-raw")
    ym = ("year", "month")
    first = tables.with_date_parts(_df(spark, _solar_rows(range(24)), SOLAR.schema), parts=ym)
    later = tables.with_date_parts(_df(spark, _solar_rows(range(48, 72)), SOLAR.schema), parts=ym).withColumn("GEN_PANHANDLE", F.lit(7.0))
    for df in (first, later):
        raw = df.withColumnsRenamed({"Interval_Start": "Interval Start", "GEN_SYSTEM_WIDE": "GEN SYSTEM (WIDE)"})
        tables.write_partitioned(raw, path, ym, "append")
    got = landing.read_feed(spark, path, SOLAR)
    assert got.count() == 48 and got.filter("GEN_PANHANDLE = 7.0").count() == 24
    day = landing.read_feed(spark, path, SOLAR, "2024-02-01", "2024-02-01")
    assert day.count() == 24 and "GEN_PANHANDLE" in day.columns
    assert landing.landed_paths(spark, path, SOLAR, "2024-02-01", "2024-02-01") == [f"{path}/year=2024/month=2"]
    assert "GEN_PANHANDLE" not in landing.read_feed(spark, path, SOLAR, "2024-01-30", "2024-01-30").columns
    assert landing.read_feed(spark, path, SOLAR, "2023-01-01", "2023-01-02").count() == 0


@pytest.mark.parametrize("gone", ["GEN_SYSTEM_WIDE", "Interval_Start"])
def test_missing_required_column_is_an_error(spark, scratch, gone):
    path = scratch("landing-missing")
    _df(spark, _solar_rows(range(3)), SOLAR.schema).drop(gone).write.parquet(path)
    with pytest.raises(ValueError, match=gone):
        landing.read_feed(spark, path, SOLAR)


FEEDS = {
    SOLAR.name: (SOLAR.schema, lambda h: _solar_rows([h])[0]),
    WIND.name: (WIND.schema, lambda h: _solar_rows([h])[0]),
    SOLAR_REGIONAL.name: ("Interval_Start TIMESTAMP_NTZ, Interval_End TIMESTAMP_NTZ, GEN_WEST DOUBLE, STPPF_WEST DOUBLE",
                          lambda h: (BASE + h * HOUR, BASE, 1.0, 2.0)),
    WIND_REGIONAL.name: ("Interval_Start TIMESTAMP_NTZ, Interval_End TIMESTAMP_NTZ, GEN_WEST DOUBLE, STWPF_WEST DOUBLE",
                         lambda h: (BASE + h * HOUR, BASE, 1.0, 2.0)),
    LOAD_FORECAST.name: (LOAD_FORECAST.schema, lambda h: (BASE + h * HOUR, BASE, "COAST", 5.0)),
    FUEL_MIX.name: ("Time TIMESTAMP_NTZ, Coal_and_Lignite DOUBLE, Wind DOUBLE", lambda h: (BASE + h * HOUR, 3.0, 4.0)),
    LMP_SETTLEMENT_POINT.name: (LMP_SETTLEMENT_POINT.schema, lambda h: (BASE + h * HOUR, BASE, "HB_WEST", 20.0)),
    DAM.name: (DAM.schema, lambda h: (BASE + h * HOUR, BASE, "HB_WEST", "SP", "DAM", 20.0)),
}


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
@pytest.mark.parametrize("name", sorted(SOURCES))
def test_every_feed_lands_in_every_format(spark, scratch, name, fmt):
    schema, row = FEEDS[name]
    if fmt != "parquet" and name in (WIND.name, WIND_REGIONAL.name):
        pytest.skip("as its solar twin")
    source, path, table = SOURCES[name], scratch(f"landing-{fmt}"), scratch(f"bronze-{fmt}")
    df = _df(spark, [row(h) for h in range(72)], schema)
    (df.write.option("header", "true") if fmt == "csv" else df.write).format(fmt).save(path)
    bronze.land(spark, path, table, source, "2024-01-31", "2024-02-01", fmt=fmt)
    got = tables.read_table(spark, table)
    assert got.count() == 48 and got.filter("_ingested_at IS NULL OR _source <> '" + name + "'").count() == 0
    types = {f.name: f.dataType for f in got.schema.fields}
    assert {f.name: f.dataType for f in df.schema.fields}.items() <= types.items()
    rep = quality.quality_report(got, name).first()
    assert rep.null_ingested_at == 0 and rep.duplicate_intervals == 0


@pytest.mark.parametrize("name", [SOLAR.name, SOLAR_REGIONAL.name, FUEL_MIX.name])
def test_stream_and_batch_make_the_same_table(spark, scratch, name):
    schema, row = FEEDS[name]
    source, path = SOURCES[name], scratch("landing-both")
    batch, stream = scratch("bronze-batch"), scratch("bronze-stream")
    _df(spark, [row(h) for h in range(72)], schema).write.parquet(path)
    bronze.land(spark, path, batch, source)
    bronze.land(spark, path, stream, source)  # loaded once by batch, then streamed
    start_incremental_upsert(spark, path, stream, source, checkpoint=scratch("ckpt-both")).awaitTermination(120)
    start_incremental_upsert(spark, path, scratch("bronze-only"), source, checkpoint=scratch("ckpt-only")).awaitTermination(120)
    cols = [c for c in tables.read_table(spark, batch).columns if c != "_ingested_at"]
    a, b = (sorted(map(str, tables.read_table(spark, p).select(*cols).collect())) for p in (batch, stream))
    assert a == b and len(a) == 72
    assert files.partition_dirs(spark, stream, source.partitions) and set(files.partition_dirs(spark, stream, source.partitions)) == set(
        files.partition_dirs(spark, batch, source.partitions))


# ------------------------------------------------------------------------- writes

def _staged(spark):
    root = checkpoint_root(spark).removeprefix("file://").removeprefix("file:")
    return {d for d in os.listdir(root) if d.startswith("stage-")}


def test_few_files_a_partition_and_no_staging_left(spark, scratch):
    path = scratch("few-files")
    rows = [(i, BASE + dt.timedelta(days=i % 90), float(i), BASE) for i in range(5000)]
    df = _df(spark, rows, "k LONG, ts TIMESTAMP_NTZ, v DOUBLE, _ingested_at TIMESTAMP_NTZ").repartition(40)
    before = _staged(spark)
    tables.upsert_table(spark, path, df, ["k"], time_col="ts")
    tables.upsert_table(spark, path, df.withColumn("v", F.col("v") + 1).withColumn("_ingested_at", F.col("_ingested_at") + F.expr("INTERVAL 1 DAY")),
                        ["k"], time_col="ts")
    assert tables.read_table(spark, path).agg(F.sum("v")).first()[0] == sum(range(5000)) + 5000
    local = path.removeprefix("file://").removeprefix("file:")
    for d, _, names in os.walk(local):
        assert sum(n.startswith("part-") and n.endswith(".parquet") for n in names) <= 2
    assert _staged(spark) == before


def test_staging_is_kept_and_named_when_a_merge_fails(spark, scratch, monkeypatch):
    path = scratch("fails")
    df = _df(spark, [(1, BASE, 1.0, BASE)], "k LONG, ts TIMESTAMP_NTZ, v DOUBLE, _ingested_at TIMESTAMP_NTZ")
    tables.upsert_table(spark, path, df, ["k"], time_col="ts")
    monkeypatch.setattr(tables, "upsert", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError) as e:
        tables.upsert_table(spark, path, df, ["k"], time_col="ts")
    assert "stage-batch" in e.value.__notes__[0]


def test_dedupe_rewrites_only_partitions_with_a_repeated_key(spark, scratch):
    path, ym = scratch("dd-parts"), ("year", "month")
    t0 = dt.datetime(2024, 3, 1)
    rows = [(1, BASE, 1.0, t0), (1, BASE, 2.0, t0 + HOUR), (2, BASE + dt.timedelta(days=40), 3.0, t0),
            (3, BASE + dt.timedelta(days=70), 4.0, t0), (3, BASE + dt.timedelta(days=100), 5.0, t0 + HOUR)]
    df = _df(spark, rows, "k LONG, ts TIMESTAMP_NTZ, v DOUBLE, _ingested_at TIMESTAMP_NTZ")
    tables.write_partitioned(tables.with_date_parts(df, "ts", ym), path, ym, "overwrite")
    local = path.removeprefix("file://").removeprefix("file:")
    march = os.listdir(f"{local}/year=2024/month=3")
    out = tables.dedupe_table(spark, path, ["k"], parts=ym)
    assert (out["before"], out["after"], out["removed"], out["partitions"]) == (5, 3, 2, 3)
    assert os.listdir(f"{local}/year=2024/month=3") == march
    assert sorted((r.k, r.v) for r in tables.read_table(spark, path).collect()) == [(1, 2.0), (2, 3.0), (3, 5.0)]
    assert out["backup"].startswith(path + "_backup_") and tables.read_table(spark, out["backup"]).count() == 4


def test_dedupe_sorts_repeated_keys_only_and_keeps_the_total_order(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, 1, 2]), rng.choice([None, 1.0, 2.0])) for _ in range(300)]
    rows += [(7, 3, float(i % 5)) for i in range(150)]  # a third of the rows under one key
    df = _df(spark, rows, "k LONG, o LONG, v DOUBLE").repartition(5)
    got = {r.k: (r.o, r.v) for r in merge.dedupe_latest(df, ["k"], ["o"]).collect()}
    low = lambda x: (x is not None, x or 0)
    want = {}
    for k, o, v in rows:
        if k not in want or (low(o), low(v)) > (low(want[k][0]), low(want[k][1])):
            want[k] = (o, v)
    assert got == want
    plan = merge.dedupe_latest(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


def test_quality_counts_need_no_shuffle_by_time(spark):
    df = _df(spark, [(BASE, BASE), (BASE, None), (None, BASE)], "Interval_Start TIMESTAMP_NTZ, _ingested_at TIMESTAMP_NTZ")
    rep = quality.quality_report(df, "t", duplicates=False)
    r = rep.first()
    assert (r.row_count, r.null_time_column, r.null_ingested_at, r.duplicate_intervals) == (3, 1, 1, None)
    assert "hashpartitioning" not in rep._jdf.queryExecution().executedPlan().toString()
    assert quality.quality_report(df, "t").first().duplicate_intervals == 1


def test_high_water_mark_reads_the_latest_partition(spark, scratch):
    path, ym = scratch("hwm"), ("year", "month")
    df = _df(spark, [(BASE + dt.timedelta(days=i),) for i in range(90)], "ts TIMESTAMP_NTZ")
    tables.write_partitioned(tables.with_date_parts(df, "ts", ym), path, ym, "overwrite")
    mark = landing.high_water_mark_path(spark, path, "ts", ym)
    assert mark.first()["max_date"] == (BASE + dt.timedelta(days=89)).date()
    assert len(mark.inputFiles()) == 1


# ------------------------------------------------------------------ small additions

@pytest.mark.parametrize("block", [None, 4 * 3600])
def test_range_roll_is_the_plain_range_window(spark, block):
    rng = random.Random(5)
    rows, t = [], BASE
    for i in range(250):
        t += dt.timedelta(seconds=rng.choice([0, 60, 1800, 3600, 40_000]))
        rows.append((i, rng.choice("ab"), t, rng.choice([None, float(i)])))
    rows.append((999, "a", None, 5.0))
    df = _df(spark, rows, "i LONG, e STRING, ts TIMESTAMP_NTZ, v DOUBLE").repartition(3)
    frames = {"s": ("sum", -4 * 3600, -60), "n": ("count", -3600, 0), "m": ("max", -7200, -1)}
    got = {r.i: (r.s, r.n, r.m) for r in series.range_roll(df, "ts", "v", frames, by=["e"], block_seconds=block).collect()}
    for i, e, t, v in rows:
        def seen(lo, hi):
            return [w for _, f, u, w in rows if t and u and f == e and w is not None and lo <= (u - t).total_seconds() <= hi]
        s, n, m = seen(-4 * 3600, -60), seen(-3600, 0), seen(-7200, -1)
        assert got[i] == (sum(s) if s else None, len(n), max(m) if m else None)


def test_zone_and_horizon(spark):
    df = _df(spark, _solar_rows(range(3)), SOLAR.schema)
    local = silver.transform_solar_hourly(df, zone="America/Chicago").orderBy("interval_start").collect()
    assert [r.hour_of_day for r in local] == [18, 19, 20] and local[0].day_of_week == "Monday"
    ahead = silver.forecast_horizon(silver.transform_solar_hourly(df)).orderBy("interval_start").collect()
    assert [(r.forecast_horizon_hours, r.is_forecast) for r in ahead] == [(0.0, False), (1.0, True), (2.0, True)]
