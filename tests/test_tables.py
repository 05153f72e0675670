"""Sinks: upsert rewrites only touched partitions, dedupe backs up and
rewrites only when something is removed, range reads prune partitions."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from voltaic.sources import landing, tables
from voltaic.sources.registry import SOLAR

S = "Interval_Start TIMESTAMP_NTZ, v DOUBLE, _ingested_at TIMESTAMP_NTZ"
BASE = dt.datetime(2024, 1, 30)


def _rows(hours, v, ing):
    return [(BASE + dt.timedelta(hours=h), v + h, ing) for h in hours]


def _files(path, part):
    return sorted(glob.glob(os.path.join(path, part, "*.parquet")))


def test_upsert_rewrites_only_touched_partitions(spark, scratch):
    path = scratch("up")
    t0 = dt.datetime(2024, 3, 1)
    first = spark.createDataFrame(_rows(range(0, 72), 0.0, t0), S)   # Jan 30 .. Feb 1
    assert tables.upsert_table(spark, path, first, ["Interval_Start"],
                               time_col="Interval_Start")["action"] == "create"
    jan = _files(path, "year=2024/month=1")
    batch = spark.createDataFrame(_rows(range(60, 100), 1000.0, t0 + dt.timedelta(days=1)), S)
    out = tables.upsert_table(spark, path, batch, ["Interval_Start"], time_col="Interval_Start")
    assert out == {"action": "merge", "path": path, "partitions": 1}
    assert _files(path, "year=2024/month=1") == jan          # January not rewritten
    back = tables.read_table(spark, path).collect()
    assert len(back) == 100
    got = {r.Interval_Start: r.v for r in back}
    assert got[BASE + dt.timedelta(hours=59)] == 59.0 and got[BASE + dt.timedelta(hours=60)] == 1060.0
    # the same batch again changes nothing (idempotent)
    tables.upsert_table(spark, path, batch, ["Interval_Start"], time_col="Interval_Start")
    assert sorted(tables.read_table(spark, path).collect()) == sorted(back)


def test_upsert_missing_key(spark, scratch):
    path = scratch("up2")
    df = spark.createDataFrame(_rows(range(3), 0.0, BASE), S)
    with pytest.raises(ValueError):
        tables.upsert_table(spark, path, df, ["Interval_Start", "Geographic_Region"],
                            time_col="Interval_Start")
    out = tables.upsert_table(spark, path, df, ["Interval_Start", "Geographic_Region"],
                              time_col="Interval_Start", on_missing_key="append")
    assert out["action"] == "append" and tables.read_table(spark, path).count() == 3


def test_dedupe_table_backup_and_rewrite(spark, scratch):
    path = scratch("dd")
    rows = _rows(range(5), 0.0, BASE) + _rows(range(2), 50.0, BASE + dt.timedelta(days=1))
    df = tables.with_date_parts(spark.createDataFrame(rows, S), parts=("year", "month"))
    tables.write_partitioned(df, path, ("year", "month"), "overwrite")
    out = tables.dedupe_table(spark, path, ["Interval_Start"], parts=("year", "month"))
    assert (out["before"], out["after"], out["removed"]) == (7, 5, 2)
    assert tables.read_table(spark, out["backup"]).count() == 7
    got = {r.Interval_Start: r.v for r in tables.read_table(spark, path).collect()}
    assert got[BASE] == 50.0 and got[BASE + dt.timedelta(hours=4)] == 4.0
    again = tables.dedupe_table(spark, path, ["Interval_Start"], parts=("year", "month"))
    assert again["removed"] == 0 and again["backup"] is None


def test_read_feed_range_prunes_partitions(spark, scratch):
    path = scratch("feed")
    rows = [(BASE + dt.timedelta(days=d), BASE, BASE, float(d), 1.0, 2.0, 3.0, 4.0) for d in range(60)]
    feed = spark.createDataFrame(rows, SOLAR.schema)
    tables.write_partitioned(tables.with_date_parts(feed, parts=("year", "month")), path,
                             ("year", "month"), "overwrite")
    got = landing.read_feed(spark, path, SOLAR, start="2024-02-03", end="2024-02-05")
    assert sorted(r.GEN_SYSTEM_WIDE for r in got.collect()) == [4.0, 5.0, 6.0]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan
    assert "GreaterThanOrEqual(Interval_Start" in plan or "Interval_Start >=" in plan


def test_dedupe_source_table_preset(spark, scratch):
    from voltaic.sources.registry import DAM
    path = scratch("dam")
    s = ("Interval_Start TIMESTAMP_NTZ, Interval_End TIMESTAMP_NTZ, Location STRING, "
         "Location_Type STRING, Market STRING, LMP DOUBLE, _ingested_at TIMESTAMP_NTZ")
    t = dt.datetime(2024, 5, 1)
    rows = [(t, t, "HB_A", "SP", "DAM", 1.0, t), (t, t, "HB_A", "SP", "DAM", 2.0, t + dt.timedelta(1)),
            (t, t, "HB_B", "SP", "DAM", 3.0, t)]
    df = tables.with_date_parts(spark.createDataFrame(rows, s), parts=DAM.partitions)
    tables.write_partitioned(df, path, DAM.partitions, "overwrite")
    out = tables.dedupe_source_table(spark, path, DAM)
    assert out["removed"] == 1
    got = {r.Location: r.LMP for r in tables.read_table(spark, path).collect()}
    assert got == {"HB_A": 2.0, "HB_B": 3.0}


@pytest.mark.parametrize("parts", [(), ("year", "month")])
def test_upsert_empty_batch_and_unpartitioned_tables(spark, scratch, parts):
    s = "k LONG, ts TIMESTAMP_NTZ, v DOUBLE, _ingested_at TIMESTAMP_NTZ"
    path = scratch("plain")
    t0 = dt.datetime(2024, 3, 1)
    first = spark.createDataFrame([(1, dt.datetime(2024, 1, 5), 1.0, t0),
                                   (2, dt.datetime(2024, 2, 5), 2.0, t0)], s)
    tables.upsert_table(spark, path, first, ["k"], time_col="ts", parts=parts)
    # an empty batch leaves the table as it is (and never removes it)
    tables.upsert_table(spark, path, spark.createDataFrame([], s), ["k"], time_col="ts",
                        parts=parts)
    assert sorted((r.k, r.v) for r in tables.read_table(spark, path).collect()) == [(1, 1.0), (2, 2.0)]
    batch = spark.createDataFrame([(2, dt.datetime(2024, 1, 9), 20.0, t0 + dt.timedelta(days=1)),
                                   (3, dt.datetime(2024, 2, 9), 3.0, t0 + dt.timedelta(days=1))], s)
    tables.upsert_table(spark, path, batch, ["k"], time_col="ts", parts=parts)
    assert sorted((r.k, r.v) for r in tables.read_table(spark, path).collect()) == \
        [(1, 1.0), (2, 20.0), (3, 3.0)]


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_read_feed_text_formats(spark, scratch, fmt):
    rows = [(BASE + dt.timedelta(days=d), BASE, BASE, float(d), 1.0, 2.0, 3.0, 4.0) for d in range(60)]
    feed = tables.with_date_parts(spark.createDataFrame(rows, SOLAR.schema), parts=("year", "month"))
    path = scratch(f"feed-{fmt}")
    w = feed.write.partitionBy("year", "month").mode("overwrite")
    (w.option("header", "true").csv(path) if fmt == "csv" else w.json(path))
    got = landing.read_feed(spark, path, SOLAR, start="2024-02-03", end="2024-02-05", fmt=fmt)
    assert got.schema["Interval_Start"].dataType == SOLAR.schema["Interval_Start"].dataType
    assert sorted(r.GEN_SYSTEM_WIDE for r in got.collect()) == [4.0, 5.0, 6.0]


def test_read_feed_csv_is_read_by_header_name(spark, scratch):
    rows = [(BASE, BASE, BASE, 1.0, 2.0, 3.0, 4.0, 5.0)]
    feed = spark.createDataFrame(rows, SOLAR.schema)
    path = scratch("feed-swapped")
    cols = feed.columns
    feed.select(cols[0], cols[1], cols[2], cols[4], cols[3], *cols[5:]) \
        .write.option("header", "true").mode("overwrite").csv(path)
    got = landing.read_feed(spark, path, SOLAR, fmt="csv").first()
    assert (got.GEN_SYSTEM_WIDE, got.HSL_SYSTEM_WIDE, got.STPPF_SYSTEM_WIDE) == (1.0, 2.0, 3.0)


def test_upsert_reads_the_touched_partitions_with_their_own_schema(spark, scratch):
    # January's files carry a column added later (schema evolution by
    # append); merging a batch into January keeps it, February is untouched
    path = scratch("evolve")
    t0 = dt.datetime(2024, 3, 1)
    old = spark.createDataFrame([(1, dt.datetime(2024, 2, 5), 1.0, t0)],
                                "k LONG, ts TIMESTAMP_NTZ, v DOUBLE, _ingested_at TIMESTAMP_NTZ")
    tables.upsert_table(spark, path, old, ["k", "ts"], time_col="ts")
    wide = spark.createDataFrame([(2, dt.datetime(2024, 1, 5), 2.0, t0, "x")],
                                 "k LONG, ts TIMESTAMP_NTZ, v DOUBLE, _ingested_at TIMESTAMP_NTZ, "
                                 "extra STRING")
    tables.write_partitioned(tables.with_date_parts(wide, "ts", ("year", "month")), path,
                             ("year", "month"), "append")
    feb = _files(path, "year=2024/month=2")
    batch = spark.createDataFrame([(2, dt.datetime(2024, 1, 5), 20.0, t0 + dt.timedelta(days=1)),
                                   (3, dt.datetime(2024, 1, 6), 3.0, t0 + dt.timedelta(days=1))],
                                  "k LONG, ts TIMESTAMP_NTZ, v DOUBLE, _ingested_at TIMESTAMP_NTZ")
    out = tables.upsert_table(spark, path, batch, ["k", "ts"], time_col="ts")
    assert out["partitions"] == 1 and _files(path, "year=2024/month=2") == feb
    got = sorted((r.k, r.v, r.extra) for r in tables.read_table(spark, path, merge_schema=True).collect())
    assert got == [(1, 1.0, None), (2, 20.0, "x"), (3, 3.0, None)]


def test_dedupe_and_backup_keep_columns_added_by_appends(spark, scratch):
    path = scratch("dd-evolve")
    t0 = dt.datetime(2024, 3, 1)
    s1 = "Interval_Start TIMESTAMP_NTZ, v DOUBLE, _ingested_at TIMESTAMP_NTZ"
    first = spark.createDataFrame([(BASE, 1.0, t0), (BASE, 2.0, t0 + dt.timedelta(days=1))], s1)
    tables.write_partitioned(first, path, (), "append")
    wide = spark.createDataFrame([(BASE + dt.timedelta(hours=1), 3.0, t0, "x")],
                                 s1 + ", extra STRING")
    tables.write_partitioned(wide, path, (), "append")
    out = tables.dedupe_table(spark, path, ["Interval_Start"])
    assert out["removed"] == 1
    assert "extra" in tables.read_table(spark, out["backup"], merge_schema=True).columns
    got = sorted((r.v, r.extra) for r in tables.read_table(spark, path, merge_schema=True).collect())
    assert got == [(2.0, None), (3.0, "x")]


def test_read_feed_invents_no_column(spark, scratch):
    path = scratch("feed-narrow")
    rows = [(BASE + dt.timedelta(hours=h), BASE, BASE, float(h), 1.0, 2.0, 3.0, 4.0) for h in range(5)]
    feed = spark.createDataFrame(rows, SOLAR.schema).drop("PVGRPP_SYSTEM_WIDE")   # an older file
    tables.write_partitioned(tables.with_date_parts(feed, parts=("year", "month")), path,
                             ("year", "month"), "append")
    got = landing.read_feed(spark, path, SOLAR)
    assert set(got.columns) == set(feed.columns) | {"year", "month"}
    assert got.count() == 5


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_read_feed_wide_regional_keeps_region_columns(spark, scratch, fmt):
    from voltaic.sources.registry import SOLAR_REGIONAL
    path = scratch(f"feed-wide-{fmt}")
    rows = [(BASE + dt.timedelta(days=d), BASE + dt.timedelta(days=d + 1), float(d), 2.0 * d)
            for d in range(10)]
    wide = spark.createDataFrame(rows, "Interval_Start TIMESTAMP_NTZ, Interval_End TIMESTAMP_NTZ, "
                                       "GEN_WEST DOUBLE, STPPF_WEST DOUBLE")
    w = wide.write.mode("overwrite")
    (w.option("header", "true").csv(path) if fmt == "csv" else w.parquet(path))
    got = landing.read_feed(spark, path, SOLAR_REGIONAL, start="2024-02-02", end="2024-02-03",
                            fmt=fmt)
    assert {"GEN_WEST", "STPPF_WEST"} <= set(got.columns)
    assert sorted(r.GEN_WEST for r in got.collect()) == [3.0, 4.0]
