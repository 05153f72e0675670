"""The source pipeline's own four checks, on this engine's operators
(table existence, load dates, partitioned write + append, quality checks)."""

import datetime as dt

from pyspark.sql import functions as F

from voltaic.operators.quality import quality_report, quality_report_path
from voltaic.sources import tables
from voltaic.sources.landing import high_water_mark, load_range

TS = "Interval_Start TIMESTAMP_NTZ, value DOUBLE"


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_table_exists(spark, scratch):
    path = scratch("exists")
    assert not tables.table_exists(spark, path)
    spark.createDataFrame([], "id INT, value STRING").write.parquet(path)
    assert tables.table_exists(spark, path)


def test_determine_load_dates(spark):
    assert load_range(None, today=dt.date(2024, 12, 5))[0] == "2024-01-01"
    df = spark.createDataFrame(
        [(_ts("2024-12-01 00:00:00"), 100.0), (_ts("2024-12-02 00:00:00"), 200.0),
         (_ts("2024-12-03 00:00:00"), 300.0)], TS)
    hwm = high_water_mark(df, "Interval_Start")
    assert hwm == dt.date(2024, 12, 3)
    assert load_range(hwm, lookback_days=7)[0] == "2024-11-26"
    assert load_range(hwm, lookback_days=3)[0] == "2024-11-30"
    assert load_range(hwm, load_type="date_range", start="2024-02-01", end="2024-02-03") == (
        "2024-02-01", "2024-02-03")


def test_write_partitioned_and_append(spark, scratch):
    schema = ("Interval_Start TIMESTAMP_NTZ, value DOUBLE, _ingested_at TIMESTAMP_NTZ, "
              "_source STRING, _endpoint STRING")
    now = _ts("2024-04-01 00:00:00")
    first = spark.createDataFrame(
        [(_ts("2024-01-15 10:00:00"), 100.0, now, "api", "solar"),
         (_ts("2024-02-20 14:00:00"), 200.0, now, "api", "solar"),
         (_ts("2024-03-25 18:00:00"), 300.0, now, "api", "solar")], schema)
    path = scratch("bronze")
    parts = ("year", "month", "day")
    tables.write_partitioned(tables.with_date_parts(first), path, parts, "append")
    back = tables.read_table(spark, path)
    got = sorted((r.year, r.month, r.day) for r in back.select(*parts).collect())
    assert got == [(2024, 1, 15), (2024, 2, 20), (2024, 3, 25)]
    assert back.count() == 3
    assert {"_ingested_at", "_source", "_endpoint"} <= set(back.columns)
    more = spark.createDataFrame([(_ts("2024-01-15 11:00:00"), 150.0, now, "api", "solar")], schema)
    tables.write_partitioned(tables.with_date_parts(more), path, parts, "append")
    assert tables.read_table(spark, path).count() == 4


QC = "Interval_Start TIMESTAMP_NTZ, value DOUBLE, _ingested_at TIMESTAMP_NTZ"


def test_quality_checks(spark, scratch):
    missing = quality_report_path(spark, scratch("nothing"), "nothing").first()
    assert missing.status == "table_not_found"
    t = _ts("2024-01-04 00:00:00")
    dirty = spark.createDataFrame([
        (_ts("2024-01-01 00:00:00"), 100.0, t),
        (_ts("2024-01-01 01:00:00"), 200.0, t),
        (_ts("2024-01-01 01:00:00"), 250.0, t),   # duplicate interval
        (_ts("2024-01-03 00:00:00"), 300.0, t),
        (None, 400.0, t),                         # NULL interval
        (_ts("2024-01-02 00:00:00"), 500.0, None),  # NULL ingest time
    ], QC)
    r = quality_report(dirty, "dirty").first()
    assert (r.row_count, r.null_time_column, r.null_ingested_at, r.duplicate_intervals) == (6, 1, 1, 1)
    assert (r.min_date, r.max_date) == (dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    assert r.time_column == "Interval_Start" and r.status == "ok"
    clean = spark.createDataFrame(
        [(_ts(f"2024-01-01 0{h}:00:00"), float(h), t) for h in range(3)], QC)
    c = quality_report(clean, "clean").first()
    assert (c.row_count, c.null_time_column, c.null_ingested_at, c.duplicate_intervals) == (3, 0, 0, 0)
    e = quality_report(spark.createDataFrame([], QC), "empty").first()
    assert e.row_count == 0 and e.status == "empty"
    no_time = quality_report(spark.range(3).withColumn("x", F.lit(1)), "no_time").first()
    assert no_time.status == "no_time_column" and no_time.row_count == 3
