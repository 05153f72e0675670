"""The incremental landing stream merges each new landed batch by key."""

import datetime as dt

from pyspark.sql import functions as F

from voltaic.sources.registry import SOLAR
from voltaic.sources.tables import read_table
from voltaic.streaming.incremental import landed_schema, start_incremental_upsert

BASE = dt.datetime(2024, 1, 1)


def _batch(spark, hours, gen, ingested):
    rows = [(BASE + dt.timedelta(hours=h), BASE + dt.timedelta(hours=h + 1), BASE,
             gen + h, 1.0, 2.0, 3.0, 4.0, ingested, "api", "solar") for h in hours]
    return spark.createDataFrame(rows, landed_schema(SOLAR))


def test_stream_upserts_landed_batches(spark, scratch):
    landing, table, ckpt = scratch("landing"), scratch("bronze"), scratch("ckpt")
    _batch(spark, range(0, 48), 100.0, BASE).write.mode("append").parquet(landing)
    q = start_incremental_upsert(spark, landing, table, SOLAR, checkpoint=ckpt)
    q.awaitTermination(120)
    assert read_table(spark, table).count() == 48
    # a re-read of the last day (corrected) plus one new day
    _batch(spark, range(24, 72), 1000.0, BASE + dt.timedelta(days=3)).write.mode("append").parquet(landing)
    q = start_incremental_upsert(spark, landing, table, SOLAR, checkpoint=ckpt)
    q.awaitTermination(120)
    out = read_table(spark, table)
    assert out.count() == 72
    got = {r.Interval_Start: r.GEN_SYSTEM_WIDE for r in out.collect()}
    assert got[BASE + dt.timedelta(hours=1)] == 101.0
    assert got[BASE + dt.timedelta(hours=30)] == 1030.0
    assert out.groupBy("Interval_Start").count().filter(F.col("count") > 1).count() == 0


def test_restarted_stream_resumes_from_its_checkpoint(spark, scratch):
    # no checkpoint given: the default is stable per target table, so the
    # second start reads only the newly landed file
    landing, table = scratch("landing2"), scratch("bronze2")
    _batch(spark, range(0, 24), 1.0, BASE).write.mode("append").parquet(landing)
    q = start_incremental_upsert(spark, landing, table, SOLAR)
    q.awaitTermination(120)
    _batch(spark, range(24, 30), 1.0, BASE).write.mode("append").parquet(landing)
    q = start_incremental_upsert(spark, landing, table, SOLAR)
    q.awaitTermination(120)
    # the batch ids go on from the first run (a fresh checkpoint starts at 0)
    assert [p["batchId"] for p in q.recentProgress if p["numInputRows"]] == [1]
    assert read_table(spark, table).count() == 30


def test_a_column_that_lands_while_the_stream_runs_is_complete(spark, scratch):
    landing, table = scratch("landing three"), scratch("bronze3")
    _batch(spark, range(0, 24), 1.0, BASE).write.mode("append").parquet(landing)
    q = start_incremental_upsert(spark, landing, table, SOLAR, checkpoint=scratch("ckpt3"), available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        assert read_table(spark, table).count() == 24
        more = _batch(spark, range(20, 30), 5.0, BASE + dt.timedelta(days=1))
        # a new column, and a measure that is a whole number in this load
        more.withColumn("Note", F.hour("Interval_Start").cast("string")).withColumn(
            "HSL_SYSTEM_WIDE", F.col("HSL_SYSTEM_WIDE").cast("long")).write.mode("append").parquet(landing)
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.Interval_Start: r for r in read_table(spark, table).collect()}
    assert len(got) == 30
    for h in range(30):
        r = got[BASE + dt.timedelta(hours=h)]
        assert r.Note == (str(r.Interval_Start.hour) if h >= 20 else None) and r.GEN_SYSTEM_WIDE == (5.0 if h >= 20 else 1.0) + h


def test_late_and_repeated_rows_give_the_table_of_a_batch_load(spark, scratch):
    """Rows that come weeks late, twice and out of order, over a restart: nothing is dropped, no key is there twice."""
    from voltaic.plans import bronze

    landing, table, ckpt = scratch("landing4"), scratch("bronze4"), scratch("ckpt4")
    loads = [(range(600, 640), 9.0, 20), (range(0, 30), 1.0, 21), (range(610, 620), 9.0, 20), (range(10, 20), 3.0, 2), (range(1200, 1210), 4.0, 60)]
    for k, (hours, gen, day) in enumerate(loads):
        _batch(spark, hours, gen, BASE + dt.timedelta(days=day)).coalesce(1).write.mode("append").parquet(landing)
        if k in (1, 4):  # started twice, two files a micro-batch
            start_incremental_upsert(spark, landing, table, SOLAR, checkpoint=ckpt, max_files_per_trigger=2).awaitTermination(120)
    plain = scratch("plain4")
    bronze.land(spark, landing, plain, SOLAR)
    rows = lambda p: sorted(map(tuple, read_table(spark, p).select("Interval_Start", "GEN_SYSTEM_WIDE", "_ingested_at").collect()))
    assert len(rows(table)) == 80 and {r[0] for r in rows(table)} == {r[0] for r in rows(plain)}
    newest = {}
    for hours, gen, day in loads:  # files are merged in the order they land, as loads are
        newest |= {BASE + dt.timedelta(hours=h): gen + h for h in hours}
    assert {t: g for t, g, _ in rows(table)} == newest
