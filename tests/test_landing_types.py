"""Landings whose types change, and values that can't be cast."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from voltaic.plans import bronze
from voltaic.sources import landing, schemas, tables
from voltaic.sources.registry import DAM, FUEL_MIX, SOLAR, Source

T0 = dt.datetime(2024, 3, 1)
FEED = Source(name="feed", schema=T.StructType([T.StructField("Time", T.TimestampNTZType())]), keys=("Time",), time_col="Time", open_schema=True)


def _write(spark, path, rows, schema, mode="append"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode(mode).parquet(path)


def test_common_types():
    D, L, I, F = T.DoubleType(), T.LongType(), T.IntegerType(), T.FloatType()
    assert schemas.common_type(I, L) == L and schemas.common_type(L, D) == D and schemas.common_type(I, F) == D
    assert schemas.common_type(T.DecimalType(10, 2), T.DecimalType(8, 4)) == T.DecimalType(12, 4)
    assert schemas.common_type(T.DecimalType(4, 2), L) == T.DecimalType(22, 2)
    assert schemas.common_type(T.NullType(), T.StringType()) == T.StringType()
    assert schemas.common_type(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    assert schemas.common_type(T.ArrayType(I), T.ArrayType(L)) == T.ArrayType(L)
    for a, b in ((T.StringType(), D), (T.BooleanType(), I), (T.TimestampType(), T.TimestampNTZType()), (T.DecimalType(10, 2), D),
                 (T.DecimalType(38, 0), T.DecimalType(38, 10))):
        with pytest.raises(schemas.TypesDiffer):
            schemas.common_type(a, b)


def test_files_of_changing_types_are_read(spark, scratch):
    path = scratch("types")
    for k in range(6):  # whole numbers at first, fractions later, a column more at the end
        rows = [(T0 + dt.timedelta(hours=24 * k + h), (h if k < 3 else h + 0.25), k) for h in range(4)]
        kind = "bigint" if k < 3 else "double"
        _write(spark, path, rows if k < 5 else [(*r, "x") for r in rows], f"Time timestamp_ntz, mw {kind}, n {'int' if k % 2 else 'bigint'}" + (", note string" if k == 5 else ""))
    df = landing.read_feed(spark, path, FEED)
    assert dict(df.dtypes) == {"Time": "timestamp_ntz", "mw": "double", "n": "bigint", "note": "string"}
    got = {r.Time: (r.mw, r.n, r.note) for r in df.collect()}
    assert got == {T0 + dt.timedelta(hours=24 * k + h): (h if k < 3 else h + 0.25, k, "x" if k == 5 else None) for k in range(6) for h in range(4)}
    assert len(schemas.read_groups(spark, [path])) <= 4


def test_a_table_takes_a_changed_type(spark, scratch):
    path, table = scratch("landing"), scratch("table")
    _write(spark, path, [(T0 + dt.timedelta(days=d), d) for d in range(70)], "Time timestamp_ntz, mw bigint")
    bronze.land(spark, path, table, FEED)
    later = scratch("later")
    _write(spark, later, [(T0 + dt.timedelta(days=d), d + 0.5) for d in range(60, 75)], "Time timestamp_ntz, mw double")
    bronze.land(spark, later, table, FEED)
    got = {r.Time: r.mw for r in tables.read_table(spark, table).collect()}
    assert got == {T0 + dt.timedelta(days=d): (d if d < 60 else d + 0.5) for d in range(75)}
    # an append by hand too
    tables.write_partitioned(tables.with_date_parts(spark.createDataFrame([(T0, 7)], "Time timestamp_ntz, mw int"), "Time", ("year", "month")), table,
                             ("year", "month"), "append")
    assert tables.read_table(spark, table).schema["mw"].dataType == T.DoubleType()
    text = spark.createDataFrame([(T0, "much")], "Time timestamp_ntz, mw string")
    with pytest.raises(schemas.TypesDiffer, match="mw"):
        tables.load_bronze(spark, table, text, FEED)
    assert tables.read_table(spark, table).count() == 76


def test_what_a_double_can_not_hold_is_refused(spark, scratch):
    path = scratch("large")
    _write(spark, path, [(T0, 2**53 + 1)], "Time timestamp_ntz, mw bigint")
    _write(spark, path, [(T0 + dt.timedelta(days=1), 0.5)], "Time timestamp_ntz, mw double")
    with pytest.raises(Exception, match="9007199254740993"):
        landing.read_feed(spark, path, FEED).collect()
    exact = scratch("exact")
    _write(spark, exact, [(T0, 2**60), (T0 + dt.timedelta(hours=1), None), (T0 + dt.timedelta(hours=2), -(2**63))], "Time timestamp_ntz, mw bigint")
    _write(spark, exact, [(T0 + dt.timedelta(days=1), 0.5)], "Time timestamp_ntz, mw double")
    assert {r.mw for r in landing.read_feed(spark, exact, FEED).collect()} == {float(2**60), None, -float(2**63), 0.5}


CSV = """Interval_Start,Interval_End,Location,Location_Type,Market,LMP
2024-03-01 00:00:00,2024-03-01 01:00:00,HB_A,SP,DAM,{a}
2024-03-01 01:00:00,2024-03-01 02:00:00,HB_A,SP,DAM,{b}
2024-03-02 00:00:00,2024-03-02 01:00:00,HB_A,SP,DAM,{c}
{rest}"""


def _csv(tmp_path, name, rest="", **values):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(CSV.format(rest=rest, **{**dict(a="1.5", b="2", c="-3.25"), **values}))
    return str(folder)


def test_rejects(spark, scratch, tmp_path):
    path = _csv(tmp_path, "one.csv", b="N/A", rest="not a time,2024-03-02 01:00:00,HB_B,SP,DAM,4\n2024-03-02 02:00:00,2024-03-02 03:00:00,HB_B\n"
                "2024-03-02 05:00:00,2024-03-02 06:00:00,HB_B,SP,DAM,\n")
    table, bad = scratch("table"), scratch("rejects")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast|malformed"):
        bronze.land(spark, path, table, DAM, fmt="csv")
    with pytest.raises(bronze.TooManyRejects):
        bronze.land(spark, path, table, DAM, fmt="csv", rejects_path=bad)
    assert not tables.table_exists(spark, table)
    out = bronze.land(spark, path, table, DAM, fmt="csv", rejects_path=bad, most_rejected=0.6, counts=True)
    assert (out["rejected"], out["rows_in"], out["inserted"]) == (3, 3, 3)
    rows = {(r.Interval_Start, r.LMP) for r in tables.read_table(spark, table).collect()}
    # an empty field is null, as it was; what stood there and isn't a number is nowhere silently null
    assert rows == {(T0, 1.5), (T0 + dt.timedelta(days=1), -3.25), (T0 + dt.timedelta(hours=29), None)}
    kept = bronze.rejects(spark, bad).collect()  # the failed load and this one hold the same rows
    assert sorted((r.column, r.raw.split(",")[0]) for r in kept) == [
        ("Interval_Start", "not a time"), ("LMP", "N/A"), ("_corrupt_record", "2024-03-02 02:00:00")]
    assert all(r.file.endswith("one.csv") and r.source == DAM.name for r in kept)


def test_rejects_of_a_range_and_of_good_files(spark, scratch, tmp_path):
    path = _csv(tmp_path, "two.csv", rest="never,2024-03-02 01:00:00,HB_B,SP,DAM,4\n")
    bad = scratch("rejects")
    df = landing.read_feed(spark, path, DAM, "2024-03-02", "2024-03-02", "csv", checked=True)
    assert sorted(str(r.Interval_Start) for r in df.collect()) == ["2024-03-02 00:00:00", "None"]
    out = bronze.land(spark, path, scratch("t"), DAM, "2024-03-01", "2024-03-01", fmt="csv", rejects_path=bad, most_rejected=0.5)
    assert out["rejected"] == 1
    good = scratch("good")
    _write(spark, good, [(T0, T0, T0, 1.0, 2.0, 3.0, 4.0, 5.0)], SOLAR.schema)
    assert bronze.land(spark, good, scratch("t2"), SOLAR, rejects_path=scratch("none"))["rejected"] == 0


def test_measures_that_come_as_text_in_some_files(spark, scratch):
    """A declared measure that is text in one load and a number in the next is what the feed declares."""
    path, table, bad = scratch("mixed"), scratch("table"), scratch("rejects")
    cols = ["Interval_Start timestamp_ntz", "Interval_End timestamp_ntz", "Location string", "Location_Type string", "Market string"]
    _write(spark, path, [(T0, T0, "A", "SP", "DAM", "1.25"), (T0, T0, "B", "SP", "DAM", "--")], ", ".join([*cols, "LMP string"]))
    _write(spark, path, [(T0, T0, "C", "SP", "DAM", 3)], ", ".join([*cols, "LMP bigint"]))
    out = bronze.land(spark, path, table, DAM, rejects_path=bad, most_rejected=0.4)
    assert out["rejected"] == 1
    assert {r.Location: r.LMP for r in tables.read_table(spark, table).collect()} == {"A": 1.25, "C": 3.0}
    assert FUEL_MIX.all_measures
