"""An incremental refresh equals a full build, and touches only what a change reaches."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from voltaic.plans import layers
from voltaic.plans.refresh import FEATURE_REACH, _in, reach, refresh
from voltaic.sources import redo, tables
from voltaic.sources.registry import DAM, SOLAR, WIND

BASE = dt.datetime(2023, 11, 1)
HUBS = ["HB_HOUSTON", "HB_WEST", "HB_NORTH", "HB_SOUTH", "LZ_HOUSTON", "RN_1"]


def _resource(spark, source, rows):
    fc, pot = ("STPPF", "PVGRPP") if source is SOLAR else ("STWPF", "WGRPP")
    cols = ["Interval_Start", "Interval_End", "Publish_Time", "GEN_SYSTEM_WIDE", "HSL_SYSTEM_WIDE", f"{fc}_SYSTEM_WIDE",
            f"{pot}_SYSTEM_WIDE", "COP_HSL_SYSTEM_WIDE", "_ingested_at"]
    types = ["timestamp_ntz"] * 3 + ["double"] * 5 + ["timestamp_ntz"]
    full = [(t, t + dt.timedelta(hours=1), t - dt.timedelta(days=1), v, None if v is None else v * 1.1, f, f, f, at) for t, v, f, at in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} {k}" for c, k in zip(cols, types)))


def _prices(spark, rows):
    return spark.createDataFrame([(t, t + dt.timedelta(hours=1), p, "SP", "DAM", v, at) for t, p, v, at in rows],
                                 "Interval_Start timestamp_ntz, Interval_End timestamp_ntz, Location string, Location_Type string, "
                                 "Market string, LMP double, _ingested_at timestamp_ntz")


def _hours(rng, first, last, share):
    return [BASE + dt.timedelta(hours=h) for h in range(first * 24, last * 24) if rng.random() < share]


def _land(spark, paths, rng, first, last, share, n):
    """A load of some hours of all three feeds; later loads win."""
    at = dt.datetime(2025, 1, 1) + dt.timedelta(days=n)
    value = lambda: None if rng.random() < 0.05 else round(rng.uniform(0, 900), 2)
    out = {}
    for source in (SOLAR, WIND):
        rows = [(t, value(), round(rng.uniform(0, 900), 2), at) for t in _hours(rng, first, last, share)]
        out[source.name] = tables.load_bronze(spark, paths[source.name], _resource(spark, source, rows), source, counts=True)
    points = HUBS if n else HUBS[:-3]  # later loads bring new hubs, and so a new spread
    rows = [(t, p, round(rng.uniform(-20, 150), 2), at) for t in _hours(rng, first, last, share) for p in points if rng.random() < 0.5]
    out[DAM.name] = tables.load_bronze(spark, paths[DAM.name], _prices(spark, rows), DAM, counts=True)
    return out


def _same(one, other) -> bool:
    """The same columns and rows, doubles up to the order of additions."""
    def rows(df):
        cols = sorted(c for c in df.columns if c not in ("_transformed_at", "_ingested_at"))
        out = [tuple(r) for r in df.select(*cols).collect()]
        return cols, sorted(out, key=lambda r: [str(v) for v in r if not isinstance(v, float)] + [str(round(v, 1)) for v in r if isinstance(v, float)])
    (cols, a), (others, b) = rows(one), rows(other)
    close = lambda x, y: x == y or isinstance(x, float) and isinstance(y, float) and abs(x - y) < 1e-6 * max(1, abs(x))
    return cols == others and len(a) == len(b) and all(close(x, y) for r, s in zip(a, b) for x, y in zip(r, s))


@pytest.mark.parametrize("seed", [1, 2])
def test_refresh_equals_a_full_build(spark, scratch, seed):
    rng = random.Random(seed)
    paths = {s.name: scratch(f"bronze-{s.name}") for s in (SOLAR, WIND, DAM)}
    s_root, g_root = scratch("silver"), scratch("gold")
    # seven months, some of them with few hours
    _land(spark, paths, rng, 0, 100, 0.10, 0)
    _land(spark, paths, rng, 120, 210, 0.02 if seed == 1 else 0.2, 1)
    refresh(spark, paths, s_root, g_root)
    first = {n: set(glob.glob(f"{g_root}/{n}/year=*/month=*/*.parquet")) for n in layers.GOLD_TABLES}
    days = rng.randrange(30, 60)
    _land(spark, paths, rng, days, days + 3, 0.5, 2)
    written = refresh(spark, paths, s_root, g_root)
    assert refresh(spark, paths, s_root, g_root) == {}  # nothing changed since
    assert 1 <= len(written["solar_hourly"]) <= 2
    assert len(written["lmp_daily_statistics"]) == len(written["lmp_day_ahead_market"]) <= 2
    kept = first["lmp_daily_statistics"] & set(glob.glob(f"{g_root}/lmp_daily_statistics/year=*/month=*/*.parquet"))
    assert len(kept) >= 4  # partitions that nothing reached keep their files
    bronze = {n: tables.read_table(spark, p) for n, p in paths.items()}
    full_s, full_g = scratch("full-silver"), scratch("full-gold")
    silver = layers.build_silver(spark, bronze, full_s)
    gold = layers.build_gold(spark, full_s, full_g)
    for name, path in (silver | gold).items():
        own = os.path.join(s_root if name in silver else g_root, name)
        assert _same(tables.read_table(spark, own), tables.read_table(spark, path)), name


def test_reach_is_exact(spark):
    """Partitions reached and read are those a plain search over rows gives."""
    rng = random.Random(7)
    for rows in (1, 5, 20):
        counts = {(2024, m, e): rng.choice([0, 1, 3, 8]) for m in range(1, 13) for e in "ab"}
        changed = {(2024, rng.randrange(1, 13)) for _ in range(2)}
        df = spark.createDataFrame([(y, m, e, n) for (y, m, e), n in counts.items() if n or (y, m) in changed], "year int, month int, e string, n long")
        out, read = reach(df, ["e"], changed, rows)
        want_out, want_read = set(changed), set()
        for e in "ab":
            for m in range(1, 13):
                for c in (c for _, c in changed if c < m and counts[2024, m, e]):
                    if sum(counts[2024, k, e] for k in range(c + 1, m)) < rows:
                        want_out.add((2024, m))
        for e in "ab":
            for m in (m for _, m in want_out if counts[2024, m, e]):
                want_read |= {(2024, k) for k in range(1, m) if counts[2024, k, e] and sum(counts[2024, j, e] for j in range(k + 1, m)) < rows}
        assert out == want_out and read == want_read | want_out


def test_a_failed_refresh_is_made_up_for(spark, scratch, monkeypatch):
    """Notes of changes stay until all tables are written."""
    rng = random.Random(3)
    paths = {SOLAR.name: scratch("bronze-solar")}
    s_root, g_root = scratch("silver"), scratch("gold")
    load = lambda n, first, last: tables.load_bronze(spark, paths[SOLAR.name], _resource(spark, SOLAR, [
        (t, 100.0 + n, 90.0, dt.datetime(2025, 1, 1 + n)) for t in _hours(rng, first, last, 0.3)]), SOLAR)
    load(0, 0, 90)
    refresh(spark, paths, s_root, g_root)
    load(1, 40, 42)
    with monkeypatch.context() as m:
        m.setattr("voltaic.plans.refresh.Refresh._features", lambda self, scope: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh(spark, paths, s_root, g_root)
    load(2, 70, 71)
    assert redo.pending(spark, paths[SOLAR.name])[0] == {(2023, 12), (2024, 1)}
    refresh(spark, paths, s_root, g_root)
    assert redo.pending(spark, paths[SOLAR.name])[0] == set()
    silver = layers.build_silver(spark, {SOLAR.name: tables.read_table(spark, paths[SOLAR.name])}, scratch("full-silver"))
    gold = layers.build_gold(spark, os.path.dirname(silver["solar_hourly"]), scratch("full-gold"))
    for name, path in gold.items():
        assert _same(tables.read_table(spark, f"{g_root}/{name}"), tables.read_table(spark, path)), name


def test_null_partition(spark):
    df = spark.createDataFrame([(2024, 1), (None, None), (2024, 2)], "year int, month int")
    assert df.where(_in({(2024, 2), (None, None)})).count() == 2 and df.where(_in(set())).count() == 0
    assert FEATURE_REACH == 168
    assert df.where(F.lit(True)).count() == 3
