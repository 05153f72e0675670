"""Every operator of the inventory as a query over the driver's tables.

``QUERIES[id](spark, sf_dir) -> DataFrame``.  The frames are built from the
whole tables (``sources.derived``); nothing is sampled or capped except where
a limit is the feature (previews, top-k reports).  Columns that are not
reproducible (transform / ingest timestamps) are left out of the results.
"""

from __future__ import annotations

import datetime as dt
import functools
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.operators import merge, metrics, ordering, quality, reshape, series
from voltaic.plans import bronze, gold, refresh, reports, silver
from voltaic.session import scratch_path
from voltaic.sources import derived, landing, tables
from voltaic.sources.registry import DAM, FUEL_MIX, SOLAR, WIND, WIND_REGIONAL, Source

NONDETERMINISTIC = ("_transformed_at", "_ingested_at")


def _clean(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in NONDETERMINISTIC if c in df.columns])


class Frames:
    """Lazily built frames for one (session, data dir)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return derived.table(self.spark, self.sf, name)

    # landing feeds
    @cached_property
    def hourly(self):
        """The hourly aggregate that both resource feeds and their scaffold are built from, stored once:
        events are scanned once a query."""
        path = scratch_path(self.spark, "hourly-events")
        derived.hourly_event_stats(self.table("events")).write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def solar_bronze(self):
        return derived.resource_feed(self.hourly, "solar")

    @cached_property
    def wind_bronze(self):
        return derived.resource_feed(self.hourly, "wind")

    @cached_property
    def dam_bronze(self):
        return derived.dam_feed(self.spark, self.sf)

    @cached_property
    def regional_bronze(self):
        return derived.regional_feed(self.spark, self.sf)

    @cached_property
    def wind_regional_bronze(self):
        return derived.regional_feed(self.spark, self.sf, resource="wind")

    # silver
    @cached_property
    def solar(self):
        return _clean(silver.transform_solar_hourly(self.solar_bronze))

    @cached_property
    def wind(self):
        return _clean(silver.transform_wind_hourly(self.wind_bronze))

    @cached_property
    def by_tag(self):
        return {"solar": self.solar, "wind": self.wind}

    @cached_property
    def combined(self):
        return silver.combined_resources(self.by_tag)

    @cached_property
    def totals(self):
        return silver.renewable_totals(self.by_tag)

    @cached_property
    def regional(self):
        return _clean(silver.transform_regional(self.regional_bronze))

    @cached_property
    def wind_regional(self):
        return _clean(silver.transform_regional(self.wind_regional_bronze, WIND_REGIONAL))

    @cached_property
    def lmp(self):
        return _clean(silver.transform_lmp_dam(self.dam_bronze))

    # gold
    @cached_property
    def solar_acc(self):
        return gold.solar_forecast_accuracy(self.solar)

    @cached_property
    def wind_acc(self):
        return gold.wind_forecast_accuracy(self.wind)

    @cached_property
    def patterns(self):
        return gold.generation_patterns(self.totals)

    @cached_property
    def curtail(self):
        return gold.curtailment_analysis(self.solar, self.wind)

    @cached_property
    def solar_rolled(self):
        base = self.solar.filter(F.col("actual_mw").isNotNull())
        return series.lag_roll(base, ["interval_start"], "actual_mw",
                               lags=gold.FEATURE_LAGS, frames=gold.FEATURE_FRAMES)

    @cached_property
    def features(self):
        return gold.solar_features(self.solar)

    @cached_property
    def price_stats(self):
        return gold.lmp_price_statistics(self.lmp)

    @cached_property
    def hub_comparison(self):
        return gold.lmp_hub_comparison(self.lmp)

    @cached_property
    def volatility(self):
        return gold.lmp_volatility(self.price_stats[0])

    @cached_property
    def correlation(self):
        return gold.lmp_renewable_correlation(self.lmp, self.totals)

    # bronze-side
    @cached_property
    def upsert_pair(self):
        """target = events up to three days before the last day (an earlier
        load); batch = a re-read from seven days before that (values
        corrected by +1), with the click events delivered twice (the later
        copy, +2, must win)."""
        ev = self.table("events")
        hwm = landing.high_water_mark(ev, "ts")
        cut = F.lit((hwm - dt.timedelta(days=2)).isoformat()).cast("timestamp_ntz")
        start = F.lit((hwm - dt.timedelta(days=10)).isoformat()).cast("timestamp_ntz")
        target = ev.filter(F.col("ts") < cut).withColumn("_ingested_at", F.col("ts"))
        fresh = ev.filter(F.col("ts") >= start)
        batch = fresh.withColumns({"value": F.col("value") + 1.0,
                                   "_ingested_at": F.col("ts") + F.expr("INTERVAL 1 DAY")})
        again = (fresh.filter(F.col("event_type") == "click")
                 .withColumns({"value": F.col("value") + 2.0,
                               "_ingested_at": F.col("ts") + F.expr("INTERVAL 2 DAYS")}))
        return target, batch.unionByName(again)

    @cached_property
    def dam_landed_twice(self):
        """The price feed landed, then the hub rows landed again a day later
        with corrected prices (+0.5)."""
        first = self.dam_bronze.withColumn("_ingested_at", F.col("Interval_Start"))
        second = (self.dam_bronze.filter(F.col("Location").startswith("HB_"))
                  .withColumns({"LMP": F.col("LMP") + 0.5,
                                "_ingested_at": F.col("Interval_Start") + F.expr("INTERVAL 1 DAY")}))
        return first.unionByName(second)

    def with_ingest(self, df: DataFrame, time_col: str = "Interval_Start") -> DataFrame:
        return df.withColumn("_ingested_at", F.col(time_col) + F.expr("INTERVAL 1 DAY"))

    def reports(self, duplicates: bool = True):
        spark = self.spark
        rep = functools.partial(quality.quality_report, duplicates=duplicates)
        reps = [
            rep(self.table("events"), "events", "ts"),
            rep(self.table("lineitem"), "lineitem", "l_shipdate"),
            rep(self.with_ingest(self.solar_bronze), SOLAR.name),
            rep(self.with_ingest(self.dam_landed_twice.drop("_ingested_at")), DAM.name),
            rep(self.table("customer"), "customer"),
            quality.quality_report_path(spark, scratch_path(spark, "absent"), "fuel_mix"),
        ]
        return quality.quality_summary(reps)

    @cached_property
    def quality(self):
        return self.reports()

    @cached_property
    def quality_counts(self):
        return self.reports(duplicates=False)


# ------------------------------------------------------------ writers (I/O)

def _landed(f: Frames, df: DataFrame, name: str, parts=("year", "month")) -> str:
    path = scratch_path(f.spark, name)
    tables.write_partitioned(tables.with_date_parts(df, parts=parts), path, parts, "overwrite")
    return path


def _last_days(f: Frames, first: int, last: int) -> tuple[str, str]:
    """The days from ``first`` to ``last`` days before the last event."""
    hwm = landing.high_water_mark(f.hourly, "Interval_Start")
    return (hwm - dt.timedelta(days=first)).isoformat(), (hwm - dt.timedelta(days=last)).isoformat()


def q_src1(f: Frames) -> DataFrame:
    """Solar files with raw column names and a column beyond the declared ones, a range of days."""
    path, ym = scratch_path(f.spark, "landing-solar"), ("year", "month")
    df = tables.with_date_parts(f.solar_bronze, parts=ym).withColumn("Operator_Note", F.hour("Interval_Start").cast("string"))
    raw = df.withColumnsRenamed({c: c.replace("_", " ") for c in ("Interval_Start", "Interval_End", "Publish_Time", "Operator_Note")})
    tables.write_partitioned(raw, path, ym, "overwrite")
    start, end = _last_days(f, 9, 2)
    return landing.read_feed(f.spark, path, SOLAR, start, end).select(*SOLAR.schema.fieldNames(), "Operator_Note")


def q_src3(f: Frames) -> DataFrame:
    """Unstamped price files through the bronze step: its rows carry the lineage."""
    path, table = scratch_path(f.spark, "landing-dam"), scratch_path(f.spark, "bronze-dam")
    tables.write_partitioned(f.dam_bronze, path, (), "overwrite")
    bronze.land(f.spark, path, table, DAM, endpoint="dam_lmp")
    return tables.read_table(f.spark, table).withColumn(
        "has_ingested_at", F.col("_ingested_at").isNotNull()).drop("_ingested_at", "year", "month")


def q_src4(f: Frames) -> DataFrame:
    path = scratch_path(f.spark, "silver-solar")
    tables.write_partitioned(f.solar, path, ("year", "month"), "overwrite")
    return tables.read_table(f.spark, path)


def q_snk2(f: Frames) -> DataFrame:
    path = scratch_path(f.spark, "append")
    ym = ("year", "month")
    tables.write_partitioned(tables.with_date_parts(f.solar_bronze, parts=ym), path, ym, "append")
    tables.write_partitioned(tables.with_date_parts(f.wind_bronze, parts=ym), path, ym, "append")
    return tables.read_table(f.spark, path, merge_schema=True)


def q_snk3(f: Frames) -> DataFrame:
    path = scratch_path(f.spark, "overwrite-parted")
    ym = ("year", "month")
    tables.write_partitioned(tables.with_date_parts(f.wind_bronze, parts=ym), path, ym, "overwrite")
    tables.write_partitioned(tables.with_date_parts(f.solar_bronze, parts=ym), path, ym, "overwrite")
    return tables.read_table(f.spark, path)


def q_snk4(f: Frames) -> DataFrame:
    path = scratch_path(f.spark, "overwrite-flat")
    tables.write_partitioned(f.solar_bronze, path, (), "overwrite")
    tables.write_partitioned(f.wind_bronze, path, (), "overwrite")
    return tables.read_table(f.spark, path)


EVENTS = Source(name="events", schema=T.StructType([]), keys=("event_id",), time_col="ts")


def q_snk5(f: Frames) -> DataFrame:
    """Two landings of events through the bronze step."""
    path = scratch_path(f.spark, "upsert")
    for name, df in zip(("first", "again"), f.upsert_pair):
        landed = scratch_path(f.spark, f"landing-events-{name}")
        tables.write_partitioned(df, landed, (), "overwrite")
        bronze.land(f.spark, landed, path, EVENTS)
    return tables.read_table(f.spark, path).drop("year", "month")


def q_snk6(f: Frames) -> DataFrame:
    """The stored table deduplicated in place: counts, backup, rewrite."""
    path = scratch_path(f.spark, "dedupe")
    tables.write_partitioned(f.table("lineitem"), path, (), "overwrite")
    tables.dedupe_table(f.spark, path, LINEITEM_KEYS, order_by=("l_shipdate",))
    return tables.read_table(f.spark, path)


def q_inc1(f: Frames) -> DataFrame:
    """The last loaded day of a partitioned table, from its latest partition."""
    path = scratch_path(f.spark, "orders")
    parts = ("year", "month")
    tables.write_partitioned(tables.with_date_parts(f.table("orders"), "o_orderdate", parts), path, parts, "overwrite")
    return landing.high_water_mark_path(f.spark, path, "o_orderdate", parts)


def q_snk8(f: Frames) -> DataFrame:
    path = _landed(f, f.solar_bronze, "to-backup")
    dst = tables.backup(f.spark, path, parts=("year", "month"))
    return tables.read_table(f.spark, dst)


def _q(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Frames(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]


def _dedupe_lineitem(f: Frames) -> DataFrame:
    return merge.dedupe_latest(f.table("lineitem"), LINEITEM_KEYS, ["l_shipdate"])


def _inc2(f: Frames) -> DataFrame:
    orders = f.table("orders")
    hwm = landing.high_water_mark(orders, "o_orderdate")
    start, end = landing.load_range(hwm, end=hwm)
    return landing.range_filter(orders, "o_orderdate", start, end)


def _rpt6(f: Frames) -> DataFrame:
    # the last day of the report is the last one priced: a small aggregate of the price table
    as_of = f.lmp.filter(F.col("point_type") == "Hub").agg(F.max("delivery_date")).first()[0]
    return reports.recent_volatility(f.volatility, as_of=as_of)


def _skill(f: Frames) -> DataFrame:
    """Against persistence: the actual 24 rows earlier."""
    return metrics.skill_score(f.solar_rolled, actual="actual_mw", forecast="stppf_forecast_mw",
                               floor=gold.SOLAR_FLOOR, persistence="actual_lag_24h")


ZONE = "America/Chicago"


def _zoned(f: Frames) -> DataFrame:
    return silver.transform_solar_hourly(f.solar_bronze, zone=ZONE).select(
        F.col("interval_start_utc").alias(_S), "hour_of_day", "day_of_week", "is_weekend")


def _zoned_accuracy(f: Frames) -> DataFrame:
    """Days and months of the zone."""
    return gold.solar_forecast_accuracy(silver.transform_solar_hourly(f.solar_bronze, zone=ZONE))[0]


def _zoned_totals(f: Frames) -> DataFrame:
    by_tag = {"solar": silver.transform_solar_hourly(f.solar_bronze, zone=ZONE), "wind": silver.transform_wind_hourly(f.wind_bronze, zone=ZONE)}
    return silver.renewable_totals(by_tag).drop("interval_start_utc")


def _refreshed(f: Frames, feed: DataFrame, source: Source, measure: str, name: str) -> DataFrame:
    """Six years of a feed with a wrong month in the middle are built; then the last months and the corrections land, and
    a refresh brings the layers up to date: the table is that of a full build."""
    bronze_path, s_root, g_root = (scratch_path(f.spark, n) for n in ("bronze-orders", "silver-orders", "gold-orders"))
    wrong = "Interval_Start >= TIMESTAMP_NTZ '1998-06-01' AND Interval_Start < TIMESTAMP_NTZ '1998-07-01'"
    late = "Interval_Start >= TIMESTAMP_NTZ '2001-05-01'"
    stamp = lambda df, day: df.withColumn("_ingested_at", F.expr(f"TIMESTAMP_NTZ '{day}'"))
    first = feed.where(f"NOT ({late})").withColumn(measure, F.expr(f"CASE WHEN {wrong} THEN {measure} * 2 + 1 ELSE {measure} END"))
    tables.load_bronze(f.spark, bronze_path, stamp(first, "2024-01-01"), source)
    refresh.refresh(f.spark, {source.name: bronze_path}, s_root, g_root)
    tables.load_bronze(f.spark, bronze_path, stamp(feed.where(f"({wrong}) OR ({late})"), "2024-01-02"), source)
    refresh.refresh(f.spark, {source.name: bronze_path}, s_root, g_root)
    return tables.read_table(f.spark, f"{g_root}/{name}")


def _types(f: Frames) -> DataFrame:
    """Daily orders, landed as whole numbers until 1998 and as fractions from then on."""
    path = scratch_path(f.spark, "landing-types")
    daily = f.table("orders").groupBy(F.expr("CAST(o_orderdate AS TIMESTAMP_NTZ)").alias("Time")).agg(
        F.count(F.lit(1)).alias("n"), F.expr("count(1) / 4.0D").alias("share"))
    whole = daily.where("Time < TIMESTAMP_NTZ '1998-01-01'").select("Time", F.col("n").alias("orders_mw"))
    tables.write_partitioned(whole, path, (), "append")
    tables.write_partitioned(daily.where("Time >= TIMESTAMP_NTZ '1998-01-01'").select("Time", F.col("share").alias("orders_mw")), path, (), "append")
    return landing.read_feed(f.spark, path, FUEL_MIX)


def _rejects(f: Frames) -> DataFrame:
    """Price files in which a point has no number at five o'clock: what is loaded, and what is kept of the rest."""
    path, table, bad = (scratch_path(f.spark, n) for n in ("landing-csv", "bronze-csv", "rejects"))
    odd = "Location = 'RN_1' AND hour(Interval_Start) = 5"
    raw = f.dam_bronze.withColumn("LMP", F.expr(f"CASE WHEN {odd} THEN 'N/A' ELSE CAST(LMP AS STRING) END"))
    raw.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("Interval_Start", "Interval_End")}).write.csv(path, header=True)
    out = bronze.land(f.spark, path, table, DAM, fmt="csv", rejects_path=bad, most_rejected=0.2)
    kept = bronze.rejects(f.spark, bad).groupBy("column", "raw", "reason").agg(F.count(F.lit(1)).alias("n"))
    loaded = tables.read_table(f.spark, table).agg(F.count(F.lit(1)).alias("n"))
    loaded = loaded.select(F.lit("loaded").alias("column"), F.lit(None).cast("string").alias("raw"), F.lit(f"rejected {out['rejected']}").alias("reason"), "n")
    return kept.unionByName(loaded)


def _load_counts(f: Frames) -> DataFrame:
    """What the two landings of SNK-5 report of themselves, the second one twice."""
    path, rows = scratch_path(f.spark, "counted"), []
    target, batch = f.upsert_pair
    for name, df in (("first", target), ("again", batch), ("repeated", batch)):
        out = tables.load_bronze(f.spark, path, df, EVENTS, counts=True)
        rows.append((name, *[out[c] for c in ("rows_in", "rows", "inserted", "updated", "unchanged")]))
    return f.spark.createDataFrame(rows, "load string, rows_in long, rows long, inserted long, updated long, unchanged long")


def _ranged(f: Frames, method: str = "rows") -> DataFrame:
    """Time frames over the events as they come, gaps and repeated times included."""
    ev = f.table("events").select("event_id", "event_type", "ts", "value")
    return series.range_roll(ev, "ts", "value", {"max_6h": ("max", -6 * 3600, -1), "n_24h": ("count", -24 * 3600, -3600)},
                             by=["event_type"], method=method).select("event_id", "max_6h", "n_24h")


def _sel(attr: str, *cols, idx=None):
    def fn(f: Frames):
        df = getattr(f, attr)
        df = df[idx] if idx is not None else df
        return df.select(*cols)
    return fn


_S = "interval_start"

_DEFS = {
    # sources
    "SRC-1": q_src1,
    "SRC-2": lambda f: landing.sanitize_columns(f.regional_bronze),
    "SRC-3": q_src3,
    "SRC-4": q_src4,
    # sinks
    "SNK-1": lambda f: tables.with_date_parts(f.solar_bronze).select(
        "Interval_Start", "year", "month", "day"),
    "SNK-2": q_snk2,
    "SNK-3": q_snk3,
    "SNK-4": q_snk4,
    "SNK-5": q_snk5,
    "SNK-6": q_snk6,
    "SNK-7": lambda f: merge.dedupe_latest(f.dam_landed_twice, list(DAM.keys)),
    "SNK-8": q_snk8,
    # incremental
    "INC-1": q_inc1,
    "INC-2": _inc2,
    # quality
    "QC-1": lambda f: f.quality_counts.select("table_name", "status"),
    "QC-2": lambda f: f.quality_counts.select("table_name", "row_count"),
    "QC-3": lambda f: f.quality_counts.select("table_name", "time_column"),
    "QC-4": lambda f: f.quality_counts.select("table_name", "min_date", "max_date"),
    "QC-5": lambda f: f.quality_counts.select("table_name", "null_time_column", "null_ingested_at"),
    "QC-6": lambda f: f.quality.select("table_name", "duplicate_intervals"),
    "QC-7": lambda f: quality.duplicate_keys(f.table("lineitem"), LINEITEM_KEYS),
    "QC-8": lambda f: f.quality,
    # projections
    "PRJ-1": _sel("solar", *[v for v in SOLAR.rename.values()]),
    "PRJ-2": _sel("wind", *[v for v in WIND.rename.values()]),
    "PRJ-3": _sel("lmp", *[v for v in DAM.rename.values()], "Market"),
    "PRJ-4": lambda f: landing.rename(landing.sanitize_columns(f.regional_bronze),
                                      {"Interval_Start": _S, "Interval_End": "interval_end"}),
    "PRJ-5": _sel("solar", _S, "hour_of_day"),
    "PRJ-6": _sel("solar", _S, "day_of_week"),
    "PRJ-7": _sel("solar", _S, "is_weekend"),
    "PRJ-8": _sel("lmp", _S, "settlement_point", "is_peak_hour"),
    "PRJ-9": _sel("lmp", _S, "settlement_point", "hour_ending"),
    "PRJ-10": _sel("lmp", _S, "settlement_point", "delivery_date"),
    "PRJ-11": _sel("solar", _S, "stppf_error_mw"),
    "PRJ-12": _sel("solar", _S, "stppf_error_pct"),
    "PRJ-13": _sel("combined", _S, "resource_type", "estimated_curtailment_mw"),
    "PRJ-14": _sel("lmp", _S, "settlement_point", "point_type"),
    "PRJ-15": _sel("solar", _S, "year", "month", "day"),
    "PRJ-16": lambda f: silver.transform_lmp_dam(f.dam_bronze).select(
        _S, "settlement_point", "_source_table",
        F.col("_transformed_at").isNotNull().alias("has_transformed_at")),
    "PRJ-17": _sel("combined", _S, "resource_type", "forecast_mw"),
    "PRJ-18": lambda f: metrics.accuracy_base(f.solar, "actual_mw", "stppf_forecast_mw",
                                              gold.SOLAR_FLOOR).select(
        _S, "actual_mw", "stppf_forecast_mw"),
    "PRJ-19": lambda f: f.lmp.filter(F.col("point_type") == "Hub").select(
        _S, "settlement_point", "lmp_price"),
    "PRJ-20": lambda f: f.lmp.filter(F.col("settlement_point").contains("HOUSTON")).select(
        _S, "settlement_point", "lmp_price"),
    "PRJ-21": _sel("totals", _S, "solar_pct", "wind_pct"),
    "PRJ-22": _sel("patterns", "year", "month", "capacity_factor_estimate", idx=1),
    "PRJ-23": _sel("curtail", "date", "curtailment_rate_pct", idx=1),
    "PRJ-24": _sel("features", _S, "hour_sin", "hour_cos"),
    "PRJ-25": _sel("features", _S, "month_num", "day_of_week_num"),
    "PRJ-26": _sel("features", _S, "day_of_year"),
    "PRJ-27": _sel("volatility", "date", "settlement_point", "is_price_spike",
                   "has_extreme_high", "has_negative_price"),
    "PRJ-28": _sel("volatility", "date", "settlement_point", "cv_7d", "cv_30d"),
    "PRJ-29": lambda f: f.features,
    # joins
    "JOI-1": lambda f: f.curtail[1],
    "JOI-2": lambda f: metrics.houston_join(f.lmp, f.totals),
    # aggregations
    "AGG-1": lambda f: f.totals,
    "AGG-2": lambda f: silver.lmp_hub_daily_summary(f.lmp),
    "AGG-3": lambda f: silver.lmp_load_zone_daily_summary(f.lmp),
    "AGG-4": lambda f: f.solar_acc[0],
    "AGG-5": lambda f: f.solar_acc[1],
    "AGG-6": lambda f: f.wind_acc[0],
    "AGG-7": lambda f: f.wind_acc[1],
    "AGG-8": lambda f: f.patterns[0],
    "AGG-9": lambda f: f.patterns[1],
    "AGG-10": lambda f: f.patterns[2],
    "AGG-11": lambda f: metrics.curtailment_by_hour(f.solar, tag="solar"),
    "AGG-12": lambda f: metrics.curtailment_by_hour(f.wind, tag="wind"),
    "AGG-13": lambda f: f.curtail[1],
    "AGG-14": lambda f: f.price_stats[0],
    "AGG-15": lambda f: f.price_stats[1],
    "AGG-16": lambda f: f.hub_comparison[1],
    "AGG-17": lambda f: f.correlation,
    "AGG-18": lambda f: f.quality_counts.select("table_name", "row_count", "min_date", "max_date",
                                         "null_time_column", "null_ingested_at"),
    "AGG-19": lambda f: quality.duplicate_keys(f.table("lineitem"), LINEITEM_KEYS),
    "AGG-20": lambda f: reshape.pivot_first(
        f.lmp.filter(F.col("point_type") == "Hub"), ["delivery_date", "hour_of_day"],
        "settlement_point", None, "lmp_price", "interval_start"),
    # windows
    "WIN-1": _dedupe_lineitem,
    "WIN-2": _sel("solar_rolled", _S, "actual_lag_1h", "actual_lag_24h", "actual_lag_168h"),
    "WIN-3": _sel("features", _S, "same_hour_yesterday", "same_hour_last_week"),
    "WIN-4": _sel("solar_rolled", _S, "actual_avg_24h", "actual_avg_168h"),
    "WIN-5": _sel("solar_rolled", _S, "actual_max_24h", "actual_min_24h"),
    "WIN-6": _sel("solar_rolled", _S, "actual_std_24h"),
    "WIN-7": _sel("features", _S, "target_actual_mw", "actual_lag_168h"),
    "WIN-8": _sel("volatility", "date", "settlement_point", "rolling_7d_avg", "rolling_7d_stddev"),
    "WIN-9": _sel("volatility", "date", "settlement_point", "rolling_30d_avg",
                  "rolling_30d_stddev"),
    # sorts, sets, reshaping
    "SRT-1": lambda f: ordering.latest(f.solar, _S, 100),
    "SRT-2": lambda f: reports.accuracy_trend(f.solar_acc[0], 30),
    "SRT-3": lambda f: ordering.sort_by(f.price_stats[1], "settlement_point", "hour_of_day"),
    "SET-1": lambda f: f.combined,
    "SET-2": lambda f: f.curtail[0],
    "RSH-1": lambda f: f.regional,
    "RSH-2": _sel("hub_comparison", "delivery_date", "hour_of_day", "houston_west_spread",
                  "north_south_spread", idx=0),
    # reports
    "RPT-1": lambda f: reports.accuracy_trend(f.solar_acc[0]),
    "RPT-2": lambda f: reports.hourly_generation(f.patterns[0]),
    "RPT-3": lambda f: reports.monthly_gwh(f.patterns[1]),
    "RPT-4": lambda f: reports.hub_daily_prices(f.price_stats[0]),
    "RPT-5": lambda f: reports.hub_hourly_prices(f.price_stats[1]),
    "RPT-6": _rpt6,
    # composed steps
    "PIP-1": lambda f: f.solar,
    "PIP-2": lambda f: f.wind,
    "PIP-3": lambda f: f.totals,
    "PIP-4": lambda f: f.regional,
    "PIP-4-wind": lambda f: f.wind_regional,
    "PIP-5": lambda f: f.lmp,
    "PIP-6": lambda f: silver.lmp_hub_daily_summary(f.lmp),
    "PIP-7": lambda f: silver.lmp_load_zone_daily_summary(f.lmp),
    "PIP-8": lambda f: f.solar_acc[0],
    "PIP-9": lambda f: f.wind_acc[0],
    "PIP-10": lambda f: f.patterns[0],
    "PIP-11": lambda f: f.curtail[1],
    "PIP-12": lambda f: f.features,
    "PIP-13": lambda f: f.price_stats[0],
    "PIP-14": lambda f: f.hub_comparison[0],
    "PIP-15": lambda f: f.volatility,
    "PIP-16": lambda f: f.correlation,
    # what the survey adds
    "EXT-horizon": lambda f: silver.forecast_horizon(f.solar).select(_S, "forecast_horizon_hours", "is_forecast"),
    "EXT-skill": _skill,
    "EXT-corr": lambda f: gold.lmp_renewable_correlation(f.lmp, f.totals, with_corr=True),
    "EXT-zone": _zoned,
    "EXT-zone-accuracy": _zoned_accuracy,
    "EXT-zone-totals": _zoned_totals,
    # layers brought up to date from what changed
    "EXT-refresh-features": lambda f: _refreshed(f, derived.order_feed(f.spark, f.sf), SOLAR, "GEN_SYSTEM_WIDE", "solar_forecast_features"),
    "EXT-refresh-volatility": lambda f: _refreshed(f, derived.order_prices(f.spark, f.sf), DAM, "LMP", "lmp_volatility_metrics"),
    # landings whose types change or whose values don't cast, and what loads report
    "EXT-types": _types,
    "EXT-rejects": _rejects,
    "EXT-counts": _load_counts,
    # the forms for groups and series without a bound
    "EXT-quantiles": lambda f: metrics.daily_price_statistics(f.lmp, exact="distributed"),
    "EXT-features": lambda f: gold.solar_features(f.solar, method="range"),
    "EXT-range": _ranged,
    "EXT-range-cells": lambda f: _ranged(f, "cells"),
}

QUERIES = {k: _q(v) for k, v in _DEFS.items()}
