"""Materialise the silver and gold layers as partitioned parquet tables.

Each layer reads the previous one from storage (as separate jobs would), so
the lineage of every table is one layer deep and a failed step is re-run from
the stored inputs.  Writes are full replacements (static overwrite); the
bronze layer is maintained incrementally by ``sources.tables.upsert_table``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from voltaic.plans import gold, silver
from voltaic.sources.registry import DAM, SOLAR, SOLAR_REGIONAL, WIND, WIND_REGIONAL
from voltaic.sources.tables import read_table, table_exists, write_partitioned

YM = ("year", "month")

# Table names of each layer and their storage partitions.
SILVER_TABLES = {
    "solar_hourly": YM,
    "wind_hourly": YM,
    "renewable_generation_combined": ("year", "month", "resource_type"),
    "renewable_generation_totals": YM,
    "solar_hourly_regional": YM,
    "wind_hourly_regional": YM,
    "lmp_day_ahead_market": YM,
    "lmp_hub_daily_summary": YM,
    "lmp_load_zone_daily_summary": YM,
}
GOLD_TABLES = {
    "solar_forecast_accuracy_daily": YM,
    "solar_forecast_accuracy_by_hour": (),
    "wind_forecast_accuracy_daily": YM,
    "wind_forecast_accuracy_by_hour": (),
    "generation_hourly_patterns": (),
    "generation_monthly_summary": (),
    "generation_dow_patterns": (),
    "curtailment_hourly_patterns": (),
    "curtailment_daily_summary": YM,
    "solar_forecast_features": YM,
    "lmp_daily_statistics": YM,
    "lmp_hourly_patterns": (),
    "lmp_hub_hourly_comparison": YM,
    "lmp_daily_spreads": YM,
    "lmp_volatility_metrics": YM,
    "lmp_renewable_correlation": YM,
}


def _write(df: DataFrame | None, root: str, name: str, parts) -> str | None:
    if df is None:
        return None
    path = os.path.join(root, name)
    write_partitioned(df, path, parts, "overwrite")
    return path


def build_silver(spark: SparkSession, bronze: dict[str, DataFrame], root: str, zone: str | None = None) -> dict[str, str]:
    """Silver tables from the bronze frames keyed by source name (solar, wind,
    the regional feeds and day-ahead prices; any may be missing).  With a ``zone``, all of them (and so gold) are in its
    wall-clock time."""
    out: dict[str, str] = {}
    P = SILVER_TABLES

    def put(name, df):
        path = _write(df, root, name, P[name])
        if path:
            out[name] = path

    if SOLAR.name in bronze:
        put("solar_hourly", silver.transform_solar_hourly(bronze[SOLAR.name], zone))
    if WIND.name in bronze:
        put("wind_hourly", silver.transform_wind_hourly(bronze[WIND.name], zone))
    if "solar_hourly" in out and "wind_hourly" in out:
        by_tag = {"solar": read_table(spark, out["solar_hourly"]),
                  "wind": read_table(spark, out["wind_hourly"])}
        put("renewable_generation_combined", silver.combined_resources(by_tag))
        put("renewable_generation_totals", silver.renewable_totals(by_tag))
    for src, name in ((SOLAR_REGIONAL, "solar_hourly_regional"),
                      (WIND_REGIONAL, "wind_hourly_regional")):
        if src.name in bronze:
            put(name, silver.transform_regional(bronze[src.name], src, zone))
    if DAM.name in bronze:
        put("lmp_day_ahead_market", silver.transform_lmp_dam(bronze[DAM.name], zone))
        lmp = read_table(spark, out["lmp_day_ahead_market"])
        put("lmp_hub_daily_summary", silver.lmp_hub_daily_summary(lmp))
        put("lmp_load_zone_daily_summary", silver.lmp_load_zone_daily_summary(lmp))
    return out


def build_gold(spark: SparkSession, silver_root: str, root: str) -> dict[str, str]:
    """Gold tables from the stored silver tables (steps whose inputs are
    missing are skipped; errors inside a step are raised).  Presence is
    checked through Spark's file system layer, so ``silver_root`` may be any
    shared-storage URI, not only a local folder."""
    present: dict[str, bool] = {}

    def has(name):
        if name not in present:
            present[name] = table_exists(spark, os.path.join(silver_root, name))
        return present[name]

    def load(name):
        return read_table(spark, os.path.join(silver_root, name))

    out: dict[str, str] = {}
    P = GOLD_TABLES

    def put(name, df):
        path = _write(df, root, name, P[name])
        if path:
            out[name] = path

    if has("solar_hourly"):
        daily, hourly = gold.solar_forecast_accuracy(load("solar_hourly"))
        put("solar_forecast_accuracy_daily", daily)
        put("solar_forecast_accuracy_by_hour", hourly)
        put("solar_forecast_features", gold.solar_features(load("solar_hourly")))
    if has("wind_hourly"):
        daily, hourly = gold.wind_forecast_accuracy(load("wind_hourly"))
        put("wind_forecast_accuracy_daily", daily)
        put("wind_forecast_accuracy_by_hour", hourly)
    if has("renewable_generation_totals"):
        hourly, monthly, dow = gold.generation_patterns(load("renewable_generation_totals"))
        put("generation_hourly_patterns", hourly)
        put("generation_monthly_summary", monthly)
        put("generation_dow_patterns", dow)
    if has("solar_hourly") and has("wind_hourly"):
        by_hour, daily = gold.curtailment_analysis(load("solar_hourly"), load("wind_hourly"))
        put("curtailment_hourly_patterns", by_hour)
        put("curtailment_daily_summary", daily)
    if has("lmp_day_ahead_market"):
        lmp = load("lmp_day_ahead_market")
        daily_stats, hub_hourly = gold.lmp_price_statistics(lmp)
        put("lmp_daily_statistics", daily_stats)
        put("lmp_hourly_patterns", hub_hourly)
        comparison, spreads = gold.lmp_hub_comparison(lmp)
        put("lmp_hub_hourly_comparison", comparison)
        put("lmp_daily_spreads", spreads)
        put("lmp_volatility_metrics",
            gold.lmp_volatility(read_table(spark, out["lmp_daily_statistics"])))
        if has("renewable_generation_totals"):
            put("lmp_renewable_correlation",
                gold.lmp_renewable_correlation(lmp, load("renewable_generation_totals")))
    return out
