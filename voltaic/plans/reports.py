"""Read-only reports over the gold tables.

Rounding goes through ``decimal`` first so that a value printed as 97.275
rounds to 97.28 (half up on the decimal value, not on its binary neighbour).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaic.operators.ordering import latest


def dround(c, digits: int) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("decimal(38,10)"), digits).cast("double")


def accuracy_trend(daily_accuracy: DataFrame, n: int = 30) -> DataFrame:
    """RPT-1: the last ``n`` days of forecast accuracy."""
    return latest(daily_accuracy.select("date", "mae_mw", "mape_pct", "bias_mw",
                                        "observation_count"), "date", n)


def hourly_generation(hour_profile: DataFrame) -> DataFrame:
    """RPT-2: typical-day profile rounded to whole MW."""
    return hour_profile.select(
        "hour_of_day", dround("avg_solar_mw", 0).alias("avg_solar_mw"),
        dround("avg_wind_mw", 0).alias("avg_wind_mw"),
        dround("avg_total_mw", 0).alias("avg_total_mw"),
        dround("p10_total_mw", 0).alias("p10_mw"), dround("p90_total_mw", 0).alias("p90_mw"),
    ).orderBy("hour_of_day")


def monthly_gwh(monthly: DataFrame) -> DataFrame:
    """RPT-3: monthly totals in GWh, newest first."""
    return monthly.select(
        "year", "month",
        dround(F.col("total_generation_mwh") / 1000, 1).alias("total_gwh"),
        dround("solar_share_pct", 1).alias("solar_pct"),
        dround("wind_share_pct", 1).alias("wind_pct"),
        dround(F.col("total_curtailment_mwh") / 1000, 1).alias("curtailment_gwh"),
    ).orderBy(F.col("year").desc(), F.col("month").desc())


def hub_daily_prices(daily_stats: DataFrame, n: int = 50) -> DataFrame:
    """RPT-4: newest ``n`` hub-days."""
    hub = daily_stats.filter(F.col("point_type") == "Hub").select(
        "date", "settlement_point", dround("avg_price", 2).alias("avg_price"),
        dround("min_price", 2).alias("min_price"), dround("max_price", 2).alias("max_price"),
        dround("peak_offpeak_spread", 2).alias("peak_offpeak_spread"))
    return hub.orderBy(F.col("date").desc(), F.col("settlement_point").asc()).limit(n)


def hub_hourly_prices(patterns: DataFrame) -> DataFrame:
    """RPT-5: hub hour-of-day price pattern."""
    return patterns.select(
        "settlement_point", "hour_of_day", dround("avg_price", 2).alias("avg_price"),
        dround("p10_price", 2).alias("p10_price"), dround("p90_price", 2).alias("p90_price"),
        "observation_count").orderBy("settlement_point", "hour_of_day")


def recent_volatility(volatility: DataFrame, as_of: dt.date | Column | None = None,
                      days: int = 30) -> DataFrame:
    """RPT-6: volatility rows of the ``days`` days up to ``as_of`` (default:
    today; a Column such as a scalar subquery is accepted)."""
    ref = F.current_date() if as_of is None else (
        as_of if isinstance(as_of, Column) else F.lit(as_of))
    return volatility.filter(F.col("date") >= F.date_sub(ref, days)).select(
        "date", "settlement_point", dround("avg_price", 2).alias("avg_price"),
        dround("rolling_7d_stddev", 2).alias("volatility_7d"),
        dround("cv_7d", 1).alias("cv_7d_pct"), "is_price_spike", "has_negative_price",
    ).orderBy(F.col("date").desc(), "settlement_point")
