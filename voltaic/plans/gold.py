"""Gold steps: forecast accuracy, generation patterns, curtailment, the
solar feature table, price statistics, hub comparison, volatility and price
versus generation.  Inputs are silver DataFrames; outputs are lazy."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.functions.measures import pct_of
from voltaic.operators import metrics, reshape, series

# Accuracy floors (MW) below which hours are not scored.
SOLAR_FLOOR = 10.0
WIND_FLOOR = 100.0
# The spreads between hubs (each where both hubs are in the data).
SPREADS = (("HB_HOUSTON", "HB_WEST", "houston_west_spread"),
           ("HB_NORTH", "HB_SOUTH", "north_south_spread"))
# Price flag thresholds.
SPIKE_FACTOR = 2.0
EXTREME_HIGH = 100.0
NEGATIVE_BELOW = 0.0


def _accuracy(silver: DataFrame, tag: str, forecast: str, floor: float):
    kw = dict(actual="actual_mw", forecast=f"{forecast}_forecast_mw",
              error=f"{forecast}_error_mw", floor=floor, tag=tag)
    return metrics.accuracy_daily(silver, **kw), metrics.accuracy_by_hour(silver, **kw)


def solar_forecast_accuracy(solar: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PIP-8: (daily, by hour) for solar."""
    return _accuracy(solar, "solar", "stppf", SOLAR_FLOOR)


def wind_forecast_accuracy(wind: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PIP-9: (daily, by hour) for wind."""
    return _accuracy(wind, "wind", "stwpf", WIND_FLOOR)


def generation_patterns(totals: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """PIP-10: (hour-of-day profile, monthly summary, day-of-week × hour)."""
    return (metrics.hour_profile(totals), metrics.monthly_summary(totals),
            metrics.dow_profile(totals))


def curtailment_analysis(solar: DataFrame, wind: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PIP-11: (hourly patterns of both resources, daily summary)."""
    hourly = reshape.combine([metrics.curtailment_by_hour(solar, tag="solar"),
                              metrics.curtailment_by_hour(wind, tag="wind")])
    return hourly, metrics.daily_curtailment(solar, wind)


# The columns of the feature and volatility tables.
FEATURE_LAGS = {"actual_lag_1h": 1, "actual_lag_24h": 24, "actual_lag_168h": 168}
FEATURE_FRAMES = {
    "actual_avg_24h": ("avg", -24, -1),
    "actual_avg_168h": ("avg", -168, -1),
    "actual_max_24h": ("max", -24, -1),
    "actual_min_24h": ("min", -24, -1),
    "actual_std_24h": ("stddev", -24, -1),
}
FEATURE_COLUMNS = (
    "interval_start", "hour_of_day", "is_weekend", "actual_lag_1h", "actual_lag_24h",
    "actual_lag_168h", "actual_avg_24h", "actual_avg_168h", "actual_max_24h",
    "actual_min_24h", "actual_std_24h", "hour_sin", "hour_cos", "day_of_year",
    "month_num", "day_of_week_num", "same_hour_yesterday", "same_hour_last_week",
    "stppf_forecast_mw", "target_actual_mw", "year", "month", "day",
)


def solar_features(solar: DataFrame, block_rows: int | None = None,
                   method: str = "bucket") -> DataFrame:
    """PIP-12: lags, trailing statistics and cyclic calendar features of the
    hours with an actual, keeping only rows with a full week of history.
    ``method="range"`` numbers rows without assuming a bounded day
    (``series.position_index``)."""
    base = solar.filter(F.col("actual_mw").isNotNull())
    rolled = series.lag_roll(base, ["interval_start", *metrics.instant(base)], "actual_mw",
                             lags=FEATURE_LAGS, frames=FEATURE_FRAMES, block_rows=block_rows,
                             method=method)
    angle = F.lit(2 * math.pi) * F.col("hour_of_day") / F.lit(24.0)
    ts = F.col("interval_start")
    return (rolled.withColumns({
        "hour_sin": F.sin(angle), "hour_cos": F.cos(angle),
        "day_of_year": F.dayofyear(ts), "month_num": F.month(ts),
        "day_of_week_num": F.dayofweek(ts),
        "same_hour_yesterday": F.col("actual_lag_24h"),
        "same_hour_last_week": F.col("actual_lag_168h"),
        "target_actual_mw": F.col("actual_mw"),
    }).filter(F.col("actual_lag_168h").isNotNull()).select(*FEATURE_COLUMNS))


def lmp_price_statistics(lmp: DataFrame, exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """PIP-13: (daily statistics per point, hub hour-of-day patterns)."""
    return (metrics.daily_price_statistics(lmp, exact=exact),
            metrics.hub_hourly_patterns(lmp, exact=exact))


def hub_hourly_comparison(lmp: DataFrame, hubs=None, spreads=SPREADS) -> DataFrame:
    """PIP-14 (first table): prices of all hubs in the data (or of ``hubs``) side by side per
    (day, hour), with spreads."""
    pivot = reshape.pivot_first(lmp.filter(F.col("point_type") == "Hub"),
                                ["delivery_date", "hour_of_day"], "settlement_point",
                                None if hubs is None else list(hubs), "lmp_price", (metrics.instant(lmp) or ["interval_start"])[0])
    for a, b, name in spreads:
        pivot = reshape.add_spread(pivot, a, b, name)
    return pivot.withColumns({"year": F.year("delivery_date"),
                              "month": F.month("delivery_date")})


def lmp_hub_comparison(lmp: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """PIP-14: (hourly hub comparison, daily spread summary)."""
    comp = hub_hourly_comparison(lmp)
    return comp, reshape.daily_spreads(comp)


VOLATILITY_FRAMES = {
    "rolling_7d_avg": ("avg", -6, 0),
    "rolling_7d_stddev": ("stddev", -6, 0),
    "rolling_30d_avg": ("avg", -29, 0),
    "rolling_30d_stddev": ("stddev", -29, 0),
}


def price_flags(df: DataFrame, *, spike_factor: float = SPIKE_FACTOR,
                high: float = EXTREME_HIGH, low: float = NEGATIVE_BELOW) -> DataFrame:
    return df.withColumns({
        "is_price_spike": F.col("max_price") > F.col("rolling_30d_avg") * F.lit(spike_factor),
        "has_extreme_high": F.col("max_price") > F.lit(high),
        "has_negative_price": F.col("min_price") < F.lit(low),
    })


def lmp_volatility(daily_stats: DataFrame) -> DataFrame:
    """PIP-15: trailing 7- and 30-row volatility per hub, CV and price flags.  A hub has one
    row a day, so its window is bounded by the time span."""
    hubs = daily_stats.filter(F.col("point_type") == "Hub")
    rolled = series.roll_by_entity(hubs, ["settlement_point"], ["date"], "avg_price", VOLATILITY_FRAMES)
    rolled = rolled.withColumns({
        "cv_7d": pct_of("rolling_7d_stddev", "rolling_7d_avg"),
        "cv_30d": pct_of("rolling_30d_stddev", "rolling_30d_avg"),
    })
    return price_flags(rolled)


def lmp_renewable_correlation(lmp: DataFrame, totals: DataFrame,
                              with_corr: bool = False) -> DataFrame:
    """PIP-16: daily price at the Houston points against renewable totals."""
    return metrics.price_vs_generation(lmp, totals, with_corr=with_corr)
