"""Silver steps: typed renames, calendar columns, forecast error, curtailment,
point classification, the combined resource view, hourly totals, regional
unpivot and daily price summaries.  Each step takes DataFrames and returns a
lazy DataFrame; writing is the caller's choice (``sources.tables``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.functions.calendar import calendar_columns, forecast_horizon_hours, local_time
from voltaic.functions.classify import classify_point
from voltaic.functions.measures import curtailment, forecast_error, forecast_error_pct
from voltaic.operators import metrics, reshape
from voltaic.sources.landing import rename, sanitize_columns
from voltaic.sources.registry import DAM, SOLAR, SOLAR_REGIONAL, WIND, Source

# The forecast column each resource is scored on.
RESOURCE_FORECAST = {"solar": "stppf", "wind": "stwpf"}


def lineage_columns(source_table: str) -> dict:
    return {"_transformed_at": F.current_timestamp(), "_source_table": F.lit(source_table)}


def transform_hourly(bronze: DataFrame, source: Source, forecast: str,
                     zone: str | None = None) -> DataFrame:
    """PIP-1 / PIP-2: canonical names, calendar, error vs ``<forecast>``,
    curtailment estimate, lineage and partition columns (one projection).  With a ``zone``, the feed's times (stored as
    UTC) become the wall-clock times there, so that this and all later steps, which take dates, hours and months
    from them, are in that zone; the instant stays as ``interval_start_utc``.  Where clocks go back, two rows share an hour."""
    df = _in_zone(rename(bronze, source.rename, source.required), zone)
    fc = f"{forecast}_forecast_mw"
    cols = calendar_columns("interval_start")
    cols.update({
        f"{forecast}_error_mw": forecast_error("actual_mw", fc),
        f"{forecast}_error_pct": forecast_error_pct("actual_mw", fc),
        "estimated_curtailment_mw": curtailment("actual_mw", "hsl_mw"),
    })
    cols.update(lineage_columns(source.name))
    cols.update({"year": F.year("interval_start"), "month": F.month("interval_start"),
                 "day": F.dayofmonth("interval_start")})
    return df.withColumns(cols)


#: Columns of a feed's intervals and of its publication.
TIMES = ("interval_start", "interval_end", "report_time", "Publish_Time")


def _in_zone(df: DataFrame, zone: str | None) -> DataFrame:
    """The frame with its times in ``zone``, and the start as it was stored."""
    if zone is None:
        return df
    local = {c: local_time(c, zone) for c in TIMES if c in df.columns}
    return df.withColumns({"interval_start_utc": F.col("interval_start")} | local)


def transform_solar_hourly(bronze: DataFrame, zone: str | None = None) -> DataFrame:
    return transform_hourly(bronze, SOLAR, "stppf", zone)


def transform_wind_hourly(bronze: DataFrame, zone: str | None = None) -> DataFrame:
    return transform_hourly(bronze, WIND, "stwpf", zone)


def forecast_horizon(silver: DataFrame) -> DataFrame:
    """Hours ahead of the interval that its report was published, and whether it was a forecast then."""
    h = forecast_horizon_hours("interval_start", "report_time")
    return silver.withColumns({"forecast_horizon_hours": h, "is_forecast": h > 0})


SLIM_COLUMNS = ("interval_start", "interval_end", "actual_mw", "hsl_mw",
                "estimated_curtailment_mw", "hour_of_day", "day_of_week", "is_weekend",
                "year", "month", "day")


def combined_resources(by_tag: dict[str, DataFrame]) -> DataFrame:
    """PIP-3 / SET-1: slim rows of every resource with its tag and its own
    forecast column, stacked by name."""
    frames = [df.select(*SLIM_COLUMNS,
                        *(["interval_start_utc"] if "interval_start_utc" in df.columns else []),
                        F.lit(tag).alias("resource_type"),
                        F.col(f"{RESOURCE_FORECAST[tag]}_forecast_mw").alias("forecast_mw"))
              for tag, df in by_tag.items()]
    return reshape.combine(frames)


def renewable_totals(by_tag: dict[str, DataFrame]) -> DataFrame:
    """PIP-3 / AGG-1: totals per interval with per-resource sums and shares."""
    return metrics.hourly_totals(combined_resources(by_tag), parts=tuple(by_tag))


def transform_regional(bronze: DataFrame, source: Source = SOLAR_REGIONAL, zone: str | None = None) -> DataFrame:
    """PIP-4: sanitise names, unpivot every ``<METRIC>_<REGION>`` column to one row per
    (interval, region) with a column per metric, calendar and partitions.  All other
    columns (publish time, lineage) are carried; a feed that is long already (its region is a
    column) keeps its rows."""
    df = rename(sanitize_columns(bronze), source.rename, ("Interval_Start",))
    df = _in_zone(df.drop("year", "month", "day"), zone)  # derived again below
    region = next((c for c in source.region_cols if c in df.columns), None)
    long = df.withColumnRenamed(region, "region") if region else reshape.unpivot_regions(df)
    cols = {"hour_of_day": F.hour("interval_start"), "year": F.year("interval_start"),
            "month": F.month("interval_start"), "day": F.dayofmonth("interval_start")}
    cols.update(lineage_columns(source.name))
    return long.withColumns(cols)


def transform_lmp_dam(bronze: DataFrame, zone: str | None = None) -> DataFrame:
    """PIP-5: canonical names, delivery date, hour ending, calendar, peak flag,
    point class, lineage and partitions (one projection)."""
    df = _in_zone(rename(bronze, DAM.rename, DAM.required), zone)
    cols = calendar_columns("interval_start", "interval_end", peak=True, delivery_date=True)
    cols["point_type"] = classify_point("settlement_point")
    cols.update(lineage_columns(DAM.name))
    cols.update({"year": F.year("interval_start"), "month": F.month("interval_start"),
                 "day": F.dayofmonth("interval_start")})
    return df.withColumns(cols)


def lmp_hub_daily_summary(lmp: DataFrame) -> DataFrame:
    """PIP-6 / AGG-2."""
    return metrics.point_daily_summary(lmp, "Hub", "price_spread")


def lmp_load_zone_daily_summary(lmp: DataFrame) -> DataFrame:
    """PIP-7 / AGG-3."""
    return metrics.point_daily_summary(lmp, "Load Zone", "daily_price_range")
