"""Declared landing schemas, canonical names and business keys per feed.

One frozen record per feed holds everything the readers and writers need:
declared schema (no inference), the rename to canonical snake_case names, the
business key used by upsert/dedupe, the time column and the storage partitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TS = T.TimestampNTZType()
DBL = T.DoubleType()
STR = T.StringType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


@dataclass(frozen=True)
class Source:
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    time_col: str
    partitions: tuple[str, ...] = ("year", "month")
    rename: dict = field(default_factory=dict)
    # measure columns a silver step cannot work without (checked up front)
    required: tuple[str, ...] = ()
    # wide feeds carry columns beyond the declared ones (one per region or
    # fuel): they are read as stored, not with the declared schema
    open_schema: bool = False
    # every undeclared column of the open schema is a measure (a double by contract); else
    # those named like one are
    all_measures: bool = False
    # columns that join the key where a feed carries them (its long form)
    region_cols: tuple[str, ...] = ()

    def keys_for(self, columns) -> tuple[str, ...]:
        """The business key of a frame with these columns: a long feed is keyed by its region as well."""
        return self.keys + tuple(c for c in self.region_cols if c in columns and c not in self.keys)


# Landing column names and canonical names of each feed.
SOLAR_RENAME = {
    "Interval_Start": "interval_start",
    "Interval_End": "interval_end",
    "Publish_Time": "report_time",
    "GEN_SYSTEM_WIDE": "actual_mw",
    "HSL_SYSTEM_WIDE": "hsl_mw",
    "STPPF_SYSTEM_WIDE": "stppf_forecast_mw",
    "PVGRPP_SYSTEM_WIDE": "pvgrpp_forecast_mw",
    "COP_HSL_SYSTEM_WIDE": "cop_hsl_mw",
}
WIND_RENAME = {
    "Interval_Start": "interval_start",
    "Interval_End": "interval_end",
    "Publish_Time": "report_time",
    "GEN_SYSTEM_WIDE": "actual_mw",
    "HSL_SYSTEM_WIDE": "hsl_mw",
    "STWPF_SYSTEM_WIDE": "stwpf_forecast_mw",
    "WGRPP_SYSTEM_WIDE": "wgrpp_forecast_mw",
    "COP_HSL_SYSTEM_WIDE": "cop_hsl_mw",
}
DAM_RENAME = {
    "Interval_Start": "interval_start",
    "Interval_End": "interval_end",
    "Location": "settlement_point",
    "Location_Type": "settlement_point_type",
    "LMP": "lmp_price",
}
REGIONAL_RENAME = {
    "Interval_Start": "interval_start",
    "Interval_End": "interval_end",
}

SOLAR = Source(
    name="solar_hourly_actual_forecast",
    schema=_schema(("Interval_Start", TS), ("Interval_End", TS), ("Publish_Time", TS),
                   ("GEN_SYSTEM_WIDE", DBL), ("HSL_SYSTEM_WIDE", DBL),
                   ("STPPF_SYSTEM_WIDE", DBL), ("PVGRPP_SYSTEM_WIDE", DBL),
                   ("COP_HSL_SYSTEM_WIDE", DBL)),
    keys=("Interval_Start",), time_col="Interval_Start",
    rename=SOLAR_RENAME, required=("GEN_SYSTEM_WIDE", "STPPF_SYSTEM_WIDE"),
)
WIND = Source(
    name="wind_hourly_actual_forecast",
    schema=_schema(("Interval_Start", TS), ("Interval_End", TS), ("Publish_Time", TS),
                   ("GEN_SYSTEM_WIDE", DBL), ("HSL_SYSTEM_WIDE", DBL),
                   ("STWPF_SYSTEM_WIDE", DBL), ("WGRPP_SYSTEM_WIDE", DBL),
                   ("COP_HSL_SYSTEM_WIDE", DBL)),
    keys=("Interval_Start",), time_col="Interval_Start",
    rename=WIND_RENAME, required=("GEN_SYSTEM_WIDE", "STWPF_SYSTEM_WIDE"),
)
DAM = Source(
    name="lmp_day_ahead_market",
    schema=_schema(("Interval_Start", TS), ("Interval_End", TS), ("Location", STR),
                   ("Location_Type", STR), ("Market", STR), ("LMP", DBL)),
    keys=("Interval_Start", "Location", "Market", "Location_Type"),
    time_col="Interval_Start", rename=DAM_RENAME, required=("LMP",),
)
# Regional feeds arrive wide (GEN_<REGION>, STPPF_<REGION>) or long, a row per interval and
# region; the region is then part of the key.
REGION_COLS = ("Geographic_Region", "Region", "region")
SOLAR_REGIONAL = Source(
    name="solar_hourly_actual_forecast_regional",
    schema=_schema(("Interval_Start", TS), ("Interval_End", TS)),
    keys=("Interval_Start",), time_col="Interval_Start", rename=REGIONAL_RENAME,
    open_schema=True, region_cols=REGION_COLS,
)
WIND_REGIONAL = Source(
    name="wind_hourly_actual_forecast_regional",
    schema=_schema(("Interval_Start", TS), ("Interval_End", TS)),
    keys=("Interval_Start",), time_col="Interval_Start", rename=REGIONAL_RENAME,
    open_schema=True, region_cols=REGION_COLS,
)
LOAD_FORECAST = Source(
    name="load_forecast_7day",
    schema=_schema(("Time", TS), ("PublishDate", TS), ("WeatherZone", STR),
                   ("Forecast", DBL)),
    keys=("Time", "PublishDate", "WeatherZone"), time_col="Time",
)
FUEL_MIX = Source(
    name="fuel_mix",
    schema=_schema(("Time", TS)),
    keys=("Time",), time_col="Time", partitions=("year", "month", "day"),
    open_schema=True, all_measures=True,
)
LMP_SETTLEMENT_POINT = Source(
    name="lmp_by_settlement_point",
    schema=_schema(("Interval_Start", TS), ("Interval_End", TS),
                   ("Settlement_Point", STR), ("LMP", DBL)),
    keys=("Interval_Start", "Settlement_Point"), time_col="Interval_Start",
)

SOURCES = {s.name: s for s in (SOLAR, SOLAR_REGIONAL, WIND, WIND_REGIONAL,
                               LOAD_FORECAST, FUEL_MIX, LMP_SETTLEMENT_POINT, DAM)}
