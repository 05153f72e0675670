"""Calendar columns derived from an interval timestamp.

All of them are locale-free built-ins: ``dayofweek`` is 1 = Sunday … 7 = Saturday,
``date_format(..., 'EEEE')`` gives the English day name.  Timestamps stay in the
type they arrive in (the landing files carry ``timestamp_ntz``), and no zone shift
happens unless one is asked for (``local_time``, ``zone=``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Peak hours are 07:00 (inclusive) to 22:00 (exclusive), all days.
PEAK_START_HOUR = 7
PEAK_END_HOUR = 22


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_time(ts, zone: str | None, stored_in: str = "UTC") -> Column:
    """The wall-clock time in ``zone`` of a zone-free timestamp stored as ``stored_in`` time;
    the timestamp itself without a zone."""
    if zone is None:
        return _c(ts)
    return F.convert_timezone(F.lit(stored_in), F.lit(zone), _c(ts))


def forecast_horizon_hours(interval_start, published) -> Column:
    """Hours from publication to the start of the interval (negative for actuals published later)."""
    return F.timestamp_diff("SECOND", _c(published), _c(interval_start)) / F.lit(3600.0)


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts))


def day_name(ts) -> Column:
    return F.date_format(_c(ts), "EEEE")


def is_weekend(ts) -> Column:
    # Sunday = 1, Saturday = 7
    return F.dayofweek(_c(ts)).isin(1, 7)


def is_peak_hour(ts, start: int = PEAK_START_HOUR, end: int = PEAK_END_HOUR) -> Column:
    h = F.hour(_c(ts))
    return (h >= start) & (h < end)


def calendar_columns(time_col: str, end_col: str | None = None, *, peak: bool = False,
                     delivery_date: bool = False, zone: str | None = None) -> dict[str, Column]:
    """Hour/day-name/weekend (and optionally peak flag, delivery date and hour
    ending) as named expressions, of the time in ``zone`` if one is given."""
    ts = local_time(time_col, zone)
    cols: dict[str, Column] = {}
    if delivery_date:
        cols["delivery_date"] = F.to_date(ts)
    if end_col is not None:
        # hour of the interval end: 0 for the last hour of a day, not 24
        cols["hour_ending"] = F.hour(local_time(end_col, zone))
    cols["hour_of_day"] = hour_of_day(ts)
    cols["day_of_week"] = day_name(ts)
    cols["is_weekend"] = is_weekend(ts)
    if peak:
        cols["is_peak_hour"] = is_peak_hour(ts)
    return cols
