"""Forecast-error, curtailment and ratio expressions.

Every division goes through ``try_divide`` so that a zero denominator gives
NULL instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct_of(part, total) -> Column:
    """``part / total * 100``; NULL when total is 0 or NULL."""
    return F.try_divide(_c(part), _c(total)) * F.lit(100.0)


def forecast_error(actual, forecast) -> Column:
    """``forecast − actual``; NULL when the actual is NULL."""
    a, f = _c(actual), _c(forecast)
    return F.when(a.isNotNull(), f - a)


def forecast_error_pct(actual, forecast) -> Column:
    """Error as % of the actual, only where the actual is positive."""
    a, f = _c(actual), _c(forecast)
    return F.when(a.isNotNull() & (a > 0), (f - a) / a * F.lit(100.0))


def curtailment(actual, limit) -> Column:
    """``limit − actual`` when both are present and the limit is higher, else 0."""
    a, h = _c(actual), _c(limit)
    return (F.when(h.isNotNull() & a.isNotNull() & (h > a), h - a)
            .otherwise(F.lit(0.0)))
