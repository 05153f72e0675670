"""Reshaping: stacking by name, pivot to one column per point, spreads,
the daily spread summary, and the wide-to-long regional unpivot."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.sources.landing import MEASURES


def combine(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """``unionByName`` of all frames; missing columns are NULL (additive
    schema evolution)."""
    return functools.reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


#: More pivot columns than this is taken for a wrong column.
MOST_PIVOT_VALUES = 10_000


def pivot_first(df: DataFrame, by: list[str], pivot_col: str, values: list[str] | None,
                value: str, order: str) -> DataFrame:
    """One column per pivot value holding ``value`` of the earliest row (by
    ``order``) of that cell, so a cell with two rows (e.g. a repeated local
    hour on a clock change) has a defined result.

    Without ``values`` there is a column for every value in the data (found by one
    small job).  Given ``values`` choose the columns, not the rows: a group that holds
    other values only is still a row.  Written as conditional ``min_by`` aggregates: one
    hash aggregate and one shuffle.
    """
    p = F.col(pivot_col)
    if values is None:
        found = df.filter(p.isNotNull()).select(p.alias("v")).distinct().limit(MOST_PIVOT_VALUES + 1).collect()
        if len(found) > MOST_PIVOT_VALUES:
            raise ValueError(f"{pivot_col} holds over {MOST_PIVOT_VALUES} values")
        values = sorted(r["v"] for r in found)
    aggs = [F.min_by(F.when(p == v, F.col(value)), F.when(p == v, F.col(order))).alias(v)
            for v in values]
    return df.groupBy(*by).agg(*(aggs or [F.first(F.lit(None)).alias("_none")])).drop("_none")


def add_spread(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``a − b`` as ``name`` when both columns exist; the frame unchanged otherwise."""
    if a in df.columns and b in df.columns:
        return df.withColumn(name, F.col(a) - F.col(b))
    return df


def daily_spreads(df: DataFrame, by: str = "delivery_date",
                  spread_cols: list[str] | None = None) -> DataFrame | None:
    """avg, min and max of every spread column per day (None when there is no
    spread column)."""
    spread_cols = spread_cols or [c for c in df.columns if "spread" in c]
    if not spread_cols:
        return None
    aggs = []
    for c in spread_cols:
        aggs += [F.avg(c).alias(f"avg_{c}"), F.min(c).alias(f"min_{c}"),
                 F.max(c).alias(f"max_{c}")]
    return (df.groupBy(by).agg(*aggs)
            .withColumns({"year": F.year(by), "month": F.month(by)}))


#: Fixed value: what follows the metric in a column of the whole system; no region.
SYSTEM = "SYSTEM_WIDE"


def region_columns(columns, metrics: tuple[str, ...] = MEASURES, totals: tuple[str, ...] = (SYSTEM,)) -> dict[str, dict[str, str]]:
    """region -> metric -> column, of columns named ``<METRIC>_<REGION>``.

    Regions are what follows a known metric, ``totals`` excepted: those columns hold sums over regions and are
    no region's.  Any other column that ends in one of these regions is a metric too."""
    known = sorted(metrics, key=len, reverse=True)
    regions: dict[str, dict[str, str]] = {}
    for c in columns:
        m = next((m for m in known if c.startswith(f"{m}_") and len(c) > len(m) + 1), None)
        if m and c[len(m) + 1:] not in totals:
            regions.setdefault(c[len(m) + 1:], {})[m] = c
    taken = {c for own in regions.values() for c in own.values()}
    for c in columns:
        r = max((r for r in regions if c.endswith(f"_{r}") and len(c) > len(r) + 1), key=len, default=None)
        if c not in taken and r and not c.endswith(tuple(f"_{t}" for t in totals)):
            regions[r][c[:-len(r) - 1]] = c
    return regions


def unpivot_regions(df: DataFrame, ids: list[str] | None = None, metrics: tuple[str, ...] = MEASURES,
                    region_col: str = "region", keep_all_null: bool = True) -> DataFrame:
    """Wide ``<METRIC>_<REGION>`` columns to one row per (other columns, region) with one
    lower-case ``<metric>_mw`` column per metric found.

    A generator (``inline`` of an array of structs) in a projection: narrow,
    no shuffle.  Regions and metrics are read from the column names (schema metadata).
    A region lacking one of the metrics gets NULL for it; all columns that aren't
    a region's are carried (totals of the system, and text that ends in a region's name), unless ``ids`` names those to
    keep.
    """
    # measures are numbers, or text under a known metric's name (CSV)
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.NullType))
               or isinstance(f.dataType, T.StringType) and any(f.name.startswith(f"{m}_") for m in metrics)]
    regions = region_columns(numbers, metrics)
    if not regions:
        raise ValueError(f"no <METRIC>_<REGION> columns for metrics {metrics}")
    wide = {c for own in regions.values() for c in own.values()}
    ids = ids if ids is not None else [c for c in df.columns if c not in wide]
    found = sorted({m for own in regions.values() for m in own})
    structs = [F.struct(F.lit(r).alias(region_col),
                        *[(F.col(f"`{own[m]}`").cast("double") if m in own
                           else F.lit(None).cast("double")).alias(f"{m.lower()}_mw") for m in found])
               for r, own in sorted(regions.items())]
    out = df.select(*[F.col(f"`{c}`") for c in ids], F.inline(F.array(*structs)))
    if not keep_all_null:
        out = out.filter(F.coalesce(*[F.col(f"{m.lower()}_mw") for m in found]).isNotNull())
    return out
