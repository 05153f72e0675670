"""Sorted previews and top-k.  ``orderBy().limit(n)`` plans as
TakeOrderedAndProject: each task keeps its own top n, so only n rows per task
reach the final merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, order: str | list[str], n: int = 100, descending: bool = True) -> DataFrame:
    cols = [order] if isinstance(order, str) else list(order)
    keys = [F.col(c).desc() if descending else F.col(c).asc() for c in cols]
    return df.orderBy(*keys).limit(n)


def sort_by(df: DataFrame, *keys) -> DataFrame:
    """Full ordered output (range-partitioned sort, no single-task sort)."""
    return df.orderBy(*keys)
