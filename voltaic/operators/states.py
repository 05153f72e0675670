"""Mergeable states of grouped measures.

A profile over all of history (by hour of day, by weekday, by point and hour) is kept as one row a group and
partition of the table it is made from: how many values, their sum, squared deviations, extremes, and
the values themselves or a sketch of them where quantiles are asked for.  When a partition changes, its states are made again
from it alone; the profile is merged from the states, without reading the table.

Deviations are merged around the mean of the whole group, so that large means cost no digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Size of a KLL sketch, and a bound of the rank error of its quantiles (1.65 % at 200, about as 1 / k ** 0.9).
SKETCH_K, RANK_ERROR = 400, 0.0133


def state(df: DataFrame, parts: list[str], by: list[str], values: dict[str, Column], *, quantiles: dict[str, str] | None = None) -> DataFrame:
    """One row per partition and group: rows, and for each named value its count, sum, squared deviations, min and max.

    ``quantiles`` names the values whose quantiles will be asked for, and how they are kept: ``values`` (all of them, sorted: for
    groups with a bounded number of values a partition) or ``sketch`` (a KLL sketch of bounded size)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for name, v in values.items():
        aggs += [F.count(v).alias(f"{name}_n"), F.sum(v).alias(f"{name}_sum"), (F.var_pop(v) * F.count(v)).alias(f"{name}_dev"),
                 F.min(v).alias(f"{name}_min"), F.max(v).alias(f"{name}_max")]
        kind = (quantiles or {}).get(name)
        if kind == "values":
            aggs.append(F.sort_array(F.collect_list(v)).alias(f"{name}_values"))
        elif kind == "sketch":
            aggs.append(F.kll_sketch_agg_double(v.cast("double"), F.lit(SKETCH_K)).alias(f"{name}_sketch"))
        elif kind is not None:
            raise ValueError("quantiles are kept as 'values' or as a 'sketch'")
    return df.groupBy(*parts, *by).agg(*aggs)


def merged(states: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """One row per group over all partitions, with the columns of ``state`` but values and sketches."""
    group = Window.partitionBy(*by)
    mean = {n: F.sum(f"{n}_sum").over(group) / F.sum(f"{n}_n").over(group) for n in names}
    around = states.withColumns({f"_{n}_mean": m for n, m in mean.items()})
    aggs = [F.sum("rows").alias("rows")]
    for n in names:
        off = F.try_divide(F.col(f"{n}_sum"), F.col(f"{n}_n")) - F.col(f"_{n}_mean")
        aggs += [F.sum(f"{n}_n").alias(f"{n}_n"), F.sum(f"{n}_sum").alias(f"{n}_sum"),
                 F.sum(F.col(f"{n}_dev") + F.col(f"{n}_n") * off * off).alias(f"{n}_dev"),
                 F.min(f"{n}_min").alias(f"{n}_min"), F.max(f"{n}_max").alias(f"{n}_max")]
    return around.groupBy(*by).agg(*aggs)


def mean(name: str) -> Column:
    return F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n"))


def stddev(name: str) -> Column:
    """Sample standard deviation; NULL for fewer than two values."""
    return F.when(F.col(f"{name}_n") > 1, F.sqrt(F.col(f"{name}_dev") / (F.col(f"{name}_n") - 1)))


def quantiles(states: DataFrame, by: list[str], name: str, qs, names: list[str], how: str = "percentile") -> DataFrame:
    """One row per group with the quantiles ``qs`` of a value over all partitions.

    ``percentile`` interpolates and ``percentile_approx`` takes a value, both from the values kept; ``sketch`` merges the sketches (rank error
    below ``RANK_ERROR`` with 99 %)."""
    if how == "sketch":
        sketch = states.where(F.col(f"{name}_n") > 0).groupBy(*by).agg(F.kll_merge_agg_double(F.col(f"{name}_sketch"), F.lit(SKETCH_K)).alias("_s"))
        return sketch.select(*by, *[F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(n) for q, n in zip(qs, names)])
    of = {"percentile": F.percentile, "percentile_approx": F.percentile_approx}[how]
    each = states.select(*by, F.explode(f"{name}_values").alias("_v"))
    return each.groupBy(*by).agg(of("_v", list(qs)).alias("_q")).select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def with_quantiles(out: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """``out`` with the columns of ``found``, by group (NULL is a group); groups without a value have none."""
    other = found.withColumnsRenamed({c: f"_q_{c}" for c in by})
    on = F.lit(True)
    for c in by:
        on = on & out[c].eqNullSafe(other[f"_q_{c}"])
    return out.join(other, on, "left").drop(*[f"_q_{c}" for c in by])
