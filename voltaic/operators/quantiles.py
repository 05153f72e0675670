"""Exact quantiles for groups of any size.

Spark's ``percentile`` keeps a map of every distinct value of a group and
merges a group's maps in one task, so a group holding a third of all rows
(with many distinct values) would sit in one task.  ``exact_quantiles`` gives
the same values (linear interpolation between the two nearest ranks, as
``percentile``) without that:

1. rows are counted per (group, value): repeated values collapse on the map
   side, and a hot group is spread over the reducers by its values;
2. the distinct (group, value) rows are range-partitioned and sorted by
   (group, value) — the range bounds come from a sample, so a hot group is cut
   into many partitions — and checkpointed to the shared folder, which fixes
   the partition of every row (and cuts the lineage);
3. a group's rank offset in each partition is a running sum over the small
   (partition, group) count table; the rank inside a partition is a running sum
   over that partition's part of the group only;
4. per group and quantile, the two values at the neighbouring ranks are picked
   with conditional aggregates (partial aggregation, one row per group).

Every window is bounded by the size of one range partition or by the number
of range partitions; nothing holds a whole group.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltaic.session import checkpoint_root


def exact_quantiles(df: DataFrame, by: list[str], value: str, quantiles, *,
                    names: list[str] | None = None,
                    partitions: int | None = None) -> DataFrame:
    """One row per group of ``by`` (NULL keys form a group) with one double
    column per quantile (``names``, default ``q_<i>``): the exact quantile of
    the non-NULL ``value``s, equal to ``percentile(value, q)``.  The range
    partitioning and checkpoint run when this is called; the rest is lazy."""
    by, quantiles = list(by), list(quantiles)
    names = names or [f"q_{i}" for i in range(len(quantiles))]
    spark = df.sparkSession
    checkpoint_root(spark)          # make sure a (shared) checkpoint folder is set
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = F.col(value).cast("double")
    counted = (df.where(F.col(value).isNotNull())
               .groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    ranged = (counted.repartitionByRange(n_parts, *by, "_v")
              .sortWithinPartitions(*by, "_v")
              .checkpoint(eager=True)
              .withColumn("_pid", F.spark_partition_id()))
    # rank offset of each group in each range partition, and the group size
    per_part = ranged.groupBy("_pid", *by).agg(F.sum("_c").alias("_t"))
    wg = Window.partitionBy(*by)
    offsets = per_part.select(
        "_pid", *by,
        F.coalesce(F.sum("_t").over(wg.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_t").over(wg).alias("_n"))
    # rank range [start, end) of every distinct value inside its partition
    wl = (Window.partitionBy("_pid", *by).orderBy("_v")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn("_end", F.sum("_c").over(wl))
    o = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in ["_pid", *by]], "_off", "_n")
    on = functools.reduce(lambda a, b: a & b,
                          [local[c].eqNullSafe(o[f"_o_{c}"]) for c in ["_pid", *by]])
    ranked = local.join(o, on, "inner").select(
        *by, "_v", "_n",
        (F.col("_off") + F.col("_end") - F.col("_c")).alias("_start"),
        (F.col("_off") + F.col("_end")).alias("_stop"))

    def at(rank):
        hit = (F.col("_start") <= rank) & (rank < F.col("_stop"))
        return F.max(F.when(hit, F.col("_v")))

    aggs = []
    for i, q in enumerate(quantiles):
        pos = F.lit(float(q)) * (F.col("_n") - F.lit(1)).cast("double")
        aggs += [at(F.floor(pos)).alias(f"_lo{i}"), at(F.ceil(pos)).alias(f"_hi{i}"),
                 F.max(pos).alias(f"_pos{i}")]
    picked = ranked.groupBy(*by).agg(*aggs)
    out = {}
    for i, name in enumerate(names):
        pos, lo, hi = F.col(f"_pos{i}"), F.col(f"_lo{i}"), F.col(f"_hi{i}")
        # the same interpolation as Spark's percentile
        out[name] = F.when(F.floor(pos) == F.ceil(pos), lo).otherwise(
            (F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi)
    return picked.select(*by, *[c.alias(n) for n, c in out.items()])


def with_exact_quantiles(grouped: DataFrame, df: DataFrame, by: list[str], value: str,
                         quantiles, names: list[str], **kw) -> DataFrame:
    """``grouped`` (one row per group of ``by``) with the exact quantile
    columns joined on (NULL-safe group keys).  Groups whose values are all
    NULL get NULL quantiles."""
    if not by:
        raise ValueError("with_exact_quantiles needs group keys; use exact_quantiles for one group")
    q = exact_quantiles(df, by, value, quantiles, names=names, **kw)
    qk = q.select(*[F.col(c).alias(f"_q_{c}") for c in by], *names)
    on = functools.reduce(lambda a, b: a & b,
                          [grouped[c].eqNullSafe(qk[f"_q_{c}"]) for c in by])
    return grouped.join(qk, on, "left").drop(*[f"_q_{c}" for c in by])
