"""Keep-newest dedupe and keyed upsert as DataFrame operations.

``dedupe_latest`` counts keys first (a hash aggregate over the key columns) and
passes rows whose key is unique through unsorted.  Rows of repeated keys are
numbered newest first and only the first is kept; Spark applies that limit in
each map task before the shuffle, so a key that holds a third of all rows sends
one row per task through it.  The order is total (ties on the order columns are
broken by the other columns, so a re-run picks the same row).

``newest_of_batch`` does the same in one pass over its input, for a batch that is costly to read.

``upsert`` is ``target ⟕anti batch ∪ batch`` on null-safe key equality: a NULL
key matches a NULL key once instead of being inserted again on every run.  ``merge_counted`` is the same,
and observes how many stored rows it replaces and how many of these stay as they were.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F


def dedupe_latest(df: DataFrame, keys: list[str], order_by: list[str] = ("_ingested_at",),
                  tie_break: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by ``order_by`` (descending), ties broken
    by ``tie_break`` and then by every other column."""
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in (tie_break or []) if c not in keys]
    rest += [c for c in df.columns if c not in keys and c not in rest]
    order = order_by + [c for c in rest if c not in order_by]
    # keys seen more than once: counted by hash aggregation over the keys alone
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    rkeys = repeated.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    on = _null_safe_on(df, rkeys, keys, "_r_")
    # rows are ordered only where there is something to choose
    latest = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    chosen = (df.join(rkeys, on, "left_semi").withColumn("_rank", F.row_number().over(latest))
              .filter(F.col("_rank") == 1).drop("_rank"))
    return df.join(rkeys, on, "left_anti").unionByName(chosen)


def newest_of_batch(df: DataFrame, keys: list[str], order_by: list[str] = ("_ingested_at",)) -> DataFrame:
    """``dedupe_latest`` reading its input once: all rows are shuffled by key, a key's rows are cut to the newest in
    each map task before."""
    order = list(order_by) + [c for c in df.columns if c not in keys and c not in order_by]
    latest = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(latest)).filter(F.col("_rank") == 1).drop("_rank")


def _null_safe_on(left: DataFrame, right: DataFrame, keys: list[str], prefix: str):
    return functools.reduce(lambda a, b: a & b,
                            [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys])


def upsert(target: DataFrame, batch: DataFrame, keys: list[str],
           order_by: list[str] = ("_ingested_at",), dedupe_batch: bool = True) -> DataFrame:
    """Target rows whose key is not in the batch, plus the batch rows (a key
    repeated in the batch keeps its newest row).  Columns the batch lacks keep
    the target's value for matched keys and are NULL for new keys."""
    keys = list(keys)
    missing = [k for k in keys if k not in batch.columns or k not in target.columns]
    if missing:
        raise ValueError(f"merge keys {missing} are not in both frames")
    src = dedupe_latest(batch, keys, order_by) if dedupe_batch else batch
    bkeys = src.select(*[F.col(k).alias(f"_b_{k}") for k in keys])
    kept = target.join(bkeys, _null_safe_on(target, bkeys, keys, "_b_"), "left_anti")
    carry = [c for c in target.columns if c not in src.columns]
    if carry:
        # one stored row per key (the newest), so a key the target holds twice
        # (e.g. after an append fallback) does not multiply the batch row
        order = [c for c in order_by if c in target.columns]
        newest = dedupe_latest(target.select(*keys, *order, *carry), keys, order)
        old = newest.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *carry)
        src = (src.join(old, _null_safe_on(src, old, keys, "_b_"), "left")
               .drop(*[f"_b_{k}" for k in keys]))
    return kept.unionByName(src, allowMissingColumns=True)


#: Columns that say how a row came in, not what it holds.
LINEAGE = ("_ingested_at", "_source", "_endpoint")


def merge_counted(target: DataFrame, batch: DataFrame, keys: list[str], order_by: list[str], seen: Observation) -> DataFrame:
    """``upsert`` of a batch without repeated keys; ``seen`` gets ``replaced`` (stored rows whose key is in the batch) and
    ``unchanged`` (those of them that the batch repeats, lineage aside)."""
    content = sorted(c for c in batch.columns if c in target.columns and c not in keys and c not in LINEAGE)

    def digest(df: DataFrame):
        # a column that is null leaves a hash as it is, so its place goes in too
        return F.xxhash64(*[x for i, c in enumerate(content) for x in (F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNull(), F.lit(i)))], F.lit(0))

    same_type = {c: target.schema[c].dataType for c in content}
    typed = batch.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in same_type.items() if batch.schema[c].dataType != t})
    bkeys = typed.select(*[F.col(k).alias(f"_b_{k}") for k in keys], digest(typed).alias("_b_digest"))
    joined = target.join(bkeys, _null_safe_on(target, bkeys, keys, "_b_"), "left")
    matched = F.col("_b_digest").isNotNull()
    joined = joined.observe(seen, F.count_if(matched).alias("replaced"), F.count_if(F.col("_b_digest") == digest(target)).alias("unchanged"))
    kept = joined.filter(~matched).drop("_b_digest", *[f"_b_{k}" for k in keys])
    carry = [c for c in target.columns if c not in batch.columns]
    if carry:
        order = [c for c in order_by if c in target.columns]
        newest = dedupe_latest(target.select(*keys, *order, *carry), keys, order)
        old = newest.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *carry)
        batch = batch.join(old, _null_safe_on(batch, old, keys, "_b_"), "left").drop(*[f"_b_{k}" for k in keys])
    return kept.unionByName(batch, allowMissingColumns=True)
