"""A Bloom filter of the keys in each partition of a table, built and asked with built-in functions.

Where the partition isn't a function of the key, the older version of a key may be in any partition.
The filter says which partitions can't hold any key of a batch; the others are checked exactly.

A partition's filter is cut into buckets of 32,768 bits, a row each (``bitmap_construct_agg``); all
``PROBES`` bits of a key are in one bucket, so that a key asks for one row a partition.  The number of
buckets is a power of two, so that partitions of any size share a few numbers and the keys of a
batch meet the buckets in one equi-join.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bucket (the size of Spark's bitmaps), bits a key and bits set for a key.
BUCKET_BITS = 32_768
KEY_BITS = 32
PROBES = 12
#: Most keys a task gets to sort the bits of, in the mean.
TASK_KEYS = 250_000


def _hashes(keys: list[Column]) -> list[Column]:
    """Two hashes of a key; null is a value like others."""
    tagged = [F.coalesce(k, F.lit("\u0000null")) for k in (k.cast("string") for k in keys)]
    return [F.xxhash64(F.lit(seed), *tagged) for seed in (1, 2)]


def _positions(h: Column) -> Column:
    """The bits of a key in its bucket: a start, a step and its change from 15 bits of the hash each, so that hardly any
    two keys of a bucket have all bits in common."""
    start, step, turn = (F.pmod(F.shiftrightunsigned(h, shift), F.lit(BUCKET_BITS)) for shift in (1, 20, 40))
    return F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)),
                       lambda i: F.pmod(start + i * (step + 1) + (i * (i - 1) / 2).cast("long") * turn, F.lit(BUCKET_BITS)))


def build(rows: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """``parts``, buckets (how many the partition has), bucket and bits: the filters of the partitions in ``rows``."""
    sizes = rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n"))
    need = F.greatest(F.lit(1.0), F.col("_n") * F.lit(KEY_BITS / BUCKET_BITS))
    sizes = sizes.select(*[F.col(p).alias(f"_s_{p}") for p in parts], F.pow(F.lit(2.0), F.ceil(F.log2(need))).cast("int").alias("buckets"))
    where, which = _hashes([F.col(k) for k in keys])
    # a key that many rows share sets its bits once
    own = rows.select(*parts, where.alias("_where"), which.alias("_which")).distinct().alias("r")
    on = functools.reduce(lambda a, b: a & b, [F.col(f"r.{p}").eqNullSafe(F.col(f"_s_{p}")) for p in parts])
    hashed = own.join(sizes, on).select(
        *[F.col(f"r.{p}").alias(p) for p in parts], "buckets", F.pmod("_where", F.col("buckets")).cast("int").alias("bucket"), "_which")
    # keys are dealt out by bucket before each becomes a row a bit, which are sorted: over all shuffle partitions, and
    # over more where there are more keys than those should sort
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / TASK_KEYS))
    hashed = hashed.repartition(n, *parts, "buckets", "bucket").withColumn("_at", F.explode(_positions(F.col("_which"))))
    return hashed.groupBy(*parts, "buckets", "bucket").agg(F.bitmap_construct_agg("_at").alias("bits"))


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def candidates(filters: DataFrame, batch: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """The partitions (distinct ``parts``) whose filter may hold a key of ``batch``: all that do, and a few that don't."""
    numbers = [r["buckets"] for r in filters.select("buckets").distinct().collect()]  # powers of two
    where, which = _hashes([F.col(k) for k in keys])
    asked = batch.select(where.alias("_where"), which.alias("_which")).distinct()
    asked = asked.select("_which", "_where", F.explode(F.array(*[F.lit(n) for n in numbers] or [F.lit(0)])).alias("buckets")).where(
        "buckets > 0").select("_which", "buckets", F.pmod("_where", F.col("buckets")).cast("int").alias("bucket"))
    met = filters.join(asked, ["buckets", "bucket"])
    return met.where(F.forall(_positions(F.col("_which")), lambda at: _is_set(F.col("bits"), at))).select(*parts).distinct()
