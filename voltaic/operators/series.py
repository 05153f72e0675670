"""Ordered-series windows (lags and trailing ROWS frames) without a global sort.

A window with ``orderBy`` and no ``partitionBy`` makes Spark move every row to
one task.  ``lag_roll`` computes the same values in blocks instead:

1. every row gets its global position ``_rn`` in the order: a per-bucket
   ``row_number`` (bucket = a coarse time unit, e.g. the day) plus the number of
   rows in all earlier buckets (a running sum over the small per-bucket count
   table);
2. rows are cut into blocks of ``block_rows`` positions; the last ``halo``
   rows of each block are also emitted into the next block (``explode``), where
   they serve only as history;
3. the window runs per block (``partitionBy(by…, block)``), and the copies are
   dropped again.

A lag of k, or a frame reaching k rows back, is exact when ``k <= halo`` and
``halo <= block_rows``; both are checked.  With entity columns ``by`` the
position is counted per entity, so one large entity is still split into many
blocks.  Frames are ROWS frames, as in the source pipeline: over a gap the
"24 rows" reach further back than 24 hours.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.session import checkpoint_root

_FUNCS = {
    "avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum,
    "stddev": F.stddev_samp, "count": F.count,
}


def _with_offsets(local: DataFrame, offsets: DataFrame, cols: list[str]) -> DataFrame:
    """``local`` with the ``_off`` of its (``cols``) cell; NULL-safe on the
    keys, so rows with a NULL entity or time are kept."""
    o = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in cols], "_off")
    on = functools.reduce(lambda a, b: a & b,
                          [local[c].eqNullSafe(o[f"_o_{c}"]) for c in cols])
    return local.join(o, on, "inner").drop(*[f"_o_{c}" for c in cols])


def position_index(df: DataFrame, order: list[str], by: list[str] = (),
                   bucket: Column | None = None, name: str = "_rn", *,
                   method: str = "bucket", partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (per ``by`` entity).

    ``order`` must be a total order within an entity (append a tie-break
    column otherwise), so positions are reproducible when a task is re-run.

    ``method="bucket"`` numbers rows per (entity, bucket) — the bucket is the
    day of ``order[0]`` by default, so a regular hourly series has at most 24
    rows per entity-day, whatever the table size.  ``method="range"`` has no
    such assumption: the rows are range-partitioned on (entity, order) — the
    bounds come from a sample, so a bucket or entity with a third of the rows
    is cut into many partitions — and checkpointed to the shared folder; the
    position is the row number inside a partition plus the rows of the entity
    in earlier partitions.
    """
    by = list(by)
    if method == "range":
        spark = df.sparkSession
        checkpoint_root(spark)
        n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        staged = (df.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order)
                  .checkpoint(eager=True).withColumn("_bkt", F.spark_partition_id()))
    elif method == "bucket":
        bucket = bucket if bucket is not None else F.date_trunc("day", F.col(order[0]))
        staged = df.withColumn("_bkt", bucket)
    else:
        raise ValueError("method must be 'bucket' or 'range'")
    local = staged.withColumn(
        "_lrn", F.row_number().over(Window.partitionBy(*by, "_bkt").orderBy(*order)) - 1)
    counts = staged.groupBy(*by, "_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*by).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_bkt", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    return (_with_offsets(local, offsets, [*by, "_bkt"])
            .withColumn(name, F.col("_off") + F.col("_lrn"))
            .drop("_bkt", "_lrn", "_off"))


def lag_roll(df: DataFrame, order: list[str], value: str, *,
             lags: dict[str, int] | None = None,
             frames: dict[str, tuple[str, int, int]] | None = None,
             by: list[str] = (), block_rows: int | None = None,
             bucket: Column | None = None, method: str = "bucket") -> DataFrame:
    """Add ``lags`` (name → k: value k rows earlier) and trailing ROWS-frame
    aggregates ``frames`` (name → (func, lower, upper), e.g.
    ``("avg", -24, -1)``) of ``value`` over ``order`` (per ``by`` entity).
    ``method`` is how rows are numbered (``position_index``)."""
    lags, frames, by = dict(lags or {}), dict(frames or {}), list(by)
    for fn, lo, hi in frames.values():
        if fn not in _FUNCS:
            raise ValueError(f"unknown frame function {fn}")
        if hi > 0 or lo > hi:
            raise ValueError("only trailing frames (lower <= upper <= 0) are supported")
    halo = max([*lags.values(), *[-lo for _, lo, _ in frames.values()], 1])
    block_rows = block_rows or max(64 * halo, 4096)
    if block_rows < halo:
        raise ValueError(f"block_rows ({block_rows}) must be >= the longest reach ({halo})")

    indexed = position_index(df, order, by, bucket, method=method)
    own = F.floor(F.col("_rn") / block_rows)
    # a row in the last `halo` positions of its block is also sent to the next
    # block (one generator, so the input is read once, not once per copy)
    in_halo = F.col("_rn") % block_rows >= block_rows - halo
    staged = indexed.withColumn("_own", own).withColumn(
        "_blk", F.explode(F.when(in_halo, F.array(own, own + 1)).otherwise(F.array(own))))
    w = Window.partitionBy(*by, "_blk").orderBy("_rn")
    v = F.col(value)
    cols = {n: F.lag(v, k).over(w) for n, k in lags.items()}
    cols.update({n: _FUNCS[fn](v).over(w.rowsBetween(lo, hi))
                 for n, (fn, lo, hi) in frames.items()})
    return (staged.withColumns(cols)
            .filter(F.col("_blk") == F.col("_own")).drop("_rn", "_blk", "_own"))


def roll_by_entity(df: DataFrame, by: list[str], order: list[str], value: str,
                   frames: dict[str, tuple[str, int, int]]) -> DataFrame:
    """Trailing ROWS frames as a plain window per entity: for entities whose rows are bounded
    (one a day, say).  One shuffle and one sort; ``lag_roll`` cuts longer ones into blocks."""
    w = Window.partitionBy(*by).orderBy(*order)
    v = F.col(value)
    return df.withColumns({n: _FUNCS[fn](v).over(w.rowsBetween(lo, hi)) for n, (fn, lo, hi) in frames.items()})


def range_roll(df: DataFrame, time_col: str, value: str, frames: dict[str, tuple[str, int, int]],
               by: list[str] = (), block_seconds: int | None = None, method: str = "rows") -> DataFrame:
    """Trailing RANGE frames over time: name -> (func, lower, upper) in seconds before the row's own
    time (e.g. ``("avg", -86400, -3600)``: the last day up to an hour ago), whatever
    gaps the series has.  Several rows of one time see each other if ``upper`` is 0.

    Time is cut into spans as long as a frame, so that a frame is the end of one span and the beginning of the next:
    ``_met`` adds values up from the beginning of each span and from its end, once, whatever a frame holds, and a frame is put
    together from two of these.  A task holds the rows of an entity in a span; nothing is subtracted, so a value that
    isn't finite is in no frame but those that hold it.  (``block_seconds`` says how long blocks of time may be at least; spans are
    no longer than the frames.)

    ``method="cells"`` is for spans in which very many rows fall: rows are first added up by second (all that share one have
    the same frames), before the shuffle, so that a span holds a row a second at most; frames are made over these.
    Sums are taken around the mean of each entity, so deviations have an error of about 1e-10 of the entity's spread.

    Either way frames are joined to the rows by second, a join that adaptive execution splits where one second has most rows.
    """
    for fn, lo, hi in frames.values():
        if fn not in _FUNCS:
            raise ValueError(f"unknown frame function {fn}")
        if hi > 0 or lo > hi:
            raise ValueError("only trailing frames (lower <= upper <= 0) are supported")
    reach = max([-lo for _, lo, _ in frames.values()], default=0)
    if block_seconds and block_seconds < reach:
        raise ValueError(f"block_seconds ({block_seconds}) must be >= the longest reach ({reach})")
    if method not in ("rows", "cells"):
        raise ValueError("method must be 'rows' or 'cells'")
    if not frames:
        return df
    by = list(by)
    at = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(time_col).cast("timestamp_ntz"))
    staged = df.withColumn("_at", at)
    spans = sorted({(lo, hi) for _, lo, hi in frames.values()})
    if method == "cells":
        parts = {p: fn for p, fn in _CELL_PARTS.items() if any(p in _CELL_NEEDS[f] for f, _, _ in frames.values())}
        met = _met(_cells(staged, value, by), spans, {p: _FUNCS[fn](p) for p, fn in parts.items()}, by, keep=["_mean"])
        made = {n: _over_cells(fn, spans.index((lo, hi))) for n, (fn, lo, hi) in frames.items()}
    else:
        v = F.col(value)
        number = v if isinstance(df.schema[value].dataType, T.DecimalType) else v.cast("double")
        parts = {"_n": F.count(v), "_lo": F.min(v), "_hi": F.max(v), "_s": F.sum(v), "_t": F.sum(number), "_m": F.avg(number),
                 "_d": F.var_pop(v)}
        parts = {p: c for p, c in parts.items() if any(p in _ROW_NEEDS[f] for f, _, _ in frames.values())}
        points = staged.filter(F.col("_at").isNotNull()).select(*by, "_at", value)
        met = _met(points, spans, parts, by)
        types = df.agg(*[_FUNCS[fn](v).alias(n) for n, (fn, _, _) in frames.items()]).schema
        made = {n: _over_rows(fn, spans.index((lo, hi))).cast(types[n].dataType) for n, (fn, lo, hi) in frames.items()}
    keys = [*by, "_at"]
    found = met.select(*[F.col(k).alias(f"_f_{k}") for k in keys], *[c.alias(f"_g_{n}") for n, c in made.items()])
    on = functools.reduce(lambda a, b: a & b, [staged[k].eqNullSafe(found[f"_f_{k}"]) for k in keys])
    # rows without a time keep their row, with empty frames, and are in no other row's
    joined = staged.join(found, on, "left").drop(*[f"_f_{k}" for k in keys], "_at")
    joined = joined.withColumns({n: F.coalesce(f"_g_{n}", F.lit(0)) if fn == "count" else F.col(f"_g_{n}") for n, (fn, _, _) in frames.items()})
    return joined.drop(*[f"_g_{n}" for n in frames])


def _met(points: DataFrame, spans: list[tuple[int, int]], parts: dict[str, Column], by: list[str], keep: list[str] = ()) -> DataFrame:
    """For every entity and second of ``points`` (``by``, ``_at``, values): what each frame of ``spans`` (lower, upper) holds, as
    ``parts`` of its two pieces: ``<part>_<i>_0`` from the frame's lower end to the end of the span that this is in, and
    ``<part>_<i>_1`` from there to its upper end.  A frame that is one whole span is a second piece only.

    Each point goes to its own span as a value, and to the spans in which its frames begin and end as a question."""
    values = [c for c in points.columns if c not in (*by, "_at", *keep)]
    kind = lambda i, side, shift: F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), (F.col("_at") + shift).alias("key"), F.lit(spans[i][1] - spans[i][0] + 1).alias("w"))  # noqa: E731, E501
    roles = [kind(i, side, shift) for i, (lo, hi) in enumerate(spans) for side, shift in ((-1, 0), (0, lo), (1, hi))]
    rows = points.withColumn("_r", F.explode(F.array(*roles))).filter("_r.side != 0 OR pmod(_r.key, _r.w) != 0")
    rows = rows.select(*by, "_at", *keep, *[F.when(F.col("_r.side") == -1, F.col(c)).alias(c) for c in values],
                       F.col("_r.i").alias("_i"), F.col("_r.side").alias("_side"), F.col("_r.key").alias("_key"),
                       F.floor(F.col("_r.key") / F.col("_r.w")).alias("_span"))
    # dealt out over all shuffle partitions, which adaptive execution would join until a task sorts millions of rows
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, *by, "_i", "_span")
    w = Window.partitionBy(*by, "_i", "_span")
    # seconds that are equal see each other both ways
    onward, back = (w.orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in ("_key", F.desc("_key")))
    rows = rows.withColumns({f"{p}_1": c.over(onward) for p, c in parts.items()} | {f"{p}_0": c.over(back) for p, c in parts.items()})
    pieces = [F.max(F.when((F.col("_i") == i) & (F.col("_side") == side), F.col(f"{p}_{side}"))).alias(f"{p}_{i}_{side}")
              for i in range(len(spans)) for side in (0, 1) for p in parts]
    return rows.filter("_side >= 0").groupBy(*by, "_at").agg(*pieces, *[F.max(c).alias(c) for c in keep])


#: What a frame's function takes of the parts of rows.
_ROW_NEEDS = {"count": ("_n",), "min": ("_lo",), "max": ("_hi",), "sum": ("_s",), "avg": ("_t", "_n"), "stddev": ("_n", "_m", "_d")}


def _added(part: str, i: int) -> Column:
    a, b = F.col(f"{part}_{i}_0"), F.col(f"{part}_{i}_1")
    return F.coalesce(a + b, a, b)


def _over_rows(fn: str, i: int) -> Column:
    """A frame's value from its two pieces."""
    if fn in ("min", "max"):
        part, pick = ("_lo", F.least) if fn == "min" else ("_hi", F.greatest)
        return pick(f"{part}_{i}_0", f"{part}_{i}_1")
    if fn == "sum":
        return _added("_s", i)
    n = _added("_n", i)
    if fn == "count":
        return n
    if fn == "avg":
        return F.try_divide(_added("_t", i), n)
    between = F.col(f"_m_{i}_1") - F.col(f"_m_{i}_0")
    own = [F.col(f"_d_{i}_{side}") * F.col(f"_n_{i}_{side}") for side in (0, 1)]
    spread = F.coalesce(own[0] + own[1], *own) + F.coalesce(between * between * F.col(f"_n_{i}_0") * F.try_divide(F.col(f"_n_{i}_1"), n), F.lit(0.0))
    return F.when(n > 1, F.sqrt(spread / (n - 1)))


def _cells(rows: DataFrame, value: str, by: list[str]) -> DataFrame:
    """One row per entity and second: count, sum and squares of the values around the entity's mean, and their extremes."""
    v = F.col(value)
    means = rows.groupBy(*by).agg(F.coalesce(F.avg(v), F.lit(0.0)).alias("_mean")).select(*[F.col(k).alias(f"_m_{k}") for k in by], "_mean")
    timed = rows.filter(F.col("_at").isNotNull()).select(*by, "_at", v.cast("double").alias("_v"))
    # a value and its count, added up before the means are joined to what is left
    sums = timed.groupBy(*by, "_at").agg(F.count("_v").alias("_n"), F.sum("_v").alias("_s"), (F.var_pop("_v") * F.count("_v")).alias("_d"),
                                         F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    on = functools.reduce(lambda a, b: a & b, [sums[k].eqNullSafe(means[f"_m_{k}"]) for k in by], F.lit(True))
    off = F.col("_s") - F.col("_n") * F.col("_mean")
    return sums.join(means, on).drop(*[f"_m_{k}" for k in by]).withColumns({
        "_s": F.when(F.col("_n") > 0, off), "_q": F.col("_d") + F.try_divide(off * off, F.col("_n"))})


#: How cells add up, and what a frame's function takes of them.
_CELL_PARTS = {"_n": "sum", "_s": "sum", "_q": "sum", "_lo": "min", "_hi": "max"}
_CELL_NEEDS = {"count": ("_n",), "min": ("_lo",), "max": ("_hi",), "sum": ("_n", "_s"), "avg": ("_n", "_s"), "stddev": ("_n", "_s", "_q")}


def _over_cells(fn: str, i: int) -> Column:
    """A frame's value from the cells in its two pieces."""
    if fn in ("min", "max"):
        return _over_rows(fn, i)
    n = _added("_n", i)
    if fn == "count":
        return n
    s = _added("_s", i)
    if fn == "sum":
        return s + n * F.col("_mean")
    if fn == "avg":
        return F.try_divide(s, n) + F.col("_mean")
    spread = F.greatest(F.lit(0.0), _added("_q", i) - F.try_divide(s * s, n))
    return F.when(n > 1, F.sqrt(spread / (n - 1)))
