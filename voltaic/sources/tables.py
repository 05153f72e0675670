"""Table sinks on plain parquet directories: partitioned append/overwrite,
keyed upsert that rewrites only the partitions a batch touches, keep-newest
dedupe of a stored table, and run-stamped backups.

A table is never overwritten from a plan that still reads it: the new content
is first written to a staging directory under the shared checkpoint folder
(which also cuts the lineage), takes effect by a commit that is carried out again after a
crash (``redo``), and the staging directory is deleted.
"""

from __future__ import annotations

import datetime as dt
import functools
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from voltaic.operators import keyindex
from voltaic.operators.merge import dedupe_latest, newest_of_batch
from voltaic.operators.merge import merge_counted as upsert
from voltaic.session import scratch_path
from voltaic.sources import files, redo, schemas
from voltaic.sources.landing import LOAD_TYPES, stamp_lineage
from voltaic.sources.registry import Source

_PART_FUNCS = {"year": F.year, "month": F.month, "day": F.dayofmonth}


def with_date_parts(df: DataFrame, time_col: str | None = None,
                    parts=("year", "month", "day")) -> DataFrame:
    """``year/month/day`` from the time column (``Interval_Start``, else
    ``Time``); the frame unchanged when it has neither."""
    if time_col is None:
        time_col = next((c for c in ("Interval_Start", "Time") if c in df.columns), None)
    if time_col is None:
        return df
    return df.withColumns({p: _PART_FUNCS[p](F.col(time_col)) for p in parts})


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table stands at ``path`` (one folder listing)."""
    return files.has_data(spark, path)


def read_table(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """The stored table, with the columns of all its files (appends may have added some, or changed a
    type: ``schemas.read_merged``); ``merge_schema=False`` reads one file's schema, where it is known to be
    the only one."""
    return schemas.read_merged(spark, [path]) if merge_schema else spark.read.parquet(path)


def write_partitioned(df: DataFrame, path: str, parts=(), mode: str = "append") -> None:
    """``append`` adds files (readers evolve the schema with ``mergeSchema``);
    ``overwrite`` replaces the whole table; ``replace_partitions`` replaces
    only the partitions present in ``df``.

    Rows are dealt out by partition first (a rebalance, which adaptive execution splits where
    a partition is large and joins where they are small), so that a partition gets a few files
    and not one from every task."""
    if parts:
        df = df.hint("rebalance", *[F.col(p) for p in parts])
    w = df.write.format("parquet")
    if mode == "replace_partitions":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        w = w.mode("overwrite").option("partitionOverwriteMode", "static")
    else:
        w = w.mode(mode)
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)


def _stage(spark: SparkSession, df: DataFrame, name: str, parts=()) -> str:
    """Write a frame to the shared scratch folder; returns where."""
    path = scratch_path(spark, f"stage-{name}")
    write_partitioned(df, path, parts, "overwrite")
    return path


class _Kept:
    """Names the folder of staged rows in an error raised in its block (what fails before a commit has an intent
    leaves them behind)."""

    def __init__(self, path: str):
        self.path = path

    def __enter__(self) -> str:
        return self.path

    def __exit__(self, kind, error, trace) -> bool:
        if error is not None:
            error.add_note(f"the staged rows are kept at {self.path}")
        return False


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], *,
                 time_col: str, parts=("year", "month"), order_by=("_ingested_at",),
                 on_missing_key: str = "error", counts: bool = False) -> dict:
    """Merge ``batch`` into the table at ``path`` by ``keys``.

    The batch is evaluated once, deduplicated, into a staged copy, from which everything
    else is derived.  First load: it is written.  Later loads: only the partitions the batch
    touches are read, merged (``merge.merge_counted``), staged and put in the place of the old ones by a
    commit that a crash can't leave half done (``redo``); all other partitions are not read or rewritten.
    Where the partition is no function of the key, Bloom filters (``keyindex``) say which other
    partitions may hold a key of the batch.  A batch without a key column raises, unless ``on_missing_key='append'``; so does
    one whose types have no common type with the table's.

    ``counts`` adds what the writing jobs saw: rows_in, rows (after the newest of each key is chosen), inserted,
    updated, unchanged (stored rows that the batch repeats, lineage aside) and the partitions changed.  A task that
    Spark runs again after an executor is lost may be counted twice.
    """
    missing = [k for k in keys if k not in batch.columns]
    batch, parts = with_date_parts(batch, time_col, parts), tuple(parts)
    redo.recover(spark, path)
    if missing:
        if on_missing_key != "append":
            raise ValueError(f"merge keys {missing} not in batch columns {batch.columns}")
        return _append(spark, path, batch, parts, counts)
    here = table_exists(spark, path)
    seen = Observation()
    at = [F.collect_set(F.struct(*parts)).alias("parts")] if parts else []
    newest = newest_of_batch(batch.observe(rows_in := Observation(), F.count(F.lit(1)).alias("n")), keys, list(order_by))
    newest = newest.observe(seen, F.count(F.lit(1)).alias("n"), *at)
    if here:
        schemas.conform(newest, (stored := read_table(spark, path, merge_schema=False)).schema)
    staged = _stage(spark, newest, "batch", () if here else parts)
    with _Kept(staged):
        touched = {tuple(v) for v in seen.get["parts"]} if parts else set()
        report = {"rows_in": rows_in.get["n"], "rows": seen.get["n"], "inserted": seen.get["n"], "updated": 0, "unchanged": 0,
                  "changed": sorted(touched, key=str)}
        if not here:
            redo.commit(spark, path, staged, newest.schema, parts, mode="overwrite", changed=touched)
            _index(spark, path, parts, keys, time_col, touched)
            return {"action": "create", "path": path} | (report if counts else {})
        if not report["rows"]:
            files.delete(spark, staged)
            return {"action": "none", "path": path, "partitions": 0} | (report if counts else {})
        own = spark.read.schema(newest.schema).parquet(staged)
        out, replaced = _merge_staged(spark, path, own, keys, time_col, parts, list(order_by), stored, touched)
        files.delete(spark, staged)
    report |= {"inserted": report["rows"] - replaced["replaced"], "updated": replaced["replaced"] - replaced["unchanged"],
               "unchanged": replaced["unchanged"], "changed": replaced["changed"]}
    return out | (report if counts else {})


def _append(spark: SparkSession, path: str, batch: DataFrame, parts, counts: bool) -> dict:
    seen = Observation()
    at = [F.collect_set(F.struct(*parts)).alias("parts")] if parts else []
    if table_exists(spark, path):
        schemas.conform(batch, read_table(spark, path, merge_schema=False).schema)
    else:
        redo.record(spark, path, None)
    write_partitioned(batch.observe(seen, F.count(F.lit(1)).alias("n"), *at), path, parts, "append")
    changed = sorted({tuple(v) for v in seen.get["parts"]}, key=str) if parts else []
    redo.record(spark, path, changed)
    n = seen.get["n"]
    report = {"rows_in": n, "rows": n, "inserted": n, "updated": 0, "unchanged": 0, "changed": changed}
    return {"action": "append", "path": path} | (report if counts else {})


def _merge_staged(spark, path, batch, keys, time_col, parts, order_by, stored, batch_parts) -> tuple[dict, dict]:
    touched = set(batch_parts)
    indexed = bool(parts) and time_col not in keys
    if indexed:
        # the partition is not a function of the key: an older version of a batch key may sit in a
        # partition the batch does not touch, so those partitions are merged too
        touched |= _other_partitions(spark, path, batch, keys, parts, stored, batch_parts)
    target = (_read_partitions(spark, path, parts, touched, like=stored) if parts
              else read_table(spark, path))
    target, batch = target.drop(*parts), batch.drop(*parts)
    schema = schemas.conform(batch, target.schema)
    want = {f.name: f.dataType for f in schema.fields}
    target, batch = (df.select(*[schemas.widened(F.col(f"`{f.name}`"), f.dataType, want[f.name], f.name).alias(f.name)
                                 for f in df.schema.fields]) for df in (target, batch))
    seen = Observation()
    merged = with_date_parts(upsert(target, batch, keys, order_by, seen), time_col, parts)  # partitions always from the time column
    staged = _stage(spark, merged, "upsert", parts)
    with _Kept(staged):
        drop = set()
        if parts and touched - batch_parts:
            # replacing leaves a partition alone when the merge emptied it (all its rows moved to
            # another partition): those are dropped
            drop = touched - set(files.partition_dirs(spark, staged, parts))
        redo.commit(spark, path, staged, merged.schema, parts, mode="replace_partitions" if parts else "overwrite",
                    drop=drop, changed=touched)
        if indexed:
            _index(spark, path, parts, keys, time_col, touched - drop)
    found = seen.get
    return ({"action": "merge", "path": path, "partitions": len(touched)},
            {"replaced": found["replaced"], "unchanged": found["unchanged"], "changed": sorted(touched, key=str)})


# ------------------------------------------------------------------- key index

def _index(spark: SparkSession, path: str, parts, keys, time_col: str, touched) -> None:
    """Filters of the keys in the given partitions, beside the table; only where loads will ask for them."""
    if not parts or time_col in keys or not touched:
        return
    rows = _read_partitions(spark, path, parts, touched, like=None)
    if rows is None:
        return
    folder = files.log_dir(path, "keys")
    write_partitioned(keyindex.build(rows, keys, list(parts)), f"{folder}/filters", parts,
                      "replace_partitions" if files.has_data(spark, f"{folder}/filters") else "overwrite")
    known = _known(spark, path, keys)
    known |= files.fingerprints(spark, path, parts, touched)
    text = json.dumps({"keys": list(keys), "files": [[list(v), f] for v, f in sorted(known.items(), key=str)]})
    files.write_text(spark, f"{folder}/files.json", text)


def _known(spark: SparkSession, path: str, keys) -> dict[tuple, str]:
    """The files each filter was built from, by partition."""
    text = files.read_text(spark, f"{files.log_dir(path, 'keys')}/files.json")
    own = json.loads(text) if text else {"keys": None}
    return {tuple(v): f for v, f in own["files"]} if own["keys"] == list(keys) else {}


def _other_partitions(spark: SparkSession, path: str, batch: DataFrame, keys, parts, stored: DataFrame, batch_parts) -> set[tuple]:
    """Partitions beside ``batch_parts`` that hold a key of the batch.  Filters rule most of them out; those that
    remain, and those whose files aren't the ones their filter was built from, are searched by a semi
    join of keys."""
    others = [v for v in files.partition_dirs(spark, path, parts) if v not in batch_parts]
    if not others:
        return set()
    known, now = _known(spark, path, keys), files.fingerprints(spark, path, parts, others)
    covered = [v for v in others if known.get(v) == now[v]]
    possible = set(others) - set(covered)
    typed = batch.select(*[F.col(f"`{k}`").cast(stored.schema[k].dataType).alias(k) for k in keys])
    if covered:
        filters = _read_partitions(spark, f"{files.log_dir(path, 'keys')}/filters", parts, covered, like=None)
        if filters is None:
            possible |= set(covered)
        else:
            possible |= {tuple(r) for r in keyindex.candidates(filters, typed, keys, list(parts)).collect()}
            # a partition without a filter row (no keys when it was built) is searched too
            possible |= set(covered) - set(files.partition_dirs(spark, f"{files.log_dir(path, 'keys')}/filters", parts))
    if not possible:
        return set()
    rows = _read_partitions(spark, path, parts, possible, like=stored)
    bkeys = typed.select(*[F.col(f"`{k}`").alias(f"_b_{k}") for k in keys])
    on = functools.reduce(lambda a, b: a & b, [rows[k].eqNullSafe(bkeys[f"_b_{k}"]) for k in keys])
    return {tuple(r) for r in rows.join(bkeys, on, "left_semi").select(*parts).distinct().collect()}


def replace_scope(spark: SparkSession, path: str, df: DataFrame, parts, scope) -> list[tuple]:
    """The partitions ``scope`` of the table hold the rows of ``df`` from now on, and none if it has none for them (all
    rows must be of these partitions); a new table is written whole.  Returns the partitions written."""
    parts = tuple(parts)
    redo.recover(spark, path)
    if not parts or not table_exists(spark, path):
        staged = _stage(spark, df, "table", parts)
        redo.commit(spark, path, staged, df.schema, parts, mode="overwrite", changed=None if not parts else scope)
        return sorted(files.partition_dirs(spark, path, parts), key=str)
    staged = _stage(spark, df, "scope", parts)
    found = set(files.partition_dirs(spark, staged, parts))
    gone = set(scope) - found
    redo.commit(spark, path, staged, df.schema, parts, mode="replace_partitions", drop=gone, changed=scope)
    return sorted(found, key=str)


def _read_partitions(spark: SparkSession, path: str, parts, values, like: DataFrame | None) -> DataFrame | None:
    """The stored rows of the given partitions, with the schema merged over
    those partitions' files only: an incremental load reads the footers of
    the partitions it touches, not of the whole table.  Partitions that do not
    exist yet are skipped (NULL-safe: the NULL partition is a directory too);
    one listing by level finds those that do.  Without any, no rows of ``like``."""
    there = set(files.partition_dirs(spark, path, parts))
    dirs = [f"{path.rstrip('/')}/{files.partition_dir(parts, v)}" for v in values if tuple(v) in there]
    if not dirs:
        return None if like is None else like.filter(F.lit(False))
    return schemas.read_merged(spark, dirs, path)


def load_bronze(spark: SparkSession, path: str, batch: DataFrame, source: Source, *,
                load_type: str = "incremental", on_missing_key: str = "error", counts: bool = False) -> dict:
    """Write a landed batch of ``source`` into its bronze table.

    ``full`` replaces the whole table with the batch (deduplicated by the
    business key, newest ``_ingested_at`` wins); ``incremental`` and
    ``date_range`` merge the batch by the key (``upsert_table``), which makes
    a re-read of the last days idempotent.  ``counts`` as there.
    """
    if load_type not in LOAD_TYPES:
        raise ValueError(f"load_type must be one of {LOAD_TYPES}")
    parts, keys = tuple(source.partitions), list(source.keys_for(batch.columns))
    if "_ingested_at" not in batch.columns:  # keep-newest needs an order
        batch = stamp_lineage(batch, source.name, source.name)
    if load_type == "full":
        missing = [k for k in keys if k not in batch.columns]
        if missing:
            raise ValueError(f"merge keys {missing} not in batch columns {batch.columns}")
        redo.recover(spark, path)
        rows_in, seen = Observation(), Observation()
        out = newest_of_batch(batch.observe(rows_in, F.count(F.lit(1)).alias("n")), keys)
        out = with_date_parts(out, source.time_col, parts).observe(seen, F.count(F.lit(1)).alias("n"))
        redo.commit(spark, path, _stage(spark, out, "full", parts), out.schema, parts, mode="overwrite", changed=None)
        n = seen.get["n"]
        report = {"rows_in": rows_in.get["n"], "rows": n, "inserted": n, "updated": 0, "unchanged": 0, "changed": None}
        return {"action": "overwrite", "path": path} | (report if counts else {})
    return upsert_table(spark, path, batch, keys, time_col=source.time_col, parts=parts,
                        on_missing_key=on_missing_key, counts=counts)


def backup(spark: SparkSession, src: str, dst: str | None = None, parts=()) -> str:
    """Copy the table at ``src`` to ``dst`` (default: a run-stamped path beside the table, which no
    cleaning of scratch folders touches).  ``restore`` brings it back."""
    redo.recover(spark, src)
    stamp = dt.datetime.now().strftime("%Y%m%d_%H%M%S_%f")
    dst = dst or f"{src.rstrip('/')}_backup_{stamp}"
    # every file's schema: a column that appends added to some files is kept
    write_partitioned(read_table(spark, src), dst, parts, "overwrite")
    return dst


def restore(spark: SparkSession, saved: str, path: str, parts=(), *, whole: bool = True) -> dict:
    """The table at ``path`` holds what the backup ``saved`` holds: all of it, or with ``whole=False`` the partitions that
    the backup has (``dedupe_table`` saves those it rewrites), the others staying as they are."""
    parts, rows = tuple(parts), read_table(spark, saved)
    redo.recover(spark, path)
    if parts and not whole:
        scope = files.partition_dirs(spark, saved, parts)
        replace_scope(spark, path, rows, parts, scope)
        return {"action": "restore", "path": path, "partitions": len(scope)}
    staged = _stage(spark, rows, "restore", parts)
    redo.commit(spark, path, staged, rows.schema, parts, mode="overwrite", changed=None)
    return {"action": "restore", "path": path, "partitions": len(files.partition_dirs(spark, path, parts)) if parts else 0}


def dedupe_table(spark: SparkSession, path: str, keys: list[str], *,
                 order_by=("_ingested_at",), parts=()) -> dict:
    """Keep the newest row per key in the table at ``path``.

    Counts before/after, and the partitions that hold a key more than once, come from one grouped
    job over the keys.  Only those partitions are backed up and rewritten, and only if
    something is removed.
    """
    redo.recover(spark, path)
    df, parts = read_table(spark, path), tuple(parts)   # the rewrite keeps every column
    in_key = all(p in keys for p in parts)
    where = [] if in_key else [F.collect_set(F.struct(*parts)).alias("_parts")]
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *where)
    row = per_key.agg(F.sum("_n").alias("before"), F.count(F.lit(1)).alias("after")).first()
    before, after = int(row["before"] or 0), int(row["after"] or 0)
    out = {"before": before, "after": after, "removed": before - after, "backup": None, "partitions": 0}
    if before == after:
        return out
    if parts:
        repeated = per_key.filter("_n > 1")
        repeated = repeated.select(*parts) if in_key else repeated.select(F.explode("_parts").alias("p")).select("p.*")
        touched = {tuple(r) for r in repeated.distinct().collect()}  # bounded by the number of partitions
        df = _read_partitions(spark, path, parts, touched, like=df)
        out["partitions"] = len(touched)
    stamp = dt.datetime.now().strftime("%Y%m%d_%H%M%S_%f")
    out["backup"] = f"{path.rstrip('/')}_backup_{stamp}"
    write_partitioned(df, out["backup"], parts, "overwrite")
    newest = dedupe_latest(df, keys, list(order_by))
    staged = _stage(spark, newest, "dedupe", parts)
    drop = touched - set(files.partition_dirs(spark, staged, parts)) if parts else set()
    redo.commit(spark, path, staged, newest.schema, parts, mode="replace_partitions" if parts else "overwrite", drop=drop,
                changed=touched if parts else None)
    return out


def dedupe_source_table(spark: SparkSession, path: str, source: Source) -> dict:
    """``dedupe_table`` with the feed's own business keys and partitions from
    the registry (e.g. ``dedupe_source_table(spark, path, DAM)``)."""
    return dedupe_table(spark, path, list(source.keys_for(read_table(spark, path).columns)),
                        parts=source.partitions)
