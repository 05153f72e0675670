"""Landing-side readers: lossless reads cast to the declared types, name sanitising,
lineage stamps, renames, the high-water mark and the incremental load range."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.sources import schemas
from voltaic.sources.files import partition_dir, partition_dirs
from voltaic.sources.registry import Source

# Default start of a first load and the late-data lookback.
DEFAULT_START = "2024-01-01"
LOOKBACK_DAYS = 7
LOAD_TYPES = ("incremental", "date_range", "full")


def sanitize_name(name: str) -> str:
    """Spaces become ``_``; parentheses are dropped."""
    return name.replace(" ", "_").replace("(", "").replace(")", "")


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[sanitize_name(c) for c in df.columns])


def stamp_lineage(df: DataFrame, source: str, endpoint: str,
                  ingested_at=None) -> DataFrame:
    """Add ``_ingested_at`` (one value per batch), ``_source`` and ``_endpoint``.
    The stamp is a zone-free timestamp, the declared type of the lineage
    column, so batches and stored tables order it the same way."""
    ts = F.localtimestamp() if ingested_at is None else ingested_at
    return df.withColumns({"_ingested_at": ts, "_source": F.lit(source),
                           "_endpoint": F.lit(endpoint)})


def rename(df: DataFrame, mapping: dict, required=()) -> DataFrame:
    """Rename to canonical names; fails if a required column is absent (a
    silent no-op rename would hide a changed feed)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; have {df.columns}")
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def range_filter(df: DataFrame, time_col: str, start=None, end=None,
                 parts: tuple[str, ...] = (), or_else: Column | None = None) -> DataFrame:
    """``start <= day(time) <= end`` (end inclusive), written as a range on
    the raw column so parquet row groups are skipped, plus ``year``/``month``
    predicates when the data is stored partitioned by them (pruning); rows for which
    ``or_else`` holds stay whatever their time."""
    col, within = F.col(time_col), []
    if start is not None:
        s = _as_date(start)
        within.append(col >= F.lit(s.isoformat()).cast("timestamp_ntz"))
        if "year" in parts:
            within.append(F.col("year") >= s.year)
    if end is not None:
        e = _as_date(end)
        within.append(col < F.lit((e + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz"))
        if "year" in parts:
            within.append(F.col("year") <= e.year)
    if start is not None and end is not None and "month" in parts:
        s, e = _as_date(start), _as_date(end)
        if s.year == e.year:
            within.append((F.col("month") >= s.month) & (F.col("month") <= e.month))
    if not within:
        return df
    where = functools.reduce(lambda a, b: a & b, within)
    return df.filter(where if or_else is None else where | or_else)


# lineage stamps carried by every landed batch (see ``stamp_lineage``)
LINEAGE_FIELDS = (T.StructField("_ingested_at", T.TimestampNTZType()),
                  T.StructField("_source", T.StringType()),
                  T.StructField("_endpoint", T.StringType()))


def landed_schema(source: Source) -> T.StructType:
    """The feed's declared schema plus the lineage stamps."""
    return T.StructType(list(source.schema.fields) + list(LINEAGE_FIELDS))


def normalize_landed(df: DataFrame, source: Source, checked: bool = False) -> DataFrame:
    """A landed frame as bronze takes it: names sanitised, the columns the feed can't do without
    present, declared columns cast to their declared types, all others kept as they are.

    Nothing is invented: a declared column that the files lack stays absent, and a missing
    time, key or measure column is an error.  Measures of an ``open_schema`` feed that
    arrive as text (CSV) are doubles by contract.

    A value that can't be cast is an error, or with ``checked`` noted in the column ``REJECTS`` (an array of column, raw and
    reason, empty for a good row), in which a row that couldn't be parsed (``CORRUPT``) is noted too.
    """
    df = sanitize_columns(df)
    needed = [c for c in (source.time_col, *source.keys, *source.required) if c not in df.columns]
    if needed:
        raise ValueError(f"{source.name}: the landed files lack {sorted(set(needed))}; they have {df.columns}")
    declared = {f.name: f.dataType for f in landed_schema(source).fields}
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    known = {*declared, *source.partitions, *source.region_cols}
    cols, rejects = [], []
    for c in df.columns:
        raw = F.col(f"`{c}`")
        if c in declared:
            want = declared[c]
        elif source.open_schema and c in text and c not in known and (source.all_measures or _is_measure(c)):
            want = T.DoubleType()
        else:
            want = df.schema[c].dataType
        if c == CORRUPT:
            rejects.append(_reject(raw.isNotNull(), c, raw, "the row can't be parsed"))
        elif want == df.schema[c].dataType:
            cols.append(raw)
        elif checked:
            typed = raw.try_cast(want)
            cols.append(typed.alias(c))
            rejects.append(_reject(raw.isNotNull() & typed.isNull(), c, raw, f"not a {want.simpleString()}"))
        else:
            cols.append(raw.cast(want).alias(c))
    if checked:
        none = F.array().cast("array<struct<column:string,raw:string,reason:string>>")
        cols.append((F.filter(F.array(*rejects), lambda r: r.isNotNull()) if rejects else none).alias(REJECTS))
    return df.select(*cols)


#: Columns of a checked read: what is wrong with a row, the file it stands in, and its text if it couldn't be parsed.
REJECTS, FILE, CORRUPT = "_rejects", "_file", "_corrupt_record"


def _reject(wrong, column: str, raw, reason: str):
    return F.when(wrong, F.struct(F.lit(column).alias("column"), raw.cast("string").alias("raw"), F.lit(reason).alias("reason")))


#: Prefixes of the measures of regional feeds.
MEASURES = ("COP_HSL", "GEN", "HSL", "PVGRPP", "STPPF", "STWPF", "WGRPP")


def _is_measure(name: str) -> bool:
    return any(name.startswith(f"{m}_") for m in MEASURES)


def landed_paths(spark: SparkSession, path: str, source: Source, start=None, end=None) -> list[str]:
    """The partition folders of the landing that can hold days of ``[start, end]``; the landing
    itself if it isn't partitioned as the source declares or no range is given."""
    if start is None and end is None:
        return [path]
    parts = [p for p in source.partitions if p in ("year", "month", "day")]
    found = partition_dirs(spark, path, parts)
    if not found:
        return [path]
    lo = _as_date(start) if start is not None else None
    hi = _as_date(end) if end is not None else None

    def within(values):
        if None in values:
            return False
        a = (lo.year, lo.month, lo.day)[:len(values)] if lo else None
        b = (hi.year, hi.month, hi.day)[:len(values)] if hi else None
        return (a is None or values >= a) and (b is None or values <= b)

    return [f"{path.rstrip('/')}/{partition_dir(parts, v)}" for v in sorted(v for v in found if within(v))]


def read_feed(spark: SparkSession, path: str, source: Source, start=None, end=None,
              fmt: str = "parquet", checked: bool = False) -> DataFrame:
    """The landed feed for the days ``[start, end]`` (by its time column), lossless: by stored names,
    with every column of the files in range (their schemas merged), then ``normalize_landed``.

    Parquet files whose types differ (a column of whole numbers in one load, of fractions in the next) are read
    in groups of equal types, each normalised, and stacked with their common types (``schemas``).
    CSV is read by its header with all columns as text, so no scan infers types; JSON
    names come from the files.  Only the partition folders in range are listed and read.

    With ``checked``, values that can't be cast don't end the read: rows carry what is wrong with them
    in ``REJECTS`` and their file in ``FILE``, and rows whose time isn't known are kept whatever the range.
    """
    paths = landed_paths(spark, path, source, start, end)
    if not paths:  # no folder in range: the feed's columns, no rows
        return range_filter(read_feed(spark, path, source, fmt=fmt, checked=checked).limit(0), source.time_col, start, end)
    df = read_files(spark, paths, source, fmt, None if paths == [path] else path, checked)
    parts = tuple(p for p in source.partitions if p in df.columns)
    unknown = F.col(source.time_col).isNull() & (F.size(REJECTS) > 0) if checked else None
    return range_filter(df, source.time_col, start, end, parts, unknown)


def read_files(spark: SparkSession, paths: list[str], source: Source, fmt: str = "parquet", base: str | None = None,
               checked: bool = False) -> DataFrame:
    """Landed files or folders (below ``base``, whose partition folders give columns), all rows, as ``read_feed`` reads them."""
    if fmt == "parquet":
        groups = schemas.read_groups(spark, paths, base, FILE if checked else None)
    else:
        reader = spark.read.format(fmt)
        if base:
            reader = reader.option("basePath", base)
        if fmt == "csv":
            reader = reader.option("header", "true").option("inferSchema", "false")
        if checked:
            reader = _with_corrupt(reader, paths, fmt)
        df = reader.load(paths)
        groups = [df.withColumn(FILE, F.col("_metadata.file_path")) if checked else df]
    frames = [normalize_landed(g, source, checked) for g in groups]
    return frames[0] if len(frames) == 1 else schemas.stacked(frames)


def _with_corrupt(reader, paths: list[str], fmt: str):
    """The reader with a column for rows that can't be parsed (too few or too many fields, broken JSON); the
    names in every CSV header must be those of the first."""
    found = reader.load(paths).schema
    if CORRUPT not in found.fieldNames():
        data = [f for f in found.fields]
        found = T.StructType(data + [T.StructField(CORRUPT, T.StringType())])
    reader = reader.schema(found).option("columnNameOfCorruptRecord", CORRUPT).option("mode", "PERMISSIVE")
    return reader.option("enforceSchema", "false") if fmt == "csv" else reader


def _as_date(v) -> dt.date:
    if isinstance(v, dt.datetime):
        return v.date()
    if isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(str(v)[:10])


def high_water_mark_df(df: DataFrame, time_col: str) -> DataFrame:
    """One row: the last loaded day (``max(to_date(time))``)."""
    return df.agg(F.max(F.to_date(time_col)).alias("max_date"))


def high_water_mark(df: DataFrame | None, time_col: str) -> dt.date | None:
    """The last loaded day as a driver-side scalar (one aggregated row), or
    None when there is no table or it is empty."""
    if df is None:
        return None
    row = high_water_mark_df(df, time_col).first()
    return row["max_date"] if row is not None else None


def high_water_mark_path(spark: SparkSession, path: str, time_col: str, parts=("year", "month")) -> DataFrame:
    """``high_water_mark_df`` of a stored table, from its latest partition alone.

    The greatest partition is found from directory names; only it is read.  Where it holds
    no time (or the table isn't partitioned by date), the next older one, and at last the
    whole table, is asked.
    """
    dated = sorted(v for v in partition_dirs(spark, path, parts) if None not in v)
    for values in reversed(dated):
        df = high_water_mark_df(spark.read.parquet(f"{path.rstrip('/')}/{partition_dir(parts, values)}"), time_col)
        if df.first()["max_date"] is not None:
            return df
    return high_water_mark_df(spark.read.parquet(path), time_col)


def load_range(last_loaded: dt.date | None, *, load_type: str = "incremental",
               lookback_days: int = LOOKBACK_DAYS, default_start: str = DEFAULT_START,
               start=None, end=None, today: dt.date | None = None) -> tuple[str, str]:
    """The ``[start, end]`` days to (re)load.

    incremental: from ``last_loaded − lookback`` (re-reading late data, made
    idempotent by the upsert), or ``default_start`` on a first load;
    date_range: the given days; full: ``default_start`` to today.
    """
    if load_type not in LOAD_TYPES:
        raise ValueError(f"load_type must be one of {LOAD_TYPES}")
    today = today or dt.date.today()
    if load_type == "date_range":
        return str(_as_date(start)), str(_as_date(end))
    if load_type == "incremental" and last_loaded is not None:
        s = _as_date(last_loaded) - dt.timedelta(days=lookback_days)
        return s.isoformat(), (end and str(_as_date(end))) or today.isoformat()
    return default_start, (end and str(_as_date(end))) or today.isoformat()


_TIME_CANDIDATES = ("Interval_Start", "interval_start", "Time")


def pick_time_column(columns, candidates=_TIME_CANDIDATES) -> str | None:
    for c in candidates:
        if c in columns:
            return c
    return None

