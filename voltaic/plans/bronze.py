"""The bronze step: landed files of a source into its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from voltaic.sources import files
from voltaic.sources.landing import FILE, REJECTS, read_feed, stamp_lineage
from voltaic.sources.registry import Source
from voltaic.sources.tables import _Kept, _stage, load_bronze, read_table, write_partitioned

#: Share of a load's rows that may be rejected.
MOST_REJECTED = 0.01


class TooManyRejects(ValueError):
    """A load with so many bad rows that it isn't the feed it should be; the table is as it was."""


def land(spark: SparkSession, path: str, table_path: str, source: Source, start=None, end=None, *,
         fmt: str = "parquet", load_type: str = "incremental", endpoint: str | None = None,
         rejects_path: str | None = None, most_rejected: float = MOST_REJECTED, counts: bool = False) -> dict:
    """Read the landed files of ``[start, end]`` (names sanitised, required columns checked, types
    cast), stamp the rows that carry no lineage yet, and merge them by the source's key.

    A feed that was stamped when it landed keeps its stamps, so that a re-read is idempotent.

    A value that can't be cast ends the load, unless ``rejects_path`` is given: then rows with such values are
    kept there (``rejects``) and the others are loaded, if no more than the share ``most_rejected`` is bad; the result counts them
    as ``rejected``.  The landed files are read once.  ``counts`` as for ``load_bronze``.
    """
    if rejects_path is None:
        batch = read_feed(spark, path, source, start, end, fmt)
        return load_bronze(spark, table_path, _stamped(batch, source, endpoint), source, load_type=load_type, counts=counts)
    batch = _stamped(read_feed(spark, path, source, start, end, fmt, checked=True), source, endpoint)
    seen = Observation()
    bad = F.size(REJECTS) > 0
    checked = batch.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("rejected"))
    staged = _stage(spark, checked, "landed")
    with _Kept(staged):
        own = spark.read.schema(batch.schema).parquet(staged)
        n, rejected = seen.get["n"], seen.get["rejected"]
        if rejected:
            _keep(own.filter(bad), rejects_path, source)
        if rejected > most_rejected * n:
            files.delete(spark, staged)
            raise TooManyRejects(f"{source.name}: {rejected} of {n} rows are bad (see {rejects_path}); nothing was loaded")
        out = load_bronze(spark, table_path, own.filter(~bad).drop(REJECTS, FILE), source, load_type=load_type, counts=counts)
    files.delete(spark, staged)
    return out | {"rejected": rejected}


def _stamped(batch: DataFrame, source: Source, endpoint: str | None) -> DataFrame:
    return batch if "_ingested_at" in batch.columns else stamp_lineage(batch, source.name, endpoint or source.name)


def _keep(bad: DataFrame, path: str, source: Source) -> None:
    """Append a row for each value that couldn't be cast, with the row it stood in."""
    rest = [c for c in bad.columns if c not in (REJECTS, FILE)]
    out = bad.select(F.lit(source.name).alias("source"), F.col(FILE).alias("file"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("row"),
                     F.localtimestamp().alias("rejected_at"), F.inline(REJECTS))
    write_partitioned(out, path, ("source",), "append")


def rejects(spark: SparkSession, path: str) -> DataFrame:
    """What loads have rejected: source, file, column, raw (the value as it came), reason, row (the others, as JSON, null where they
    can't be cast either) and rejected_at.  A file that was landed again counts once."""
    key = ["source", "file", "column", "raw", "row"]
    own = read_table(spark, path)
    # within a load, rows that look the same are rows each; between loads of one file they are the same
    last = Window.partitionBy("source", "file")
    return own.withColumn("_last", F.max("rejected_at").over(last)).filter(F.col("rejected_at") == F.col("_last")).select(*key, "reason", "rejected_at")
