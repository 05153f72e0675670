"""Incremental landing → bronze as a Structured Streaming job.

New files that land in a directory are picked up as micro-batches (file
source; the offsets live in the checkpoint), and each micro-batch is merged
into the bronze table by business key with ``sources.tables.upsert_table``.
Because the upsert is idempotent (applying a batch twice equals applying it
once), a micro-batch that is re-run after a failure leaves the same table: the
sink is effectively exactly-once.  Re-delivered late data (the re-read of the
last days) is absorbed by the same upsert.

Run it with ``trigger(availableNow=True)`` from a scheduler (process what has
landed, then stop) or with a processing-time trigger as a service.
"""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltaic.session import checkpoint_root
from voltaic.sources.landing import (  # noqa: F401 (LINEAGE_FIELDS is re-exported)
    LINEAGE_FIELDS, landed_schema, read_files, stamp_lineage,
)
from voltaic.sources.registry import Source
from voltaic.sources.tables import upsert_table


def stream_checkpoint(spark: SparkSession, table_path: str, source: Source) -> str:
    """The default checkpoint of the stream into ``table_path``: under the
    shared checkpoint folder and the same on every start, so a restarted
    stream resumes from its offsets instead of re-reading every landed file."""
    digest = hashlib.sha1(table_path.rstrip("/").encode()).hexdigest()[:16]
    return f"{checkpoint_root(spark)}/stream-{source.name}-{digest}"


def start_incremental_upsert(spark: SparkSession, landing_dir: str, table_path: str,
                             source: Source, *, keys=None, parts=None,
                             checkpoint: str | None = None, available_now: bool = True,
                             processing_time: str = "1 hour", fmt: str = "parquet",
                             max_files_per_trigger: int | None = 1000) -> StreamingQuery:
    """Start the stream; returns the running query (``awaitTermination()`` it
    for an available-now run).

    The stream itself carries the names of new files.  A micro-batch reads its files, whatever columns and types they have
    (a column that first lands while the stream runs is complete in the table), and goes the way a batch load goes
    (``landing.read_files``, the source's partitions and key); it is bounded by ``max_files_per_trigger`` files.
    """
    parts = tuple(source.partitions if parts is None else parts)
    # rows are counted off by file, no column of them is read here
    reader = spark.readStream.format(fmt).schema(landed_schema(source))
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing_dir).select(F.col("_metadata.file_path").alias("file"))

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        new = sorted(unquote(r["file"]) for r in batch.distinct().collect())  # at most max_files_per_trigger
        if not new:
            return
        rows = read_files(own, new, source, fmt, landing_dir)
        if "_ingested_at" not in rows.columns:
            rows = stamp_lineage(rows, source.name, source.name)
        # the upsert evaluates the micro-batch once, into its staged copy
        upsert_table(own, table_path, rows, list(keys or source.keys_for(rows.columns)),
                     time_col=source.time_col, parts=parts)

    writer = (stream.writeStream.foreachBatch(merge_batch)
              .option("checkpointLocation", checkpoint or stream_checkpoint(spark, table_path, source)))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()
