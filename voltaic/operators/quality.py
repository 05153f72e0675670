"""Data-quality checks.

The row count, date range and NULL counts are one aggregate without a shuffle of
rows.  The number of repeated time values is a second, grouped pass, made only
where it is asked for (partially aggregated on the map side, so a time value
holding a third of the rows costs no more than any other).
"""

from __future__ import annotations

import functools

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.sources.landing import pick_time_column

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("time_column", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("min_date", T.DateType()),
    T.StructField("max_date", T.DateType()),
    T.StructField("null_time_column", T.LongType()),
    T.StructField("null_ingested_at", T.LongType()),
    T.StructField("duplicate_intervals", T.LongType()),
])


def _typed(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                           for f in REPORT_SCHEMA])


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _status_only(spark: SparkSession, table: str, status: str, rows=None,
                 time_col=None) -> DataFrame:
    return spark.createDataFrame(
        [(table, status, time_col, rows, None, None, None, None, None)], REPORT_SCHEMA)


def quality_report(df: DataFrame, table: str, time_col: str | None = None,
                   ingest_col: str = "_ingested_at", duplicates: bool = True) -> DataFrame:
    """One row: table, status, time column, row count, first/last day, NULL
    time values, NULL ingest stamps, number of time values seen more than once
    (NULL counts as one value).  Status ``empty`` when there are no rows,
    ``no_time_column`` when no time column is known.  ``duplicates=False`` leaves the
    repeated time values out (NULL), and with them the only shuffle."""
    time_col = time_col or pick_time_column(df.columns)
    if time_col is None:
        return _typed(df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"),
            F.when(F.col("row_count") == 0, "empty").otherwise("no_time_column").alias("status"),
            F.lit(None).alias("time_column"), "row_count",
            *[F.lit(None).alias(c) for c in ("min_date", "max_date", "null_time_column",
                                             "null_ingested_at", "duplicate_intervals")]))
    # expressions as SQL text: one JVM call each; partial aggregates of one row a task
    rep = df.agg(
        F.expr("count(1) AS row_count"),
        F.expr(f"min(to_date(`{time_col}`)) AS min_date"),
        F.expr(f"max(to_date(`{time_col}`)) AS max_date"),
        F.expr(f"count_if(`{time_col}` IS NULL) AS null_time_column"),
        F.expr(f"count_if(`{ingest_col}` IS NULL) AS null_ingested_at" if ingest_col in df.columns
               else "CAST(NULL AS BIGINT) AS null_ingested_at"))
    rep = rep.withColumn("table_name", F.lit(table))
    if duplicates:
        repeated = (df.groupBy(F.col(time_col).alias("_t")).agg(F.expr("count(1) AS _n"))
                    .agg(F.expr("count_if(_n > 1) AS duplicate_intervals"))
                    .withColumn("table_name", F.lit(table)))
        rep = rep.join(repeated, "table_name")  # one row each
    else:
        rep = rep.withColumn("duplicate_intervals", F.lit(None).cast("bigint"))
    return _typed(rep.selectExpr(
        "table_name",
        "CASE WHEN row_count = 0 THEN 'empty' ELSE 'ok' END AS status",
        f"{_sql_str(time_col)} AS time_column",
        "row_count", "min_date", "max_date", "null_time_column", "null_ingested_at",
        "duplicate_intervals"))


def quality_report_path(spark: SparkSession, path: str, table: str,
                        time_col: str | None = None, ingest_col: str = "_ingested_at",
                        duplicates: bool = True) -> DataFrame:
    """``quality_report`` of the table stored at ``path``; status
    ``table_not_found`` when there is none."""
    try:
        # every file's schema: a lineage column only some files carry still counts
        df = spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException:
        return _status_only(spark, table, "table_not_found")
    return quality_report(df, table, time_col, ingest_col, duplicates)


def quality_summary(reports: list[DataFrame]) -> DataFrame:
    """All reports as one DataFrame (one row per table)."""
    return functools.reduce(DataFrame.unionByName, reports)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Business keys seen more than once, most repeated first."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
            .filter(F.col("duplicate_count") > 1)
            .orderBy(F.col("duplicate_count").desc(), *keys))
