"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic.session import scratch_path
from voltaic.sources import files

#: Rows of remainder 2 are held out of everything that learns from labels.
FOLDS = 4
HELD_OUT = 2


def let_workers_import(spark: SparkSession) -> None:
    """Put the folder this package was imported from on the Python workers' path (a cluster
    has the package there too, or is given it with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` reduced to the named columns, as ``new_name="old name"``.

    Columns are found by exact name, so others that differ in case only, repeat a
    name or hold dots do no harm.
    """
    names = df.columns
    for old in columns.values():
        if old not in names:
            raise ValueError(f"no column {old!r} among {names}")
    at = {new: names.index(old) for new, old in columns.items()}
    return df.toDF(*[f"c{i}" for i in range(len(names))]).select(
        *[F.col(f"c{i}").alias(new) for new, i in at.items()])


def temporary(name: str) -> str:
    """A column name that no input can hold."""
    return f"_{name}_{uuid.uuid4().hex[:12]}"


def keep_where(df: DataFrame, text: str, decide) -> DataFrame:
    """Rows of ``df`` for which ``decide(text column)`` is true, all columns as they were."""
    names = df.columns
    tmp = [f"c{i}" for i in range(len(names))]
    out = df.toDF(*tmp)
    return out.where(decide(F.col(tmp[names.index(text)]))).toDF(*names)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == HELD_OUT, F.lit(False))


def may_learn(doc_id: Column) -> Column:
    """False for held-out ids and for null ids, whose fold is unknown."""
    return F.coalesce(fold(doc_id) != HELD_OUT, F.lit(False))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: its lineage is cut
    and a lost executor costs no more than the tasks it was running."""
    return stage_at(df, name)[0]


def stage_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stage``, and the folder written, for ``discard`` once nothing reads it any more; what isn't discarded
    goes when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    files.delete_at_exit(spark, path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    files.delete(spark, path)
    _STAGED.remove(path)


def discard_all(spark: SparkSession) -> int:
    """Delete what operators of this process have staged so far, for a caller that has written
    their results; returns how many folders went."""
    n = len(_STAGED)
    for path in list(_STAGED):
        discard(spark, path)
    return n


_STAGED: list[str] = []
