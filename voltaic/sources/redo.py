"""Commits of staged rows that survive a crash, and the log of what they changed.

A commit that touches several partitions, or overwrites and deletes, is not one step.  So the new
rows are staged first, then an intent (where they are, what they replace, what goes) is written beside the
table, and only then is the table touched.  Whoever works on the table next calls ``recover``: an
intent that is still there is carried out again.  Every step may be repeated, so a crash after any of them
leaves, after the next start, the table of a run without one.

With each commit the partitions it changed are recorded, until a reader of the changes
(``plans.refresh``) has done its work and clears them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from voltaic.sources import files


def _step(name: str) -> None:
    """Called after each step of a commit; tests raise here."""


def commit(spark: SparkSession, path: str, staged: str, schema: T.StructType, parts, *, mode: str, drop=(),
           changed=None) -> None:
    """The staged rows, partitioned as the table is, take effect at ``path``, and the staged folder goes.  Where the
    file system can, folders are moved, so that rows are written once.

    ``mode`` is ``replace_partitions`` (of those in the staged rows) or ``overwrite``; partitions in ``drop`` are
    deleted; ``changed`` are the partitions recorded as changed (None: all).
    """
    _step("staged")
    name = uuid.uuid4().hex
    intent = {"staged": staged, "schema": schema.json(), "parts": list(parts), "mode": mode,
              "drop": [list(v) for v in drop], "changed": None if changed is None else sorted([list(v) for v in changed], key=str)}
    files.write_text(spark, f"{files.log_dir(path, 'redo')}/{name}.json", json.dumps(intent))
    _step("intent")
    _carry_out(spark, path, name, intent)


def recover(spark: SparkSession, path: str) -> int:
    """Carry out what a commit that ended early has left; returns how many there were."""
    folder = files.log_dir(path, "redo")
    names = [n for n in files.list_names(spark, folder) if n.endswith(".json")]
    for n in names:
        _carry_out(spark, path, n[:-5], json.loads(files.read_text(spark, f"{folder}/{n}")))
    return len(names)


def _carry_out(spark: SparkSession, path: str, name: str, intent: dict) -> None:
    from voltaic.sources.tables import write_partitioned

    record(spark, path, intent["changed"], name)  # before the data: a change is never missed
    _step("recorded")
    staged, parts = intent["staged"], intent["parts"]
    if intent["mode"] == "overwrite" and files.can_move(spark, staged, path):
        files.move_folder(spark, staged, path)
    elif intent["mode"] == "replace_partitions" and parts and files.can_move(spark, staged, path):
        for v in files.partition_dirs(spark, staged, parts):
            folder = files.partition_dir(parts, v)
            files.move_folder(spark, f"{staged}/{folder}", f"{path.rstrip('/')}/{folder}")
            _step("partition")
    elif files.has_data(spark, staged):
        rows = spark.read.schema(T.StructType.fromJson(json.loads(intent["schema"]))).parquet(staged)
        write_partitioned(rows, path, parts, intent["mode"])
    _step("written")
    for v in intent["drop"]:
        files.delete(spark, f"{path.rstrip('/')}/{files.partition_dir(parts, v)}")
        _step("dropped")
    files.delete(spark, f"{files.log_dir(path, 'redo')}/{name}.json")
    _step("cleared")
    files.delete(spark, staged)


# ------------------------------------------------------------------ change log

def record(spark: SparkSession, path: str, changed, name: str | None = None) -> None:
    """Note partitions of the table as changed (None: any may be)."""
    text = json.dumps(None if changed is None else [list(v) for v in changed])
    files.write_text(spark, f"{files.log_dir(path, 'changes')}/{name or uuid.uuid4().hex}.json", text)


def pending(spark: SparkSession, path: str) -> tuple[set[tuple] | None, list[str]]:
    """(partitions changed since they were last cleared, None if any may be; the notes they come from)."""
    folder, changed, names = files.log_dir(path, "changes"), set(), files.list_names(spark, files.log_dir(path, "changes"))
    names = [n for n in names if n.endswith(".json")]
    for n in names:
        own = json.loads(files.read_text(spark, f"{folder}/{n}"))
        if own is None:
            return None, names
        changed |= {tuple(v) for v in own}
    return changed, names


def clear(spark: SparkSession, path: str, names: list[str]) -> None:
    """Forget the given notes, those of changes made meanwhile stay."""
    for n in names:
        files.delete(spark, f"{files.log_dir(path, 'changes')}/{n}")
