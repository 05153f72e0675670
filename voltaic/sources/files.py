"""Paths on shared storage, through Hadoop's file system layer (any URI Spark reads).

Needs a session with a SparkContext: the sinks and the partition-wise readers are run
by a classic session, not through Spark Connect.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    _, root, fs = file_system(spark, path)
    fs.delete(root, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete what is at ``path`` when the application ends (its driver exits in an orderly way)."""
    _, root, fs = file_system(spark, path)
    fs.deleteOnExit(root)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table stands at ``path``: a folder with anything but hidden or marker files
    (one listing of the folder itself, not of all files below it)."""
    _, root, fs = file_system(spark, path)
    if not fs.exists(root):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(root))


def log_dir(path: str, name: str) -> str:
    """A folder beside the table at ``path`` for what is kept about it (hidden from readers of the
    folder above, and out of the way when the table is overwritten)."""
    parent, slash, table = path.rstrip("/").rpartition("/")
    return f"{parent}{slash}_{table}_log/{name}"


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    _, root, fs = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    jvm, root, fs = file_system(spark, path)
    if not fs.exists(root):
        return None
    stream = fs.open(root)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that a reader sees all of it or nothing: under another name, then renamed."""
    jvm, root, fs = file_system(spark, path)
    new = jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    fs.mkdirs(root.getParent())
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.delete(root, False)
    if not fs.rename(new, root):
        raise OSError(f"{path} couldn't be written")


#: Schemes of file systems on which moving a folder is no copy.
MOVABLE = ("file", "hdfs", "viewfs")


def can_move(spark: SparkSession, src: str, dst: str) -> bool:
    _, _, a = file_system(spark, src)
    _, _, b = file_system(spark, dst)
    return a.getUri().toString() == b.getUri().toString() and a.getUri().getScheme() in MOVABLE


def move_folder(spark: SparkSession, src: str, dst: str) -> None:
    """The folder ``src`` takes the place of ``dst``; where ``src`` is gone already, it has."""
    jvm, a, fs = file_system(spark, src)
    if not fs.exists(a):
        return
    b = jvm.org.apache.hadoop.fs.Path(dst)
    fs.delete(b, True)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"{src} couldn't be moved to {dst}")


def fingerprints(spark: SparkSession, path: str, parts, values) -> dict[tuple, str]:
    """For each of the partitions ``values``, a digest of the names and sizes of its files."""
    out = {}
    for v in values:
        _, root, fs = file_system(spark, f"{path.rstrip('/')}/{partition_dir(parts, v)}")
        names = sorted(f"{s.getPath().getName()}:{s.getLen()}" for s in fs.listStatus(root)) if fs.exists(root) else []
        out[tuple(v)] = hashlib.sha1("\n".join(n for n in names if n[0] not in "_.").encode()).hexdigest()
    return out


def partition_dirs(spark: SparkSession, path: str, parts) -> list[tuple]:
    """The partition values of the table at ``path``, from its directory names alone: a tuple of
    integers (None for the null partition) a partition; empty if it isn't partitioned so."""
    _, root, fs = file_system(spark, path)
    level = [((), root)]
    for p in parts:
        below = []
        for values, folder in level:
            if not fs.exists(folder):
                continue
            for s in fs.listStatus(folder):
                name = s.getPath().getName()
                if s.isDirectory() and name.startswith(f"{p}="):
                    v = name[len(p) + 1:]
                    if v != NULL_PARTITION and not v.lstrip("-").isdigit():
                        return []
                    below.append(((*values, None if v == NULL_PARTITION else int(v)), s.getPath()))
        level = below
    return [values for values, _ in level if values]


def partition_dir(parts, values) -> str:
    return "/".join(f"{p}={NULL_PARTITION if v is None else v}" for p, v in zip(parts, values))
