"""Connected components of a graph given as an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stage_at


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b): root is the smallest node of its component.

    Each round hangs every node's larger neighbours on its smallest one (large star) and
    its smaller neighbours on the smallest (small star); rounds grow with the logarithm
    of a component's size, a round moves each edge a constant number of times, and its
    result is written to the shared folder.  Ends when a round changes nothing.
    """
    now, path = stage_at(_tidy(edges.select("a", "b")), "edges")
    mark = _mark(now)
    for _ in range(most_rounds):
        if mark[0] == 0:
            break
        now, new = stage_at(_small_star(_large_star(now)), "edges")
        last, mark = mark, _mark(now)
        discard(edges.sparkSession, path)  # the round before is read no more
        path = new
        if mark == last:
            break
    else:
        raise RuntimeError(f"components still change after {most_rounds} rounds")
    # every edge is now (node, root)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _tidy(edges: DataFrame) -> DataFrame:
    """Each edge once, larger node first, no loops."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b"), F.col("a")).toDF("a", "b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _tidy(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    # edges are (larger, smaller): the smaller neighbours of a
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _tidy(hung.union(least.select("a", F.col("m").alias("b"))))
