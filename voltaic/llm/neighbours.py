"""Approximate nearest neighbours by inner product, through a hierarchical k-means tree.

1. The tree is fitted on a bounded sample of the vectors and broadcast; every row is put in
   the leaf that it descends to.  Rows of a leaf, whatever their ids, are dealt out over shards of bounded
   size, so that a leaf that holds very many rows is no group of its own.
2. A query visits leaves best bin first: a priority queue holds the nodes seen so far, the
   one whose centroid has the largest inner product with the query comes next.
3. How many leaves to visit is calibrated: a bounded sample of the queries is
   answered exactly, in blocks against all rows, and visits are widened until the leaves visited
   hold the share of true neighbours asked for.  With all leaves visited the search is exact.
4. Leaves that follow each other make a block. Queries meet the blocks of the leaves they visit, once a block with the leaves'
   numbers, a bounded number of queries and rows a group (a block that holds very many rows is cut into shards), in
   rounds that widen: the best few leaves first, which give each query a score
   to reach, then more of them, where only rows that reach it are kept.  Scores are inner products of the original vectors in double precision.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, stage

#: Rows of a block of leaves or a shard of one, and queries of a chunk, that meet in one group, on average at most.
SHARD_ROWS = 4096
CHUNK_QUERIES = 2048
#: Leaves a query visits in the first round, and how many times more after each next one.
FIRST_LEAVES = 8
WIDER = 4
#: Scores held at a time.
_AT_ONCE = 1 << 21
#: Scores that BLAS may have put in the wrong order are computed again.
_DOUBT = 1e-9


@dataclass
class Tree:
    """Nodes by number: centroids, children (empty for leaves) and the leaf's number (-1 for others)."""

    centroids: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: at every node on to the nearest child."""
        at = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.leaf[at] < 0)
            if not len(inner):
                return self.leaf[at]
            nodes = at[inner]
            for node in np.unique(nodes):
                rows = inner[nodes == node]
                kids = self.children[node]
                c = self.centroids[kids]
                at[rows] = kids[np.argmin((c ** 2).sum(axis=1) - 2 * x[rows] @ c.T, axis=1)]

    def best_bin_first(self, q: np.ndarray, visits: int, sizes: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first ``visits`` leaves a query visits, and more until they hold ``least`` rows."""
        queue, out, rows = [(0.0, 0)], [], 0
        while queue and (len(out) < visits or rows < least):
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(int(self.leaf[node]))
                rows += int(sizes[self.leaf[node]]) if sizes is not None else 0
                continue
            kids = self.children[node]
            for score, kid in zip((-(self.centroids[kids] @ q)).tolist(), kids.tolist()):
                heapq.heappush(queue, (score, kid))
        return out


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Cluster of each row; centres start at distinct rows drawn by distance."""
    centres = x[rng.integers(len(x))][None]
    nearest = ((x - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k and nearest.sum() > 1e-12:
        new = x[rng.choice(len(x), p=nearest / nearest.sum())]
        centres = np.concatenate([centres, new[None]])
        nearest = np.minimum(nearest, ((x - new) ** 2).sum(axis=1))
    own = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        own = np.argmin((centres ** 2).sum(axis=1) - 2 * x @ centres.T, axis=1)
        filled = np.unique(own)
        new = np.stack([x[own == c].mean(axis=0) for c in filled])
        if len(new) == len(centres) and np.allclose(new, centres):
            break
        centres = new
    return np.argmin((centres ** 2).sum(axis=1) - 2 * x @ centres.T, axis=1)


def fit_tree(sample: np.ndarray, total: int, leaf_rows: int = 256, branching: int = 8, least_sample: int = 16,
             seed: int = 5) -> Tree:
    """A tree whose leaves are to hold about ``leaf_rows`` of ``total`` rows; nodes of fewer than
    ``least_sample`` sample rows aren't split further, nor are equal vectors."""
    rng = np.random.default_rng(seed)
    centroids, children, leaf = [sample.mean(axis=0)], [np.empty(0, np.int64)], [-1]
    todo, leaves = [(0, np.arange(len(sample)))], 0
    while todo:
        node, rows = todo.pop()
        parts = []
        if len(rows) * total > leaf_rows * len(sample) and len(rows) >= 2 * least_sample:
            own = _kmeans(sample[rows], branching, rng)
            parts = [rows[own == c] for c in np.unique(own)]
        if len(parts) < 2:
            leaf[node] = leaves
            leaves += 1
            continue
        first = len(centroids)
        children[node] = np.arange(first, first + len(parts))
        for k, p in enumerate(parts):
            centroids.append(sample[p].mean(axis=0))
            children.append(np.empty(0, np.int64))
            leaf.append(-1)
            todo.append((first + k, p))
    return Tree(np.stack(centroids), children, np.array(leaf))


def _matrix(column, dim: int) -> np.ndarray:
    """An Arrow list column as a matrix of doubles."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def _score_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int,
                 floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score) of each query's k best rows of a block, ties to smaller ids, of
    those that score ``floor`` or more; rows with the query's own id are left out.

    A matrix product finds the candidates; their scores are then summed again in one fixed order,
    so that equal vectors score equal."""
    out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    step = max(1, _AT_ONCE // max(1, len(ids)))
    for at in range(0, len(q_ids) if len(ids) else 0, step):
        own_ids, own = q_ids[at:at + step], q[at:at + step]
        scores = own @ x.T
        scores[own_ids[:, None] == ids[None, :]] = -np.inf
        least = np.full(len(own_ids), -np.inf) if floor is None else floor[at:at + step].copy()
        many = np.flatnonzero((scores >= least[:, None]).sum(axis=1) > k)
        if len(many):
            kth = np.partition(scores[many], len(ids) - k, axis=1)[:, len(ids) - k]
            least[many] = np.maximum(least[many], kth)
        least -= _DOUBT * np.maximum(1.0, np.abs(np.where(np.isfinite(least), least, 0.0)))
        row, col = np.nonzero((scores >= least[:, None]) & np.isfinite(scores))
        again = (own[row] * x[col]).sum(axis=1)
        order = np.lexsort((ids[col], -again, row))
        row, col, again = row[order], col[order], again[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < k
        out.append((own_ids[row[best]], ids[col[best]], again[best]))
    return tuple(np.concatenate(c) for c in zip(*out))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, vec) of the rows that take part, and their dimension: ids that aren't null; vectors that
    aren't null or zero, without null or non-finite components, of the commonest length among
    these (the smaller, if two are as common)."""
    rows = pick(vectors, vec_id=id_col, vec=vector_col).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast("array<double>").alias("vec"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", fine) & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim = sizes[0]["d"] if sizes else 0
    return rows.where(F.size("vec") == dim), dim


def _exact(index: DataFrame, q_ids: np.ndarray, q: np.ndarray, k: int, dim: int) -> pd.DataFrame:
    """query_id, vec_id, score and leaf of the true k nearest of a bounded set of queries, in blocks
    against all rows."""
    shared = index.sparkSession.sparkContext.broadcast((q_ids, q))

    def search(batches):
        ids_, vectors = shared.value
        best = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)]
        for batch in batches:
            ids, leaves, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), dim)
            query, vec, score = _score_block(ids_, vectors, ids, x, k)
            by_id = np.argsort(ids)
            leaf = leaves[by_id][np.searchsorted(ids[by_id], vec)]
            both = [np.concatenate(c) for c in zip(best, (query, vec, score, leaf))]
            order = np.lexsort((both[1], -both[2], both[0]))
            both = [c[order] for c in both]
            keep = np.arange(len(order)) - np.searchsorted(both[0], both[0]) < k
            best = [c[keep] for c in both]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(best, (
            pa.int64(), pa.int64(), pa.float64(), pa.int32()))], names=["query_id", "vec_id", "score", "leaf"])

    near = index.select("vec_id", "leaf", "vec").mapInArrow(search, "query_id long, vec_id long, score double, leaf int")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).drop("r").toPandas()


def _calibrate(tree: Tree, index: DataFrame, queries: DataFrame, k: int, recall: float, sample: int, dim: int) -> tuple[int, float]:
    """(leaves to visit, share of the true neighbours of the sampled queries they hold)."""
    n = queries.count()
    share = int(min(1.0, sample / max(1, n)) * (1 << 30))
    chosen = queries.select("vec_id", "vec").where(F.pmod(F.xxhash64("vec_id", F.lit(29)), F.lit(1 << 30)) <= share).toPandas()
    if not len(chosen):
        return 1, 1.0
    q = np.stack(chosen["vec"].to_numpy()).astype(np.float64)
    truth = _exact(index, chosen["vec_id"].to_numpy(np.int64), q, k, dim)
    if not len(truth):
        return 1, 1.0
    # where in its query's order the leaf of each true neighbour comes
    order = {int(i): np.argsort(tree.best_bin_first(x, tree.leaves)) for i, x in zip(chosen["vec_id"], q)}
    place = np.array([order[i][leaf] for i, leaf in zip(truth["query_id"], truth["leaf"])])
    visits = 1
    while (place < visits).mean() < recall:  # widen
        visits += max(1, visits // 16)
    return min(visits, tree.leaves), float((place < visits).mean())


@dataclass
class Search:
    """What a search found, and what calibration measured."""

    found: DataFrame
    visits: int
    leaves: int
    calibrated_recall: float


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            recall: float = 0.95, leaf_rows: int = 256, fit_sample: int = 20_000, calibration: int = 300) -> Search:
    """The k rows with the largest inner product for each row for which ``is_query(id column)`` holds.

    ``found``: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id, and
    rows with the query's own id are no candidates.  All candidates are returned if there are
    fewer than k.  Rows that ``usable`` leaves out take no part; rows that repeat an id are
    candidates each, and of queries that repeat an id the one with the smaller vector is asked.
    """
    spark = vectors.sparkSession
    rows, dim = usable(vectors, id_col, vector_col)
    total = rows.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return Search(spark.createDataFrame([], schema), 0, 0, 1.0)
    # rows are drawn one by one, whatever their ids, and never more than twice as many are fetched
    drawn = rows if total <= fit_sample else rows.where(F.rand(31) < fit_sample / total).limit(2 * fit_sample)
    sample = drawn.orderBy("vec_id", "vec").toPandas()
    x = np.stack(sample["vec"].to_numpy()).astype(np.float64) if len(sample) else np.zeros((1, dim))
    tree = fit_tree(x, total, leaf_rows)
    shared = spark.sparkContext.broadcast(tree)

    def descend(batches):
        for batch in batches:
            leaf = shared.value.descend(_matrix(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(leaf, pa.int32()), batch.column(1)], names=["vec_id", "leaf", "vec"])

    # each row has a number of its own, so that rows of one id, and of one vector, are dealt out over shards
    index = stage(rows.mapInArrow(descend, "vec_id long, leaf int, vec array<double>").withColumn("row", F.rand(37)), "index")
    sizes = np.zeros(tree.leaves, np.int64)
    for r in index.groupBy("leaf").count().collect():  # a row a leaf
        sizes[r["leaf"]] = r["count"]
    # `copies` rows have the query's own id and are no candidates
    queries = index.where(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min("vec").alias("vec"), F.count(F.lit(1)).alias("copies"))
    visits, calibrated = _calibrate(tree, index, queries, k, recall, calibration, dim)

    block = (np.cumsum(sizes) - sizes) // SHARD_ROWS
    ends = [FIRST_LEAVES]
    while ends[-1] < tree.leaves:
        ends.append(ends[-1] * WIDER)

    def visit(batches):
        for batch in batches:
            rows, blocks, rounds, leaves = [], [], [], []
            for i, (v, n) in enumerate(zip(_matrix(batch.column(1), dim), batch.column(2).to_pylist())):
                own = np.array(shared.value.best_bin_first(v, visits, sizes, k + n), np.int64)
                turn = np.searchsorted(ends, np.arange(len(own)), side="right")
                order = np.lexsort((block[own], turn))
                cut = np.flatnonzero((np.diff(turn[order]) != 0) | (np.diff(block[own[order]]) != 0)) + 1
                for part in np.split(order, cut):
                    rows.append(i)
                    blocks.append(int(block[own[part[0]]]))
                    rounds.append(int(turn[part[0]]))
                    leaves.append(own[part].tolist())
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(blocks, pa.int32()), pa.array(rounds, pa.int32()),
                 pa.array(leaves, pa.list_(pa.int32()))], names=["query_id", "q", "block", "turn", "leaves"])

    visited = stage(queries.mapInArrow(visit, "query_id long, q array<double>, block int, turn int, leaves array<int>"), "visits")
    # widening rounds: each visits some times more leaves than those before, and keeps only rows that reach
    # the k-th best score so far, so that a round adds a few times k rows a query, however many it looks at
    best, turn = None, 0
    longest = visited.agg(F.max("turn")).first()[0]
    while best is None or turn <= (-1 if longest is None else longest):
        now = visited.where(F.col("turn") == turn)
        if best is None:
            now = now.withColumn("floor", F.lit(-float("inf")))
        else:
            reached = best.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
            now = now.join(reached.drop("n"), "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-float("inf"))))
        near = _meet(now, index, sizes, block, k)
        best = stage(_best(near if best is None else best.unionByName(near), k), "best")
        turn += 1
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = best.withColumn("rank", F.row_number().over(order)).select("query_id", "rank", "vec_id", "score")
    return Search(found, visits, tree.leaves, calibrated)


def _best(near: DataFrame, k: int) -> DataFrame:
    """Each query's k best rows, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def _meet(visited: DataFrame, index: DataFrame, sizes: np.ndarray, block: np.ndarray, k: int) -> DataFrame:
    """query_id, vec_id, score: of the leaves that a query visits in a block, its k best rows from ``floor`` on."""
    spark = index.sparkSession
    # a block's rows and the queries that visit it are dealt out so that groups stay small: a row a block, and one a leaf
    asked = {r["block"]: r["count"] for r in visited.groupBy("block").count().collect()}
    held = np.bincount(block, sizes, len(sizes) and int(block.max()) + 1).astype(np.int64)
    dealt = {b: (int(-(-max(1, int(held[b])) // SHARD_ROWS)), int(-(-n // CHUNK_QUERIES))) for b, n in asked.items()}
    by_block = F.broadcast(spark.createDataFrame([(b, *d) for b, d in dealt.items()], "block int, shards int, chunks int"))
    by_leaf = F.broadcast(spark.createDataFrame([(i, int(b), *dealt[int(b)]) for i, b in enumerate(block) if int(b) in dealt],
                                                "leaf int, block int, shards int, chunks int"))
    q_side = visited.join(by_block, "block").select(
        "query_id", "q", "floor", "leaves", "block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
        F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int").alias("chunk"))
    x_side = index.join(by_leaf, "leaf").select(
        "vec_id", "vec", "leaf", "block", F.pmod(F.xxhash64("vec_id", "vec", "row"), F.col("shards")).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))

    def meet(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if len(queries) and len(rows):
            q_ids, q, floor = queries["query_id"].to_numpy(), np.stack(queries["q"].to_numpy()), queries["floor"].to_numpy()
            ids, x, leaf = rows["vec_id"].to_numpy(), np.stack(rows["vec"].to_numpy()), rows["leaf"].to_numpy()
            wanted = np.concatenate(queries["leaves"].to_list())
            asking = np.repeat(np.arange(len(queries)), queries["leaves"].map(len))
            for own in np.unique(leaf):
                who, there = asking[wanted == own], leaf == own
                out.append(_score_block(q_ids[who], q[who], ids[there], x[there], k, floor[who]))
        query, vec, score = (np.concatenate(c) for c in zip(*out))
        order = np.lexsort((vec, -score, query))
        query, vec, score = query[order], vec[order], score[order]
        best = np.arange(len(query)) - np.searchsorted(query, query) < k
        return pd.DataFrame({"query_id": query[best], "vec_id": vec[best], "score": score[best]})

    by = ["block", "shard", "chunk"]
    return q_side.groupBy(*by).cogroup(x_side.groupBy(*by)).applyInPandas(meet, "query_id long, vec_id long, score double")
