"""Vector code compression: product codes by an integer Lloyd over two trees.

Components become integers, vectors are cut into equal parts, and every part position has a codebook.
Rounds assign each part to the nearest entry and replace entries by their parts' mean (floor), exactly:

1. Rows are cut into blocks of bounded size; for every block and part position a balanced k-d tree over
   its parts is built once and stored: points in tree order, and the box and sum of every node.
2. A round broadcasts the codebooks (a fixed size).  In each block a tree over the entries meets the tree
   over the parts, level by level: of a pair of nodes the smallest and largest distance between
   their boxes bound all distances below, so entry nodes that are farther than another's largest
   distance go.  A node of parts for which one entry remains is assigned whole, its stored sum added.
3. Points of leaves that stay uncertain are compared to the entries left, in integers; ties go
   to the lower index.
4. Sums and counts of the tasks (a fixed number of rows each) are added by Spark.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, stage

#: Components are floor(SCALE * x); their size must stay below LARGEST, so that distances fit 64 bits.
SCALE = 4096
LARGEST = 1 << 27
#: Numbers of a block (rows times components), and points of a leaf at most.
BLOCK_NUMBERS = 1 << 19
LEAF = 32
_FAR = np.iinfo(np.int64).max


# ------------------------------------------------------------------------- trees

def _tree(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the points, first and last of each node, children) of a balanced k-d tree: nodes are cut at
    the median of their widest component, down to ``leaf`` points; children of node i are ``kids[i]`` and the next, or -1."""
    order = np.arange(len(points))
    spans, kids, at = [(0, len(points))], [-1], 0
    while at < len(spans):
        a, b = spans[at]
        if b - a > leaf and points.shape[1]:
            own = points[order[a:b]]
            wide = own.max(axis=0) - own.min(axis=0)
            if wide.any():
                mid = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, int(np.argmax(wide))], mid)]
                kids[at] = len(spans)
                spans += [(a, a + mid), (a + mid, b)]
                kids += [-1, -1]
        at += 1
    return order, np.array(spans, np.int64).reshape(-1, 2), np.array(kids, np.int64)


class PartTree:
    """A tree over points: in tree order, with the box, sum and size of every node."""

    def __init__(self, order, points, spans, kids, low, high, sums):
        self.order, self.points, self.spans, self.kids = order, points, spans, kids
        self.low, self.high, self.sums = low, high, sums

    @classmethod
    def build(cls, points: np.ndarray, leaf: int = LEAF) -> "PartTree":
        order, spans, kids = _tree(points, leaf)
        own = points[order]
        if len(own):
            low = np.stack([own[a:b].min(axis=0) for a, b in spans])
            high = np.stack([own[a:b].max(axis=0) for a, b in spans])
        else:
            low = high = np.zeros((1, points.shape[1]), np.int64)
        total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(own, axis=0)])
        return cls(order, own, spans, kids, low, high, total[spans[:, 1]] - total[spans[:, 0]])

    def pack(self) -> dict:
        return {"order": self.order.astype("<i4").tobytes(), "points": self.points.astype("<i4").tobytes(),
                "spans": self.spans.astype("<i4").tobytes(), "kids": self.kids.astype("<i4").tobytes(),
                "low": self.low.astype("<i4").tobytes(), "high": self.high.astype("<i4").tobytes(),
                "sums": self.sums.astype("<i8").tobytes()}

    @classmethod
    def unpack(cls, own: dict, width: int) -> "PartTree":
        def read(name, kind="<i4", columns=None):
            x = np.frombuffer(own[name], kind).astype(np.int64)
            return x if columns is None else x.reshape(len(x) // columns if columns else -1, columns)

        order, spans, kids = read("order"), read("spans", columns=2), read("kids")
        if not width:
            nothing = np.zeros((len(spans), 0), np.int64)
            return cls(order, np.zeros((len(order), 0), np.int64), spans, kids, nothing, nothing, nothing)
        return cls(order, read("points", columns=width), spans, kids, read("low", columns=width),
                   read("high", columns=width), read("sums", "<i8", width))


class EntryTree:
    """A tree over the entries of a codebook, by level: boxes, and which nodes of the next level are below."""

    def __init__(self, entries: np.ndarray):
        order, spans, kids = _tree(entries, 1)
        members = [order[a:b] for a, b in spans]
        self.levels, now = [], [0]
        while True:
            self.levels.append((np.stack([entries[members[i]].min(axis=0) for i in now]),
                                np.stack([entries[members[i]].max(axis=0) for i in now])))
            if all(kids[i] < 0 for i in now):
                break
            below, up = [], []
            for k, i in enumerate(now):
                own = [i] if kids[i] < 0 else [int(kids[i]), int(kids[i]) + 1]
                below += own
                up += [k] * len(own)
            self.levels[-1] += (np.array(up),)
            now = below
        #: equal entries share a last node, whose lowest index stands for it: ties go there
        self.index = np.array([int(members[i].min()) for i in now])


def candidates(low: np.ndarray, high: np.ndarray, tree: EntryTree) -> np.ndarray:
    """For boxes of points (a row each), which last nodes of the entry tree can hold a nearest entry."""
    left = np.ones((len(low), 1), bool)
    for level in tree.levels:
        e_low, e_high = level[0], level[1]
        gap = np.maximum(np.maximum(e_low[None] - high[:, None], low[:, None] - e_high[None]), 0)
        reach = np.maximum(high[:, None] - e_low[None], e_high[None] - low[:, None])
        least, most = (gap ** 2).sum(axis=2), (reach ** 2).sum(axis=2)
        bound = np.where(left, most, _FAR).min(axis=1)
        left = left & (least <= bound[:, None])
        if len(level) > 2:
            left = left[:, level[2]]
    return left


def assign(tree: PartTree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the nearest entry of each point in tree order, sums and counts by entry)."""
    own = np.zeros(len(tree.points), np.int64)
    sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
    if not len(own):
        return own, sums, counts
    by = EntryTree(entries)
    active = np.zeros(1, np.int64)
    uncertain = []
    while len(active):
        left = candidates(tree.low[active], tree.high[active], by)
        alone = left.sum(axis=1) == 1
        for node, index in zip(active[alone], by.index[np.argmax(left[alone], axis=1)]):
            a, b = tree.spans[node]
            own[a:b] = index  # the whole node, with its stored sum
            sums[index] += tree.sums[node]
            counts[index] += b - a
        leaf = tree.kids[active] < 0
        uncertain += [(node, row) for node, row in zip(active[~alone & leaf], left[~alone & leaf])]
        inner = tree.kids[active[~alone & ~leaf]]
        active = np.concatenate([inner, inner + 1])
    if uncertain:
        spans = tree.spans[[node for node, _ in uncertain]]
        sizes = spans[:, 1] - spans[:, 0]
        at = np.repeat(spans[:, 0] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        by_index = np.argsort(by.index)
        possible = np.repeat(np.stack([row for _, row in uncertain])[:, by_index], sizes, axis=0)
        index = by.index[by_index]
        x, far = tree.points[at], np.empty(possible.shape, np.int64)
        for k, e in enumerate(entries[index]):
            far[:, k] = ((x - e) ** 2).sum(axis=1)
        far[~possible] = _FAR
        own[at] = index[np.argmin(far, axis=1)]
        np.add.at(sums, own[at], x)
        counts += np.bincount(own[at], minlength=len(entries))
    return own, sums, counts


# ------------------------------------------------------------------------ blocks

_PART = ("struct<order:binary,points:binary,spans:binary,kids:binary,low:binary,high:binary,sums:binary>")


def _integers(column, dim: int) -> np.ndarray:
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), dim)
    v = np.floor(x * SCALE)
    if v.size and np.abs(v).max() >= LARGEST:
        raise ValueError(f"components of {LARGEST // SCALE} and more aren't supported")
    return v.astype(np.int64)


def _blocks(rows: DataFrame, dim: int, parts: int) -> DataFrame:
    """Rows in blocks: ids, labels, and a packed tree a part position."""
    id_type, label_type = rows.schema["vec_id"].dataType.simpleString(), rows.schema["label"].dataType.simpleString()
    most, width = max(256, BLOCK_NUMBERS // max(1, dim)), dim // parts

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                own = batch.slice(at, most)
                v = _integers(own.column(2), dim)
                trees = [PartTree.build(v[:, p * width:(p + 1) * width]).pack() for p in range(parts)]
                kind = pa.struct([(n, pa.binary()) for n in trees[0]])
                yield pa.RecordBatch.from_arrays([
                    pa.array([own.column(0).to_pylist()], pa.list_(own.schema.field(0).type)),
                    pa.array([own.column(1).to_pylist()], pa.list_(own.schema.field(1).type)),
                    pa.array([trees], pa.list_(kind))], names=["ids", "labels", "parts"])

    return rows.select("vec_id", "label", "vec").mapInArrow(
        cut, f"ids array<{id_type}>, labels array<{label_type}>, parts array<{_PART}>")


def _trees(batch: pa.RecordBatch, at: int, width: int) -> list[PartTree]:
    return [PartTree.unpack(own, width) for own in batch.column(batch.schema.get_field_index("parts"))[at].as_py()]


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round of assignments."""
    parts, entries, width = books.shape
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def meet(batches):
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries, 1), np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                for p, tree in enumerate(_trees(batch, at, width)):
                    _, s, n = assign(tree, shared.value[p])
                    sums[p] += s
                    counts[p, :, 0] += n
        both = np.concatenate([counts, sums], axis=2)  # the count stands before the components
        part, entry, place = np.nonzero(np.broadcast_to(counts > 0, both.shape))
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in (part, entry, place)] + [
            pa.array(both[part, entry, place])], names=["part", "entry", "place", "n"])

    total = blocks.select("parts").mapInArrow(meet, "part int, entry int, place int, n long").groupBy(
        "part", "entry", "place").agg(F.sum("n").alias("n")).collect()  # a codebook's size
    both = np.zeros((parts, entries, width + 1), np.int64)
    for r in total:
        both[r["part"], r["entry"], r["place"]] = r["n"]
    used = both[:, :, 0] > 0
    out = books.copy()
    out[used] = both[used][:, 1:] // both[used][:, :1]
    return out


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks): a row a kept vector with vec_id, label, code (binary, an index a part) and error (its
    squared distances in integers, summed over parts); codebooks by part, entry and component.

    Codebooks start as the parts of the ``entries`` smallest vec_ids (null ids last, ties by vector; fewer rows
    give fewer entries).  Vectors that are null or hold null or non-finite components are dropped, and
    so are those whose length isn't the commonest (the smaller, if two are as common); that must be a
    multiple of ``parts``.  Components of 32768 and more, whose distances 64 bits can't hold, raise an
    error in the job.  Rows that repeat an id count each; an empty table gives no row and no entry.
    """
    if not 0 < entries <= 256:
        raise ValueError("codes have one byte a part: 1 to 256 entries")
    rows = pick(vectors, vec_id=id_col, vec=vector_col, label=label_col).withColumn("vec", F.col("vec").cast("array<double>"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.col("vec").isNotNull() & F.forall("vec", fine))
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim = sizes[0]["d"] if sizes else 0
    if dim % parts:
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts")
    rows = rows.where(F.size("vec") == dim)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    start = np.array([r["vec"] for r in first], np.float64).reshape(len(first), parts, dim // parts)
    books = np.ascontiguousarray(np.floor(start * SCALE).astype(np.int64).transpose(1, 0, 2))
    blocks = stage(_blocks(rows, dim, parts), "trees")
    for _ in range(rounds if len(first) else 0):
        books = _round(blocks, books)
    shared = blocks.sparkSession.sparkContext.broadcast(books)
    width = dim // parts

    def encode(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                ids, labels = batch.column(0)[at].values, batch.column(1)[at].values
                code, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                for p, tree in enumerate(_trees(batch, at, width)):
                    own, _, _ = assign(tree, shared.value[p])
                    code[tree.order, p] = own
                    error[tree.order] += ((tree.points - shared.value[p][own]) ** 2).sum(axis=1)
                data = code.tobytes()
                yield pa.RecordBatch.from_arrays([
                    ids, labels, pa.array([data[i:i + parts] for i in range(0, len(data), parts)], pa.binary()),
                    pa.array(error)], names=["vec_id", "label", "code", "error"])

    kinds = {n: rows.schema[n].dataType.simpleString() for n in ("vec_id", "label")}
    codes = blocks.mapInArrow(encode, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code binary, error long")
    return codes, books


def decode(code: bytes, books: np.ndarray) -> np.ndarray:
    """The vector a code stands for (the middle of each integer's step)."""
    return np.concatenate([books[p, i] for p, i in enumerate(code)]).astype(np.float64) / SCALE + 0.5 / SCALE


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, as decimal integers joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def report(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, **columns) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (over equal labels, nulls together) and
    codebooks_sha256."""
    codes, books = compress(vectors, parts, entries, rounds, **columns)
    codes = stage(codes, "codes")
    of_label = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return codes.join(of_label, codes["label"].eqNullSafe(of_label["of"])).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
