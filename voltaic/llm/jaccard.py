"""Exact Jaccard join of documents on their word shingles, by blocked sparse matrix products.

Two documents link when ``100 |A & B| >= percent |A | B|``.  The product of the document by shingle
matrix with its transpose has all overlaps; only blocks of it that can hold a link are computed:

1. Every text becomes its set of hashed shingles (polynomial prefix sums over bytes, numpy).  Shingles are
   dealt out packed (eight bytes each) and counted, so that each is known by how many rows hold it.
   Those that one row holds alone never overlap and are left behind: sizes stand for them.
2. With a set's shingles ordered rarest first, links share one among the first ``n - ceil(percent n / 100) + 1`` of both.
   Most texts have nothing but lone shingles there and are done.  The others are put under these columns, and
   columns chain rows whose sizes can link (classes of sizes, neighbouring ones at most): components of
   that graph hold every link, and are the blocks.
3. In a block the overlaps are accumulated, rare columns pair by pair and frequent ones by matrix products, and pairs
   below the bound their sizes give are discarded.  Links leave a block as stars, not as pairs.
4. A block of more rows or shingles than a task should hold is dealt out over tiles; the tiles' hubs meet, which
   brings together what is one group of near copies; then rows outside the largest group so far meet
   all rows of compatible size, tile by tile.  Nothing is left out, and members of one group don't meet again.

Rows are known by 64-bit hashes of their sets, so copies meet nothing: a chance of N**2 / 2**65 that two of N different sets
are taken for one, and about 2**-55 a pair of shingles.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, stage
from .components import connected_components

#: Rows and shingles of a block that one task holds.
MOST_ROWS = 2048
MOST_SHINGLES = 4 << 20
#: Shingles and rows that are dealt out together, and bytes of text hashed at a time.
GROUP_SHINGLES = 1 << 20
GROUP_ROWS = 60_000
CHUNK_BYTES = 1 << 20
#: Columns of so many rows at most are accumulated pair by pair, others by products of so many columns.
RARE = 16
PRODUCT_COLUMNS = 1024

_U = np.uint64
_B = _U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_B_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(11).integers(0, 1 << 64, 256, np.uint64)  # a number for each byte
_LOW = _U(0xFFFF)


# -------------------------------------------------------------------- shingles

def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_B, _B_INVERSE)):
            own = np.full(n, base, np.uint64)
            own[0] = 1
            _POWERS[k] = np.multiply.accumulate(own)
    return _POWERS[0][:n], _POWERS[1][:n]


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _hash_runs(data: bytes, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes ``first`` to ``last`` (exclusive)."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[np.frombuffer(data, np.uint8)] * up[:-1], out=total[1:])
    h = (total[last] - total[first]) * down[first]
    for multiplier in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> _U(33))) * _U(multiplier)
    return h ^ (h >> _U(33))


def _of_words(texts: list[list[bytes]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every shingle of some texts, each a list of words that isn't empty."""
    data = b"\n".join([b" ".join(own) for own in texts]) + b"\n"
    seen = np.frombuffer(data, np.uint8)
    last = np.flatnonzero((seen == 32) | (seen == 10))  # no word holds these
    first = np.concatenate([[0], last[:-1] + 1])
    n = np.array([len(own) for own in texts])
    each = np.minimum(n, size)  # words of a shingle
    rows = n - each + 1
    doc = np.repeat(np.arange(len(texts)), rows)
    word = np.repeat(np.cumsum(n) - n - (np.cumsum(rows) - rows), rows) + np.arange(int(rows.sum()))
    return doc, _hash_runs(data, first[word], last[word + each[doc] - 1])


def shingle_sets(texts: list[str | None], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(n, hashes): how many distinct shingles each text has, and their hashes, text by text, ascending.

    Words are runs without ASCII white space, A-Z lower-cased; a text of fewer words is one shingle."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    own, at, held = [], [], 0

    def flush():
        nonlocal own, at, held
        if own:
            doc, h = _of_words(own, size)
            found.append((np.array(at)[doc], h))
        own, at, held = [], [], 0

    for i, text in enumerate(texts):
        words = text.encode("utf-8", "replace").lower().split() if text else []
        if not words:
            continue
        step = max(size, CHUNK_BYTES // (1 + max(map(len, words))) if len(text) > CHUNK_BYTES else len(words))
        for a in range(0, max(1, len(words) - size + 1), step):  # long texts by runs of words
            part = words[a:a + step + size - 1]
            own.append(part)
            at.append(i)
            held += sum(map(len, part)) + len(part)
            if held >= CHUNK_BYTES:
                flush()
    flush()
    if not found:
        return np.zeros(len(texts), np.int64), np.empty(0, np.uint64)
    doc, h = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return np.bincount(doc[new], minlength=len(texts)), h[new]


def prefix_length(n, percent: int):
    """Shingles of a set of n, in the common order, of which a link shares one."""
    return n + percent * n * -1 // 100 + 1


def runs_of(batches, column: int = 0):
    """(key, list of record batches) of each run of equal keys; the rows stand sorted by key."""
    key, own = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(column).to_numpy(zero_copy_only=False)
        edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if own and keys[a] != key:
                yield key, own
                own = []
            key = keys[a]
            own.append(batch.slice(a, b - a))
    if own:
        yield key, own


def _bytes_of(column, kind: str) -> np.ndarray:
    """The numbers of a column of packed arrays, one after the other."""
    return np.frombuffer(b"".join(x.as_py() for x in column), kind)


# ----------------------------------------------------------------- rare columns

_DEALT = "part int, grp long, entries binary, ranks binary, ids {ids}, sizes binary, nodes binary"


def _deal(docs: DataFrame, size: int, parts: int) -> DataFrame:
    """Shingles of groups of documents, packed by part, and a row a group with its documents.

    An entry is the upper 48 bits of the shingle and, below, the document's place in the group; the lower 16 bits
    choose the part."""
    ids = f"array<{docs.schema['doc_id'].dataType.simpleString()}>"

    def deal(batches):
        number, keys, sizes, nodes, hashes, places, seen = 0, [], [], [], [], [], set()

        def flush():
            h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
            place = np.concatenate(places) if places else np.empty(0, np.uint64)
            part = ((h & _LOW) * _U(parts)) >> _U(16)
            entry = (h & ~_LOW) | place
            order = np.lexsort((entry, part))
            part, entry = part[order], entry[order]
            edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.empty(0, int)
            ends = np.concatenate([edge[1:], [len(part)]]) if len(part) else edge
            grp = (TaskContext.get().partitionId() << 32) | number
            packed = [entry[a:b].astype("<u8").tobytes() for a, b in zip(edge, ends)] + [None]
            n = len(packed)
            own = pa.array([None] * (n - 1) + [keys], pa.list_(key_type))
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([part[edge].astype(np.int32), [np.int32(grp % parts)]]), pa.int32()),
                pa.array([grp] * n, pa.int64()), pa.array(packed, pa.binary()), pa.array([None] * n, pa.binary()), own,
                pa.array([None] * (n - 1) + [np.array(sizes, "<i8").tobytes()], pa.binary()),
                pa.array([None] * (n - 1) + [np.array(nodes, "<i8").tobytes()], pa.binary())],
                names=["part", "grp", "entries", "ranks", "ids", "sizes", "nodes"])

        held = 0
        for batch in batches:
            key_type = batch.schema.field(0).type
            texts = batch.column(1)
            for at in range(0, batch.num_rows, 512):
                own = texts.slice(at, 512).to_pylist()
                n, h = shingle_sets(own, size)
                ends = np.cumsum(n)
                for key, k, end in zip(batch.column(0).slice(at, 512).to_pylist(), n.tolist(), ends.tolist()):
                    mine = h[end - k:end]
                    node = int(np.uint64(xxhash.xxh3_64_intdigest(mine.tobytes())).view(np.int64)) if k else 0
                    if k and node not in seen:  # copies within a task are counted once
                        if len(seen) < 1 << 20:
                            seen.add(node)
                        hashes.append(mine)
                        places.append(np.full(k, len(keys), np.uint64))
                        held += k
                    keys.append(key)
                    sizes.append(k)
                    nodes.append(node)
                    if held >= GROUP_SHINGLES or len(keys) >= GROUP_ROWS:
                        yield flush()
                        number, held = number + 1, 0
                        keys, sizes, nodes, hashes, places = [], [], [], [], []
        if keys:
            yield flush()

    return docs.mapInArrow(deal, _DEALT.format(ids=ids))


def _rank(rows: np.ndarray) -> np.ndarray:
    """A byte that grows with the number of rows that hold a shingle: any order serves, one by rarity is quick."""
    return np.minimum(255, 8 * np.log2(rows)).astype(np.uint8)


def _count(dealt: DataFrame, parts: int) -> DataFrame:
    """Groups' entries of shingles that several rows hold, with their ranks; rows of documents pass through."""
    def count(batches):
        for part, own in runs_of(batches):
            table = pa.Table.from_batches(own)
            there = np.array([x is not None for x in table.column("entries").to_pylist()])
            rest = table.filter(pa.array(~there))
            yield from rest.to_batches()
            table = table.filter(pa.array(there))
            if not table.num_rows:
                continue
            packed = table.column("entries")
            entry = _bytes_of(packed, "<u8")
            row = np.repeat(np.arange(table.num_rows), [len(x.as_py()) // 8 for x in packed])
            order = np.argsort(entry >> _U(16), kind="stable")
            key = entry[order] >> _U(16)
            edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            n = np.diff(np.concatenate([edge, [len(key)]]))
            several = np.repeat(n > 1, n)
            rank, order = np.repeat(_rank(n), n)[several], order[several]
            by_row = np.argsort(row[order], kind="stable")
            rank, order = rank[by_row], order[by_row]
            cut = np.searchsorted(row[order], np.arange(table.num_rows + 1))
            some = [(a, b) for a, b in zip(cut[:-1], cut[1:]) if b > a]
            at = [i for i in range(table.num_rows) if cut[i + 1] > cut[i]]
            if not at:
                continue
            groups, n = table.column("grp").to_numpy()[at], len(at)
            yield pa.RecordBatch.from_arrays([
                pa.array([part] * n, pa.int32()), pa.array(groups, pa.int64()),
                pa.array([entry[order[a:b]].tobytes() for a, b in some], pa.binary()),
                pa.array([rank[a:b].tobytes() for a, b in some], pa.binary()), pa.nulls(n, table.schema.field("ids").type),
                pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names=table.schema.names)

    return dealt.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(count, dealt.schema)


def _columns(counted: DataFrame, parts: int, percent: int) -> DataFrame:
    """node, n, class (of its size), shared (its shingles that other rows hold too, packed) and cols (those of them that
    a link shares one of), for rows that have such columns."""
    base = math.log(100 / percent * 1.0001)

    def gather(batches):
        for _, own in runs_of(batches):
            table = pa.Table.from_batches(own)
            sizes, nodes = _bytes_of(table.column("sizes").drop_null(), "<i8"), _bytes_of(table.column("nodes").drop_null(), "<i8")
            there = np.array([x is not None for x in table.column("entries").to_pylist()])
            table = table.filter(pa.array(there))
            if not table.num_rows:
                continue
            entry, rank = _bytes_of(table.column("entries"), "<u8"), _bytes_of(table.column("ranks"), "u1")
            part = np.repeat(table.column("part").to_numpy(), [len(x.as_py()) for x in table.column("ranks")]).astype(np.uint64)
            place, shingle = (entry & _LOW).astype(np.int64), (entry & ~_LOW) | part
            order = np.lexsort((shingle, rank, place))
            place, shingle = place[order], shingle[order]
            edge = np.searchsorted(place, np.arange(len(sizes) + 1))
            m = np.diff(edge)
            take = prefix_length(sizes, percent) - (sizes - m)  # lone shingles come first
            at = np.flatnonzero((m > 0) & (take > 0))
            if not len(at):
                continue
            out = [shingle[edge[i]:edge[i + 1]] for i in at]
            first = [x[:t].view(np.int64) for x, t in zip(out, take[at])]
            yield pa.RecordBatch.from_arrays([
                pa.array(nodes[at]), pa.array(sizes[at]),
                pa.array(np.floor(np.log(sizes[at]) / base).astype(np.int32)),
                pa.array([np.sort(x).tobytes() for x in out], pa.binary()),
                pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in first])]).astype(np.int32),
                                         np.concatenate(first))], names=["node", "n", "class", "shared", "cols"])

    rows = counted.repartition(parts, "grp").sortWithinPartitions("grp")
    rows = rows.select("grp", "part", "entries", "ranks", "sizes", "nodes")
    return rows.mapInArrow(gather, "node long, n long, class int, shared binary, cols array<long>")


# ---------------------------------------------------------------------- products

def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of some sets (sorted, distinct), as a matrix."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    shingle = np.concatenate(sets)
    doc = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(shingle, kind="stable")
    shingle, doc = shingle[order], doc[order]
    edge = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
    held = np.diff(np.concatenate([edge, [len(shingle)]]))
    for k in range(2, RARE + 1):  # rare columns, those of k rows together
        own = edge[held == k]
        if len(own):
            rows = doc[own[:, None] + np.arange(k)]
            for i in range(k):
                for j in range(i + 1, k):
                    np.add.at(out, (rows[:, i], rows[:, j]), 1)
    out += out.T
    often = np.flatnonzero(held > RARE)
    for a in range(0, len(often), PRODUCT_COLUMNS):
        some = often[a:a + PRODUCT_COLUMNS]
        x = np.zeros((n, len(some)), np.float32)
        at = np.repeat(edge[some] - (np.cumsum(held[some]) - held[some]), held[some]) + np.arange(int(held[some].sum()))
        x[doc[at], np.repeat(np.arange(len(some)), held[some])] = 1
        out += x @ x.T
    np.fill_diagonal(out, 0)
    return out


def stars(nodes: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, hub) that connect rows of a block as all their links do; a hub is the row of a group
    with most links."""
    if len(nodes) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # 100 c >= percent (a + b - c), in whole numbers: pairs below this bound are discarded
    both = sizes[:, None] + sizes[None, :]
    linked = overlaps(sets).astype(np.int64) * (100 + percent) >= percent * both
    np.fill_diagonal(linked, False)
    degree = linked.sum(axis=1)
    i, j = np.nonzero(np.triu(linked))
    root = np.arange(len(nodes))
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            break
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(up := root[root], root):
            root = up
    by = np.lexsort((nodes, -degree, root))  # the hub stands first in its group
    first = np.concatenate([[True], root[by][1:] != root[by][:-1]])
    hub = np.empty(len(nodes), np.int64)
    hub[by] = by[np.flatnonzero(first)[np.cumsum(first) - 1]]
    hung = np.flatnonzero(hub != np.arange(len(nodes)))
    return nodes[hung], nodes[hub[hung]]


def _multiply(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """(a, b): stars of the rows (node, n, shared) of each key."""
    def run(batches):
        for _, own in runs_of(batches):
            table = pa.Table.from_batches(own)
            nodes, at = np.unique(table.column("node").to_numpy(), return_index=True)
            packed = table.column("shared")
            a, b = stars(nodes, table.column("n").to_numpy()[at], [np.frombuffer(packed[int(i)].as_py(), np.uint64) for i in at], percent)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    key = F.xxhash64(*keys).alias("key")  # blocks that share a hash would be multiplied together, rightly
    return rows.select(key, "node", "n", "shared").repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def _large_blocks(rows: DataFrame, sizes: DataFrame, percent: int, most_rows: int, most_shingles: int) -> DataFrame:
    """(a, b): links within blocks of any size; rows hold root, node, n, class, shared, and sizes root, rows, shingles."""
    def tiles(of: DataFrame, keys: list[str]) -> DataFrame:
        number = F.ceil(F.greatest(F.col("rows") / most_rows, F.col("shingles") / most_shingles))
        return of.select(*keys, F.greatest(F.lit(1), number).cast("int").alias("tiles"))

    def tile_of(tiles_col: str = "tiles"):
        return F.pmod(F.xxhash64("node", F.lit(3)), F.col(tiles_col)).cast("int")

    # tiles by hash, then the hubs of all tiles
    dealt = rows.join(tiles(sizes, ["root"]), "root").withColumn("tile", tile_of())
    within = stage(_multiply(dealt, ["root", "tile"], percent), "tile-links")
    hubs = within.select(F.col("b").alias("node")).distinct()
    met = rows.join(hubs, "node")
    of_hubs = met.groupBy("root").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("shared") / 8).alias("shingles"))
    met = met.join(tiles(of_hubs, ["root"]), "root").withColumn("tile", tile_of())
    within = stage(within.union(_multiply(met, ["root", "tile"], percent)), "hub-links")
    # what isn't in the largest group of its block yet meets all rows that its size can link to
    grouped = connected_components(within)
    rows = stage(rows.join(grouped.withColumnRenamed("root", "grp"), "node", "left").withColumn("grp", F.coalesce("grp", "node")), "grouped")
    by_grp = rows.groupBy("root", "grp").count()
    main = by_grp.groupBy("root").agg(F.max(F.struct("count", "grp")).alias("m")).select("root", F.col("m.grp").alias("main"))
    rows = rows.join(main, "root").withColumn("open", F.col("grp") != F.col("main"))
    half = lambda c: (F.col(c) / 2)  # noqa: E731  two tiles meet, so each holds half
    cells = rows.groupBy("root", "class", "open").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("shared") / 8).alias("shingles"))
    cells = cells.withColumn("tiles", F.ceil(F.greatest(F.lit(1.0), half("rows") * 4 / most_rows, half("shingles") * 4 / most_shingles)).cast("int"))
    cells = cells.select("root", "class", "open", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), "tiles")
    one, two = cells.where("open"), cells
    pairs = one.select("root", *[F.col(c).alias(f"{c}_1") for c in ("class", "open", "tile", "tiles")]).join(
        two.select("root", *[F.col(c).alias(f"{c}_2") for c in ("class", "open", "tile", "tiles")]), "root")
    pairs = pairs.where(F.abs(F.col("class_1") - F.col("class_2")) <= 1)
    # open tiles meet each other once
    pairs = pairs.where(~F.col("open_2") | (F.struct("class_1", "tile_1") <= F.struct("class_2", "tile_2")))
    cell = F.xxhash64("root", "class_1", "tile_1", "class_2", "open_2", "tile_2")
    pairs = pairs.withColumn("cell", cell)
    sides = pairs.select("root", "cell", *[F.col(f"{c}_1").alias(c) for c in ("class", "open", "tile")]).union(
        pairs.select("root", "cell", *[F.col(f"{c}_2").alias(c) for c in ("class", "open", "tile")])).distinct()
    counts = cells.select("root", "class", "open", "tiles").distinct()
    placed = rows.join(counts, ["root", "class", "open"]).withColumn("tile", tile_of())
    return within.union(_multiply(placed.join(sides, ["root", "class", "open", "tile"]), ["cell"], percent))


def links(columns: DataFrame, percent: int = 80, most_rows: int = MOST_ROWS, most_shingles: int = MOST_SHINGLES) -> DataFrame:
    """(a, b): links that connect the rows of ``_columns`` as all pairs of the wanted similarity would."""
    rows = columns.select("node", "class", F.explode("cols").alias("col")).distinct()
    hubs = stage(rows.groupBy("col", "class").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("rows")), "hubs")
    chained = hubs.select("col", F.col("class").alias("above"), F.col("hub").alias("a")).join(
        hubs.select("col", (F.col("class") + 1).alias("above"), F.col("hub").alias("b")), ["col", "above"])
    crowded = rows.join(hubs.where("rows > 1"), ["col", "class"]).select(F.col("node").alias("a"), F.col("hub").alias("b"))
    blocks = connected_components(crowded.union(chained.select("a", "b")).where("a <> b").distinct())
    rows = stage(columns.drop("cols").join(blocks, "node").dropDuplicates(["node"]), "blocks")
    sizes = stage(rows.groupBy("root").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("shared") / 8).alias("shingles")), "sizes")
    small = (F.col("rows") <= most_rows) & (F.col("shingles") <= most_shingles)
    found = _multiply(rows.join(sizes.where(small), "root"), ["root"], percent)
    large = sizes.where(~small)
    if not large.isEmpty():
        found = found.union(_large_blocks(rows.join(large.select("root"), "root"), large, percent, most_rows, most_shingles))
    return found


def components(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
               **most) -> DataFrame:
    """doc_id, n_shingles (distinct shingles of ``size`` words) and component_id, a row a document.

    Documents link when their sets have a Jaccard similarity of ``percent`` or more; the component id is the
    smallest doc_id that links reach.  A text of fewer words is one shingle; null and empty texts, and texts without
    words, have none and link with nothing: their component id is their own.  Rows that repeat an id, or
    have none, count as documents (a component of null ids only has a null id); an empty table gives no
    row; other columns are ignored.
    """
    src = pick(docs, doc_id=id_col, text=text_col)
    parts = max(16, min(1 << 16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    counted = stage(_count(_deal(src, size, parts), parts), "shingles")
    columns = stage(_columns(counted, parts, percent), "columns")
    roots = connected_components(links(columns, percent, **most))

    def list_documents(batches):
        for batch in batches:
            for ids, sizes, nodes in zip(*(batch.column(i) for i in range(3))):
                yield pa.RecordBatch.from_arrays([
                    ids.values, pa.array(np.frombuffer(sizes.as_py(), "<i8")), pa.array(np.frombuffer(nodes.as_py(), "<i8"))],
                    names=["doc_id", "n", "node"])

    kind = src.schema["doc_id"].dataType.simpleString()
    each = counted.where("ids is not null").select("ids", "sizes", "nodes").mapInArrow(list_documents, f"doc_id {kind}, n long, node long")
    each = stage(each, "documents")
    filled = each.where("n > 0")
    least = stage(filled.groupBy("node").agg(F.min("doc_id").alias("least")), "least")
    rooted = least.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    owner = rooted.join(of_root, "root").select("node", "component_id")
    return filled.join(owner, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(
        each.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
