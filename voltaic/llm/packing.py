"""Best-fit packing of tokenised documents into fixed-capacity sequences.

Planned over the histogram of lengths, not over documents:

1. one pass encodes every document, cuts longer ones into pieces of the capacity
   and gives each piece its rank among the pieces of its length in its partition;
2. counts by length (at most ``capacity`` rows, whatever the input) reach the
   driver, and best-fit decreasing runs over the counts: equal lengths are placed
   by the run, so the plan is a list of slot runs;
3. pieces take their slots by joining on length and rank: runs are cut at every ``RANKS`` ranks, so that a
   piece meets the runs of its length that hold ranks next to its own, and no others.

No text or id moves: the one shuffle carries a few numbers per piece, keyed by
(length, partition of origin) and then by (length, ranks), so a length that very many pieces share is spread
over as many keys as there were input partitions.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, stage
from .tokens import encoder

#: Slot runs are broadcast up to here (48 bytes each) and joined with a shuffle beyond.
MOST_BROADCAST_RUNS = 200_000
#: Ranks of one length that are looked up together.
RANKS = 1024


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts by length.

    Returns runs (length, first rank, pieces, first sequence, pieces per sequence,
    offset): piece ``first rank + i`` of the length goes to sequence ``first
    sequence + i // per``, at ``offset + (i % per) * length``.  Sequences with the
    same free room are handled as groups; a length splits at most one group, so
    groups and runs depend on the capacity, not on the counts.
    """
    free: dict[int, list[tuple[int, int]]] = {}  # room left -> groups (first sequence, sequences)
    rooms: list[int] = []  # keys of free, ascending
    runs, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room not in free:
            free[room] = []
            insort(rooms, room)
        free[room].append((first, n))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} isn't between 1 and {capacity}")
        left, rank = counts[length], 0
        while left:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                n = -(-left // (capacity // length))
                put(capacity, sequences, n)
                sequences += n
                k = len(rooms) - 1
            room = rooms[k]
            first, n = free[room].pop()
            if not free[room]:
                del free[room]
                rooms.pop(k)
            per = room // length
            full = min(n, left // per)
            if full:
                runs.append((length, rank, full * per, first, per, capacity - room))
                rank, left = rank + full * per, left - full * per
                if room > per * length:
                    put(room - per * length, first, full)
                first, n = first + full, n - full
            if n and left and left < per:
                runs.append((length, rank, left, first, per, capacity - room))
                put(room - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            if n:
                put(room, first, n)
    return runs


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, and where the
    piece stands (``part``, ``rank_in_part`` among those of its length)."""
    src = pick(docs, doc_id=id_col, text=text_col)
    id_type = src.schema["doc_id"].dataType
    schema = (f"doc_id {id_type.simpleString()}, piece int, start long, length int, ids_crc32 long, "
              "part int, rank_in_part long" + (", ids binary" if with_ids else ""))

    def cut(batches):
        enc, part, ranks = encoder(vocabulary), TaskContext.get().partitionId(), {}
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for doc, text in zip(ids, batch.column(1)):
                raw = enc.encode(text.as_py()).tobytes() + end
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    own = raw[at:at + 4 * capacity]
                    n = len(own) // 4
                    rank = ranks.get(n, 0)
                    ranks[n] = rank + 1
                    rows.append((doc, piece, at // 4, n, zlib.crc32(own), part, rank) + ((own,) if with_ids else ()))
                if len(rows) >= 50_000:
                    yield _batch(rows, batch.schema.field(0).type, with_ids)
                    rows = []
            if rows:
                yield _batch(rows, batch.schema.field(0).type, with_ids)

    return src.mapInArrow(cut, schema)


def _batch(rows: list[tuple], id_type: pa.DataType, with_ids: bool) -> pa.RecordBatch:
    types = [id_type, pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()] + [pa.binary()] * with_ids
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank_in_part"] + ["ids"] * with_ids
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Where every piece of every document goes.

    Returns doc_id, piece (from 0), start (ids of the document before it), length,
    ids_crc32 (of its ids as little-endian unsigned 32-bit integers), sequence_id
    and offset; with ``with_ids`` also the ids themselves.  Null and empty texts are
    one piece that holds the end id; repeated and null doc_ids are packed row by
    row; an empty table gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    placed = stage(pieces(docs, vocabulary, capacity, end_id, id_col, text_col, with_ids), "pieces")
    by_part = placed.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # at most `capacity` rows reach the driver
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_best_fit(counts, capacity)
    runs = spark.createDataFrame(
        plan, "length int, first_rank long, pieces long, first_sequence long, per int, first_offset int")
    few = len(plan) + sum(-(-n // RANKS) for n in counts.values()) <= MOST_BROADCAST_RUNS
    last = F.floor((F.col("first_rank") + F.col("pieces") - 1) / RANKS)
    runs = runs.withColumn("ranks", F.explode(F.sequence(F.floor(F.col("first_rank") / RANKS), last)))
    if few:
        runs = F.broadcast(runs)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = placed.join(base, ["length", "part"]).withColumn("rank", F.col("base") + F.col("rank_in_part"))
    i = F.col("rank") - F.col("first_rank")
    joined = ranked.withColumn("ranks", F.floor(F.col("rank") / RANKS)).join(runs, ["length", "ranks"]).where((i >= 0) & (i < F.col("pieces")))
    return joined.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("first_sequence") + F.floor(i / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + (i % F.col("per")) * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack(..., with_ids=True)``: sequence_id,
    ids (binary, little-endian unsigned 32-bit), length.  A group is one sequence, so
    never more than the capacity."""
    own = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(own.alias("own"), F.sum("length").alias("length")).select(
        "sequence_id",
        F.unhex(F.array_join(F.transform("own", lambda x: F.hex(x["ids"])), "")).alias("ids"), "length")
