"""SimHash near-duplicates: fingerprints, bit-sliced comparison, components.

1. A fingerprint a document (XXH64 of its shingles, bitwise majority), then one row a
   distinct fingerprint: copies never meet each other again.
2. Fingerprints within ``radius`` bits agree on two of ``radius + 2`` blocks of bits, so each
   goes into one bucket for each pair of blocks, keyed by their bits.  Nothing is missed.
3. Buckets of up to ``MOST_IN_BUCKET`` members, sorted side by side, are compared bit-sliced:
   one bit plane holds a bit of 64 fingerprints a word; planes XORed with themselves
   shifted by s lanes feed carry-save counters that update 64 distances an operation, and
   words in which every distance is over the radius are abandoned.  Links are
   folded into a spanning forest where they are found.
4. Larger buckets are linked without comparing members: each member names the points
   at half the radius around it (radius 2: itself with one bit flipped), and those that name
   the same point are within the radius.  Linear in the bucket, and exact.
5. Components of the forest by alternating stars.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, stage
from .components import connected_components

BITS = 64
#: Members a bucket may have to be compared in one task.
MOST_IN_BUCKET = 4096
_AT_ONCE = 1 << 15
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority of the bits of XXH64 over shingles of words; 0 without words."""
    own = text.encode("utf-8", "replace").lower().split() if text else []  # bytes: A-Z and ASCII white space
    if not own:
        return 0
    joined, size = b" ".join(own), min(shingle, len(own))
    lengths = np.fromiter(map(len, own), np.int64, len(own))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[:len(own) - size + 1].tolist(), ends[size - 1:].tolist()
    counts, h = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _AT_ONCE):
        own_hashes = np.array([h(joined[a:b], seed) for a, b in zip(starts[at:at + _AT_ONCE], ends[at:at + _AT_ONCE])], "<u8")
        bits = np.unpackbits(own_hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int32)
    majority = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(shingle: int = 3, seed: int = 42):
    """Column function: text -> fingerprint as a signed 64-bit number."""
    @F.pandas_udf("long")
    def of(text: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle, seed) for t in text], np.uint64).view(np.int64))

    return of


# ------------------------------------------------------------------ comparison

def bit_planes(fingerprints: np.ndarray, planes: int = BITS) -> np.ndarray:
    """Plane b, word w, bit l: bit b of fingerprint 64 w + l (zeros behind the last)."""
    words = -(-len(fingerprints) // 64)
    bits = np.zeros((words * 64, BITS), np.uint8)
    bits[:len(fingerprints)] = np.unpackbits(
        np.ascontiguousarray(fingerprints, "<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8")[:planes]


def near_lanes(planes: np.ndarray, shift: int, lanes: np.ndarray, radius: int) -> np.ndarray:
    """Lanes i, of those set in ``lanes`` (a bit each), whose fingerprint is within ``radius`` bits of lane i + shift."""
    step, by = divmod(shift, 64)
    at = np.flatnonzero(lanes)
    digits = [np.zeros(len(at), np.uint64) for _ in range(max(1, (radius + 1).bit_length()))]
    over = ~lanes[at]
    padded = planes.shape[1]

    def moved(plane: np.ndarray) -> np.ndarray:
        lo = at + step
        out = np.where(lo < padded, plane[np.minimum(lo, padded - 1)], 0) >> np.uint64(by)
        if by:
            hi = lo + 1
            out = out | (np.where(hi < padded, plane[np.minimum(hi, padded - 1)], 0) << np.uint64(64 - by))
        return out

    for b, plane in enumerate(planes):
        carry = plane[at] ^ moved(plane)
        for k in range(len(digits)):  # carry-save: 64 counters a word go up by their bit
            digits[k], carry = digits[k] ^ carry, digits[k] & carry
        over |= carry | _above(digits, radius)
        if b % 8 == 7:
            live = over != _ALL
            if not live.any():
                return np.empty(0, np.int64)
            if not live.all():  # abandoned: every distance in the word is over the radius
                at, over, digits = at[live], over[live], [d[live] for d in digits]
    left = (~over).astype("<u8")
    bits = np.unpackbits(left.view(np.uint8), bitorder="little").reshape(-1, 64)
    word, lane = np.nonzero(bits)
    return at[word] * 64 + lane


def _above(digits: list[np.ndarray], radius: int) -> np.ndarray:
    """Counters that are over the radius, a bit each."""
    above, equal = np.zeros_like(digits[0]), np.full_like(digits[0], _ALL)
    for k in range(len(digits) - 1, -1, -1):
        if radius >> k & 1:
            equal = equal & digits[k]
        else:
            above, equal = above | (equal & digits[k]), equal & ~digits[k]
    return above


def forest_of_buckets(keys: np.ndarray, members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect members of the same key as their distances do; rows sorted by key."""
    n = len(members)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    planes = bit_planes(members.view(np.uint64))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.concatenate([first, [n]]))
    last = np.repeat(first + size, size)  # of each lane's bucket
    root = np.arange(n)
    lane = np.arange(n)
    for shift in range(1, int(size.max())):
        mask = np.zeros(planes.shape[1] * 64, np.uint8)
        mask[:n] = lane + shift < last
        i = near_lanes(planes, shift, np.packbits(mask, bitorder="little").view("<u8"), radius)
        j = i + shift
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j = i[apart], j[apart]
            np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
    hung = np.flatnonzero(root != lane)
    return members[hung], members[root[hung]]


# ---------------------------------------------------------------------- linking

def _blocks(radius: int) -> list[tuple[int, int]]:
    """(lowest bit, bits) of radius + 2 blocks that share the fingerprint evenly."""
    n = radius + 2
    edges = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _bits(fp: Column, low: int, n: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << n) - 1))


def _links_of_hot(members: DataFrame, radius: int) -> DataFrame:
    """Links within buckets of any size: members that name the same point around them are
    within the radius.  A point is named by a bounded number of distinct fingerprints."""
    pairs = list(combinations(_blocks(radius), 2))
    half, odd = divmod(radius, 2)

    def name(batches):
        for batch in batches:
            pair = batch.column(0).to_numpy(zero_copy_only=False)
            fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for p in np.unique(pair).tolist():
                fixed = {b for low, n in pairs[p] for b in range(low, low + n)}
                free = [b for b in range(BITS) if b not in fixed]
                own = fp[pair == p]
                for flips in range(half + 1):
                    for bits in combinations(free, flips):
                        point = own ^ np.uint64(sum(1 << b for b in bits))
                        for gone in (free if odd else [-1]):
                            at = point & ~np.uint64(1 << gone) if odd else point
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(own), p, np.int32)), pa.array(np.full(len(own), gone, np.int32)),
                                 pa.array(at.view(np.int64)), pa.array(own.view(np.int64))],
                                names=["pair", "gone", "point", "fp"])

    named = members.mapInArrow(name, "pair int, gone int, point long, fp long")
    least = F.min("fp").over(Window.partitionBy("pair", "gone", "point"))
    return named.select(F.col("fp").alias("a"), least.alias("b")).where("a <> b")


def links(fps: DataFrame, radius: int = 2, most_in_bucket: int = MOST_IN_BUCKET) -> DataFrame:
    """(a, b): links that connect distinct fingerprints (column fp) as all pairs within ``radius`` bits would."""
    pairs = list(combinations(_blocks(radius), 2))
    key = [F.struct(F.lit(p).alias("pair"), F.shiftleft(_bits(F.col("fp"), *x), y[1]).bitwiseOR(_bits(F.col("fp"), *y)).alias("bits"))
           for p, (x, y) in enumerate(pairs)]
    keyed = fps.select("fp", F.explode(F.array(*key)).alias("key")).select("key.pair", "key.bits", "fp")
    crowded = keyed.groupBy("pair", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stage(keyed.join(crowded, ["pair", "bits"]), "members")

    def compare(batches):
        left: list[np.ndarray] = [np.empty(0, np.int64)] * 3

        def out(k, m):
            a, b = forest_of_buckets(k, m, radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            rows = [np.concatenate([x, batch.column(c).to_numpy(zero_copy_only=False)]) for c, x in enumerate(left)]
            new = np.concatenate([[True], (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])])
            bucket, cut = np.cumsum(new), int(np.flatnonzero(new)[-1])
            if cut:  # the last bucket may go on in the next batch
                yield out(bucket[:cut], rows[2][:cut])
            left = [r[cut:] for r in rows]
        if len(left[0]):
            yield out(np.zeros(len(left[0]), np.int64), left[2])

    cold = members.where(F.col("n") <= most_in_bucket).select(F.col("pair").cast("long"), "bits", "fp")
    compared = cold.repartition("pair", "bits").sortWithinPartitions("pair", "bits", "fp").mapInArrow(compare, "a long, b long")
    hot = members.where(F.col("n") > most_in_bucket).select("pair", "fp")
    if not hot.isEmpty():
        compared = compared.union(_links_of_hot(hot, radius))
    return compared


def components(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text",
               most_in_bucket: int = MOST_IN_BUCKET) -> DataFrame:
    """doc_id, sig (hash of the text), fp, fingerprint (16 hex digits) and component_id, a row a document.

    Documents are linked if their fingerprints differ in ``radius`` bits or fewer; the
    component id is the smallest doc_id that links reach.  Texts without words have fingerprint
    0 and are linked like others; rows that repeat an id, or have none (null: component_id
    is null only if the whole component has none), count as documents; an empty table
    gives no row; other columns are ignored.
    """
    src = pick(docs, doc_id=id_col, text=text_col)
    fps = stage(src.select("doc_id", F.xxhash64("text").alias("sig"), fingerprints(shingle)("text").alias("fp")), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "sig")).alias("first")  # null ids last
    distinct = stage(fps.groupBy("fp").agg(first), "distinct")
    roots = connected_components(links(distinct.select("fp"), radius, most_in_bucket))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("of"))
    owner = rooted.join(smallest, "root").select("fp", F.col("of.doc_id").alias("component_id"), F.col("of.sig").alias("component_sig"))
    return fps.join(owner, "fp").select(
        "doc_id", "sig", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_sig")


def deduplicate(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text",
                **kw) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id (of rows that
    repeat an id, one; the smallest text hash decides between texts), columns as they were."""
    names = docs.columns
    tmp = [f"c{i}" for i in range(len(names))]
    own = components(docs, shingle, radius, id_col, text_col, **kw)
    is_first = F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("sig").eqNullSafe(F.col("component_sig"))
    own = stage(own.select("doc_id", "sig", is_first.alias("first")), "components")
    gone = own.where(~F.col("first")).select(F.col("doc_id").alias("_gone"), F.col("sig").alias("_gone_sig")).distinct()
    out = docs.toDF(*tmp).withColumn("sig", F.xxhash64(F.col(tmp[names.index(text_col)])))
    doc = F.col(tmp[names.index(id_col)])
    out = out.join(gone, doc.eqNullSafe(F.col("_gone")) & (F.col("sig") == F.col("_gone_sig")), "left_anti")
    repeated = own.where("first").groupBy("doc_id", "sig").count().where("count > 1")
    if not repeated.isEmpty():  # whole rows that repeat an id and a text
        out = out.dropDuplicates([tmp[names.index(id_col)], "sig"])
    return out.select(*tmp).toDF(*names)
