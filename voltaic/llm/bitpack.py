"""Token ids in fixed-width bit-packed files with block offsets.

Every id takes the fewest bits that hold the vocabulary.  Ids are packed in blocks
of ``BLOCK`` (a multiple of 64, so blocks start on a word), whose byte offsets
are stored, so any range of ids is read by unpacking the blocks it touches.

File layout, little-endian:

====================  ==========================================================
``VBP1``              4 bytes
width, block          uint32 each: bits an id, ids a block
documents, ids        uint64 each
blocks                uint64
starts                uint64 x (documents + 1): first id of each document
offsets               uint64 x (blocks + 1): byte offset of each block in the payload
payload               blocks of ceil(ids / 64) * width words of 64 bits
====================  ==========================================================

Documents are dealt out by range of doc_id and sorted within a task, each task
writes files of at most ``FILE_IDS`` ids (or one longer document), and the manifest
of what committed tasks wrote is all that readers go by: a file left by a lost
or repeated task is never read.  Files go through pyarrow's file systems (local
or mounted paths, HDFS, S3, GCS) below the shared folder.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltaic.session import scratch_path
from voltaic.sources import files

from .common import pick, stage
from .tokens import encoder

MAGIC = b"VBP1"
BLOCK = 4096
FILE_IDS = 8 << 20
#: Ids packed at a time.
AT_ONCE = 1 << 18
#: Files are read by at most so many tasks, several files a task beyond.
MOST_READ_TASKS = 50_000
_HEAD = struct.Struct("<4sIIQQQ")


def width_of(vocabulary_size: int) -> int:
    """Fewest bits that hold every id below the vocabulary size."""
    return max(1, (max(1, vocabulary_size) - 1).bit_length())


def pack_ids(ids: np.ndarray, width: int) -> bytes:
    """ids (below 2 ** width) as consecutive ``width``-bit fields of 64-bit words; 64 ids take
    ``width`` words, and the last group is filled up with zeros."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    groups = -(-len(ids) // 64)
    v = np.zeros((groups, 64), np.uint64)
    v.reshape(-1)[:len(ids)] = ids
    out = np.zeros((groups, width), "<u8")
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[:, word] |= v[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= v[:, j] >> np.uint64(64 - shift)
    return out.tobytes()


def unpack_ids(data: bytes, width: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed data, as uint32."""
    words = np.frombuffer(data, "<u8").reshape(-1, width)
    v = np.empty((len(words), 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        x = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (words[:, word + 1] << np.uint64(64 - shift))
        v[:, j] = x & mask
    return v.reshape(-1)[:n].astype("<u4")


def file_bytes(documents: list[np.ndarray], width: int, block: int = BLOCK) -> bytes:
    """A whole file of the documents' ids."""
    starts = np.concatenate([[0], np.cumsum([len(d) for d in documents])]).astype("<u8")
    ids = np.concatenate(documents) if documents else np.empty(0, "<u4")
    # blocks are whole words, so that many are packed in one go
    payload = [pack_ids(ids[i:i + AT_ONCE], width) for i in range(0, len(ids), AT_ONCE)]
    blocks, total = -(-len(ids) // block), sum(map(len, payload))
    offsets = np.minimum(np.arange(blocks + 1) * (block // 64 * width * 8), total).astype("<u8")
    head = _HEAD.pack(MAGIC, width, block, len(documents), len(ids), blocks)
    return b"".join([head, starts.tobytes(), offsets.tobytes(), *payload])


class PackedFile:
    """Random access to one file, given any object with read_at(bytes, offset)."""

    def __init__(self, source):
        self.source = source
        magic, self.width, self.block, self.documents, self.ids, self.blocks = _HEAD.unpack(
            self._read(0, _HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a bit-packed token file")
        at = _HEAD.size
        self.starts = np.frombuffer(self._read(at, 8 * (self.documents + 1)), "<u8")
        at += 8 * (self.documents + 1)
        self.offsets = np.frombuffer(self._read(at, 8 * (self.blocks + 1)), "<u8")
        self.payload = at + 8 * (self.blocks + 1)

    def _read(self, at: int, n: int) -> bytes:
        data = self.source.read_at(n, at)
        data = data.to_pybytes() if hasattr(data, "to_pybytes") else bytes(data)
        if len(data) != n:
            raise ValueError("the file is cut short")
        return data

    def slice(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last`` (exclusive): reads and unpacks the blocks they touch."""
        if first >= last:
            return np.empty(0, "<u4")
        a, b = first // self.block, (last - 1) // self.block + 1
        lo, hi = int(self.offsets[a]), int(self.offsets[b])
        n = min(self.ids, b * self.block) - a * self.block
        ids = unpack_ids(self._read(self.payload + lo, hi - lo), self.width, n)
        return ids[first - a * self.block:last - a * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.starts[k]), int(self.starts[k + 1]))

    def in_order(self, at_once: int = 1 << 18):
        """All documents, one after the other, ``at_once`` ids (or one longer document) read at a time."""
        k = 0
        while k < self.documents:
            last = int(np.searchsorted(self.starts, self.starts[k] + np.uint64(at_once), "right")) - 1
            last = min(max(last, k + 1), self.documents)
            first = int(self.starts[k])
            ids = self.slice(first, int(self.starts[last]))
            for d in range(k, last):
                yield ids[int(self.starts[d]) - first:int(self.starts[d + 1]) - first]
            k = last


def _qualified(spark, path: str) -> str:
    """The path with the file system that Spark resolves it on, so that tasks go to the same one."""
    _, root, fs = files.file_system(spark, path)
    own = fs.makeQualified(root).toString()
    return own.replace("file:/", "file:///", 1) if own.startswith("file:/") and not own.startswith("file://") else own


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def write_packed(docs: DataFrame, vocabulary: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", path: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode every document, append the end id and write the ids in ascending doc_id order.

    Returns the manifest: file, part and number (their order is that of the ids), n_docs,
    n_ids, n_bytes and doc_ids.  Null ids come first; rows that repeat an id follow each
    other; null and empty texts hold the end id only; an empty table writes no file.
    """
    spark = docs.sparkSession
    root = _qualified(spark, path or scratch_path(spark, "llm-ids"))
    src = pick(docs, doc_id=id_col, text=text_col).withColumn("tie", F.xxhash64("text")).withColumn("row", F.rand(41))
    # the text is moved once, by range: repeated ids are told apart by their text's hash, and rows
    # that repeat both, whose order makes no difference, are spread by a number of their own
    dealt = src.repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    id_type = dealt.schema["doc_id"].dataType.simpleString()

    def write(batches):
        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        width, end = width_of(max(enc.vocabulary, end_id + 1)), np.array([end_id], "<u4")
        fs, base = _open(root)
        fs.create_dir(base, recursive=True)
        own: list[np.ndarray] = []
        keys, n, number = [], 0, 0

        def flush():
            name = f"part-{part:06d}-{number:05d}-{uuid.uuid4().hex[:12]}.vbp"
            data = file_bytes(own, width)
            with fs.open_output_stream(f"{base}/{name}") as f:
                f.write(data)
            return pa.RecordBatch.from_arrays([
                pa.array([name]), pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                pa.array([len(own)], pa.int64()), pa.array([n], pa.int64()), pa.array([len(data)], pa.int64()),
                pa.array([keys], pa.list_(key_type))], names=["file", "part", "number", "n_docs", "n_ids", "n_bytes", "doc_ids"])

        for batch in batches:
            key_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([enc.encode(text.as_py()), end])
                if own and n + len(ids) > file_ids:
                    yield flush()
                    own, keys, n, number = [], [], 0, number + 1
                own.append(ids)
                keys.append(key)
                n += len(ids)
        if own:
            yield flush()

    manifest = dealt.mapInArrow(
        write, f"file string, part int, number int, n_docs long, n_ids long, n_bytes long, doc_ids array<{id_type}>")
    return stage(manifest.withColumn("root", F.lit(root)), "manifest")


def read_packed(manifest: DataFrame) -> DataFrame:
    """Every document as read back from the files: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32.  Only files in the manifest are read, each in one task, a
    document's blocks at a time."""
    id_type = manifest.schema["doc_ids"].dataType.elementType.simpleString()
    # ids before a file: those of earlier parts (one row a task of the write), and of earlier files of its part
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("of_parts"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    at = manifest.withColumn("of_files", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(parts, "part")
    at = at.select("root", "file", (F.col("of_parts") + F.col("of_files")).alias("base"), "doc_ids")

    def read(batches):
        for batch in batches:
            for root, name, base, keys in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                fs, folder = _open(root)
                with fs.open_input_file(f"{folder}/{name}") as f:
                    packed = PackedFile(f)
                    own = [(len(d), zlib.crc32(d.tobytes())) for d in packed.in_order()]
                    yield pa.RecordBatch.from_arrays([
                        keys.values, pa.array(packed.starts[:-1].astype(np.int64) + base),
                        pa.array([x for x, _ in own], pa.int64()), pa.array([x for _, x in own], pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # dealt out one file a task (a number is given, so that small rows don't end in one task)
    files = manifest.count()
    return at.repartition(max(1, min(files, MOST_READ_TASKS))).mapInArrow(
        read, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")
