"""Benchmark decontamination by n-gram windows.

Windows of the benchmark items (``n`` consecutive words; an item of fewer words is
one window) are indexed by a rolling hash and broadcast; every document is scanned
once, in place: words become numbers of the benchmark's vocabulary, windows in
which every word is known are hashed with numpy, hashes found are verified word by
word, and the words of occurrences are marked.  Nothing is shuffled.

The index is broadcast in blocks of bounded size (``block_chars`` characters of
items); a larger benchmark takes several passes over the documents, each of which
adds to the marks of the last, so there is no size at which items are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, stage, temporary
from .words import word_spans, words

HITS = "struct<n_words:bigint,hits:array<struct<first:int,last:int>>,items:array<string>>"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every window of n numbers, modulo 2**64."""
    h = np.zeros(len(ids) - n + 1, np.uint64)
    v = (ids + 1).astype(np.uint64)
    for j in range(n):
        h = h * _BASE + v[j:len(v) - n + 1 + j]
    return h


class WindowIndex:
    """The hash set of windows: by window length, sorted hashes for the scan and the windows
    themselves with their items for the check."""

    def __init__(self, items: list[tuple[str, str | None]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)]
            size = min(n, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                self.windows.setdefault(size, {}).setdefault(tuple(ids[i:i + size]), set()).add(item)
        self.hashes = {size: np.unique(_hashes_of(own)) for size, own in self.windows.items()}

    def find(self, text: str | None) -> tuple[int, np.ndarray | None, set[str]]:
        """(number of words, mask of hit words or None, items that occur)."""
        own = words(text)
        get, none = self.vocabulary.get, -1
        ids = np.fromiter((get(w, none) for w in own), np.int64, len(own))
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        mask, items = None, set()
        for size, hashes in self.hashes.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(at):
                continue
            h = np.zeros(len(at), np.uint64)
            for j in range(size):
                h = h * _BASE + (ids[at + j] + 1).astype(np.uint64)
            k = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for i in at[hashes[k] == h].tolist():
                found = self.windows[size].get(tuple(ids[i:i + size].tolist()))  # the words themselves
                if found:
                    items |= found
                    mask = np.zeros(len(ids), bool) if mask is None else mask
                    mask[i:i + size] = True
        return len(own), mask, items


def _hashes_of(windows) -> np.ndarray:
    return np.array([_hashes(np.array(w, np.int64), len(w))[0] for w in windows], np.uint64)


def _runs(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2])]


def find(docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", block_chars: int = 32 << 20, into: str = "hits") -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, hits (runs of hit words, first and last
    word from 0) and items (ids of items with occurring windows, as strings, sorted).

    Null and empty texts have no words; null or empty items have no window; items without
    an id count as the item ""; repeated items and rows change nothing; an empty table on
    either side gives no hit.  Other columns of ``docs`` stay as they are.
    """
    spark = docs.sparkSession
    items = pick(benchmark, item=item_col, text=item_text_col).where(F.col("text").isNotNull()).select(
        F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), "text").distinct()
    chars = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-chars // block_chars))
    names = docs.columns
    at = names.index(text_col)
    tmp = [f"c{i}" for i in range(len(names))]
    acc = temporary("hits")
    out = docs.toDF(*tmp)
    for b in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        index = spark.sparkContext.broadcast(WindowIndex([(r["item"], r["text"]) for r in own.collect()], n))
        out = out.withColumn(acc, _scan(index, b > 0)(F.col(tmp[at]), *([F.col(acc)] if b else [])))
        if blocks > 1:  # one block's index in the workers at a time
            out = stage(out, "hits")
    return out.toDF(*names, into)


def _scan(index, has_before: bool):
    def one(text, before=None):
        n, mask, items = index.value.find(text)
        if before is not None:
            mask = np.zeros(n, bool) if mask is None else mask
            for r in before["hits"]:
                mask[r["first"]:r["last"] + 1] = True
            items = items | set(before["items"])
        return n, [] if mask is None else _runs(mask), sorted(items, key=lambda s: s.encode())

    if has_before:
        @F.pandas_udf(HITS)
        def scan(text: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
            rows = [one(t, {"hits": h, "items": i} if len(h) else None)
                    for t, h, i in zip(text, before["hits"], before["items"])]
            return pd.DataFrame(rows, columns=["n_words", "hits", "items"])
    else:
        @F.pandas_udf(HITS)
        def scan(text: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([one(t) for t in text], columns=["n_words", "hits", "items"])
    return scan


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
           **kw) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated (n_hit > 0), a row a document."""
    found = find(pick(docs, doc_id=id_col, text=text_col), benchmark, n, "text", into="found", **kw)
    found = found.select("doc_id", "found.n_words", "found.hits", "found.items")  # the text stays behind
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"] + 1)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without the contaminated ones, columns as they were."""
    names, into = docs.columns, temporary("found")
    found = find(docs, benchmark, n, text_col, into=into, **kw)
    return found.where(F.size(F.col(into)["hits"]) == 0).drop(into).toDF(*names)


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with the hit words cut out of the text, from the first word of each run to its last."""
    @F.pandas_udf("string")
    def cut(text: pd.Series, hits: pd.Series) -> pd.Series:
        def one(t, own):
            if not len(own):
                return t
            data, spans, at, out = t.encode("utf-8", "replace"), word_spans(t), 0, []
            for r in own:
                out.append(data[at:spans[r["first"]][0]])
                at = spans[r["last"]][1]
            return b"".join([*out, data[at:]]).decode("utf-8", "replace")
        return pd.Series([one(t, h) for t, h in zip(text, hits)], dtype=object)

    names, into = docs.columns, temporary("found")
    at = names.index(text_col)
    found = find(docs, benchmark, n, text_col, into=into, **kw).toDF(*[f"c{i}" for i in range(len(names))], into)
    return found.select(*[cut(F.col(f"c{i}"), F.col(into)["hits"]) if i == at else F.col(f"c{i}")
                          for i in range(len(names))]).toDF(*names)
