"""Ranked lexical search by scanning the documents: Aho-Corasick over all query terms.

1. One automaton holds every term of the items, each between two spaces (the boundary guard);
   documents are scanned as their terms joined by single spaces, so an output of the
   automaton is one occurrence of a whole term.  It is broadcast, in blocks of items of
   bounded size; there is no index of the documents, and their text is never moved.
2. A first scan counts documents, terms and the documents that hold each term (a bounded
   number of rows a task, summed by Spark).
3. A second scan counts tf from the text, maps terms to the items that ask for them and adds up
   the scores of a block of documents; a task keeps the best few documents of every
   item, and the best of all tasks are chosen by a window.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick
from .words import words

#: Characters of item texts in one automaton.
BLOCK_CHARS = 2 << 20
#: Scores (documents times items) and occurrences held at a time.
_AT_ONCE = 1 << 20


class TermScanner:
    """Occurrences of terms in texts."""

    def __init__(self, terms: list[bytes]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(terms):
            self.automaton.add_word(f" {t.decode('utf-8', 'replace')} ", i)
        if terms:
            self.automaton.make_automaton()
        self.empty = not terms

    def scan(self, text: str | None) -> tuple[int, np.ndarray]:
        """(terms of the text, number of the query term at each of its occurrences)."""
        own = words(text)
        if not own or self.empty:
            return len(own), np.empty(0, np.int64)
        joined = " " + b" ".join(own).decode("utf-8", "replace") + " "
        return len(own), np.fromiter((i for _, i in self.automaton.iter(joined)), np.int64)


_SCANNERS: dict[str, TermScanner] = {}


def _scanner(shared) -> TermScanner:
    """This worker's scanner of the broadcast (name, terms), one at a time."""
    name, terms = shared.value
    if name not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[name] = TermScanner(terms)
    return _SCANNERS[name]


def _scanned(batches, shared, width: int):
    """Blocks of documents: (ids, terms a document, and document, term, tf of each pair that occurs); blocks
    hold ``width`` documents at most."""
    scanner, n_terms = _scanner(shared), max(1, len(shared.value[1]))
    ids, sizes, found, held = [], [], [], 0

    def block():
        doc = np.repeat(np.arange(len(found)), [len(f) for f in found])
        pair, tf = np.unique(doc * n_terms + np.concatenate(found), return_counts=True)
        return ids, np.array(sizes, np.int64), pair // n_terms, pair % n_terms, tf

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            n, own = scanner.scan(text.as_py())
            ids.append(key)
            sizes.append(n)
            found.append(own)
            held += len(own)
            if len(ids) >= width or held >= _AT_ONCE:
                yield block()
                ids, sizes, found, held = [], [], [], 0
    if ids:
        yield block()


def _statistics(docs: DataFrame, shared) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all their terms, documents that hold each query term)."""
    n_terms = len(shared.value[1])

    def count(batches):
        df, n, length = np.zeros(n_terms + 1, np.int64), 0, 0
        for _, sizes, _, term, _ in _scanned(batches, shared, 4096):
            df[:n_terms] += np.bincount(term, minlength=n_terms)[:n_terms]
            n, length = n + int((sizes > 0).sum()), length + int(sizes.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([held, [-1, -2]]).astype(np.int32)),
            pa.array(np.concatenate([df[held], [n, length]]).astype(np.int64))], names=["term", "n"])

    rows = docs.mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row a query term
    got = {r["term"]: r["n"] for r in rows}
    df = np.zeros(n_terms, np.int64)
    for term, n in got.items():
        if term >= 0:
            df[term] = n
    return got.get(-1, 0), got.get(-2, 0), df


class _Best:
    """The k best documents of each item: highest score first, then smallest id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.zeros(items, np.int64)  # the score of the k-th
        self.rows = [np.empty(0, np.int64)] * 4  # item, score, whether the id is null, id
        self.waiting: list[list[np.ndarray]] = []
        self.n_waiting = 0

    def add(self, ids: list, scores: np.ndarray) -> None:
        doc, item = np.nonzero((scores > 0) & (scores >= self.floor))
        none = np.array([i is None for i in ids])
        key = np.array([0 if i is None else i for i in ids], np.int64)
        self.waiting.append([item, scores[doc, item], none[doc].astype(np.int64), key[doc]])
        self.n_waiting += len(item)
        if self.n_waiting >= 4 * self.k * len(self.floor):
            self.settle()

    def settle(self) -> None:
        both = [np.concatenate(c) for c in zip(self.rows, *self.waiting)]
        order = np.lexsort((both[3], both[2], -both[1], both[0]))
        item = both[0][order]
        place = np.arange(len(order)) - np.searchsorted(item, item)
        self.rows = [c[order[place < self.k]] for c in both]
        last = order[place == self.k - 1]
        self.floor[both[0][last]] = both[1][last]
        self.waiting, self.n_waiting = [], 0


def _ranked(docs: DataFrame, items: list[tuple], shared, item_terms: list[Counter], numbers: tuple, k: int) -> DataFrame:
    """item (number), doc_id, score: of each task, the k best of each item."""
    n_docs, n_all, df = numbers
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    # the items that ask for a term, and how often
    asked = sorted((t, i, c) for i, own in enumerate(item_terms) for t, c in own.items())
    term, item, times = (np.array(c, np.int64) for c in zip(*asked)) if asked else [np.empty(0, np.int64)] * 3
    first = np.searchsorted(term, np.arange(len(df) + 1))
    n_items = len(items)
    postings = docs.sparkSession.sparkContext.broadcast((weight, item, times, first))

    def rank(batches):
        weight, item, times, first = postings.value
        best = _Best(n_items, k)
        for ids, sizes, doc, term, tf in _scanned(batches, shared, max(1, _AT_ONCE // n_items)):
            m = 100 - 25 + (25 * sizes * n_docs) // max(1, n_all)
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
            scores = np.zeros(len(ids) * n_items, np.int64)
            wide = first[term + 1] - first[term]
            ends = np.cumsum(wide)
            for a, b in _cuts(ends):  # pairs are spread over the items in bounded pieces
                w = wide[a:b]
                at = np.repeat(first[term[a:b]] - (np.cumsum(w) - w), w) + np.arange(int(w.sum()))
                np.add.at(scores, np.repeat(doc[a:b], w) * n_items + item[at], np.repeat(value[a:b], w) * times[at])
            best.add(ids, scores.reshape(-1, n_items))
        best.settle()
        yield pa.RecordBatch.from_arrays([
            pa.array(best.rows[0].astype(np.int32)), pa.array(best.rows[3], pa.int64(), mask=best.rows[2] == 1),
            pa.array(best.rows[1])], names=["item", "doc_id", "score"])

    return docs.mapInArrow(rank, "item int, doc_id long, score long")


def _cuts(ends: np.ndarray):
    """Runs (first, last exclusive) of rows that make at most four times _AT_ONCE together, or one row."""
    a, done, most = 0, 0, 4 * _AT_ONCE
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, done + most, "right")))
        yield a, b
        a, done = b, int(ends[b - 1])


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents with the highest score above 0 for each item.

    Terms are runs of letters, digits and characters beyond ASCII, only A-Z lower-cased.  N documents hold a
    term, and all their terms are L; a term in df documents weighs ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))``; a
    document of n terms has ``m = 100 - 25 + (25 n N) div L`` and scores ``w * ((10**9 tf) div (1000 tf + 12 m))`` a
    term of the item, repeats included, in 64-bit integers.  Equal scores go by ascending doc_id, null ids
    last; ids are 64-bit integers.

    Null and empty texts hold no term: they are never found, and such items find nothing.  Rows that
    repeat a doc_id are documents each.  Rows that repeat an item and its text count once; an item with
    several texts is one item of all their terms; items without an id are one item.  Empty tables give no
    row; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = pick(items, item=item_col, text=item_text_col).where("length(text) > 0").distinct()
    item_type = asked.schema["item"].dataType.simpleString()
    chars = asked.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks, numbers, out = max(1, -(-chars // block_chars)), None, []
    for b in range(blocks):
        own = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        by_item: dict = {}
        for r in own.collect():  # a block of items, of bounded size
            by_item.setdefault(r["item"], Counter()).update(words(r["text"]))
        by_item = {i: c for i, c in by_item.items() if c}
        if not by_item:
            continue
        terms = sorted({t for c in by_item.values() for t in c})
        number = {t: i for i, t in enumerate(terms)}
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, terms))
        numbers = _statistics(rows, shared)
        names = list(by_item)
        best = _ranked(rows, names, shared, [Counter({number[t]: n for t, n in c.items()}) for c in by_item.values()], numbers, k)
        known = spark.createDataFrame(list(enumerate(names)), f"item int, item_id {item_type}")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out.append(best.join(F.broadcast(known), "item").select("item_id", "rank", "doc_id", "score"))
    if not out:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole
