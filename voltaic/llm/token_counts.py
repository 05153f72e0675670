"""Token counts that follow edits.

For every document a segment tree over its pre-tokens is kept: leaves are runs of
about ``LEAF`` characters that end where the pre-tokenizer splits whatever stands around
(before a space that a word follows, or after a line break before a word), with their token
counts; inner nodes hold sums.  An edit touches the leaves it overlaps and, as boundary
context, the one on either side; only these are split and encoded again, and their counts
go up the tree.  Everything else of the document is neither read nor encoded.

Trees are a table like any other (text, leaf lengths, sums), so they can be stored and
edited again later.  One pass of rows for building, one join by document for edits.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick
from .tokens import encoder

#: Characters a leaf holds at least, if the text has places to split at.
LEAF = 512
#: A place to split: one ASCII space or line break between visible characters.
_SPLIT = re.compile(r"(?<=\S)(?= [^\s\x1c-\x1f\x85\xa0])|(?<=\S\n)(?=[^\s\x1c-\x1f\x85\xa0])")

def split(text: str, leaf: int = LEAF) -> list[int]:
    """Lengths of the leaves of a text."""
    out, at = [], 0
    while len(text) - at > leaf:
        m = _SPLIT.search(text, at + leaf)
        if m is None or m.start() >= len(text):
            break
        out.append(m.start() - at)
        at = m.start()
    if at < len(text):
        out.append(len(text) - at)
    return out


class SegmentTree:
    """Counts of leaves as a complete binary tree in one array: node i has children 2 i and 2 i + 1, and
    node 1 is the whole document."""

    def __init__(self, counts: list[int]):
        self.size = 1 << max(0, (len(counts) - 1).bit_length())
        self.sums = np.zeros(2 * self.size, np.int64)
        self.sums[self.size:self.size + len(counts)] = counts
        for i in range(self.size - 1, 0, -1):
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @classmethod
    def of(cls, sums) -> "SegmentTree":
        own = cls.__new__(cls)
        own.sums = np.array(sums, np.int64)
        own.size = len(own.sums) // 2
        return own

    def total(self) -> int:
        return int(self.sums[1])

    def count(self, leaf: int) -> int:
        return int(self.sums[self.size + leaf])

    def put(self, leaf: int, count: int) -> None:
        """Change a leaf and the sums above it."""
        i = self.size + leaf
        more = count - int(self.sums[i])
        while i and more:
            self.sums[i] += more
            i //= 2

    def prefix(self, leaf: int) -> int:
        """Tokens before a leaf."""
        i, out = self.size + leaf, 0
        while i > 1:
            if i & 1:
                out += int(self.sums[i - 1])
            i //= 2
        return out


def build(text: str | None, count, leaf: int = LEAF) -> tuple[list[int], SegmentTree]:
    """(leaf lengths, tree) of a text; ``count`` gives the tokens of a string."""
    text = text or ""
    lengths, at, counts = split(text, leaf), 0, []
    for n in lengths:
        counts.append(count(text[at:at + n]))
        at += n
    return lengths, SegmentTree(counts)


def tidy(edits, length: int) -> list[tuple[int, int, str]]:
    """Edits in order: (first, last exclusive, replacement), clipped to the text; one that
    overlaps an earlier one, or with a null or reversed place, is left out."""
    out, at = [], -1
    for first, last, new in sorted((e for e in edits if e[0] is not None and e[1] is not None), key=lambda e: (e[0], e[1], e[2] or "")):
        first, last = max(0, int(first)), min(length, int(last))
        if first > last or first > length or first < at or (first == at and first == last and out and out[-1][:2] == (first, last)):
            continue
        out.append((first, last, new or ""))
        at = max(last, at, 0)
    return out


def edit(text: str | None, lengths: list[int], tree: SegmentTree, edits, count, leaf: int = LEAF):
    """(new text, lengths, tree, edits made, characters encoded again)."""
    text = text or ""
    todo = tidy(edits, len(text))
    if not todo:
        return text, list(lengths), tree, 0, 0
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    leaves = len(lengths)
    # leaves that an edit touches, with one on either side
    regions: list[list[int]] = []
    for first, last, _ in todo:
        a = int(np.searchsorted(starts[:-1], first, "right")) - 1 if leaves else 0
        b = int(np.searchsorted(starts[:-1], max(first, last - 1), "right")) - 1 if leaves else 0
        a, b = max(0, a - 1), min(leaves, b + 2)
        if regions and a <= regions[-1][1]:
            regions[-1][1] = max(regions[-1][1], b)
        else:
            regions.append([a, b])
    pieces, new_lengths, changed, at, k, encoded = [], [], [], 0, 0, 0
    same_leaves = True
    for a, b in regions:
        pieces.append(text[int(starts[at]):int(starts[a])])
        new_lengths += lengths[at:a]
        lo, hi = int(starts[a]), int(starts[b])
        own, here = [], lo
        while k < len(todo) and todo[k][0] <= hi and (todo[k][0] < hi or b == leaves):
            first, last, new = todo[k]
            own += [text[here:first], new]
            here = last
            k += 1
        own.append(text[here:hi])
        region = "".join(own)
        parts, p = split(region, leaf), 0
        same_leaves = same_leaves and len(parts) == b - a
        for n in parts:
            changed.append((len(new_lengths), count(region[p:p + n])))
            new_lengths.append(n)
            p += n
        encoded += len(region)
        pieces.append(region)
        at = b
    pieces.append(text[int(starts[at]):])
    new_lengths += lengths[at:]
    if same_leaves:  # the leaves keep their places: only sums above the changed ones move
        tree = SegmentTree.of(tree.sums)
        for i, n in changed:
            tree.put(i, n)
    else:  # leaves moved: counts of the others are taken over, and sums are built anew
        counts, fresh, old, at = [0] * len(new_lengths), dict(changed), [], 0
        for a, b in regions:
            old += range(at, a)
            at = b
        old += range(at, leaves)
        kept = iter(old)
        for i in range(len(new_lengths)):
            counts[i] = fresh[i] if i in fresh else tree.count(next(kept))
        tree = SegmentTree(counts)
    return "".join(pieces), new_lengths, tree, len(todo), encoded


def _counter(vocabulary: str):
    return lambda text: len(encoder(vocabulary).encode(text))


def with_trees(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, lengths, sums, n_tokens: every document's segment tree and token count.

    Null and empty texts have a tree of one empty leaf and no tokens; rows are counted one
    by one, whatever their ids; an empty table gives no row; other columns are ignored."""
    @F.pandas_udf("lengths array<int>, sums array<bigint>")
    def run(text: pd.Series) -> pd.DataFrame:
        count = _counter(vocabulary)
        own = [build(t, count) for t in text]
        return pd.DataFrame({"lengths": [x for x, _ in own], "sums": [t.sums for _, t in own]})

    own = pick(docs, doc_id=id_col, text=text_col).withColumn("tree", run("text"))
    return own.select("doc_id", "text", "tree.lengths", "tree.sums", F.element_at("tree.sums", 2).alias("n_tokens"))


_EDITED = "text string, lengths array<int>, sums array<bigint>, n_edits int, n_encoded bigint"
_COUNTED = "n_tokens bigint, n_edits int, n_chars bigint, n_encoded bigint"


def _edited(text, lengths, sums, edits, count):
    """(new text, lengths, tree, edits made, characters encoded again)."""
    new, lengths, tree, made, encoded = edit(text, list(lengths), SegmentTree.of(sums), edits, count)
    return text if text is None and not made else new, lengths, tree, made, encoded


def edit_rows(trees: DataFrame, edits_col: str, vocabulary: str) -> DataFrame:
    """Trees after the edits in the column ``edits_col`` (array of struct first, last, new: characters
    ``first`` to ``last``, exclusive, of the text become ``new``): doc_id, text, lengths, sums,
    n_before, n_tokens, n_edits, n_encoded (characters encoded again)."""
    @F.pandas_udf(_EDITED)
    def run(text: pd.Series, lengths: pd.Series, sums: pd.Series, edits: pd.Series) -> pd.DataFrame:
        count, out = _counter(vocabulary), []
        for t, n, s, own in zip(text, lengths, sums, edits):
            own = [] if own is None else [(e["first"], e["last"], e["new"]) for e in own]
            new, n, tree, made, encoded = _edited(t, n, s, own, count)
            out.append((new, n, tree.sums, made, encoded))
        return pd.DataFrame(out, columns=["text", "lengths", "sums", "n_edits", "n_encoded"])

    own = trees.withColumn("edited", run("text", "lengths", "sums", F.col(edits_col)))
    return own.select("doc_id", "edited.text", "edited.lengths", "edited.sums", F.col("n_tokens").alias("n_before"),
                      F.element_at("edited.sums", 2).alias("n_tokens"), "edited.n_edits", "edited.n_encoded")


def count_edited(trees: DataFrame, find: Callable[[str], list[tuple[int, int, str]]], vocabulary: str) -> DataFrame:
    """What edits would make of the counts, without the edited texts: doc_id, n_before, n_tokens, n_edits, n_chars (null
    for a null text) and n_encoded.  ``find`` gives the edits of a text (first, last exclusive, new); they are found and made
    in one pass."""
    @F.pandas_udf(_COUNTED)
    def run(text: pd.Series, lengths: pd.Series, sums: pd.Series) -> pd.DataFrame:
        count, out = _counter(vocabulary), []
        for t, n, s in zip(text, lengths, sums):
            own = find(t) if t else []
            if own:
                new, _, tree, made, encoded = _edited(t, n, s, own, count)
                out.append((tree.total(), made, len(new), encoded))
            else:
                out.append((int(s[1]), 0, None if t is None else len(t), 0))
        rows = pd.DataFrame(out, columns=["n_tokens", "n_edits", "n_chars", "n_encoded"])
        return rows.astype({"n_chars": "Int64"})

    own = trees.withColumn("counted", run("text", "lengths", "sums"))
    return own.select("doc_id", F.col("n_tokens").alias("n_before"), "counted.*")


def apply_edits(trees: DataFrame, edits: DataFrame, vocabulary: str) -> DataFrame:
    """Trees after edits given as a table: doc_id, first, last, new.  Documents without edits stay as
    they are, edits of unknown or null ids do nothing, and each of the rows that repeat an id is edited."""
    own = edits.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.collect_list(F.struct("first", "last", "new")).alias("edits"))
    return edit_rows(trees.join(own, "doc_id", "left"), "edits", vocabulary)


#: Personal data that the registered query's edits mask: e-mail addresses, IPv4 addresses, long digit runs
#: and phone numbers.
MASKED = (
    (r"[\w.+-]+@[\w-]+\.[\w.-]+", "<mail>"),
    (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<ip>"),
    (r"\+?\d[\d ()-]{8,}\d", "<number>"),
)
_MASKED = re.compile("|".join(f"({p})" for p, _ in MASKED))


def masks(text: str) -> list[tuple[int, int, str]]:
    """The edits that mask personal data in a text."""
    return [(m.start(), m.end(), MASKED[m.lastindex - 1][1]) for m in _MASKED.finditer(text)]
