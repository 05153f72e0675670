"""Quality selection by importance resampling.

Two generative models over hashed n-grams, one of the target text (rows labelled good) and
one of the raw text (all rows), give every document an importance weight: the ratio of its
probabilities.  Documents are then sampled without replacement in proportion to their
weights, by the Gumbel top-k trick: log weight plus Gumbel noise, the k largest keys stay.

N-grams are of two kinds: words (one and two), and word shapes (two, with whether the second
word repeats the first), so that shouting, decoration, tables and stuck text, whose words are
new in every document, have n-grams of their own.  Counts are smoothed towards the
raw model, so that an n-gram too rare to judge by has a ratio near 1, and a shortfall that two
standard errors can explain is none: documents repeat their n-grams, so the error is
that of the number of documents that hold one, not of its occurrences.

The k-th largest key of all documents is found by counting keys in bins, a few passes over
a staged column of keys; nothing is sorted and no key list reaches the driver.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import may_learn, pick, stage

#: Features: hashed single words, word pairs, shape pairs.
WORD_BITS, PAIR_BITS, SHAPE_BITS = 15, 16, 12
SIZES = (1 << WORD_BITS, 1 << PAIR_BITS, 1 << SHAPE_BITS)
FEATURES = sum(SIZES)
_MANY = np.uint64(0x9E3779B97F4A7C15)
_AT_ONCE = 1 << 17
_TAIL = re.compile(r"[^\W_]*([\W_]*)$")


def shape(word: str) -> str:
    """Case or kind of a word, and the marks it ends in."""
    core = word.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    kind = ("-" if not core else "d" if core.isdigit() else "a" if core.islower() else
            "A" if core.isupper() and len(core) > 1 else "Aa" if core[0].isupper() and core[1:].islower() or len(core) == 1 else "x")
    return kind + _TAIL.search(word)[1][:4]


class _Numbers:
    """Hashes of words (upper 32 bits) and of their shapes (lower), remembered for the words met lately."""

    def __init__(self, most: int = 200_000):
        self.most, self.known = most, {}

    def of(self, own: list[str]) -> np.ndarray:
        got = list(map(self.known.get, own))
        if None in got:
            for i in [i for i, n in enumerate(got) if n is None]:
                got[i] = self._new(own[i])
        return np.array(got, np.uint64)

    def _new(self, word: str) -> int:
        n = self.known.get(word)  # the text may hold it twice
        if n is None:
            n = zlib.crc32(word.lower().encode("utf-8", "replace")) << 32 | zlib.crc32(shape(word).encode("utf-8", "replace"))
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[word] = n
        return n


_NUMBERS = _Numbers()
_LOW = np.uint64(0xFFFFFFFF)


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    h = h * _MANY
    h ^= h >> np.uint64(32)
    return ((h * _MANY) >> np.uint64(64 - bits)).astype(np.int64)


def features(text: str | None):
    """Arrays of the text's n-grams (numbers below FEATURES), some at a time."""
    own = text.split() if text else []
    numbers = _NUMBERS.of(own)
    for at in range(0, len(own), _AT_ONCE):
        both = numbers[at:at + _AT_ONCE + 1]  # pairs reach one word further
        w, s = both >> np.uint64(32), both & _LOW
        n = min(_AT_ONCE, len(own) - at)
        yield np.concatenate([
            _bucket(w[:n] + np.uint64(1), WORD_BITS),
            SIZES[0] + _bucket((w[:-1] << np.uint64(32)) + w[1:] + np.uint64(2), PAIR_BITS),
            SIZES[0] + SIZES[1] + _bucket((s[:-1] << np.uint64(33)) + (s[1:] << np.uint64(1)) + (w[:-1] == w[1:]), SHAPE_BITS)])


@dataclass
class QualityModel:
    """Log of target over raw probability, by feature, and the share of good rows among labelled ones."""

    log_ratio: np.ndarray
    share: float = 0.5

    def log_weight(self, text: str | None) -> float:
        return float(sum(self.log_ratio[f].sum() for f in features(text)))


def _counts(texts: DataFrame) -> np.ndarray:
    """For each feature its occurrences over all rows, documents that hold it, and the roots of its occurrences in each, added up:
    three numbers a feature reach the driver."""
    def count(batches):
        sums = np.zeros((3, FEATURES), np.int64)
        for batch in batches:
            for text in batch.column(0):
                own = list(features(text.as_py()))
                if own:
                    at, n = np.unique(own[0] if len(own) == 1 else np.concatenate(own), return_counts=True)
                    sums[0, at] += n
                    sums[1, at] += 1
                    sums[2, at] += np.round(1024 * np.sqrt(n)).astype(np.int64)  # whole numbers add up the same in any order
        at = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *[pa.array(x[at]) for x in sums]], names=["feature", "n", "held", "roots"])

    got = texts.select("text").mapInArrow(count, "feature int, n long, held long, roots long").groupBy("feature").agg(
        *[F.sum(c).alias(c) for c in ("n", "held", "roots")]).toPandas()
    out = np.zeros((3, FEATURES))
    out[:, got["feature"].to_numpy(np.int64)] = got[["n", "held", "roots"]].to_numpy(float).T
    return out


def _sample(rows: DataFrame, most: int, seed: int) -> DataFrame:
    total = rows.count()
    if total <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)), F.lit(1 << 30)) < int(most / total * (1 << 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = 20_000, smoothing: float = 20.0) -> QualityModel:
    """Target model from about ``sample`` rows labelled 1 whose id isn't held out (all, if fewer), chosen
    by a hash of the id; raw model from all rows.

    An id is good if all its labels are; null labels don't count.  Without good rows every weight is 1.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    known = pick(labels, doc_id=id_col, label=label_col).where(
        F.col("label").isNotNull() & F.col("doc_id").isNotNull() & may_learn(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min((F.col("label") > 0).cast("int")).alias("good"))
    n, n_good = known.agg(F.count("good"), F.sum("good")).first()
    good = known.where("good = 1").select("doc_id")
    # the sample's ids are broadcast (`sample` numbers), so that no text moves
    target = _counts(rows.join(F.broadcast(_sample(good, sample, 17)), "doc_id"))
    raw = _counts(rows)
    out, at = np.zeros(FEATURES), 0
    for size in SIZES:  # each kind of n-gram is a distribution of its own
        (t, ht, roots_t), (r, hr, roots_r) = (x[:, at:at + size] for x in (target, raw))
        if t.sum() and r.sum():
            # how much text the target is of the raw: by roots, so that one text that repeats a line without end, though
            # it counts in full for its own n-grams, doesn't make all others look rare
            expected = r * (roots_t.sum() / roots_r.sum())
            ratio = np.log((t + smoothing) / (expected + smoothing))
            error = np.sqrt(1 / (np.maximum(ht, hr * ht.sum() / hr.sum()) + 1) + 1 / (hr + 1))
            out[at:at + size] = np.where(ratio < 0, np.minimum(0, ratio + 2 * error), ratio)
        at += size
    return QualityModel(out.astype(np.float32), ((n_good or 0) + 0.5) / (n + 1))


def log_weights(spark, model: QualityModel):
    """Column function: text -> log importance weight; 0 for null and empty texts."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([shared.value.log_weight(t) for t in text], dtype=float)

    return run


def gumbel(key: Column, seed: int) -> Column:
    """Standard Gumbel noise that depends on the key alone, so that a repeated task draws the same."""
    u = (F.shiftrightunsigned(F.xxhash64(key.cast("string"), F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_largest(keys: DataFrame, k: int, bins: int = 4096) -> float | None:
    """The k-th largest value of the single column ``key``; None if there are fewer than k or k < 1.

    Counts values in equal bins of the range that holds it, then in bins of that bin,
    until the range is one value."""
    total, lo, hi = keys.agg(F.count("key"), F.min("key"), F.max("key")).first()
    if k < 1 or total < k:
        return None
    above = 0  # values over hi
    while lo < hi:
        width = (hi - lo) / bins
        own = keys.where(F.col("key").between(lo, hi))
        if width == 0 or lo + width == lo or hi - width == hi:  # neighbouring numbers: count each value
            values = own.groupBy("key").count().orderBy(F.desc("key")).collect()
            for r in values:
                above += r["count"]
                if above >= k:
                    return r["key"]
        b = F.least(F.floor((F.col("key") - lo) / width), F.lit(bins - 1)).alias("b")
        counts = own.groupBy(b).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()
        for r in sorted(counts, key=lambda r: -r["b"]):
            if above + r["n"] >= k:
                lo, hi = r["lo"], r["hi"]
                break
            above += r["n"]
    return lo


@dataclass
class Selection:
    """Staged rows with log weight and key, and the smallest key that stays."""

    rows: DataFrame
    threshold: float

    def selected(self) -> Column:
        return F.col("key") >= self.threshold


def select(docs: DataFrame, model: QualityModel, k: int | None = None, id_col: str = "doc_id", text_col: str = "text",
           seed: int = 23, columns: list[str] | None = None) -> Selection:
    """Sample ``k`` documents by Gumbel top-k; by default as many as the raw text is
    expected to hold of the target: the sum over all documents of the probability that a
    document is of the target, whose odds are its weight times those of the labelled rows.

    ``rows`` are the documents, columns renamed c0, c1, ... by place (or those of ``columns``),
    with log_weight and key.  Documents whose key equals the k-th stay too (rows that
    repeat an id and a text).  Null and empty texts weigh 1; an empty table selects nothing.
    """
    names = docs.columns
    at = {n: f"c{i}" for i, n in reversed(list(enumerate(names)))}
    out = docs.toDF(*[f"c{i}" for i in range(len(names))])
    out = out.withColumn("log_weight", log_weights(docs.sparkSession, model)(F.col(at[text_col])))
    out = out.withColumn("key", F.col("log_weight") + gumbel(F.col(at[id_col]), seed))
    if columns is not None:
        out = out.select(*[at[c] for c in columns], "log_weight", "key")
    out = stage(out, "weights")
    if k is None:
        odds = float(np.log(model.share / (1 - model.share)))
        expected = out.agg(F.sum(1 / (1 + F.exp(-F.col("log_weight") - odds))).alias("n")).first()["n"]
        k = round(expected or 0)
    threshold = kth_largest(out.select("key"), k)
    if threshold is None:  # all or none
        threshold = -float("inf") if k > 0 else float("inf")
    return Selection(out, threshold)


def resample(docs: DataFrame, model: QualityModel, k: int | None = None, id_col: str = "doc_id", text_col: str = "text",
             seed: int = 23) -> DataFrame:
    """``docs`` with the sampled documents only, columns as they were."""
    own = select(docs, model, k, id_col, text_col, seed)
    return own.rows.where(own.selected()).drop("log_weight", "key").toDF(*docs.columns)
