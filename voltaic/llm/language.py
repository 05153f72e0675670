"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes a space, and n-grams of 1 to 3
characters are hashed into ``2 ** bits`` features.  Counts by language are learned with
Spark from labelled rows, the log-probability matrix (features x languages, so of
bounded size) is broadcast, and texts are scored in batches: one gather from the
matrix and one segmented sum for many texts at a time.  Whole texts count, long ones
in slices that overlap by what n-grams need.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_where, may_learn, pick

ORDERS = (1, 2, 3)
#: Characters counted at a time.
SLICE = 1 << 18
#: Numbers gathered from the matrix at a time, so that many languages take shorter slices.
GATHERED = 1 << 20
#: More languages than this is taken for a wrong column.
MOST_LANGUAGES = 1000
UNDETERMINED = "und"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether a code point is a letter, for all of Unicode; made once in a worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, other characters than letters as 0, one 0 in front and two behind."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    out = np.zeros(len(c) + 3, np.uint64)
    out[1:-2] = np.where(_letters()[c], c, 0)
    return out


def _features(codes: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Hashed n-gram that starts at each place; the codes need ``order - 1`` more at the end."""
    n = len(codes) - max(ORDERS) + 1
    h = np.full(n, order, np.uint64)
    for j in range(order):
        h = (h ^ codes[j:n + j]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)


def _counted(codes: np.ndarray, order: int) -> np.ndarray:
    """Places whose n-gram holds a letter first or last: runs of other characters don't count."""
    n = len(codes) - max(ORDERS) + 1
    return (codes[:n] > 0) | (codes[order - 1:n + order - 1] > 0)


@dataclass
class LanguageModel:
    """languages, their log priors and the matrix of log probabilities (features x languages)."""

    languages: list[str]
    prior: np.ndarray
    matrix: np.ndarray
    bits: int

    def log_likelihoods(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages, has a letter)."""
        return self._sums(texts)[:2]

    def _sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``log_likelihoods``, and the n-grams that count in each text."""
        out = np.tile(self.prior, (len(texts), 1))
        letters, n_grams = np.zeros(len(texts), bool), np.zeros(len(texts), np.int64)
        more, step = max(ORDERS) - 1, max(1 << 12, GATHERED // max(1, len(self.languages)))
        batch, owner, size = [], [], 0

        def flush():
            nonlocal batch, owner, size
            if not batch:
                return
            # a slice's n-grams start before its last `more` codes, which the next slice holds again
            codes = np.concatenate(batch)
            ends = np.cumsum([len(b) for b in batch])
            starts = ends - [len(b) for b in batch]
            keep = np.ones(len(codes), bool)
            for j in range(1, more + 1):
                keep[ends - j] = False
            padded = np.concatenate([codes, np.zeros(more, np.uint64)])
            total, number = np.zeros((len(codes), len(self.languages))), np.zeros(len(codes), np.int64)
            for order in ORDERS:
                scored = keep & _counted(padded, order)
                at = np.flatnonzero(scored)
                total[at] += self.matrix[_features(padded, order, self.bits)[at]]
                number[at] += 1
            np.add.at(out, owner, np.add.reduceat(total, starts, axis=0))
            np.add.at(n_grams, owner, np.add.reduceat(number, starts))
            batch, owner, size = [], [], 0

        for i, text in enumerate(texts):
            if not text:
                continue
            codes = _codes(text)
            if not codes.any():
                continue
            letters[i] = True
            for at in range(0, len(codes) - more, step):
                part = codes[at:at + step + more]
                batch.append(part)
                owner.append(i)
                size += len(part)
                if size >= step:
                    flush()
        flush()
        return out, letters, n_grams

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language or und, posterior probability of it; 0 for und)."""
        languages, score, _ = self.judge(texts)
        return languages, score

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """``predict``, and how well the language explains the text: by how much its n-grams are likelier than chance, a n-gram, as a share of
        what the language's own text has (about 1; unlike a posterior, it tells noise and languages that weren't learned; 0 for und), and two
        standard errors more, since few n-grams tell little."""
        ll, letters, n_grams = self._sums(texts)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        best = ll.argmax(axis=1)
        top = ll.max(axis=1, keepdims=True)
        score = 1 / np.exp(ll - top).sum(axis=1)
        chance = self.bits * np.log(2)  # n-grams are hashed to 2 ** bits features
        log_p = self.matrix.astype(np.float64)
        own = (np.exp(log_p) * log_p).sum(axis=0) + chance  # of the language's own text
        support = ((ll - self.prior)[np.arange(len(texts)), best] / np.maximum(1, n_grams) + chance) / np.maximum(own[best], 1e-9)
        support = support + 2 / np.sqrt(np.maximum(1, n_grams))
        return ([self.languages[b] if has else UNDETERMINED for b, has in zip(best, letters)],
                np.where(letters, score, 0.0), np.where(letters, support, 0.0))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bits: int = 16,
        sample: int = 20_000, alpha: float = 0.5) -> LanguageModel:
    """Learn from text and language of rows whose language isn't null and whose id isn't held out.

    Text statistics come from about ``sample`` of these rows of each language (all, if fewer), chosen
    by a hash of the id; priors from all of them.  What reaches the driver is a number per
    language and feature.
    """
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).where(
        F.col("lang").isNotNull() & may_learn(F.col("doc_id")))
    rows = rows.withColumn("lang", F.col("lang").cast("string"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} holds over {MOST_LANGUAGES} values")
    total = sum(sizes.values())
    # languages of more rows than `sample`, at most MOST_LANGUAGES numbers
    share = [x for lang, n in sizes.items() if n > sample for x in (F.lit(lang), F.lit(int(sample / n * (1 << 30))))]
    chosen = rows if not share else rows.where(
        F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(11)), F.lit(1 << 30))
        < F.coalesce(F.try_element_at(F.create_map(*share), F.col("lang")), F.lit(1 << 30)))

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                text = text.as_py()
                if not text:
                    continue
                own = counts.setdefault(lang, np.zeros(1 << bits, np.int64))
                codes = _codes(text)
                for at in range(0, len(codes) - 2, SLICE):
                    part = codes[at:at + SLICE + 2]
                    for order in ORDERS:
                        f = _features(part, order, bits)[_counted(part, order)]
                        own += np.bincount(f, minlength=1 << bits)
        for lang, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(own[at], pa.int64())], names=["lang", "feature", "n"])

    counted = chosen.select("text", "lang").mapInArrow(count, "lang string, feature int, n long")
    got = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sizes)
    matrix = np.full((1 << bits, len(languages)), alpha)
    matrix[got["feature"].to_numpy(np.int64), [languages.index(x) for x in got["lang"]]] += got["n"].to_numpy(float)
    matrix = np.log(matrix / matrix.sum(axis=0, keepdims=True)) if languages else matrix
    prior = np.log(np.array([sizes[x] for x in languages], float) / total) if languages else np.zeros(0)
    return LanguageModel(languages, prior, matrix.astype(np.float32), bits)


def predictor(spark, model: LanguageModel):
    """Column function: text -> struct(lang, score, support)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, support double")
    def predict(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(("lang", "score", "support"), shared.value.judge(list(text)))))

    return predict


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", into: str = "predicted") -> DataFrame:
    """``docs`` with a struct column ``into``: lang (a learned one; ``und`` if the text is null or
    has no letter), score (posterior probability; 0 for ``und``) and support (``LanguageModel.judge``).  Ties go to the
    language that sorts first; with nothing to learn from, all is ``und``."""
    names = docs.columns
    out = docs.toDF(*[f"c{i}" for i in range(len(names))])
    predict = predictor(docs.sparkSession, model)
    return out.withColumn("predicted", predict(F.col(f"c{names.index(text_col)}"))).toDF(*names, into)


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.5, support: float = 0.6, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose language is identified with a posterior of ``least`` or more, and explains the text by ``support`` or
    more of what it explains of its own: letter noise and texts in other languages go, as do null and empty texts."""
    predict = predictor(docs.sparkSession, model)

    def decide(text):
        own = predict(text)
        return F.exists(F.array(own), lambda p: (p["score"] >= least) & (p["support"] >= support))

    return keep_where(docs, text_col, decide)
