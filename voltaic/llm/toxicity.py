"""Toxicity by weak supervision.

1. Voters: a word voter for each entry of a lexicon (a short fixed list of words, and the
   words and word beginnings that stand out in toxic training rows) and pattern voters (several lexicon words, their
   density, address in the second person, shouting, stretched letters).  A voter votes for
   toxic where it fires; a few vote against, and all abstain elsewhere.
2. A generative label model over the votes of all rows that may be learned from, with a label or without: expectation
   maximisation for each voter's firing rate in clean rows and in two kinds of toxic ones, started at
   the labelled rows, and correlations of voters within a kind; a voter's evidence is shared
   with the voters it moves with.  A given label counts as one more voter.  Rows are counted by their pattern of
   votes, and a round adds up a few sums over the patterns.
3. A linear classifier trained on the posterior labels of all these rows, by Newton's method, whose steps are sums over
   the rows; its score is what documents get.

Labelled rows beyond a bounded sample are left out; unlabelled ones all count.  Only sums of fixed size reach the
driver.  Scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import may_learn, pick, stage
from .words import words

#: Insults that count from the start; training rows add their own.
LEXICON = ("bastard", "clown", "disgusting", "dumb", "filth", "idiot", "loser", "moron", "pathetic", "scum",
           "stupid", "trash", "ugly", "vermin", "worthless")
#: Bytes of the word beginnings that may be learned.
STEMS = (3, 4, 5, 6, 7)
#: What a given label adds to a row's log odds, for or against: no more than a voter that is right 9 times of 10.
LABEL_EVIDENCE = float(np.log(9))
_SECOND_PERSON = frozenset((b"you", b"your", b"u", b"ur", b"youre"))
_STRETCHED = re.compile(r"([A-Za-z])\1{3,}")
PATTERNS = ("any strong entry", "two strong entries", "three strong entries", "density of strong entries", "second person insult",
            "shouting", "exclamations", "stretched letters", "density of weak entries")


@dataclass
class ToxicityModel:
    """lexicon (words, and beginnings of words that end in ``*``), the label model's estimates and
    the classifier's weights."""

    lexicon: list[bytes]
    strong: list[bool]  # rare enough among clean rows to be counted together
    prior: float
    rates: np.ndarray  # 2 x voters: how often a voter fires under label 0 and 1
    correlations: np.ndarray  # voters x voters, within a label
    weights: np.ndarray  # of the features, then the bias

    def score(self, texts: list[str | None]) -> np.ndarray:
        matcher = _matcher(self.lexicon, self.strong)
        x = np.array([features(t, matcher) for t in texts]).reshape(len(texts), len(self.weights) - 1)
        return _sigmoid(x @ self.weights[:-1] + self.weights[-1])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Matcher:
    """The lexicon entry a word is counted for: the word itself, or the longest beginning."""

    def __init__(self, lexicon: list[bytes], strong: list[bool], remembered: int = 200_000):
        self.strong = strong
        self.size, self.remembered, self.memo = len(lexicon), remembered, {}
        self.words = {w: i for i, w in enumerate(lexicon) if not w.endswith(b"*")}
        self.stems = {w[:-1]: i for i, w in enumerate(lexicon) if w.endswith(b"*")}
        self.lengths = sorted({len(s) for s in self.stems}, reverse=True)

    def of(self, word: bytes) -> int:
        """Its number, or -1."""
        k = self.memo.get(word)
        if k is None:
            k = self.words.get(word, -1)
            if k < 0:
                k = next((i for n in self.lengths if len(word) > n and (i := self.stems.get(word[:n], -1)) >= 0), -1)
            if len(self.memo) >= self.remembered:
                self.memo.clear()
            self.memo[word] = k
        return k


_MATCHERS: dict[tuple, Matcher] = {}


def _matcher(lexicon: list[bytes], strong: list[bool]) -> Matcher:
    key = (*lexicon, *strong)
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(lexicon, strong)
    return _MATCHERS[key]


def features(text: str | None, matcher: Matcher) -> np.ndarray:
    """Occurrences of lexicon entries (as logarithms), then a number for each of PATTERNS."""
    own = words(text)
    entries = list(map(matcher.of, own))
    found = Counter(entries)
    found.pop(-1, None)
    out = np.zeros(matcher.size + len(PATTERNS))
    for k, n in found.items():
        out[k] = np.log1p(n)
    total = sum(n for k, n in found.items() if matcher.strong[k])
    weak = sum(found.values()) - total
    p = matcher.size
    out[p:p + 4] = total >= 1, total >= 2, total >= 3, min(1.0, 100 * total / max(1, len(own)))
    out[p + 8] = min(1.0, 50 * weak / max(1, len(own)))
    if total and any(w in _SECOND_PERSON and max(entries[i + 1:i + 5], default=-1) >= 0 for i, w in enumerate(own)):
        out[p + 4] = 1
    if text:
        letters = sum(map(text.count, "etaoin"))  # common letters tell a text's case
        capitals = sum(map(text.count, "ETAOIN"))
        out[p + 5] = capitals > letters
        out[p + 6] = min(1.0, 20 * text.count("!") / max(1, len(own)))
        out[p + 7] = _STRETCHED.search(text) is not None
    return out


def votes(x: np.ndarray, lexicon: int) -> np.ndarray:
    """1 where a voter fires; the last voter fires where no lexicon word stands (against)."""
    fires = np.concatenate([x > 0, (x[:, lexicon] == 0)[:, None]], axis=1)
    fires[:, lexicon + 3] = x[:, lexicon + 3] >= 0.5
    fires[:, lexicon + 6] = x[:, lexicon + 6] >= 0.5
    fires[:, lexicon + 8] = x[:, lexicon + 8] >= 0.5
    return fires.astype(float)


#: Kinds of rows: clean, toxic with a lexicon word, toxic without.
KINDS = 3


@dataclass
class LabelModel:
    """The mixture's estimates: chance of label 1, firing rates by kind, what each voter's evidence weighs, correlations of
    voters within a kind, and the shares of the toxic kinds; before the first round, only the chance."""

    prior: float
    rates: np.ndarray | None = None
    weight: np.ndarray | None = None
    correlations: np.ndarray | None = None
    share: np.ndarray | None = None

    def kinds(self, fires: np.ndarray, known: np.ndarray) -> np.ndarray:
        """rows x KINDS: how likely each row is of each kind, from its votes and its label (nan: unknown)."""
        labelled, given = ~np.isnan(known), np.nan_to_num(known)
        if self.rates is None:
            # toxic kinds are those in which the last voter (against) is silent and those in which it fires: their voters
            # differ too much for one rate each
            toxic = np.where(labelled, given, np.where(fires[:, -1] > 0, 0.05, 0.7))
            first = np.where(fires[:, -1] > 0, 0.05, 0.95)
            return np.stack([1 - toxic, toxic * first, toxic * (1 - first)], axis=1)
        # a given label started the estimates, now it is one more voter, which the others can outvote
        said = np.where(labelled, LABEL_EVIDENCE * (2 * given - 1), 0.0)[:, None] * [0, 1, 1]
        z = ((fires * self.weight) @ np.log(self.rates).T + ((1 - fires) * self.weight) @ np.log1p(-self.rates).T
             + np.log([1 - self.prior, *(self.prior * self.share)]) + said)
        out = np.exp(z - z.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    def sums(self, fires: np.ndarray, known: np.ndarray, n: np.ndarray, boost: float, labelled_only: bool) -> np.ndarray:
        """What a round needs of some rows, each standing for ``n``, as one array: by kind the mass and votes (labelled rows
        ``boost`` times), and products of kinds and votes with each other."""
        if labelled_only:
            fires, known, n = (x[~np.isnan(known)] for x in (fires, known, n))
        kinds = self.kinds(fires, known)
        both = np.concatenate([kinds, fires], axis=1)
        boosted = n * np.where(np.isnan(known), 1.0, boost)
        return np.concatenate([((kinds * boosted[:, None]).T @ np.concatenate([np.ones((len(n), 1)), fires], axis=1)).ravel(),
                               ((both * n[:, None]).T @ both).ravel()])

    def next(self, sums: np.ndarray, voters: int, start: np.ndarray | None) -> "LabelModel":
        """The estimates after a round."""
        cut = KINDS * (voters + 1)
        first, products = sums[:cut].reshape(KINDS, voters + 1), sums[cut:].reshape(KINDS + voters, KINDS + voters)
        mass = first[:, 0]
        rates = (first[:, 1:] + 0.5) / (mass[:, None] + 1)
        # rates stay half way to those of the labelled rows, so that a kind can't drift to other rows
        rates = ((rates if start is None else start) + rates) / 2
        kk, kf, ff = products[:KINDS, :KINDS], products[:KINDS, KINDS:], products[KINDS:, KINDS:]
        total = max(kk.sum(), 1e-9)  # a row's kinds add up to 1
        centred = (ff - kf.T @ rates - rates.T @ kf + rates.T @ kk @ rates) / total
        spread = np.sqrt(np.maximum(np.diag(centred), 0)) + 1e-9
        correlations = centred / np.outer(spread, spread)
        # voters that move together within a kind share their evidence
        weight = 1 / np.maximum(1, (correlations ** 2).sum(axis=1))
        return LabelModel(self.prior, rates, weight, correlations, (mass[1:] + 1) / (mass[1:] + 1).sum())


def estimate(sums, voters: int, n_known: int, n_unknown: int, n_toxic: int, rounds: int = 60) -> LabelModel:
    """Expectation maximisation; ``sums(model, boost, labelled_only)`` adds up ``LabelModel.sums`` over all rows."""
    model = LabelModel(float(np.clip(n_toxic / n_known if n_known else 0.1, 0.01, 0.99)))
    boost = max(1.0, n_unknown / max(1, n_known))  # labelled rows hold half of the mass at least
    start = None
    for r in range(rounds):
        new = model.next(sums(model, boost, r == 0 and n_known > 0), voters, start)  # the first round goes by labelled rows
        start = new.rates if start is None else start
        done = r > 1 and np.abs(new.rates - model.rates).max() < 1e-5 and np.abs(new.weight - model.weight).max() < 1e-4
        model = new
        if done:
            break
    return model


def label_model(fires: np.ndarray, known: np.ndarray, rounds: int = 60) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """(prior, rates by label, correlations, posterior of label 1) from votes and labels (nan: unknown) of rows held in memory."""
    n, labelled = np.ones(len(fires)), ~np.isnan(known)
    model = estimate(lambda m, boost, only: m.sums(fires, known, n, boost, only), fires.shape[1], int(labelled.sum()),
                     int((~labelled).sum()), float(np.nansum(known)), rounds)
    return model.prior, by_label(model), model.correlations, 1 - model.kinds(fires, known)[:, 0]


def by_label(model: LabelModel) -> np.ndarray:
    return np.stack([model.rates[0], model.share @ model.rates[1:]])


def newton(sums, size: int, ridge: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Logistic regression on soft labels: weights, the bias last; ``sums(w)`` adds up ``newton_sums`` over all rows."""
    w, keep = np.zeros(size), None
    for _ in range(steps):
        own = sums(w)
        n, gradient, hessian = own[0], own[1:1 + size], own[1 + size:].reshape(size, size)
        if keep is None:
            keep = np.full(size, ridge * n + 1e-6)
            keep[-1] = 1e-6
        step = np.linalg.solve(hessian + np.diag(keep), gradient + keep * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def newton_sums(x: np.ndarray, posterior: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rows, gradient and second derivatives of some rows, as one array."""
    x1 = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    p = _sigmoid(x1 @ w)
    return np.concatenate([[len(x)], x1.T @ (p - posterior), ((x1 * (p * (1 - p))[:, None]).T @ x1).ravel()])


def linear_classifier(x: np.ndarray, posterior: np.ndarray, ridge: float = 1e-3, steps: int = 25) -> np.ndarray:
    """``newton`` over rows held in memory."""
    return newton(lambda w: newton_sums(x, posterior, w), x.shape[1] + 1, ridge, steps)


def _share(most: int, total: int) -> int:
    return 1 << 30 if total <= most else int(most / total * (1 << 30))


def _in_share(share: int, seed: int):
    return F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)), F.lit(1 << 30)) < share


def _add_up(rows: DataFrame, one, size: int) -> np.ndarray:
    """The sum of ``one(batch)`` (an array of ``size``) over all rows; each task sends one array, added up by Spark place by place."""
    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += one(batch)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["at", "v"])

    out = np.zeros(size)
    for r in rows.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out


def _dense(batch, size: int) -> np.ndarray:
    """The features of a batch whose first two columns hold places and values, packed."""
    out = np.zeros((batch.num_rows, size))
    places = [np.frombuffer(x.as_py(), "<i2") for x in batch.column(0)]
    row = np.repeat(np.arange(len(places)), [len(x) for x in places])
    out[row, np.concatenate(places)] = np.frombuffer(b"".join(x.as_py() for x in batch.column(1)), "<f4")
    return out


def _known(batch) -> np.ndarray:
    return batch.column(2).cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: nan


def _lexicon(labelled: DataFrame, learned: int, least_ratio: float) -> dict[bytes, bool]:
    """Entries that stand out in toxic rows, and whether each is strong."""
    @F.pandas_udf("array<string>")
    def distinct_entries(text: pd.Series) -> pd.Series:
        def one(t):
            own = set(words(t))
            own |= {w[:n] + b"*" for w in own for n in STEMS if len(w) > n}
            return [w.decode("latin-1") for w in own]  # a character a byte
        return pd.Series([one(t) for t in text], dtype=object)

    # entries by label: counts of documents, then those that stand out (at most 50 rows for one chosen)
    sizes = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    chosen: dict[bytes, bool] = {}
    if n1 and n0:
        counts = labelled.select("label", F.explode(distinct_entries("text")).alias("entry")).groupBy("entry").agg(
            F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
        p1, p0 = (F.col("toxic") + 0.5) / (n1 + 1), (F.col("clean") + 0.5) / (n0 + 1)
        # how much an entry tells, in bits of the toxic rows: frequent and rare among clean ones
        told = p1 * F.log2(p1 / p0)
        best = counts.withColumn("told", told).withColumn("strong", p1 > 50 * p0).where(
            (F.col("toxic") >= max(5, n1 // 100)) & (p1 > least_ratio * p0)).orderBy(
            F.desc("told"), F.desc(F.length("entry")), "entry").limit(50 * learned)
        stems = {w.encode(): n1 for w in LEXICON}  # beginnings of these add nothing
        for r in best.collect():
            entry = r["entry"].encode("latin-1")
            stem = entry.rstrip(b"*")
            covered = any(c.endswith(b"*") and stem.startswith(c[:-1]) for c in chosen)
            begins = entry.endswith(b"*") and any(
                w.startswith(stem) and r["toxic"] < 1.5 * n for w, n in stems.items())
            if len(chosen) < learned and not covered and not begins:
                chosen[entry] = r["strong"]
                stems[stem] = r["toxic"]
    return chosen


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = 20_000, learned: int = 60, least_ratio: float = 6.0) -> ToxicityModel:
    """Learn from rows whose id isn't held out: about ``sample`` ids of the labelled ones (all, if fewer), chosen by a hash of the id,
    and all that have no label.  Entries of the lexicon come from the labelled ones, votes and the classifier's posterior labels
    from both.  Ids with several labels count as 1 if any is; null labels don't count; rows that repeat an id count
    each.  Without labels the fixed lexicon votes alone."""
    docs = pick(docs, doc_id=id_col, text=text_col)
    may = F.col("doc_id").isNotNull() & may_learn(F.col("doc_id"))
    known = pick(labels, doc_id=id_col, label=label_col).where(F.col("label").isNotNull() & may)
    known = known.groupBy("doc_id").agg(F.max((F.col("label") > 0).cast("int")).alias("label"))
    chosen = _in_share(_share(sample, known.count()), 13)
    # the sample's ids are broadcast (`sample` rows of two numbers), so that no other text moves, and its texts are
    # written once for the passes below
    texts = stage(docs.join(F.broadcast(known.where(chosen)), "doc_id"), "training")
    found = _lexicon(texts, learned, least_ratio)
    lexicon = sorted({w.encode(): True for w in LEXICON} | found)
    strong = [found.get(w, True) for w in lexicon]
    size, n_lexicon = len(lexicon) + len(PATTERNS), len(lexicon)

    @F.pandas_udf("places binary, numbers binary")
    def described(text: pd.Series) -> pd.DataFrame:
        matcher = _matcher(lexicon, strong)
        out = []
        for t in text:
            x = features(t, matcher)
            at = np.flatnonzero(x)
            out.append((at.astype("<i2").tobytes(), x[at].astype("<f4").tobytes()))
        return pd.DataFrame(out, columns=["places", "numbers"])

    # what documents look like to the voters, a few numbers each, then with their labels: texts don't move
    seen = stage(docs.where(may).withColumn("x", described("text")).select("doc_id", "x.places", "x.numbers"), "voters")
    rows = seen.join(known.withColumn("chosen", chosen), "doc_id", "left").where("chosen IS NULL OR chosen")
    rows = stage(rows.select("places", "numbers", "label"), "votes")

    def patterns(batches):
        for batch in batches:
            if batch.num_rows:
                fires = np.packbits(votes(_dense(batch, size), n_lexicon).astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([f.tobytes() for f in fires], pa.binary()), batch.column(2)], names=["fires", "label"])

    counted = rows.mapInArrow(patterns, "fires binary, label int").groupBy("fires", "label").agg(F.count(F.lit(1)).alias("n"))
    counted = stage(counted, "patterns")
    totals = counted.agg(F.sum(F.when(F.col("label").isNotNull(), F.col("n"))).alias("known"), F.sum(F.when(F.col("label") == 1, F.col("n"))).alias("toxic"),
                         F.sum(F.when(F.col("label").isNull(), F.col("n"))).alias("unknown")).first()
    n_known, n_toxic, n_unknown = (int(totals[c] or 0) for c in ("known", "toxic", "unknown"))
    # no labels to start from: any lexicon word is a sign
    made = np.stack([np.zeros(size), np.ones(size)]) if not n_known else np.zeros((0, size))
    made_votes, made_known = votes(made, n_lexicon), np.arange(len(made), dtype=float)
    voters = size + 1

    def of_votes(model, boost, labelled_only):
        def one(batch):
            fires = np.unpackbits(np.frombuffer(b"".join(x.as_py() for x in batch.column(0)), np.uint8).reshape(batch.num_rows, -1),
                                  axis=1, count=voters).astype(float)
            known = batch.column(1).cast(pa.float64()).to_numpy(zero_copy_only=False)
            return model.sums(fires, known, batch.column(2).to_numpy().astype(float), boost, labelled_only)

        width = KINDS * (voters + 1) + (KINDS + voters) ** 2
        return _add_up(counted, one, width) + model.sums(made_votes, made_known, np.ones(len(made)), boost, labelled_only)

    model = estimate(of_votes, voters, n_known + len(made), n_unknown, n_toxic + len(made) // 2)

    def of_rows(w):
        def one(batch):
            x = _dense(batch, size)
            return newton_sums(x, 1 - model.kinds(votes(x, n_lexicon), _known(batch))[:, 0], w)

        extra = newton_sums(made, 1 - model.kinds(made_votes, made_known)[:, 0], w)
        return _add_up(rows, one, 1 + (size + 1) + (size + 1) ** 2) + extra

    weights = newton(of_rows, size + 1)
    return ToxicityModel(lexicon, strong, model.prior, by_label(model), model.correlations, weights)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a double column ``into`` (0 to 1, higher: toxic likelier); null and empty
    texts have no words and get the score of a text in which no voter fires."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(text: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(list(text)))

    names = docs.columns
    out = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return out.withColumn("toxicity", run(F.col(f"c{names.index(text_col)}"))).toDF(*names, into)
