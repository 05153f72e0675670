"""Toxicity: held-out accuracy, the label model on made votes, odd texts and tables."""

import zlib

import numpy as np

from tests.llm.conftest import ODD_TEXTS
from voltaic.llm import toxicity as T
from voltaic.llm.common import table
from voltaic.llm.queries import op9_toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = op9_toxicity(spark, SF)
    rows = got.join(table(spark, SF, "labels"), "doc_id").collect()
    assert got.count() == 10_000
    out = [r for r in rows if r.held_out]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    caught = [r.predicted for r in out if r.toxic == 1]
    spared = [1 - r.predicted for r in out if r.toxic == 0]
    assert np.mean(caught) > 0.9 and np.mean(spared) > 0.98


def test_label_model_finds_the_better_voter():
    rng = np.random.default_rng(3)
    y = rng.random(3000) < 0.3
    good = np.where(y, rng.random(3000) < 0.8, rng.random(3000) < 0.02)
    poor = np.where(y, rng.random(3000) < 0.3, rng.random(3000) < 0.2)
    twin = poor.copy()
    fires = np.stack([good, poor, twin, ~(good | poor)], axis=1).astype(float)
    known = np.where(rng.random(3000) < 0.1, y.astype(float), np.nan)
    prior, rates, correlations, posterior = T.label_model(fires, known)
    assert rates[1, 0] / rates[0, 0] > 5 > rates[1, 1] / rates[0, 1]
    assert correlations[1, 2] > 0.9 > correlations[0, 1]
    assert ((posterior > 0.5) == y).mean() > 0.9


def test_linear_classifier_fits_soft_labels():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 3))
    p = 1 / (1 + np.exp(-(x @ [2.0, -1.0, 0.0] - 1)))
    w = T.linear_classifier(x, p, ridge=1e-9)
    assert np.allclose(w, [2, -1, 0, -1], atol=0.05)


def test_matcher():
    m = T.Matcher([b"ab*", b"abc", b"abcd*"], [True] * 3, remembered=2)
    assert [m.of(w) for w in (b"abc", b"abx", b"ab", b"abcde", b"abcd", b"q", b"abc")] == [1, 0, -1, 2, 0, -1, 1]


def test_small_tables(spark, documents):
    texts = ODD_TEXTS + ["you are an idiot, idiot", "a calm text about trees"] * 20
    docs = documents(list(enumerate(texts)) + [(None, "scum"), (3, "again")])
    labels = spark.createDataFrame([(i, 1, int("idiot" in (t or "")), "extra") for i, t in enumerate(texts)] +
                                   [(1, 0, None, "x"), (None, 1, 1, "x"), (3, 1, 0, "x")], "doc_id long, quality int, toxic int, text string")
    out = T.score(docs, T.fit(docs, labels))
    assert out.columns == [*docs.columns, "toxicity"]
    rows = out.collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        assert 0 <= r.toxicity <= 1
        if r["text"] and "idiot" in r["text"]:
            assert r.toxicity > 0.5
        if r["text"] in (None, "", "a calm text about trees"):
            assert r.toxicity < 0.3


def test_nothing_to_learn_from(spark, documents):
    docs, labels = documents(["idiot", "tree", None]), spark.createDataFrame([], "doc_id long, toxic int")
    got = {r["text"]: r.toxicity for r in T.score(docs, T.fit(docs, labels)).collect()}
    assert got["idiot"] > got["tree"] == got[None]
    assert T.score(documents([]), T.fit(documents([]), labels)).count() == 0


def test_votes_outvote_wrong_labels():
    rng = np.random.default_rng(5)
    y = rng.random(4000) < 0.3
    fires = np.stack([np.where(y, rng.random(4000) < 0.9, rng.random(4000) < 0.03) for _ in range(4)], axis=1)
    fires = np.concatenate([fires, ~fires.any(axis=1)[:, None]], axis=1).astype(float)
    wrong = rng.random(4000) < 0.05
    known = np.where(rng.random(4000) < 0.3, (y ^ wrong).astype(float), np.nan)
    posterior = T.label_model(fires, known)[3]
    corrected = ((posterior > 0.5) == y)[wrong & ~np.isnan(known)]
    assert len(corrected) > 30 and corrected.mean() > 0.8
    assert ((posterior > 0.5) == y)[np.isnan(known)].mean() > 0.95


def test_unlabelled_rows_are_voted_on(spark, documents, monkeypatch):
    """All rows without a label count, whatever the sample of labelled ones."""
    texts = ["you are an idiot, idiot", "a calm text about trees"] * 100
    labels = spark.createDataFrame([(i, int("idiot" in texts[i])) for i in range(60)] + [(61, None)], "doc_id long, toxic int")
    seen, plain = [], T.estimate
    monkeypatch.setattr(T, "estimate", lambda sums, voters, n_known, n_unknown, *a: seen.append((n_known, n_unknown)) or plain(
        sums, voters, n_known, n_unknown, *a))
    T.fit(documents(texts), labels)
    may = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    unknown = sum(i >= 60 for i in may)
    assert seen[0] == (sum(i < 60 for i in may), unknown)
    T.fit(documents(texts), labels, sample=20)
    assert 5 < seen[1][0] < 35 and seen[1][1] == unknown


def test_sums_over_tasks_are_those_of_all_rows(spark, documents, monkeypatch):
    """The model learned by sums over tasks is the one learned from a matrix of all rows."""
    rng = np.random.default_rng(7)
    kinds = ["you are an idiot, %s", "what a moron %s", "a calm text about trees %s", "idiot trees %s calm", "SHOUTING!! AT YOU!! %s"]
    texts = [kinds[k] % ("x" * n) for k, n in zip(rng.integers(0, 5, 300), rng.integers(1, 9, 300))]
    texts += [texts[0]] * 150  # a third of the rows is one text, under one id
    docs = documents([(i if i < 300 else 1, t) for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, int("idiot" in texts[i] or "moron" in texts[i])) for i in range(100)], "doc_id long, toxic int")
    model = T.fit(docs, labels, learned=0)
    ids = [i if i < 300 else 1 for i in range(450)]
    rows = [(t, float("idiot" in texts[i] or "moron" in texts[i]) if i < 100 else np.nan) for i, t in zip(ids, texts) if zlib.crc32(str(i).encode()) % 4 != 2]
    x = np.array([T.features(t, T.Matcher(model.lexicon, model.strong)) for t, _ in rows]).astype(np.float32).astype(float)
    prior, rates, correlations, posterior = T.label_model(T.votes(x, len(model.lexicon)), np.array([y for _, y in rows]))
    assert np.allclose(model.rates, rates, atol=1e-6) and np.allclose(model.correlations, correlations, atol=1e-5)
    assert np.allclose(model.weights, T.linear_classifier(x, posterior), atol=1e-4)
