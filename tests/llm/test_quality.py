"""Importance resampling: held-out separation, exact top-k, weights against single n-grams, odd inputs."""

import random

import numpy as np
import pytest

from tests.llm.conftest import ODD_TEXTS
from voltaic.llm import quality as Q
from voltaic.llm.common import table
from voltaic.llm.queries import op6_importance_resampling

SF = "/root/testdata/sf0.1"


def test_held_out_selection(spark):
    got = op6_importance_resampling(spark, SF)
    rows = got.join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    good = [r.selected for r in rows if r.quality == 1]
    poor = [r.selected for r in rows if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(poor) < 0.05
    assert got.count() == 10_000
    keys = sorted((r.key for r in got.collect()), reverse=True)
    n = got.where("selected").count()
    assert got.where("selected").agg({"key": "min"}).first()[0] == keys[n - 1]


@pytest.mark.parametrize("bins", [2, 3, 4096])
def test_kth_largest(spark, bins):
    rng = random.Random(bins)
    values = [rng.gauss(0, 1) for _ in range(200)] + [1.5] * 30 + [-1e6, 1e6, 0.0, 5e-324, float(np.nextafter(1.5, 2))]
    df = spark.createDataFrame([(v,) for v in values], "key double").repartition(3)
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 25, 40, 100, len(values)):
        assert Q.kth_largest(df, k, bins) == ordered[k - 1]
    assert Q.kth_largest(df, 0, bins) is None and Q.kth_largest(df, len(values) + 1, bins) is None


def test_slices_of_a_text_hold_its_ngrams(monkeypatch):
    text = "One two, TWO two!! three | 4 " * 40
    whole = np.sort(np.concatenate(list(Q.features(text))))
    monkeypatch.setattr(Q, "_AT_ONCE", 7)
    assert np.array_equal(np.sort(np.concatenate(list(Q.features(text)))), whole)
    assert len(whole) == 3 * len(text.split()) - 2
    assert whole.max() < Q.FEATURES


def test_shapes():
    assert [Q.shape(w) for w in ("word", "Word,", "WORD!!", "12", "|", "mIx", "A")] == ["a", "Aa,", "A!!", "d", "-|", "x", "Aa"]


def test_gumbel_is_gumbel(spark):
    x = np.array([r[0] for r in spark.range(20_000).select(Q.gumbel(Q.F.col("id"), 1)).collect()])
    assert abs(x.mean() - 0.5772) < 0.05 and abs(x.var() - np.pi ** 2 / 6) < 0.1


def test_sampling_follows_the_weights(spark):
    """Of two equally many kinds, the one with odds e is sampled accordingly more often."""
    model = Q.QualityModel(np.zeros(Q.FEATURES, np.float32))
    for f in Q.features("good"):
        model.log_ratio[f] = 1.0
    docs = spark.range(6000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'good', 'raw') AS text")
    own = Q.resample(docs, model, k=600)
    assert own.columns == ["doc_id", "text"]
    n = {r["text"]: r["count"] for r in own.groupBy("text").count().collect()}
    assert sum(n.values()) == 600 and 2.0 < n["good"] / n["raw"] < 3.4


def test_odd_rows(spark, documents):
    texts = ODD_TEXTS + ["a plain sentence of words, as it is."] * 30 + ["SHOUTING!! SHOUTING!! AT!! YOU!!"] * 30
    docs = documents(list(enumerate(texts)) + [(None, "a plain"), (0, "again"), (0, "again")])
    labels = spark.createDataFrame([(i, 1 - int("SHOUT" in t), 0) for i, t in enumerate(texts) if i >= len(ODD_TEXTS)] +
                                   [(1, None, 0), (None, 1, 0)],
                                   "doc_id long, quality int, text int")
    own = Q.select(docs, Q.fit(docs, labels, smoothing=1.0)).rows.collect()
    assert len(own) == len(texts) + 3
    for r in own:
        if not r.c1:
            assert r.log_weight == 0
        if r.c1 and "SHOUT" in r.c1:
            assert r.log_weight < 0
    kept = Q.resample(docs, Q.fit(docs, labels, smoothing=1.0))
    assert kept.columns == docs.columns
    assert 30 <= kept.where("text LIKE 'a plain sentence%'").count()
    assert Q.resample(docs, Q.fit(docs, labels), k=10 ** 6).count() == len(texts) + 3
    assert Q.resample(docs, Q.fit(docs, labels), k=0).count() == 0


def test_empty_tables(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.resample(documents([]), Q.fit(documents([]), labels)).count() == 0
    docs = documents(["a b", "c"])
    assert {r.log_weight for r in Q.select(docs, Q.fit(docs, labels)).rows.collect()} == {0.0}


def test_raw_counts_cover_all_rows(spark):
    """More rows than ``sample``, of which 12 are of a poor kind: the labelled rows are all learned from, so the
    sample's size changes nothing, and the poor kind goes."""
    plain = spark.range(6000).selectExpr("id AS doc_id", "concat('a plain sentence of words, as it is in ', id % 7) AS text")
    poor = spark.range(6000, 6012).selectExpr("id AS doc_id", "repeat('BUY!! NOW!! ', 400) AS text")
    docs = plain.union(poor).repartition(5)
    labels = spark.range(400).selectExpr("id AS doc_id", "1 AS quality")
    model = Q.fit(docs, labels, sample=400)
    assert np.array_equal(model.log_ratio, Q.fit(docs, labels).log_ratio)
    assert model.log_weight("BUY!! NOW!! " * 400) < -100 < -10 < model.log_weight("a plain sentence of words, as it is in 3")
