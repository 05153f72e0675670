"""Language identification: held-out accuracy, the same scores as one n-gram at a time, odd texts."""

import math
import zlib

import numpy as np

from tests.llm.conftest import ODD_TEXTS
from voltaic.llm import language as L
from voltaic.llm.common import table
from voltaic.llm.queries import op5_language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op5_language_id(spark, SF)
    rows = got.join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    out = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97


def model(bits=8, languages=3):
    rng = np.random.default_rng(1)
    m = rng.random((1 << bits, languages))
    return L.LanguageModel([f"l{i}" for i in range(languages)], np.log(np.full(languages, 1 / languages)),
                           np.log(m / m.sum(axis=0)).astype(np.float32), bits)


def test_batches_and_slices_score_as_single_ngrams(monkeypatch):
    m = model()
    texts = ODD_TEXTS + ["ÀB c1d", "é"]

    def slow(text):
        letters = [ord(c) if c.isalpha() else 0 for c in (text or "").lower()]
        total = m.prior.copy()
        padded = np.array([0] + letters + [0, 0, 0, 0], np.uint64)
        for i in range(len(letters) + 1):
            for order in L.ORDERS:
                gram = padded[i:i + order]
                if gram[0] or gram[-1]:
                    f = L._features(np.concatenate([gram, np.zeros(2, np.uint64)]), order, m.bits)[0]
                    total = total + m.matrix[f]
        return total
    want = np.array([slow(t) if t and len(t) < 6000 else m.prior for t in texts])
    short = [t if t and len(t) < 6000 else None for t in texts]
    for gathered in (1, 1 << 20):
        monkeypatch.setattr(L, "GATHERED", gathered)
        got, letters = m.log_likelihoods(short)
        has = [bool(t) and any(c.isalpha() for c in t) for t in short]
        assert letters.tolist() == has
        assert np.allclose(got[has], want[has], rtol=1e-5)
    # slices of a long text add up
    monkeypatch.setattr(L, "GATHERED", 1)
    a, _ = m.log_likelihoods(["word été " * 20_000])
    monkeypatch.setattr(L, "GATHERED", 1 << 24)
    b, _ = m.log_likelihoods(["word été " * 20_000])
    assert np.allclose(a, b, rtol=1e-6)


def test_identify(spark, documents):
    docs = documents([(i, t, ["en", "de", None][i % 3]) for i, t in enumerate(ODD_TEXTS)] +
                     [(100 + i, "the house and the tree", "en") for i in range(20)] +
                     [(200 + i, "das haus und der baum", "de") for i in range(20)] +
                     [(None, "das haus und", "de"), (200, "das haus und der baum", "de")])
    m = L.fit(docs)
    out = L.identify(docs, m)
    assert out.columns == [*docs.columns, "predicted"]
    rows = out.collect()
    assert len(rows) == len(ODD_TEXTS) + 42
    for r in rows:
        t = r["text"]
        if not t or not any(c.isalpha() for c in t):
            assert (r.predicted.lang, r.predicted.score) == ("und", 0.0)
        else:
            assert r.predicted.lang in ("en", "de") and 0 <= r.predicted.score <= 1
    assert {r.predicted.lang for r in rows if r["text"] == "the house and the tree"} == {"en"}
    assert {r.predicted.lang for r in rows if r["text"] == "das haus und der baum"} == {"de"}
    kept = L.keep_identified(docs, m)
    assert kept.columns == docs.columns and not any(r["text"] in (None, "", " ") for r in kept.collect())


def test_nothing_to_learn_from(spark, documents):
    docs = documents(["a b", None])
    assert {r.predicted.lang for r in L.identify(docs, L.fit(docs)).collect()} == {"und"}
    assert L.identify(documents([]), L.fit(documents([]))).count() == 0


def test_rare_language_is_learned_from_all_its_rows(spark, documents):
    common = [(i, "the cat and the dog sat on the mat", "en") for i in range(3000)]
    rare = [(i, "zażółć gęślą jaźń święto ćma", "pl") for i in range(3000, 3012)]
    docs = documents(common + rare)
    model = L.fit(docs, sample=100)
    pl = model.languages.index("pl")
    assert np.array_equal(model.matrix[:, pl], L.fit(docs).matrix[:, pl])
    assert np.ptp(model.matrix[:, pl]) > 0
    assert model.predict(["święto jaźń", "the dog"])[0] == ["pl", "en"]
