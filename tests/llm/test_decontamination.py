"""Decontamination against a plain search of every window."""

import hashlib
import random
import re

import pytest

from tests.llm.conftest import ODD_TEXTS
from voltaic.llm import decontamination as D
from voltaic.llm.words import word_spans, words


def slow_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow(text, items, n=10):
    own, hit, found = slow_words(text), set(), set()
    for item, t in items:
        w = slow_words(t)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            for k in range(len(own) - size + 1):
                if own[k:k + size] == w[i:i + size]:
                    hit |= set(range(k, k + size))
                    found.add("" if item is None else str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(own), hit, len(found), digest


def case():
    rng = random.Random(2)
    words_ = ["the", "Of", "and", "thé", "x1", "ou", "re", "in"]
    items = [(i, " ".join(rng.choice(words_) for _ in range(rng.choice([3, 9, 10, 11, 14, 25])))) for i in range(30)]
    items += [(2, items[5][1]), (100, None), (101, ""), (102, "..."), (None, "alone here now")]
    texts = list(ODD_TEXTS) + ["alone, HERE now", "alone here"]
    for _ in range(40):
        own = [rng.choice(words_) for _ in range(rng.randrange(40))]
        t = rng.choice(items)[1] or ""
        texts.append(" ".join(own) + rng.choice([" ", "\n", "- "]) + t.upper() + ", " + " ".join(own[:5]))
    return texts, items


def test_words():
    for t in ODD_TEXTS + ["Ab-cD é1\x00x_y"]:
        assert [w.decode() for w in words(t)] == slow_words(t)
        if t:
            assert [t.encode()[a:b].decode().lower() for a, b in word_spans(t)] == [w.lower() for w in slow_words(t)]


@pytest.mark.parametrize("block_chars", [1 << 20, 200])
def test_report(spark, documents, block_chars):
    texts, items = case()
    texts = [t if t is None or len(t) < 1000 else t[:1000] for t in texts]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in D.report(documents(texts), bench, block_chars=block_chars).collect()}
    assert set(got) == set(range(len(texts)))
    for i, t in enumerate(texts):
        n, hit, found, digest = slow(t, items)
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, len(hit), found, digest, bool(hit)), t
    assert any(r.contaminated for r in got.values()) and not all(r.contaminated for r in got.values())


def test_removal(spark, documents):
    texts, items = case()
    docs, bench = documents(texts), spark.createDataFrame(items, "item_id long, text string")
    hits = {i for i, t in enumerate(texts) if slow(t, items)[1]}
    kept = D.remove_documents(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - hits
    cut = D.remove_spans(docs, bench)
    assert cut.columns == docs.columns
    for r in cut.collect():
        if r.doc_id not in hits:
            assert r["text"] == texts[r.doc_id]
        else:
            n, hit, _, _ = slow(texts[r.doc_id], items)
            left = [w for k, w in enumerate(slow_words(texts[r.doc_id])) if k not in hit]
            assert slow_words(r["text"]) == left


def test_empty_tables(spark, documents):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.report(documents([]), bench).count() == 0
    none = D.report(documents(["a b", None]), bench.limit(0)).collect()
    assert [r.contaminated for r in none] == [False, False]
