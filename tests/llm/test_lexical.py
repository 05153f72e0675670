"""Lexical search against a plain count of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import ODD_TEXTS
from voltaic.llm import lexical as L


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def slow(docs, items, k):
    own = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, n_all = sum(n > 0 for _, _, n in own), sum(n for _, _, n in own)
    out = []
    for item in {i for i, _ in items}:
        asked = Counter(t for text in {t for i, t in items if i == item} for t in terms(text))
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c, _ in own) + 1))) for t in asked}
        found = []
        for i, c, n in own:
            m = 75 + (25 * n * n_docs) // max(1, n_all)
            score = sum(x * w[t] * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, x in asked.items() if c[t])
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def case():
    rng = random.Random(8)
    vocabulary = ["the", "Of", "and", "thé", "x1", "ou", "re", "in", "then", "he", "1", *[f"rare{i}" for i in range(60)]]
    docs = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    docs += [(100 + i, " ".join(rng.choices(vocabulary, k=rng.randrange(60)))) for i in range(150)]
    docs += [(400 + i, "the Of-and, ou; rare1") for i in range(30)] + [(401, "the re rare1 x1"), (None, "the re rare1 x1"), (None, "")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 20)))) for i in range(12)]
    items += [(3, items[3][1]), (4, "rare5 rare5 THE"), (50, None), (51, "..."), (52, "nowhere"), (None, "x1 ou"), (53, "same same text")]
    return docs, items


@pytest.mark.parametrize("block_chars", [1 << 20, 150])
def test_search(spark, documents, block_chars):
    docs, items = case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = L.search(documents(docs), bench, k=7, block_chars=block_chars).collect()
    assert sorted(map(tuple, got), key=str) == slow(docs, items, 7)


def test_bounded_pieces(spark, documents, monkeypatch):
    monkeypatch.setattr(L, "_AT_ONCE", 40)
    docs, items = case()
    scanner = L.TermScanner([b"he", b"the"])
    n, own = scanner.scan("The he, THE then he")
    assert n == 5 and own.tolist() == [1, 0, 1, 0]
    ends = np.cumsum([3, 200, 1, 1, 170, 2])
    assert list(L._cuts(ends)) == [(0, 1), (1, 2), (2, 4), (4, 5), (5, 6)]


def test_best_of_many_ties():
    best = L._Best(2, 3)
    for a in range(0, 3000, 100):
        ids = list(range(a, a + 100))[::-1]
        best.add(ids, np.stack([np.full(100, 5), np.array(ids) % 7], axis=1))
    best.settle()
    assert [c.tolist() for c in best.rows] == [[0, 0, 0, 1, 1, 1], [5, 5, 5, 6, 6, 6], [0] * 6, [0, 1, 2, 6, 13, 20]]


def test_empty_tables(spark, documents):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert L.search(documents([]), bench).collect() == []
    assert L.search(documents([None, "", "..."]), bench).collect() == []
    assert L.search(documents(["a b"]), bench.where("false")).collect() == []
