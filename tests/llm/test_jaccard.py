"""The Jaccard join against sets compared pair by pair."""

import random
import re

import numpy as np
import pytest

from tests.llm.conftest import ODD_TEXTS
from voltaic.llm import jaccard as J


def slow_set(text, size=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    k = min(size, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def slow(rows, percent=80):
    """(doc_id, n, component) a row, sorted; ids aren't null."""
    sets = [slow_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            c = len(a & sets[j])
            if a and sets[j] and 100 * c >= percent * (len(a) + len(sets[j]) - c):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return sorted((key, len(s), least[find(i)]) for i, ((key, _), s) in enumerate(zip(rows, sets)))


def family(rng, words, n, edits, length=60):
    """n texts, each the same one with some words changed."""
    base = [rng.choice(words) for _ in range(length)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(len(own))] = rng.choice(words)
        out.append(" ".join(own[rng.randrange(3):]))
    return out


def corpus(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    texts = []
    for edits in (1, 1, 2, 3):
        texts += family(rng, words, 12, edits)
    texts += family(rng, words, 40, 2, 90)
    texts += [passage + " " + " ".join(rng.choice(words) for _ in range(rng.randrange(0, 14))) for _ in range(25)]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 9))) for _ in range(20)]
    texts += [t.upper().replace(" ", "\n", 3) for t in texts[:30]]
    return texts


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("most", [{}, {"most_rows": 4}, {"most_rows": 9, "most_shingles": 300}])
def test_components(spark, documents, most):
    rows = list(enumerate(corpus()))
    want = slow(rows)
    assert len({c for _, _, c in want}) < len(rows) - 40  # there is something to link
    assert got(J.components(documents(rows), **most)) == want


@pytest.mark.parametrize("percent", [50, 100])
def test_other_thresholds(spark, documents, percent):
    rows = list(enumerate(corpus(4)))
    assert got(J.components(documents(rows), percent=percent, most_rows=16)) == slow(rows, percent)


def test_odd_texts(spark, documents):
    rows = list(enumerate(ODD_TEXTS))
    assert got(J.components(documents(rows))) == slow(rows)
    rows = [(7, "a b c"), (7, "a b c"), (7, None), (3, "A  b\tc"), (9, "x y"), (None, "x y"), (None, "only here"), (None, None)]
    assert sorted(J.components(documents(rows)).collect(), key=str) == sorted(
        [(7, 1, 3), (7, 1, 3), (7, 0, 7), (3, 1, 3), (9, 1, 9), (None, 1, 9), (None, 1, None), (None, 0, None)], key=str)
    assert J.components(documents([])).collect() == []


def test_hot_group_makes_no_pairs(spark, documents):
    """A third of the rows is one group of near copies, a sixth copies of one text: nothing of the size of their pairs."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    texts = family(rng, words, 200, 1, 100) + ["one text that is there very often indeed"] * 100
    texts += [" ".join(rng.choice(words) for _ in range(50)) for _ in range(300)]
    rows = list(enumerate(texts))
    src = documents(rows).select("doc_id", "text")
    columns = J._columns(J._count(J._deal(src, 5, 16), 16), 16, 80).cache()
    links = J.links(columns, 80, most_rows=32)
    assert links.count() < 8 * 200
    assert got(J.components(documents(rows), most_rows=32)) == slow(rows)


def test_sets():
    rng = random.Random(1)
    long = " ".join(rng.choice("ab cde fgh ÄÖ".split()) for _ in range(5000))
    texts = [*ODD_TEXTS, long, long[: len(long) // 2]]
    J_chunk, J.CHUNK_BYTES = J.CHUNK_BYTES, 3000
    try:
        pieces = J.shingle_sets(texts)
    finally:
        J.CHUNK_BYTES = J_chunk
    whole = J.shingle_sets(texts)
    assert np.array_equal(pieces[0], whole[0]) and np.array_equal(pieces[1], whole[1])
    assert whole[0].tolist() == [len(slow_set(t)) for t in texts]


def test_overlaps():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 80)).astype(np.uint64)) for _ in range(60)]
    plain = [[0 if i == j else len(np.intersect1d(a, b)) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    assert np.array_equal(J.overlaps(sets), plain)


def test_prefix_length():
    for n in range(1, 300):
        for percent in (50, 80, 93, 100):
            need = -(-percent * n // 100)
            assert J.prefix_length(n, percent) == n - need + 1
