"""Product codes against a plain Lloyd over all parts and entries."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from voltaic.llm import codes as C

SCHEMA = "vec_id long, embedding array<float>, label int, LABEL string, code string"


def slow(rows, parts, entries, rounds):
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    dims = [len(r[1]) for r in kept]
    dim = min(set(dims), key=lambda d: (-dims.count(d), d))
    kept = [r for r in kept if len(r[1]) == dim]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    v = np.floor(4096 * np.array([r[1] for r in kept], np.float32).astype(np.float64)).astype(np.int64).reshape(len(kept), parts, dim // parts)
    books = [v[:entries, p].copy() for p in range(parts)]
    near = lambda: [((v[:, None, p] - books[p][None]) ** 2).sum(axis=2) for p in range(parts)]
    for _ in range(rounds):
        for p, far in enumerate(near()):
            own = far.argmin(axis=1)
            for e in range(len(books[p])):
                if (own == e).any():
                    books[p][e] = v[own == e, p].sum(axis=0) // (own == e).sum()
    far = near()
    error = sum(f.min(axis=1) for f in far)
    of_label = defaultdict(int)
    for r, e in zip(kept, error):
        of_label[r[2]] += int(e)
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{f[i].argmin():02x}" for f in far), int(error[i]), of_label[r[2]], digest)
                   for i, r in enumerate(kept)), key=str)


def vectors(n=700, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dim))
    x = (centres[rng.integers(0, 9, n)] + 0.05 * rng.normal(size=(n, dim))).astype(np.float32)
    rows = [(i, x[i].tolist(), None if i % 5 == 0 else i % 3, "x", None) for i in rng.permutation(n).tolist()]
    rows += [(3, rows[5][1], 1, None, None), (n, None, 1, None, None), (n + 1, [0.5, None] * (dim // 2), 1, None, None),
             (n + 2, [float("nan")] * dim, 1, None, None), (n + 3, [float("inf")] * dim, 2, None, None), (n + 4, [1.0], 2, None, None),
             (None, rows[0][1], 1, None, None), (n + 5, [0.0] * dim, 7, None, None)]
    return rows


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("parts,entries,rounds", [(8, 16, 6), (4, 16, 3), (1, 5, 2), (16, 2, 1)])
def test_report(spark, monkeypatch, parts, entries, rounds):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(C.report(df, parts, entries, rounds)) == slow(rows, parts, entries, rounds)


def test_few_rows_and_equal_entries(spark):
    rows = [(i, [float(i // 4), 1.0], i % 2, None, None) for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(C.report(df, 2, 16, 4)) == slow(rows, 2, 16, 4)
    assert C.report(df.where("false"), 2).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        C.report(df, 8)


def test_whole_nodes_are_assigned():
    """On clustered parts the trees decide for most points without looking at them."""
    rng = np.random.default_rng(4)
    entries = rng.integers(-4000, 4000, (16, 4))
    x = (entries[rng.integers(0, 16, 5000)] + rng.integers(-20, 20, (5000, 4))).astype(np.int64)
    tree = C.PartTree.unpack(C.PartTree.build(x).pack(), 4)
    assert np.array_equal(tree.points, x[tree.order])
    seen = []
    plain = C.candidates
    try:
        C.candidates = lambda low, high, by: seen.append(len(low)) or plain(low, high, by)
        own, sums, counts = C.assign(tree, entries)
    finally:
        C.candidates = plain
    want = ((tree.points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert np.array_equal(own, want)
    assert np.array_equal(counts, np.bincount(want, minlength=16))
    assert np.array_equal(sums, np.stack([tree.points[want == e].sum(axis=0) for e in range(16)]))
    left = plain(tree.low[tree.kids < 0], tree.high[tree.kids < 0], C.EntryTree(entries))
    assert (left.sum(axis=1) == 1).mean() > 0.7


def test_bounds_keep_every_nearest_entry():
    rng = np.random.default_rng(6)
    for _ in range(30):
        entries = rng.integers(-30, 30, (rng.integers(1, 17), 3))
        x = rng.integers(-40, 40, (200, 3))
        by = C.EntryTree(entries)
        left = C.candidates(x.min(axis=0)[None], x.max(axis=0)[None], by)[0]
        far = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        assert set(far.argmin(axis=1).tolist()) <= set(by.index[left].tolist())


def test_decode(spark):
    rows = [r for r in vectors(200) if r[0] is not None and r[0] < 200]
    codes, books = C.compress(spark.createDataFrame(rows, SCHEMA), 8, 16, 6)
    for r in codes.limit(20).collect():
        x = next(v for i, v, *_ in rows if i == r.vec_id)
        near = C.decode(bytes(r.code), books)
        assert abs(((near - np.array(x)) ** 2).sum() - r.error / 4096**2) < 0.05


def test_large_components_raise(spark):
    df = spark.createDataFrame([(1, [40000.0, 0.0], 1, None, None)], SCHEMA)
    with pytest.raises(Exception, match="aren't supported"):
        C.report(df, 2).collect()
