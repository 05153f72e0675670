"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from voltaic.llm import neighbours as N
from voltaic.llm.common import table

SF = "/root/testdata/sf0.1"
F = N.F


def brute(rows, is_query, k):
    """Rows are (vec_id, vector)."""
    own = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(
        x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in own:
        if is_query(i):
            scored = sorted((-float((q * v).sum()), j) for j, v in own if j != i)
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def test_recall(spark):
    """Against brute force over the whole table, as op4 asks it."""
    vectors = table(spark, SF, "embeddings")
    own = N.nearest(vectors, lambda i: F.pmod(i, F.lit(20)) == 0, k=20)
    got = {}
    for r in own.found.collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    rows = [(r.vec_id, r.embedding) for r in vectors.select("vec_id", "embedding").collect()]
    want = brute(rows, lambda i: i % 20 == 0, 20)
    at = {i: np.array(v, float) for i, v in rows}
    assert set(got) == set(want)
    hits = 0
    for i, true in want.items():
        assert sorted(got[i]) == list(range(1, 21))
        mine = [got[i][k] for k in range(1, 21)]
        assert mine == sorted(mine, key=lambda x: (-x[1], x[0]))
        for j, s in mine:
            assert abs(s - float((at[i] * at[j]).sum())) < 1e-12 and j != i
        hits += len({j for j, _ in mine} & {j for j, _ in true})
    assert hits / (20 * len(want)) >= 0.9
    assert 0 < own.visits < own.leaves and own.calibrated_recall >= 0.95


def odd_rows():
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # ties: the same vector many times
    rows += [(2000, None), (2020, [0.0] * 6), (2040, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2060, [float("nan")] * 6),
             (2080, [float("inf")] + [1.0] * 5), (2100, [1.0, 2.0]), (None, [1.0] * 6), (2120, [])]
    return rows


@pytest.mark.parametrize("k", [1, 20, 1000])
def test_odd_vectors_and_ties_with_all_leaves(spark, k):
    rows = odd_rows()
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, VEC string").repartition(4)
    own = N.nearest(df, lambda i: F.pmod(i, F.lit(20)) == 0, k=k, recall=1.0, leaf_rows=20, calibration=10 ** 6)
    got = {}
    for r in own.found.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute([r for r in rows if r[1] is None or len(r[1]) == 6], lambda i: i % 20 == 0, k)
    assert set(got) == set(want)
    for i, true in want.items():
        assert [j for _, j, _ in sorted(got[i])] == [j for j, _ in true]
        assert [r for r, _, _ in sorted(got[i])] == list(range(1, len(true) + 1))


def test_small_shards_and_chunks(spark, monkeypatch):
    rows = [(i, v) for i, v in odd_rows() if i is not None and v and len(v) == 6]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(N, "SHARD_ROWS", 16)
    monkeypatch.setattr(N, "CHUNK_QUERIES", 5)
    own = N.nearest(df, lambda i: F.pmod(i, F.lit(2)) == 0, k=5, recall=1.0, leaf_rows=100, calibration=10 ** 6)
    got = {}
    for r in own.found.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    want = brute(rows, lambda i: i % 2 == 0, 5)
    assert {i: [j for _, j in sorted(v)] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in want.items()}


def test_tree():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 8))
    t = N.fit_tree(x, 10_000, leaf_rows=100)
    leaf = t.descend(x)
    assert t.leaves > 20 and set(leaf) <= set(range(t.leaves))
    assert sorted(t.best_bin_first(x[0], t.leaves)) == list(range(t.leaves))
    sizes = np.bincount(leaf, minlength=t.leaves)
    few = t.best_bin_first(x[0], 1, sizes, 150)
    assert sizes[few].sum() >= 150 > sizes[few[:-1]].sum()
    assert N.fit_tree(np.ones((500, 3)), 10 ** 6).leaves == 1


def test_few_and_no_rows(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert N.nearest(none, lambda i: i == 0).found.count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert N.nearest(one, lambda i: i == 0).found.count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 0.0]), (1, [2.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in N.nearest(two, lambda i: i >= 0).found.collect()) == [
        (0, 1, 1, 2.0), (0, 2, 1, 1.0), (1, 1, 0, 1.0)]


def test_hot_ids(spark):
    """A third of the rows has one id, which is a query: every query still gets k candidates, nothing of that size is fetched."""
    rng = np.random.default_rng(9)
    rows = [(0, rng.normal(size=4).tolist()) for _ in range(150)] + [(i, rng.normal(size=4).tolist()) for i in range(1, 300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    own = N.nearest(df, lambda i: F.pmod(i, F.lit(100)) == 0, k=5, recall=0.1, leaf_rows=16, fit_sample=60)
    got = own.found.collect()
    assert own.leaves > 4
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert sorted(by) == [0, 100, 200] and all(len(v) == 5 for v in by.values()) and 0 not in by[0]


def test_a_query_meets_a_block_once_a_round(spark, monkeypatch):
    """A query is sent on once for all leaves of a block, not once a leaf."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sent, meet = [], N._meet

    def watched(visited, *rest):
        sent.append(visited.count())
        return meet(visited, *rest)

    monkeypatch.setattr(N, "_meet", watched)
    own = N.nearest(df, lambda i: F.pmod(i, F.lit(20)) == 0, k=5, recall=1.0, leaf_rows=20, calibration=10 ** 6)
    got = {}
    for r in own.found.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    want = brute(rows, lambda i: i % 20 == 0, 5)
    assert {i: [j for _, j in sorted(v)] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in want.items()}
    # one block holds these rows; leaves are many
    assert own.visits > 50 and len(sent) > 1 and sent == [100] * len(sent)
