"""SimHash against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD_TEXTS
from voltaic.llm import simhash
from voltaic.llm.components import connected_components


def slow_fingerprint(text, n=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps, radius):
    """Smallest index reachable, by all pairs."""
    root = list(range(len(ids)))
    distance = np.bitwise_count(np.array(fps, np.uint64)[:, None] ^ np.array(fps, np.uint64)[None, :])
    changed = True
    while changed:
        changed = False
        for i, j in zip(*np.nonzero(distance <= radius)):
            if root[j] < root[i]:
                root[i], changed = root[j], True
    return {i: ids[r] for i, r in zip(ids, root)}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aBc \n\t\x1c\xa0éÀ,")), max_size=30))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_odd_fingerprints():
    for t in ODD_TEXTS:
        assert simhash.fingerprint(t) == slow_fingerprint(t)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
@pytest.mark.parametrize("n", [2, 63, 64, 65, 300])
def test_near_lanes(radius, n):
    rng = random.Random(n * 7 + radius)
    base = rng.getrandbits(64)
    fps = np.array([base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(7))) & (1 << 64) - 1
                    if rng.random() < 0.7 else rng.getrandbits(64) for _ in range(n)], np.uint64)
    planes = simhash.bit_planes(fps)
    for shift in {1, 2, 63 % n or 1, 64, n - 1}:
        mask = np.zeros(planes.shape[1] * 64, np.uint8)
        mask[:max(0, n - shift)] = 1
        got = simhash.near_lanes(planes, shift, np.packbits(mask, bitorder="little").view("<u8"), radius)
        want = [i for i in range(n - shift) if bin(int(fps[i]) ^ int(fps[i + shift])).count("1") <= radius]
        assert sorted(got.tolist()) == want


def near_fingerprints(rng, n, spread=3):
    centres = [rng.getrandbits(64) for _ in range(8)]
    out = set()
    while len(out) < n:
        f = rng.choice(centres)
        for _ in range(rng.randrange(spread + 1)):
            f ^= 1 << rng.randrange(64)
        out.add(f)
    return sorted(out)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
@pytest.mark.parametrize("most", [4096, 2, 12])
def test_links_lose_nothing(spark, radius, most):
    """Also with buckets over the limit, which are linked through the points around them."""
    rng = random.Random(radius)
    fps = near_fingerprints(rng, 150)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    found = simhash.links(df, radius, most).collect()
    for r in found:  # links hold, or join what links reach
        assert r.a != r.b
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(found, "a long, b long")).collect()} if found else {}
    want = slow_components(signed, fps, radius)
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    assert groups({f: got.get(f, f) for f in signed}) == groups(want)


def test_connected_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    loose = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    edges = chain + star + loose + [(5, 5), (7, 6), (6, 7)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        if a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root.get(a, a), root.get(b, b))
            for x in (a, b):
                if x in root and root[x] != m:
                    root[x], changed = m, True
    assert got == root
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _texts(rng):
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randrange(60, 200))]
        for _ in range(rng.randrange(1, 6)):
            own = list(base)
            for _ in range(rng.randrange(0, 2)):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    return texts + ODD_TEXTS + ["one copy of many here"] * 200


@pytest.mark.parametrize("most", [4096, 3])
def test_components_of_documents(spark, documents, most):
    texts = _texts(random.Random(3))
    rng = random.Random(9)
    ids = rng.sample(range(10_000), len(texts))
    got = {r.doc_id: r for r in simhash.components(documents(list(zip(ids, texts))), most_in_bucket=most).collect()}
    order = sorted(range(len(ids)), key=lambda k: ids[k])
    fps = [slow_fingerprint(texts[k]) for k in order]
    want = slow_components([ids[k] for k in order], fps, 2)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.fingerprint for i, r in got.items()} == {ids[k]: f"{f:016x}" for k, f in zip(order, fps)}
    assert len(set(want.values())) < len(want)


def test_deduplicate_keeps_one_of_each_group(spark, documents):
    texts = _texts(random.Random(4))
    rows = list(enumerate(texts)) + [(0, texts[0]), (3, "another text under an id that is taken"), (None, "no id"), (None, "no id"), (None, texts[0])]
    docs = documents(rows)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    left = kept.collect()
    groups = defaultdict(list)
    for i, r in enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))):
        groups[slow_fingerprint(r[1])].append(i)
    fps = sorted(groups)
    want = slow_components(fps, fps, 2)
    reps = defaultdict(list)
    for i, t in rows:
        reps[want[slow_fingerprint(t)]].append((i is None, i or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left) == sorted(min(v) for v in reps.values())


def test_staged_folders_can_be_discarded(spark, documents):
    from voltaic.llm.common import discard_all, stage

    discard_all(spark)
    kept = simhash.components(documents(["a b c", "a b c", "d"])).collect()
    assert len(kept) == 3 and discard_all(spark) > 0 and discard_all(spark) == 0
    df = stage(documents(["x"]), "again")
    assert df.count() == 1 and discard_all(spark) == 1


def test_empty(spark, documents):
    assert simhash.components(documents([])).count() == 0
    assert simhash.deduplicate(documents([])).count() == 0
