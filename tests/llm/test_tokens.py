"""Chunked encoding, packing and bit packing against whole-text encoding."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import ODD_TEXTS
from voltaic.llm import bitpack, packing
from voltaic.llm.tokens import ChunkEncoder, encoder

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abAB'st \n\t\r.,!12ßéΣ你́\xa0\x1c |<>")), max_size=40))
def test_chunked_ids_are_the_library_s(path, text):
    whole = encoder(path).tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder(path).encode(text).tolist() == whole


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_odd_texts_and_a_small_cache(path):
    enc = ChunkEncoder(path, cache_bytes=3000)
    assert enc.split is not None
    for t in ODD_TEXTS * 2:
        assert enc.encode(t).tolist() == (enc.tokenizer.encode(t, add_special_tokens=False).ids if t else [])


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_what_comes_back_is_kept(path, monkeypatch):
    """Chunks that come back are kept, within the bytes allowed; ids stay the library's."""
    monkeypatch.setattr("voltaic.llm.tokens.MOST_YOUNG", 60)
    enc = ChunkEncoder(path, cache_bytes=60_000)
    want = lambda t: enc.tokenizer.encode(t, add_special_tokens=False).ids if t else []
    for k in range(30):
        for t in [f"once{k}x{i} again, again\nand~again {i % 7} \t Word. Word" for i in range(40)] + list(ODD_TEXTS):
            assert enc.encode(t).tolist() == want(t)
            assert sum(known.held for known in enc.known.values()) <= 60_000
            assert all(len(known.young) <= 60 for known in enc.known.values())
    kept = set().union(*(known.ids for known in enc.known.values()))
    assert not any("x" in c and c.startswith("once") for c in kept) and "again" in kept


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 300), max_size=20))
def test_plan_fills_sequences_without_gap_or_overlap(counts):
    capacity = 50
    seen, filled = defaultdict(set), defaultdict(list)
    for length, rank, n, first, per, offset in packing.plan_best_fit(counts, capacity):
        for i in range(n):
            assert rank + i not in seen[length]
            seen[length].add(rank + i)
            filled[first + i // per].append((offset + i % per * length, length))
    assert {k: set(range(n)) for k, n in counts.items()} == dict(seen)
    for own in filled.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    # as item-by-item best-fit decreasing
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = min((r for r in rooms if r >= length), default=None)
            if fit is None:
                rooms.append(capacity - length)
            else:
                rooms[rooms.index(fit)] -= length
    assert len(filled) == len(rooms)


def test_pack(spark, documents):
    docs = documents(ODD_TEXTS + ["some words"] * 50)
    rows = packing.pack(docs, WORD, capacity=64, end_id=1, with_ids=True).collect()
    texts = dict(enumerate(ODD_TEXTS + ["some words"] * 50))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    tok = Tokenizer.from_file(WORD)
    for d, own in by_doc.items():
        ids = (tok.encode(texts[d], add_special_tokens=False).ids if texts[d] else []) + [1]
        own.sort(key=lambda r: r.piece)
        for k, r in enumerate(own):
            want = np.array(ids[k * 64:k * 64 + 64], "<u4").tobytes()
            assert (r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) == (k, k * 64, len(want) // 4, zlib.crc32(want), want)
        assert sum(r.length for r in own) == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert len(by_sequence) == -(-sum(r.length for r in rows) // 64)
    joined = packing.sequences(packing.pack(docs, WORD, capacity=64, end_id=1, with_ids=True)).collect()
    assert sum(r.length for r in joined) == sum(r.length for r in rows)
    assert all(len(r.ids) == 4 * r.length for r in joined)


def test_pack_empty_table(spark, documents):
    assert packing.pack(documents([]), WORD).count() == 0


@pytest.mark.parametrize("width", [1, 2, 7, 13, 16, 17, 31, 32])
@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000])
def test_bits_round_trip(width, n):
    ids = np.random.default_rng(n).integers(0, 1 << width, n, dtype=np.uint64).astype("<u4")
    data = bitpack.pack_ids(ids, width)
    assert len(data) == -(-n // 64) * width * 8
    assert bitpack.unpack_ids(data, width, n).tolist() == ids.tolist()


def test_pack_ids_refuses_wide_ids():
    with pytest.raises(ValueError):
        bitpack.pack_ids(np.array([8], "<u4"), 3)


class _Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def test_random_access():
    rng = np.random.default_rng(1)
    documents = [rng.integers(0, 50257, n).astype("<u4") for n in (0, 5, 3, 700, 1, 64, 0, 129)]
    f = bitpack.PackedFile(_Bytes(bitpack.file_bytes(documents, 16, block=64)))
    assert [f.document(k).tolist() for k in (7, 0, 3, 6, 1)] == [documents[k].tolist() for k in (7, 0, 3, 6, 1)]
    whole = np.concatenate(documents)
    assert f.slice(100, 777).tolist() == whole[100:777].tolist()
    for at_once in (1, 70, 10_000):
        assert [d.tolist() for d in f.in_order(at_once)] == [d.tolist() for d in documents]
    with pytest.raises(ValueError):
        bitpack.PackedFile(_Bytes(bitpack.file_bytes(documents, 16)[:-1])).slice(0, len(whole))


def test_bit_packed_files(spark, documents):
    texts = ODD_TEXTS + ["again"] * 5
    ids = [(3 * i, t) for i, t in enumerate(texts)] + [(6, "second row of an id"), (None, "no id")]
    manifest = bitpack.write_packed(documents(ids), BYTE, end_id=0, file_ids=5000)
    got = sorted(bitpack.read_packed(manifest).collect(), key=lambda r: r.start)
    tok = Tokenizer.from_file(BYTE)
    assert [r.doc_id for r in got] == sorted((i for i, _ in ids), key=lambda i: -1 if i is None else i)
    at = 0
    left = defaultdict(list)
    for i, t in ids:
        own = np.array((tok.encode(t, add_special_tokens=False).ids if t else []) + [0], "<u4")
        left[i].append((len(own), zlib.crc32(own.tobytes())))
    for r in got:
        assert r.start == at
        left[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens
    assert manifest.count() > 1


def test_bit_packed_empty_table(spark, documents):
    assert bitpack.read_packed(bitpack.write_packed(documents([]), BYTE)).count() == 0
