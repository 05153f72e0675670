"""Edit-aware counts against encoding the edited text from scratch."""

import random

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD_TEXTS
from voltaic.llm import token_counts as C
from voltaic.llm.common import table
from voltaic.llm.queries import op3_token_counts
from voltaic.llm.tokens import encoder

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def plain(text, path=BYTE):
    return len(encoder(path).tokenizer.encode(text or "", add_special_tokens=False).ids)


def slow_edit(text, edits):
    out, at = [], 0
    for first, last, new in C.tidy(edits, len(text)):
        out += [text[at:first], new]
        at = last
    return "".join(out) + text[at:]


TEXT = st.text(alphabet=st.sampled_from(list("ab A1.,'s \n\t\xa0é你\x1c")), max_size=120)
EDITS = st.lists(st.tuples(st.integers(-2, 130), st.integers(-2, 130), TEXT.map(lambda t: t[:9])), max_size=5)


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=300, deadline=None)
@given(TEXT, EDITS, EDITS, st.integers(1, 20))
def test_edits_count_as_the_edited_text(path, text, edits, more, leaf):
    def count(t):
        return len(encoder(path).encode(t))
    lengths, tree = C.build(text, count, leaf)
    assert sum(lengths) == len(text) and tree.total() == plain(text, path)
    for own in (edits, more):  # an edited tree can be edited again
        want = slow_edit(text, own)
        text, lengths, tree, _, _ = C.edit(text, lengths, tree, own, count, leaf)
        assert text == want and sum(lengths) == len(text)
        assert tree.total() == plain(text, path)
        at = 0
        for k, n in enumerate(lengths):
            assert tree.count(k) == count(text[at:at + n]) and tree.prefix(k) == count(text[:at])
            at += n


def test_only_touched_regions_are_encoded():
    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha", "beta", "gamma,", "delta\nx"]) for _ in range(20_000))
    seen = []

    def count(t):
        seen.append(len(t))
        return len(encoder(BYTE).encode(t))
    lengths, tree = C.build(text, count)
    seen.clear()
    new, lengths, tree, made, encoded = C.edit(text, lengths, tree, [(50_000, 50_004, "omega")], count)
    assert made == 1 and sum(seen) == encoded < 5 * C.LEAF and tree.total() == plain(new)


def test_query_counts_the_masked_texts(spark):
    docs = {r.doc_id: r["text"] for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: r for r in op3_token_counts(spark, SF).collect()}
    assert set(got) == set(docs) and any(r.n_edits for r in got.values())
    for i, t in docs.items():
        masked = C._MASKED.sub(lambda m: C.MASKED[m.lastindex - 1][1], t)
        r = got[i]
        assert (r.n_before, r.n_tokens, r.n_chars) == (plain(t), plain(masked), len(masked))
        assert (r.n_edits == 0) == (r.n_encoded == 0)


def test_tables(spark, documents):
    rows = list(enumerate(ODD_TEXTS)) + [(None, "no id"), (4, "second row of an id")]
    trees = C.with_trees(documents(rows), BYTE)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in trees.collect()) == sorted(
        (i is None, i or 0, plain(t)) for i, t in rows)
    edits = spark.createDataFrame([(4, 0, 1, "Z z"), (0, 0, 0, "new"), (1, 0, 5, "x y"), (6, 1000, 2000, ""), (6, 1500, 1600, "overlap"),
                                   (6, None, 3, "q"), (None, 0, 1, "n"), (999, 0, 1, "n"), (7, 2, 1, "r"), (5, 1, 1, None)],
                                  "doc_id long, first int, last int, new string")
    by = {}
    for r in edits.collect():
        by.setdefault(r.doc_id, []).append((r.first, r.last, r.new))
    got = C.apply_edits(trees, edits, BYTE).collect()
    assert len(got) == len(rows)
    want = sorted(((i is None, i or 0), slow_edit(t or "", by.get(i, []) if i is not None else [])) for i, t in rows)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r["text"] or "") for r in got) == want
    for r in got:
        assert r.n_tokens == plain(r["text"])
    assert C.with_trees(documents([]), BYTE).count() == 0
