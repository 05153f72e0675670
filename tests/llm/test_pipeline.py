"""The pipeline's stages against plain versions, one row at a time, at sf0.001."""

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline as C
from tests.llm.test_decontamination import slow
from tests.llm.test_simhash import slow_components, slow_fingerprint
from voltaic.llm import language, quality
from voltaic.llm.common import table

SF = "/root/testdata/sf0.001"


def plain(spark):
    """doc_ids after each stage."""
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r["text"] for r in docs.collect()}
    out = []
    m = language.fit(docs)
    lang, score, support = m.judge(list(rows.values()))
    rows = {i: t for (i, t), s, x in zip(rows.items(), score, support) if s >= 0.5 and x >= 0.6}
    out.append(set(rows))
    kept = docs.where(docs.doc_id.isin(*rows))
    q = quality.fit(kept, table(spark, SF, "labels"))
    noise = {r[0]: r[1] for r in kept.select("doc_id", quality.gumbel(kept.doc_id, 23)).collect()}
    weight = {i: q.log_weight(t) for i, t in rows.items()}
    k = round(sum(1 / (1 + np.exp(-w - np.log(q.share / (1 - q.share)))) for w in weight.values()))
    rows = {i: rows[i] for i in sorted(rows, key=lambda i: -(weight[i] + noise[i]))[:k]}
    out.append(set(rows))
    ids = sorted(rows)
    root = slow_components(ids, [slow_fingerprint(rows[i]) for i in ids], 2)
    rows = {i: rows[i] for i in ids if root[i] == i}
    out.append(set(rows))
    items = [(r.item_id, r["text"]) for r in table(spark, SF, "benchmark").collect()]
    rows = {i: t for i, t in rows.items() if not slow(t, items)[1]}
    out.append(set(rows))
    return out, rows


def test_stages(spark):
    ids, rows = plain(spark)
    docs = table(spark, SF, "documents")
    names = docs.columns
    assert [n for n, _ in C.STAGES] == ["language ID", "quality classifier", "SimHash near-dedup",
                                        "benchmark decontamination", "best-fit packing"]
    for (_, apply), want in zip(C.STAGES[:-1], ids):
        docs = C.stage(apply(spark, docs, SF), "test")
        assert docs.columns == names
        assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == sorted(want)
    assert len(ids[0]) > len(ids[1]) > len(ids[2]) > len(ids[3]) > 100
    packed = C.STAGES[-1][1](spark, docs, SF).collect()
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    by_doc, by_sequence = defaultdict(int), defaultdict(list)
    for r in packed:
        all_ids = np.array(tok.encode(rows[r.doc_id], add_special_tokens=False).ids + [1], "<u4")
        assert r.ids_crc32 == zlib.crc32(all_ids[r.start:r.start + r.length].tobytes()) and r.start == 4096 * r.piece
        by_doc[r.doc_id] += r.length
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(rows)
    for own in by_sequence.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 4096


def test_run(spark):
    ids, rows = plain(spark)
    got = C.run(spark, SF)
    assert {r.doc_id for r in got.select("doc_id").collect()} == set(rows)
    assert re.match("doc_id,piece,start,length,ids_crc32,sequence_id,offset", ",".join(got.columns))


def test_stages_get_through_odd_documents(spark, documents):
    from tests.llm.conftest import ODD_TEXTS

    for rows in ([], list(enumerate(ODD_TEXTS)) + [(None, "no id"), (3, "id again"), (3, "id again")]):
        docs = documents(rows)
        names = docs.columns
        for _, apply in C.STAGES[:-1]:
            docs = C.stage(apply(spark, docs, SF), "test")
            assert docs.columns == names
        C.STAGES[-1][1](spark, docs, SF).collect()


def test_language_stage_rejects_what_no_language_explains(spark, documents):
    """Letter noise and a language that wasn't learned go, though some language always wins; clean texts stay."""
    own = [(r["text"], r.lang) for r in table(spark, "/root/testdata/sf0.01", "documents").collect()]
    rng = np.random.default_rng(2)
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), n)) for n in (30, 200, 3000)] + ["qqqq xxxx zzzz wwww", "12345 ..."]
    strangers = [t for t, lang in own if lang == "es"][:15]
    rows = [(i, t, lang) for i, (t, lang) in enumerate(x for x in own if x[1] != "es")]
    docs = documents(rows + [(10_000 + i, t) for i, t in enumerate(noise + strangers)])
    kept = {r.doc_id for r in C.language_id(spark, docs, SF).collect()}
    assert kept >= {i for i, _, _ in rows}
    assert not kept & set(range(10_000, 10_000 + len(noise))) and len(kept & set(range(10_000 + len(noise), 20_000))) <= 2
