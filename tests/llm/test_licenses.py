"""Licence scans against a plain search, and the expression parser against hand-made cases."""

import re

import pytest

from tests.llm.conftest import ODD_TEXTS
from voltaic.llm import licenses as L

TEXTS = ODD_TEXTS + [
    "Released under the MIT License.", "GNU General Public License, version 3. GNU GENERAL-PUBLIC license",
    "Licensed under CC BY-NC 4.0.", "cc by cc by cc by", "Apache License, Version 2.0 and the mit license mit license",
    "xmit license", "mit licenses", "// SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND Apache-2.0 */",
    "SPDX-License-Identifier: MIT OR\nword", "spdx license identifier without a colon", "Mozilla Public License",
    "SPDX-License-Identifier: GPL-3.0-or-later AND MIT. Then a sentence", "mit license " * 3000,
]


def slow_base(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in L.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(own) - len(p) + 1):
            if own[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def test_base_places():
    s = L.Scanner()
    for t in TEXTS:
        r = s.scan(t)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == slow_base(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "")


@pytest.mark.parametrize("expression, tokens", [
    ("MIT", "mit"), ("MIT OR Apache-2.0 AND BSD-3-Clause", "mit apache-2.0 bsd-3-clause and or"),
    ("(MIT OR Apache-2.0) AND BSD-3-Clause", "mit apache-2.0 or bsd-3-clause and"),
    ("GPL-2.0-only WITH Classpath-exception-2.0 OR MIT", "gpl-2.0-only classpath-exception-2.0 with mit or"),
    ("A OR B OR C", "a b or c or"), ("((MIT))", "mit"), ("MIT */", "mit"), ("MIT or ISC. More text", "mit isc or"),
])
def test_postfix(expression, tokens):
    assert " ".join(L.postfix(expression)) == tokens


@pytest.mark.parametrize("expression", ["", "OR MIT", "MIT AND", "(MIT", "MIT OR )", "()", "(MIT ISC)"])
def test_no_expression(expression):
    with pytest.raises(L.ExpressionError):
        L.postfix(expression)


@pytest.mark.parametrize("expression, families, permissive", [
    ("MIT", {"mit"}, True), ("GPL-3.0-only", {"gpl"}, False), ("MIT OR GPL-2.0", {"mit", "gpl"}, True),
    ("MIT AND GPL-2.0", {"mit", "gpl"}, False), ("GPL-2.0 WITH Classpath-exception-2.0", {"gpl"}, False),
    ("(GPL-2.0 OR MIT) AND Apache-2.0", {"gpl", "mit", "apache"}, True), ("Own-1", {"own-1"}, False),
    ("LGPL-2.1 OR CC-BY-NC-4.0", {"lgpl", "cc-by-nc"}, False),
])
def test_evaluate(expression, families, permissive):
    assert L.evaluate(L.postfix(expression)) == (frozenset(families), permissive)


def test_labels():
    s = L.Scanner()
    r = s.scan(TEXTS[len(ODD_TEXTS) + 7])
    assert r["labels"] == "apache,gpl,mit" and r["permissive"] is True and r["score"] == 1.0
    assert s.scan("Licensed under CC BY-NC 4.0.")["labels"] == "cc-by,cc-by-nc"
    r = s.scan(TEXTS[len(ODD_TEXTS) + 11])
    assert r["labels"] == "gpl,mit" and r["permissive"] is False


def test_scan(spark, documents):
    s = L.Scanner()
    docs = documents(list(enumerate(TEXTS)) + [(None, "mit license"), (0, "cc by")])
    rows = L.scan(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        if r.doc_id:
            want = s.scan(TEXTS[r.doc_id])
            assert {k: r[k] for k in want} == want
    assert L.scan(documents([])).count() == 0
