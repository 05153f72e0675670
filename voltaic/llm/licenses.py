"""Licence scans: phrases and identifier tags by Aho-Corasick, expressions by shunting-yard.

One automaton over the words of a text (joined by single spaces, so that a phrase is found
where its words stand consecutively) holds all notice phrases and the identifier tag. Only
texts with the tag have their expressions read: tokenised, put in postfix order by a
shunting-yard parser (``with`` binds tighter than ``and``, that tighter than ``or``) and
evaluated to the licence families named and to whether the terms can be met with permissive
licences.
"""

from __future__ import annotations

import re

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick
from .words import words

#: The base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notice phrases, as words, and the family each names.
NOTICE_PHRASES = {
    "affero general public license": "agpl",
    "all rights reserved": "proprietary",
    "apache 2 0": "apache",
    "artistic license": "artistic",
    "boost software license": "boost",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0 1 0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "eclipse public license": "epl",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge": "mit",
    "public domain": "public-domain",
    "redistribution and use in source and binary forms": "bsd",
    "the unlicense": "unlicense",
    "zlib license": "zlib",
}
TAG = "spdx license identifier"
#: Family of an identifier by the start of its lower-cased name; the first that fits.
IDENTIFIERS = (
    ("agpl", "agpl"), ("apache", "apache"), ("artistic", "artistic"), ("bsd", "bsd"), ("bsl-1", "boost"),
    ("cc-by-nc", "cc-by-nc"), ("cc-by-nd", "cc-by-nd"), ("cc-by-sa", "cc-by-sa"), ("cc-by", "cc-by"), ("cc0", "cc0"),
    ("epl", "epl"), ("gpl", "gpl"), ("isc", "isc"), ("lgpl", "lgpl"), ("mit", "mit"), ("mpl", "mpl"),
    ("unlicense", "unlicense"), ("zlib", "zlib"),
)
PERMISSIVE = frozenset(("apache", "artistic", "boost", "bsd", "cc-by", "cc0", "isc", "mit", "public-domain", "unlicense", "zlib"))

_BINDS = {"or": 1, "and": 2, "with": 3}
_AFTER_TAG = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+:-]*", re.IGNORECASE)


class ExpressionError(ValueError):
    """Not a licence expression."""


def postfix(expression: str) -> list[str]:
    """The expression's tokens in postfix order, lower-cased; raises ExpressionError.

    Reading stops where a token can't go on with the expression outside parentheses
    (a comment's end, a following sentence)."""
    out: list[str] = []
    stack: list[str] = []
    operand = True  # whether an operand comes next
    at = 0
    text = expression.strip()
    while at < len(text):
        if text[at] in " \t":
            at += 1
            continue
        m = _TOKEN.match(text, at)
        if not m:
            break
        token = m[0].lower()
        if operand:
            if token == "(":
                stack.append(token)
            elif token == ")" or token in _BINDS:
                raise ExpressionError(f"{token!r} where a licence is due")
            else:
                out.append(token.rstrip(".:"))
                operand = False
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
        elif token in _BINDS:
            while stack and _BINDS.get(stack[-1], 0) >= _BINDS[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = True
        elif "(" in stack:
            raise ExpressionError(f"{token!r} where an operator is due")
        else:
            break
        at = m.end()
    if operand or "(" in stack:
        raise ExpressionError("the expression isn't complete")
    return out + stack[::-1]


def family(identifier: str) -> str:
    """The family of an identifier; one that isn't known is its own."""
    return next((label for start, label in IDENTIFIERS if identifier.startswith(start)), identifier)


def evaluate(tokens: list[str]) -> tuple[frozenset[str], bool]:
    """(families named, whether permissive licences alone can meet the terms) of a postfix expression.

    ``and`` needs both sides, ``or`` either, and ``with`` is as its licence: the exception on
    the right names no family."""
    stack: list[tuple[frozenset[str], bool]] = []
    for token in tokens:
        if token in _BINDS:
            right, left = stack.pop(), stack.pop()
            stack.append(left if token == "with" else (
                left[0] | right[0], left[1] and right[1] if token == "and" else left[1] or right[1]))
        else:
            stack.append((frozenset([family(token)]), family(token) in PERMISSIVE))
    return stack.pop()


def _automaton(base: dict[str, str], notices: dict[str, str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in sorted({*base, *notices, TAG}):
        found.add_word(f" {phrase} ", (len(phrase) + 2, base.get(phrase), notices.get(phrase), phrase == TAG))
    found.make_automaton()
    return found




class Scanner:
    """Scans a text at a time."""

    def __init__(self, base: dict[str, str] = BASE_PHRASES, notices: dict[str, str] = NOTICE_PHRASES):
        self.automaton = _automaton(base, notices)

    def scan(self, text: str | None) -> dict:
        own = words(text)
        joined = " " + b" ".join(own).decode("utf-8", "replace") + " " if own else ""
        n_base, first, last, tagged = 0, None, None, False
        base: set[str] = set()
        labels: set[str] = set()
        at, word = 0, 0  # `word` spaces stand before character `at`
        for end, (length, base_label, notice_label, tag) in self.automaton.iter(joined):
            start = end - length + 1
            word += joined.count(" ", at, start) if start >= at else -joined.count(" ", start, at)
            at = start
            if base_label:
                n_base += 1
                base.add(base_label)
                first = word if first is None else min(first, word)
                last = word if last is None else max(last, word)
            if notice_label:
                labels.add(notice_label)
            tagged = tagged or tag
        expressions, permissive = [], None
        if tagged:
            for m in _AFTER_TAG.finditer(text):
                try:
                    named, ok = evaluate(tokens := postfix(m[1]))
                except ExpressionError:
                    continue
                labels |= named
                expressions.append(" ".join(tokens))
                permissive = ok if permissive is None else permissive and ok
        labels |= base
        # a read expression is certain; every place of a phrase halves the doubt
        score = 1.0 if expressions else 1 - 0.5 ** min(n_base + len(labels - base), 50)
        return {"n_words": len(own), "n_base": n_base, "first_word": first, "last_word": last,
                "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": score,
                "expressions": expressions, "permissive": permissive}


SCAN = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "expressions array<string>, permissive boolean")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] = BASE_PHRASES,
         notices: dict[str, str] = NOTICE_PHRASES) -> DataFrame:
    """A row a document: doc_id, n_words, n_base (places of base phrases), first_word and
    last_word (smallest and largest start of those, or null), base_labels and labels (sorted,
    comma-joined; empty: none), score (0 to 1), expressions (read after identifier tags, postfix)
    and permissive (whether all of them can be met with permissive licences; null: none).

    Null and empty texts have no words and no labels; expressions that can't be parsed are
    passed over; rows are scanned one by one, whatever their ids; an empty table gives no row.
    """
    @F.pandas_udf(SCAN)
    def run(text: pd.Series) -> pd.DataFrame:
        scanner = _scanner(base, notices)
        rows = pd.DataFrame([scanner.scan(t) for t in text], columns=[c.split()[0] for c in SCAN.split(", ")])
        return rows.astype({"first_word": "Int64", "last_word": "Int64", "permissive": "boolean"})

    own = pick(docs, doc_id=id_col, text=text_col).withColumn("found", run("text"))
    return own.select("doc_id", "found.*")


_SCANNERS: dict[tuple, Scanner] = {}


def _scanner(base: dict[str, str], notices: dict[str, str]) -> Scanner:
    key = (*sorted(base.items()), None, *sorted(notices.items()))
    if key not in _SCANNERS:
        _SCANNERS[key] = Scanner(base, notices)
    return _SCANNERS[key]
