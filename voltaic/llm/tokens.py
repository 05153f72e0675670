"""Token ids of whole texts through the tokenizers library.

A byte-pair tokenizer never merges across the places its pre-tokenizer splits at,
so ids of a text are the ids of its white-space chunks, and those the ids of their
pre-tokens, one after the other.  Both repeat far more often than texts, so each
worker keeps the ids of chunks and pre-tokens, and gives the library's
model those that it doesn't know.  One that comes back is kept for good, one met once for a while, so that the many
that never come back don't drive out those that do; what is kept is bounded in bytes.

Chunks with characters on which Unicode tables might
differ go to the library whole, and so do texts for which the split at white space
isn't known to be exact (white space that libraries class differently, strings of special
tokens) and all texts of tokenizers of another kind.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import regex

#: White space other than the six ASCII characters, and invisible characters that some
#: libraries class as white space and others don't (code points).
_ODD_SPACE = re.compile("[" + "".join(map(chr, (
    0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200E), 0x2028, 0x2029,
    0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF))) + "]")
#: A word with the one space before it; white space up to its last character before a
#: word; other white space.
_SPACED = re.compile(r" ?\S+|\s+(?=\s\S)|\s+")
#: White space in front of a space, after which a chunk need not start at the space.
_BEFORE_SPACE = tuple(f"{c} " for c in " \t\n\x0b\x0c\r")
#: The patterns of the two public kinds of pre-tokenizer.
_SPACED_PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD_PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters (of Latin scripts) whose case, normal form and class are the same in every Unicode version.
_PLAIN = re.compile("[\t-\r -~¡-įı-ɏ]*")

#: Byte-level alphabet: printable bytes stand for themselves, others for code points from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + k) for k, b in enumerate(sorted({*range(256)} - {*_PRINTABLE}))}

#: Punctuation that ends a chunk, a pre-token of its own behind letters.
_ENDS = frozenset(".,;:!?")
#: Bytes of strings kept by a worker, and what one takes beside its characters and ids; strings met once.
CACHE_BYTES = 128 << 20
MOST_YOUNG = 200_000
_EACH = 190


class _Known:
    """Ids of strings: those that came back lately (``ids``, within a number of bytes), and those met once (``young``).
    One for strings as they are, one for those that stand behind a space, without it; the bytes are shared."""

    def __init__(self, most: int, other: "_Known | None" = None):
        self.most, self.ids, self.young = most, {}, {}
        self.all = [self] if other is None else [other, self]
        self.held = 0
        if other is not None:
            other.all = self.all

    def again(self, key: str) -> bytes | None:
        """The ids of a string that was met once; it is kept from now on."""
        ids = self.young.pop(key, None)
        if ids is not None:
            own = _EACH + len(key) + len(ids)
            if sum(k.held for k in self.all) + own > self.most:  # those that come back are soon here again
                for k in self.all:
                    k.ids.clear()
                    k.held = 0
            self.held += own
            self.ids[key] = ids
        return ids

    def learn(self, key: str, ids: bytes) -> None:
        if len(self.young) >= MOST_YOUNG:
            self.young.clear()
        self.young[key] = ids


class ChunkEncoder:
    """ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES, longest: int = 48):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.longest = longest
        bare = _Known(cache_bytes)
        self.known = {"": bare, " ": _Known(cache_bytes, bare)}
        self.split, self.pretokenize, self.lower = self._rules(spec)
        special = [re.escape(t["content"]) for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(special)) if special else None

    @staticmethod
    def _rules(spec: dict):
        """(split of a text into chunks, of a chunk into pre-tokens, whether it is lower-cased); None
        for a tokenizer of another kind."""
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
            return _SPACED.findall, regex.compile(_SPACED_PRETOKENS).findall, False
        parts = pre.get("pretokenizers", [])
        if parts and parts[0].get("type") == "Split" and parts[0].get("behavior") == "Removed" and parts[0].get("invert") \
                and parts[0].get("pattern", {}).get("Regex") == _WORD_PRETOKENS \
                and [p["type"] for p in parts[1:]] == ["ByteLevel"] and not parts[1].get("use_regex") \
                and not parts[1].get("add_prefix_space") \
                and [n["type"] for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            return str.split, regex.compile(_WORD_PRETOKENS).findall, True  # white space is dropped
        return None, None, False

    def _whole(self, text: str) -> bool:
        return self.split is None or _ODD_SPACE.search(text) is not None or (
            self.special is not None and self.special.search(text) is not None)

    def _by_library(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _of_pretoken(self, pretoken: str) -> bytes:
        front = " " if pretoken[0] == " " and len(pretoken) > 1 else ""
        return self._of_letters(front, pretoken[1:] if front else pretoken)

    def _of_letters(self, front: str, key: str) -> bytes:
        """ids of one pre-token, ``front`` and ``key``."""
        known = self.known[front]
        ids = known.ids.get(key) or known.again(key)
        if ids is None:
            mapped = front + key
            if not (mapped.isascii() and mapped.isalnum()):
                mapped = mapped.encode().decode("latin-1").translate(_BYTE_CHARS)
            ids = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
            if len(key) <= self.longest:
                known.learn(key, ids)
        return ids

    def _of_chunk(self, front: str, chunk: str, plain: bool) -> bytes:
        """ids of a chunk that isn't among those kept."""
        known = self.known[front]
        ids = known.again(chunk)
        if ids is not None:
            return ids
        if not plain and not _PLAIN.fullmatch(chunk):
            return self._by_library(front + chunk)
        own = chunk.lower() if self.lower else chunk
        if own.isalpha():  # one run of letters
            ids = self._of_letters(front, own)
            if own is chunk or own == chunk:
                return ids
        elif len(own) > 1 and own[-1] in _ENDS and own[:-1].isalpha():
            ids = self._of_letters(front, own[:-1]) + self._of_letters("", own[-1])
        else:
            ids = b"".join(map(self._of_pretoken, self.pretokenize(front + own)))
        if len(chunk) <= self.longest:
            known.learn(chunk, ids)
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """ids as little-endian unsigned 32-bit integers; none for null or empty text."""
        if not text:
            return np.empty(0, "<u4")
        if self._whole(text):
            return np.frombuffer(self._by_library(text), "<u4")
        plain = _PLAIN.fullmatch(text) is not None
        if self.lower or any(s in text for s in _BEFORE_SPACE):
            return np.frombuffer(b"".join(self._of_chunks("", self.split(text), plain)), "<u4")
        # every space follows a visible character, so that a pre-token starts at each: pieces between
        # spaces are chunks, all but the first with a space in front
        pieces = text.split(" ")
        first = pieces.pop(0)
        own = self._of_chunks(" ", pieces, plain)
        return np.frombuffer(b"".join([*self._of_chunks("", [first], plain), *own] if first else own), "<u4")

    def _of_chunks(self, front: str, chunks: list[str], plain: bool) -> list[bytes]:
        out = list(map(self.known[front].ids.get, chunks))
        if None in out:
            for i in [i for i, ids in enumerate(out) if ids is None]:
                out[i] = self._of_chunk(front, chunks[i], plain)
        return out


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """This Python worker's encoder for the vocabulary file; its threads are Spark's."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
