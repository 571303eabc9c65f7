"""Exact token ids of many texts: the tokenizers library's, each distinct piece once.

The library cuts a text into pieces by a pattern and merges inside each piece alone, so
equal pieces have equal ids.  For texts made of plain Latin letters, digits, marks, blanks
and line ends, where the pattern's character classes do not depend on a Unicode version,
the pieces are cut here, looked up in a per-process table, and only new pieces go to the
library.  Any other text (also one that holds a special token's string) goes to the library
whole.  Tests compare both paths.
"""

from __future__ import annotations

import json

import re
from array import array

import numpy as np
from tokenizers import Tokenizer

PIECE_CACHE = 500_000      # pieces kept per process, those used last
LONG_PIECE = 64            # longer pieces are encoded but not kept

#: Characters whose classes are the same in every Unicode version, and these classes.
_UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e¡-¬®-įı-ňŊ-ž]")
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ž", "0-9²³¹¼-¾"

# The two files' cutting patterns, on those characters.
PATTERNS = {
    "byte_level": rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+",
    "lower_words": rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+",
}

_LOADED: dict[str, "Pieces"] = {}


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte: itself where
    printable in Latin-1, else the next free letter from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


def load(path: str, keep: int = PIECE_CACHE) -> "Pieces":
    """The encoder of a tokenizer file, one per process; it keeps about ``keep`` pieces."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    _LOADED[path].keep = keep
    return _LOADED[path]


class _Table(dict):
    """Ids of pieces; a piece that is not there is asked for."""

    def __init__(self, ask):
        self.ask = ask

    def __missing__(self, piece: str) -> bytes:
        return self.ask(piece)


class Pieces:
    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"].lower() for t in spec["added_tokens"]]
        self.lower = bool(spec["normalizer"])
        self.cut = re.compile(PATTERNS["lower_words" if self.lower else "byte_level"]).findall
        self.letters = dict(enumerate(byte_letters()))
        self.merge = self.library.model.tokenize
        self.keep = PIECE_CACHE
        self.known = _Table(self._learn)         # pieces of this generation
        self.older: dict[str, bytes] = {}        # and of the one before

    def pieces(self, text: str) -> list[str] | None:
        """The text's pieces, or None where only the library cuts surely."""
        if _UNUSUAL.search(text):
            return None
        low = text.lower()
        if any(s in low for s in self.specials):
            return None
        return self.cut(low if self.lower else text)

    def _learn(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            letters = piece.encode("utf-8").decode("latin-1").translate(self.letters)
            ids = array("I", [t.id for t in self.merge(letters)]).tobytes()
        if len(piece) <= LONG_PIECE:
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Token ids (little-endian uint32), as the library's encode without added tokens."""
        pieces = self.pieces(text)
        if pieces is None:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")
        if len(self.known) > self.keep // 2:
            self.known, self.older = _Table(self._learn), self.known
        return np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), dtype="<u4")

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encode(t) for t in texts]
