"""Exact, cached encoding of whole texts with the tokenizers library (inside Python tasks).

A byte-level BPE never merges across pre-tokens, and between a non-space and a
following single space or line break there is always a pre-token boundary.  So the ids of a
text are the ids of its space-separated pieces in order, and each distinct piece is encoded
by the library once and remembered in a bounded cache (two generations; the older one
is dropped when the newer is full).  Texts with any other white space, runs of white space
or a special token's string are encoded whole.
"""

from __future__ import annotations

import re
import struct

import numpy as np

from tillpoint.llm.common import single_threaded_tokenizers

CACHE_PIECES = 1_000_000
#: Letters, then full stops and commas: two pre-tokens at most (a space goes with the letters).
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ſ]+)([.,]*)")
#: White space other than a space and a line break.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_OTHER_ASCII_SPACE = [c for c in _OTHER_SPACE if c.isascii()]


def _piecewise(text: str) -> bool:
    """True if every white space is one space or line break between other characters, and no
    special token's string can be in the text."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or "<|" in text:
        return False
    if text[0].isspace() or text[-1].isspace():
        return False
    return not any(map(text.__contains__, _OTHER_ASCII_SPACE if text.isascii() else _OTHER_SPACE))


class _Pieces(dict):
    """piece -> little-endian ids.  A piece stands for a space and its text, or if it begins
    with a line break, for that break and the text after it."""

    def __init__(self, tokenizer, dtype):
        super().__init__()
        self.t, self.old = tokenizer, {}
        self.model = tokenizer.model
        self.code = "H" if dtype.itemsize == 2 else "I"
        self.pack = [struct.Struct(f"<{n}{self.code}").pack for n in range(64)]
        self.chars: dict[str, str] = {}
        self.marks: dict[str, bytes] = {}
        self.space = self.char(" ")

    def ids(self, text: str) -> bytes:
        return self.packed(self.t.encode(text, add_special_tokens=False).ids)

    def packed(self, ids: list[int]) -> bytes:
        n = len(ids)
        return self.pack[n](*ids) if n < len(self.pack) else struct.pack(f"<{n}{self.code}", *ids)

    def char(self, c: str) -> str:
        """A character in the model's byte alphabet (ASCII letters are themselves)."""
        if c not in self.chars:
            self.chars[c] = self.t.pre_tokenizer.pre_tokenize_str(c)[0][0]
        return self.chars[c]

    def word(self, letters: str, space: bool) -> bytes:
        """One pre-token of letters, in the model's byte alphabet."""
        if not letters.isascii():
            letters = "".join(map(self.char, letters))
        got = self.model.tokenize(self.space + letters if space else letters)
        return self.packed([x.id for x in got])

    def encode(self, piece: str, space: bool) -> bytes:
        if piece.isascii() and piece.isalpha():
            return self.word(piece, space)
        m = _PLAIN.fullmatch(piece)
        if not m:
            return self.ids(" " + piece if space else piece)
        letters, marks = m.groups()
        if not marks:
            return self.word(letters, space)
        if marks not in self.marks:
            self.marks[marks] = self.ids(marks)
        return (self[letters] if space else self.word(letters, False)) + self.marks[marks]

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES:
            self.old = dict(self)
            self.clear()
        out = self.old.get(piece)
        if out is None:
            if piece[:1] == "\n":
                if "\n" not in self.marks:
                    self.marks["\n"] = self.ids("\n")
                out = self.marks["\n"] + (self.encode(piece[1:], False) if len(piece) > 1 else b"")
            else:
                out = self.encode(piece, True)
        self[piece] = out
        return out


class Encoder:
    def __init__(self, path: str):
        single_threaded_tokenizers()
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.t.get_vocab_size() <= 65_536 else np.dtype("<u4")
        self.pieces = _Pieces(self.t, self.dtype)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text, without special tokens added."""
        if not text:
            return np.zeros(0, self.dtype)
        if not _piecewise(text):
            return np.frombuffer(self.pieces.ids(text), self.dtype)
        parts = text.replace("\n", " \n").split(" ")
        head, parts = self.pieces.encode(parts[0], False), parts[1:]
        return np.frombuffer(head + b"".join(map(self.pieces.__getitem__, parts)), self.dtype)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder, and so one cache, per Python worker and tokenizer."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
