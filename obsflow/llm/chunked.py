"""Encoding by the tokenizers library with each distinct word encoded once per worker.

For the public word-level BPE file: lower case, white space dropped, pieces of letters,
single digits or other characters. Splitting at ASCII white space changes nothing, since
no piece crosses it, NFC never composes across it and the added tokens hold none.
"""

from __future__ import annotations

import os
import struct
import unicodedata
from functools import lru_cache

import numpy as np
import regex

from obsflow.llm.common import Bounded

CACHED_WORDS, CACHED_PIECES = 600_000, 400_000
LONGEST_CACHED = 80
# The pattern that cuts normalised text into pieces. Fixed value: it must equal the tokenizer's.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SIGNS, LAST = ".,;:!?", "\u024f"
# Words with other characters, or with what may be an added token, go to the library whole.
UNUSUAL = regex.compile(f"[^\x21-{LAST}]|<\\|")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 as itself, the others from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


class WordIds:
    """Ids of whole texts from remembered ids of their white-space separated words."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.model = self.tokenizer.model
        self._symbols = str.maketrans(dict(enumerate(byte_symbols())))
        self._words = Bounded(self._word, CACHED_WORDS, LONGEST_CACHED)
        self._pieces = Bounded(self._piece, CACHED_PIECES, LONGEST_CACHED)

    def text(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self._words.__getitem__, text.encode().split()))

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if len(word) <= LONGEST_CACHED:
            # Letters that NFC leaves alone are one piece, and the signs behind them another.
            stem = text.rstrip(SIGNS)
            low = stem.lower()
            if low.isalpha() and (stem.isascii() or stem.isalpha() and max(stem) <= LAST):
                known = self._pieces[low]
                return known if len(stem) == len(text) else known + self._pieces[text[len(stem) :]]
        if UNUSUAL.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(
            self._pieces[p]
            for p in PIECES.findall(unicodedata.normalize("NFC", text).lower())
        )

    def _piece(self, piece: str) -> bytes:
        symbols = piece.encode().decode("latin-1").translate(self._symbols)
        ids = [t.id for t in self.model.tokenize(symbols)]
        return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
