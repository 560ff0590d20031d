"""Byte-level BPE encoding and decoding.

A word's symbols form a doubly linked list; the ranks of all neighbouring pairs
that can merge wait in a heap. The lowest rank is taken, skipped when one of its
two symbols has been merged away since, else merged, and the two new neighbours
are pushed. Decoding concatenates the vocabulary's byte strings.

The vocabulary is a file of the public ``tokenizers`` format, read by each Python
worker. Words repeat, so their ids are remembered in a bounded cache.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from obsflow.llm.chunked import byte_symbols, tokenizer
from obsflow.llm.common import Bounded, text_batches

CACHED_WORDS = 200_000
LONGEST_CACHED = 64

# The pattern by which the byte-level pre-tokenizer cuts text.
# Fixed value: it must equal the tokenizer's.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# White space with the word after it. No piece of PATTERN crosses from a character
# that is not white space to one that is, so these can be encoded one by one.
CHUNK = re.compile(r"\s*\S+|\s+", re.ASCII)
# White space beyond ASCII; a text with any of it is cut by PATTERN as a whole.
WIDE_SPACE = re.compile("[\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000]")
# Up to here Unicode versions agree on what is a letter or a digit; beyond, the
# library's own pre-tokenizer cuts.
AGREED = re.compile("[^\x00-\u024f]")


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
        self.merge = {(a, b): (rank, a + b) for rank, (a, b) in enumerate(pairs)}
        self.id = vocab
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.symbol = byte_symbols()
        byte_of = {s: bytes([b]) for b, s in enumerate(self.symbol)}
        self.table = [b""] * (max([*vocab.values(), *self.added.values()]) + 1)
        for token, i in [*vocab.items(), *self.added.items()]:
            self.table[i] = b"".join(byte_of.get(c, c.encode()) for c in token)
        self._cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self._library = tokenizer(path)
        self._latin = str.maketrans({chr(b): s for b, s in enumerate(self.symbol)})
        self._pieces = Bounded(self._piece, CACHED_WORDS)
        self._chunks = Bounded(self._chunk, CACHED_WORDS)

    def forget(self) -> None:
        """Empty the caches: workers live on after their task, and others need the memory."""
        self._pieces.empty()
        self._chunks.empty()

    def merged(self, symbols: list[str]) -> list[str]:
        """The symbols after all merges, lowest rank first and leftmost among equals."""
        n, merge = len(symbols), self.merge.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, m[1]) for i in range(n - 1) if (m := merge((symbols[i], symbols[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, left, joined = heapq.heappop(heap)
            right = after[left]
            if symbols[left] is None or right >= n:
                continue
            now = merge((symbols[left], symbols[right]))
            if now is None or now[0] != rank:
                continue  # stale: one side has changed
            symbols[left], symbols[right] = joined, None
            after[left] = following = after[right]
            if following < n:
                before[following] = left
                if m := merge((joined, symbols[following])):
                    heapq.heappush(heap, (m[0], left, m[1]))
            if (previous := before[left]) >= 0 and (m := merge((symbols[previous], joined))):
                heapq.heappush(heap, (m[0], previous, m[1]))
        return [s for s in symbols if s is not None]

    def _piece(self, piece: str) -> bytes:
        symbols = self.merged(list(piece.encode().decode("latin-1").translate(self._latin)))
        return np.fromiter((self.id[s] for s in symbols), "<u4", len(symbols)).tobytes()

    def _chunk(self, text: str) -> bytes:
        if AGREED.search(text):
            pieces = [text[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(text)]
        else:
            pieces = PATTERN.findall(text)
        return b"".join(self._pieces[p] if len(p) <= LONGEST_CACHED else self._piece(p) for p in pieces)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self._cut and self._cut.search(text):
            out, at = [], 0
            for found in self._cut.finditer(text):
                out += [self._plain(text[at : found.start()]), np.uint32(self.added[found[0]]).tobytes()]
                at = found.end()
            return b"".join([*out, self._plain(text[at:])])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if not text.isascii() and WIDE_SPACE.search(text):
            return self._chunk(text)
        chunks = CHUNK.findall(text)
        if len(max(chunks, key=len, default="")) > LONGEST_CACHED:
            cached = self._chunks
            return b"".join([cached[c] if len(c) <= LONGEST_CACHED else self._chunk(c) for c in chunks])
        return b"".join(map(self._chunks.__getitem__, chunks))

    def decode(self, ids: bytes) -> str:
        """Text of the ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def bpe_round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The documents with ``bpe_ids`` (binary, little-endian unsigned 32-bit) and ``bpe_decoded``.

    NULL and empty text: no ids and an empty decoded text. Texts of any length are
    encoded whole. Other columns stay; those named like the two new ones are
    replaced. Repeated rows stay repeated; no documents: no rows.
    """
    new = ("bpe_ids", "bpe_decoded")
    kept = docs.drop(*new)
    schema = T.StructType([*kept.schema.fields, T.StructField(new[0], T.BinaryType()), T.StructField(new[1], T.StringType())])

    def run(frames):
        bpe = load(tokenizer_path)
        try:
            for part in text_batches(frames):
                ids = [bpe.encode(t) if isinstance(t, str) else b"" for t in part["text"]]
                decoded = [bpe.decode(i) for i in ids]
                yield part.assign(
                    bpe_ids=pd.Series(ids, index=part.index, dtype=object),
                    bpe_decoded=pd.Series(decoded, index=part.index, dtype=object),
                )
        finally:
            bpe.forget()

    return kept.mapInPandas(run, schema)
