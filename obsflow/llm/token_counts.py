"""Token counts of the sections of a text, from one encoding of the whole text.

The tokenizer maps every token to the characters it came from. Sections are
intervals of the same characters, so the spans are joined to them by their bounds
(a sorted search). A token across a boundary goes to the section that holds most
of its characters, and to the earlier one of equals. Hence the sections' counts
add up to the count of the whole text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from obsflow.llm.bpe import CHUNK, LONGEST_CACHED, WIDE_SPACE
from obsflow.llm.chunked import tokenizer
from obsflow.llm.common import Bounded, text_batches

CACHED = 300_000


class Spans:
    """Character spans of the tokens of a text."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._known = Bounded(self._encode, CACHED)

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).offsets, "<i4").tobytes()

    def of(self, text: str) -> np.ndarray:
        """One row (start, end) per token, of the whole text."""
        whole = WIDE_SPACE.search(text) or any(a in text for a in self.added)
        chunks = [text] if whole else CHUNK.findall(text)
        known = self._known
        found = [known[c] if len(c) <= LONGEST_CACHED else self._encode(c) for c in chunks]
        spans = np.frombuffer(b"".join(found), "<i4").reshape(-1, 2)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 8
        return spans + np.repeat(np.cumsum(sizes) - sizes, counts)[:, None]


def lines(text: str) -> np.ndarray:
    """Ends of the sections: lines with their line feed; an empty text is one empty section."""
    ends = np.cumsum([len(part) + 1 for part in text.split("\n")])
    ends[-1] -= 1
    return ends if len(ends) == 1 or ends[-1] > ends[-2] else ends[:-1]


def attributed(spans: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of tokens of each section."""
    starts = np.concatenate(([0], ends[:-1]))
    first = np.searchsorted(ends, spans[:, 0], side="right")
    last = np.maximum(np.searchsorted(ends, spans[:, 1] - 1, side="right"), first)
    section = np.minimum(first, len(ends) - 1)
    for i in np.flatnonzero(last > first):
        inside = np.arange(first[i], min(last[i], len(ends) - 1) + 1)
        shared = np.minimum(spans[i, 1], ends[inside]) - np.maximum(spans[i, 0], starts[inside])
        section[i] = inside[np.argmax(shared)]
    return np.bincount(section, minlength=len(ends))


_LOADED: dict[str, Spans] = {}


def section_token_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per section: doc_id, section (from 0), start, end (characters) and n_tokens.

    Sections are the lines of ``text``, each with its line feed. NULL text has no
    section, an empty one a single section without tokens. Repeated rows give
    repeated sections. Columns other than doc_id and text are ignored; no documents:
    no rows.
    """
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(frames):
        spans = _LOADED.get(tokenizer_path) or _LOADED.setdefault(tokenizer_path, Spans(tokenizer_path))
        for part in text_batches(frames):
            part = part[part["text"].notna()]
            bounds = [lines(t) for t in part["text"]]
            n = [len(b) for b in bounds]
            if not n:
                continue
            counts = [attributed(spans.of(t), b) for t, b in zip(part["text"], bounds, strict=True)]
            yield pd.DataFrame({
                "doc_id": part["doc_id"].repeat(n), "section": np.concatenate([np.arange(k) for k in n]),
                "start": np.concatenate([np.concatenate(([0], b[:-1])) for b in bounds]),
                "end": np.concatenate(bounds), "n_tokens": np.concatenate(counts),
            })

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {key}, section int, start long, end long, n_tokens long")
