"""Exchange of hash values in packed arrays.

Comparing every n-gram of a corpus with every other needs each of them at the task
that owns its hash value. As rows that would be a shuffle of many times the input. Here
a map task takes pieces of about ``PIECE`` characters of text and packs their values by
bucket: one row per piece and bucket, with ``width`` bytes per value (where that is five
the bucket fixes further bits) and the value's place in the piece as a difference to the
one before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash

from obsflow.llm.common import give_back, mixed

PIECE = 2 << 20
SLICE = 400_000
#: Counted for a document besides its text, so that a piece has under 2 ** 16 documents.
DOCUMENT = 128
_FACTOR = 0x9E6C63D0876A9A99


def word_values(words: list[bytes]) -> np.ndarray:
    """Scrambled 64-bit values of words; equal words have equal values."""
    return mixed(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))


def window_values(values: np.ndarray, size: int) -> np.ndarray:
    """64-bit values of all windows of ``size`` words; the order of the words matters.

    A polynomial over prefix sums, brought to a common exponent by the inverse powers.
    """
    n = len(values)
    if n < size:
        return np.zeros(0, np.uint64)
    inverse = np.uint64(pow(_FACTOR, -1, 1 << 64))
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, np.uint64(_FACTOR)))), dtype=np.uint64)
        down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - size, inverse))), dtype=np.uint64)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(values * up, dtype=np.uint64)))
        return mixed((sums[size:] - sums[: n - size + 1]) * down + np.uint64(size))


def windows_within(values: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Values and start places of the windows that lie in one document; ``counts``: words of each."""
    starts = np.cumsum(counts) - counts
    full = np.maximum(counts - size + 1, 0)
    at = np.repeat(starts, full) + np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
    return window_values(values, size)[at] if len(at) else np.zeros(0, np.uint64), at


def rows_by_bucket(values: np.ndarray, places: np.ndarray, buckets: int, width: int = 5) -> list[tuple[int, bytes, bytes]]:
    """(bucket, places, values) packed, five, seven or all eight bytes of a value; ``places`` must not decrease."""
    bucket = (values >> np.uint64(40)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    low = np.ascontiguousarray(values[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    places = places[order]
    out = []
    for b in range(buckets):
        a, z = int(cuts[b]), int(cuts[b + 1])
        if z > a:
            steps = np.diff(places[a:z], prepend=0)
            kind = "<u1" if steps.max() < 256 else "<u2" if steps.max() < 65536 else "<u4"
            out.append((b, steps.astype(kind).tobytes(), low[a:z].tobytes()))
    return out


def unpacked(bucket: int, places: bytes, low: bytes, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Values (whole, 56 bits, or 40 bits and the bucket above them) and places of a row."""
    n = len(low) // width
    steps = np.cumsum(np.frombuffer(places, f"<u{len(places) // n}"), dtype=np.int64)
    if width == 8:
        return np.frombuffer(low, "<u8"), steps
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(low, np.uint8).reshape(-1, width)
    values = wide.view("<u8").reshape(-1)
    return values | np.uint64(bucket << 40) if width == 5 else values, steps


def flat(rows: pd.DataFrame, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values and places of all rows (bucket, places, low) in a row, and where each row begins and the last ends."""
    bounds = np.concatenate(([0], np.cumsum(rows["low"].str.len().to_numpy(np.int64) // width)))
    values, places = np.empty(bounds[-1], np.uint64), np.empty(bounds[-1], np.uint32)
    for k, (bucket, steps, low) in enumerate(zip(rows["bucket"], rows["places"], rows["low"], strict=True)):
        values[bounds[k] : bounds[k + 1]], places[bounds[k] : bounds[k + 1]] = unpacked(bucket, steps, low, width)
    return values, places, bounds


def slices(values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Equal values together, a slice of about SLICE values at a time, which bounds what is held.

    Yields the positions in ``values``, the order that sorts the slice, and the starts of
    the groups of equals in that order.
    """
    n = len(values) // SLICE + 1
    kind = (mixed(values) % np.uint64(n)).astype(np.uint16) if n > 1 else np.zeros(len(values), np.uint16)
    for k in range(n):
        at = np.flatnonzero(kind == k)
        if len(at):
            chosen = values[at]
            order = np.argsort(chosen, kind="stable")
            ranked = chosen[order]
            yield at, order, np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))


def pieces(frames):
    """Pandas frames of about PIECE characters of text each, small ones put together."""
    held, size = [], 0
    give_back()  # what earlier stages have left
    for frame in frames:
        lengths = frame["text"].str.len().fillna(0).to_numpy(np.int64) + DOCUMENT
        start = 0
        for i, n in enumerate(lengths):
            size += int(n)
            if size >= PIECE:
                held.append(frame.iloc[start : i + 1])
                yield pd.concat(held, ignore_index=True)
                held, start, size = [], i + 1, 0
                give_back()
        held.append(frame.iloc[start:])
    held = [h for h in held if len(h)]
    if held:
        yield pd.concat(held, ignore_index=True)
