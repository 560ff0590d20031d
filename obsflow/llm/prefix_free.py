"""Removing repeated strings of bytes with prefix-free parsing.

A place is a trigger when the rolling hash of its next ``TRIGGER`` bytes has ``BITS`` zero
bits at the top. Triggers cut a text into phrases, the same bytes always at the same
places, so repeated text has the same phrases. A string of ``length`` bytes is given by its
first trigger, the end of the phrase before it (the dictionary side) and the phrases that
follow (the parse side), cut to ``length``. What follows is work on triggers, some 16 times
fewer than bytes:

1. Every trigger sends a hash of the bytes that follow it; one that no other trigger of
   the corpus sends is in no repeated string, and most texts are done.
2. The other triggers send their context: the phrase before and what follows, in up to
   three ranges of how much of the phrase belongs to the string (``_ranges``), because a
   longer piece of the phrase needs fewer bytes behind it. Of equal contexts the first
   stays, all strings of the others repeat it.
3. Where contexts differ that follow alike, the first ones of each go to shards. There
   the phrases are sorted by their ends and what follows by its beginnings, each with
   the lengths that neighbours have in common: suffix orders of the dictionary and of
   the parse. Both together order the strings; equal ones are neighbours, and the first
   in the corpus stays.

A string without a trigger near enough to its start goes the way of a context of its
own. Contexts count as equal by two hashes, 104 bits and the bucket; in shards bytes are
compared.

The texts that repeat anything are shuffled once and kept in a table bucketed by
document; the replies come to it.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.llm.common import mixed, partitions, text_batches
from obsflow.llm.exchange import flat, pieces, rows_by_bucket, slices
from obsflow.scratch import materialise, scratch_path

LENGTH = 100
TRIGGER, BITS = 8, 4
#: Contexts of one shard, and those that follow alike above which a group is taken string by string.
SHARD, HOT = 20_000, 2_000
#: Bytes whose hashes are held at a time; a longer document is one stretch.
CHUNK = 1 << 19
_FACTORS = (0x9E6C63D0876A9A99, 0xD1342543DE82EF95)
#: A string without a trigger near its start: its range, and what tells it from others where spans are kept.
_BARE, _BARE_SPAN = 3, 255
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _ranges(length: int) -> tuple[tuple[int, int], ...]:
    """How many bytes of the phrase before belong to a string, in three ranges (from, to)."""
    ends = length // 6, (7 * length) // 20, min((2 * length) // 3, length - TRIGGER)
    return (0, ends[0]), (ends[0] + 1, ends[1]), (ends[1] + 1, ends[2])


@lru_cache(maxsize=2)
def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    factor = np.uint64(_FACTORS[which])
    inverse = np.uint64(pow(_FACTORS[which], -1, 1 << 64))
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, f))), dtype=np.uint64) for f in (factor, inverse))


class Rolling:
    """Hashes of any stretches of some bytes."""

    def __init__(self, raw: np.ndarray, which: int = 0):
        up, self._down = _powers(which, 1 << max(16, len(raw).bit_length()))
        table = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTORS[1 - which]))
        with np.errstate(over="ignore"):
            self._sums = np.concatenate(([np.uint64(0)], np.cumsum(table[raw] * up[: len(raw)], dtype=np.uint64)))

    def plain(self, start: np.ndarray, size) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self._sums[start + size] - self._sums[start]) * self._down[start]

    def __call__(self, start: np.ndarray, size, salt: int = 0) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(self.plain(start, size) + np.asarray(size, np.uint64) * np.uint64(_FACTORS[0]) + np.uint64(salt))

    def triggers(self) -> np.ndarray:
        n = len(self._sums) - 1 - TRIGGER
        if n < 0:
            return np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            h = (self._sums[TRIGGER:] - self._sums[: n + 1]) * self._down[: n + 1]
        return np.flatnonzero(h >> np.uint64(64 - BITS) == 0)


class Parse:
    """The phrases of some documents' bytes, one after the other; ``counts``: bytes of each."""

    def __init__(self, raw: np.ndarray, counts: np.ndarray, length: int):
        self.hash = Rolling(raw)
        ends = np.cumsum(counts)
        t = self.hash.triggers()
        who = np.searchsorted(ends, t, side="right")
        inside = t + TRIGGER <= ends[who] if len(t) else np.zeros(0, bool)
        t, who = t[inside], who[inside]
        same = np.concatenate(([False], who[1:] == who[:-1]))[: len(t)]
        before = np.where(same, np.concatenate(([0], t[:-1]))[: len(t)], (ends - counts)[who] - 1)
        far = _ranges(length)[-1][1]
        #: Strings that have this as their first trigger start from ``low`` to ``high``.
        low, high = np.maximum(before + 1, t - far), np.minimum(t, ends[who] - length)
        # The others start far before a trigger, or behind the last one of their document.
        last = ends - counts - 1
        last[who] = t  # the last one wins
        first = np.concatenate((before + 1, last + 1))
        until = np.concatenate((np.minimum(t - far, ends[who] - length + 1), ends - length + 1))
        some = first < until
        sizes = (until - first)[some]
        self.bare = np.repeat(first[some] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        self.bare.sort()
        some = low <= high
        self.t, self.end, self.low, self.high, self.before = t[some], ends[who][some], low[some], high[some], before[some]
        self.starts, self.ends, self.length = ends - counts, ends, length

    def owner(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, place, side="right")


def _bytes(texts) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    raw = [t.encode() if isinstance(t, str) else b"" for t in texts]
    return raw, np.frombuffer(b"".join(raw), np.uint8), np.fromiter(map(len, raw), np.int64, len(raw))


def _chunks(counts: np.ndarray):
    """(first document, document behind the last, first byte, byte behind the last) of stretches of about CHUNK bytes."""
    ends = np.cumsum(counts)
    cuts = np.concatenate((np.flatnonzero(np.diff(ends // CHUNK)) + 1, [len(counts)]))
    a = 0
    for z in cuts.tolist():
        if z > a:
            yield a, z, int(ends[a] - counts[a]), int(ends[z - 1])
            a = z


def _packed(ascending: np.ndarray) -> bytes:
    """Differences in as few bytes as they need, and that number before them."""
    steps = np.diff(ascending.astype(np.int64), prepend=0)
    width = 1 if steps.max(initial=0) < 1 << 8 else 2 if steps.max() < 1 << 16 else 4
    return bytes([width]) + steps.astype(f"<u{width}").tobytes()


def _steps(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _places(rows) -> np.ndarray:
    """All that was packed, ascending."""
    return np.sort(np.concatenate([np.zeros(0, np.int64), *(np.cumsum(_steps(raw)) for raw in rows)]))


def _cut_by_piece(at: np.ndarray, bounds: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, list]:
    """Rows of an exchange that have any of the entries ``at`` (ascending), and the places of these."""
    cuts = np.searchsorted(at, bounds)
    some = np.flatnonzero(np.diff(cuts))
    place = places[at]
    return some, [_packed(place[cuts[k] : cuts[k + 1]]) for k in some]


def repeating_places(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, mark, n_bytes, sha256, places) of every row; ``places``: triggers and starts that another one may repeat."""
    buckets = partitions(docs.sparkSession)
    first = length - _ranges(length)[-1][1]

    def ask(frames):
        task = TaskContext.get().partitionId()
        for k, piece in enumerate(pieces(frames)):
            number = task << 24 | k
            texts, raw, counts = _bytes(piece["text"])
            known, found = piece["doc_id"].notna().to_numpy(), []
            for a, z, low, high in _chunks(counts):
                parse = Parse(raw[low:high], counts[a:z], length)
                place = np.concatenate((parse.t, parse.bare))
                value = np.concatenate((parse.hash(parse.t, first), parse.hash(parse.bare, length, 1)))
                order = np.argsort(place, kind="stable")
                order = order[known[a + parse.owner(place[order])]]
                found.append((value[order], place[order] + low))
            rows = rows_by_bucket(*(np.concatenate(x) for x in zip(*found, strict=True)), buckets)
            ids = piece["doc_id"].astype(object).where(piece["doc_id"].notna(), None)
            book = list(zip(ids, piece["mark"].tolist(), counts.tolist(), (hashlib.sha256(t).hexdigest() for t in texts), strict=True))
            none = [None] * len(rows)
            yield pd.DataFrame({
                "bucket": [b for b, _, _ in rows] + [number % buckets], "piece": number,
                "places": [p for _, p, _ in rows] + [None], "low": [v for _, _, v in rows] + [None], "docs": none + [book],
            })

    def compare(frames):
        held = [f for f in frames if len(f)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        book = rows[rows["low"].isna()]
        if len(book):
            yield book[["piece", "docs"]].assign(places=None)
        rows = rows[rows["low"].notna()]
        if len(rows) == 0:
            return
        numbers, (values, places, bounds) = rows["piece"].to_numpy(), flat(rows)
        del rows, held
        for at, order, starts in slices(values):
            sizes = np.diff(np.append(starts, len(order)))
            repeated = np.empty(len(order), bool)
            repeated[order] = np.repeat(sizes > 1, sizes)
            some, found = _cut_by_piece(at[repeated], bounds, places)
            yield pd.DataFrame({"piece": numbers[some], "docs": None, "places": pd.Series(found, dtype=object)})

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        book = frame[frame["places"].isna()].iloc[0]["docs"]
        place = _places(frame["places"][frame["places"].notna()])
        counts = np.array([d["n_bytes"] for d in book], np.int64)
        ends = np.cumsum(counts)
        cuts = np.concatenate(([0], np.searchsorted(place, ends)))
        own = [_packed(place[a:z] - s) if z > a else None for a, z, s in zip(cuts, cuts[1:], ends - counts)]
        return pd.DataFrame({
            "doc_id": pd.Series([d["doc_id"] for d in book], dtype="Int64"), "mark": [d["mark"] for d in book],
            "n_bytes": counts, "sha256": [d["sha256"] for d in book], "places": pd.Series(own, dtype=object),
        })

    doc = "array<struct<doc_id: long, mark: long, n_bytes: long, sha256: string>>"
    asked = docs.mapInPandas(ask, f"bucket int, piece long, places binary, low binary, docs {doc}")
    told = asked.repartition(buckets, "bucket").mapInPandas(compare, f"piece long, docs {doc}, places binary")
    return told.groupBy("piece").applyInPandas(gather, "doc_id long, mark long, n_bytes long, sha256 string, places binary")


def _contexts(parse: Parse, places: np.ndarray, raw: np.ndarray) -> dict[str, np.ndarray]:
    """Contexts of the triggers and strings at ``places``: start of the first and last string, trigger, range, two hashes."""
    length, second = parse.length, Rolling(raw, 1)
    chosen = np.flatnonzero(np.isin(parse.t, places))
    out = []
    for level, (least, most) in enumerate(_ranges(length)):
        t, end = parse.t[chosen], parse.end[chosen]
        low, high = np.maximum(parse.low[chosen], t - most), np.minimum(parse.high[chosen], t - least)
        some = low <= high
        t, end, low, high = t[some], end[some], low[some], high[some]
        stop = np.minimum(t + length - least, end)
        out.append((low, high, t, np.full(len(t), level), parse.hash(t, length - most, 2 + level), second(low, stop - low, 1) + mixed(t - low)))
    p = parse.bare[np.isin(parse.bare, places)]
    out.append((p, p, p, np.full(len(p), _BARE), parse.hash(p, length, 1), second(p, length)))
    columns = [np.concatenate(x) for x in zip(*out, strict=True)]
    order = np.lexsort((columns[3], columns[0]))
    return dict(zip(("low", "high", "t", "level", "key", "context"), (c[order] for c in columns), strict=True))


def merged(low: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    """The union of ranges of bytes as maximal runs."""
    if len(low) == 0:
        return []
    order = np.argsort(low, kind="stable")
    low, stop = low[order], np.maximum.accumulate(stop[order])
    new = np.flatnonzero(np.concatenate(([True], low[1:] > stop[:-1])))
    return list(zip(low[new].tolist(), stop[np.append(new[1:], len(low)) - 1].tolist(), strict=True))


def repeated_contexts(repeating: DataFrame, length: int) -> DataFrame:
    """(doc_id, mark, runs, open): bytes whose context repeats an earlier one, and contexts that shards are to look at.

    ``runs``: (start, stop). ``open``: (t, least, most), the strings that begin ``least`` to
    ``most`` bytes before the trigger.
    """
    buckets = partitions(repeating.sparkSession)

    def ask(frames):
        task = TaskContext.get().partitionId()
        for k, piece in enumerate(pieces(frames)):
            number = task << 24 | k
            _, raw, counts = _bytes(piece["text"])
            parts = []
            for a, z, low, high in _chunks(counts):
                parse = Parse(raw[low:high], counts[a:z], length)
                here = [np.cumsum(_steps(p)) + s for p, s in zip(piece["places"].iloc[a:z], parse.starts, strict=True)]
                part = _contexts(parse, np.concatenate(here), raw[low:high])
                part["who"] = a + parse.owner(part["low"])
                for c in ("low", "high", "t"):
                    part[c] = part[c] - parse.starts[part["who"] - a]  # from the document's start
                parts.append(part)
            found = {c: np.concatenate([x[c] for x in parts]) for c in parts[0]}
            who = found["who"]
            rows = rows_by_bucket(found["key"], np.arange(len(who)), buckets)
            ids = piece["doc_id"].to_numpy(np.int64)
            more = []
            for _, places, low in rows:
                place = np.cumsum(np.frombuffer(places, f"<u{5 * len(places) // len(low)}"), dtype=np.int64)
                cut = np.flatnonzero(np.concatenate(([True], who[place][1:] != who[place][:-1])))
                more.append((
                    found["context"][place].astype("<u8").tobytes(), ids[who[place][cut]].astype("<i8").tobytes(),
                    np.diff(np.append(cut, len(place))).astype("<u4").tobytes(),
                ))
            none = [None] * len(rows)
            new = np.concatenate(([True], who[1:] != who[:-1]))[: len(who)]
            step = np.where(new, found["low"], np.diff(found["low"], prepend=0))
            width = 2 if step.max(initial=0) < 1 << 16 else 4
            span = np.where(found["level"] == _BARE, _BARE_SPAN, found["high"] - found["low"])
            yield pd.DataFrame({
                "bucket": [b for b, _, _ in rows] + [number % buckets], "piece": number,
                "places": [p for _, p, _ in rows] + [None], "low": [v for _, _, v in rows] + [None],
                "context": [c for c, _, _ in more] + [None], "owners": [o for _, o, _ in more] + [None], "owned": [n for _, _, n in more] + [None],
                "docs": none + [list(zip(ids.tolist(), piece["mark"].tolist(), np.bincount(who, minlength=len(ids)).tolist(), strict=True))],
                "first": none + [bytes([width]) + step.astype(f"<u{width}").tobytes()],
                "span": none + [span.astype("<u1").tobytes()], "back": none + [(found["t"] - found["high"]).astype("<u1").tobytes()],
            })

    kept = ["piece", "docs", "first", "span", "back"]

    def compare(frames):
        held = [f for f in frames if len(f)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        book = rows[rows["low"].isna()]
        if len(book):
            yield book[kept].assign(repeats=None, asks=None)
        rows = rows[rows["low"].notna()]
        if len(rows) == 0:
            return
        numbers, (values, places, bounds) = rows["piece"].to_numpy(), flat(rows)
        contexts = np.frombuffer(b"".join(rows["context"]), "<u8")
        ids = np.frombuffer(b"".join(rows["owners"]), "<i8")
        owner = np.repeat(np.arange(len(ids), dtype=np.uint32), np.frombuffer(b"".join(rows["owned"]), "<u4"))
        del rows, held
        for at, _, _ in slices(values):
            key, context, who = values[at], contexts[at], owner[at]
            order = np.lexsort((places[at], who, ids[who], context, key))
            key, context, who = key[order], context[order], who[order]
            new_key = np.concatenate(([True], key[1:] != key[:-1]))
            new = new_key | np.concatenate(([True], context[1:] != context[:-1]))
            least = ids[who][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
            first = (ids[who] == least) & (new | np.concatenate(([True], who[1:] != who[:-1])))
            starts = np.flatnonzero(new_key)
            kinds = np.repeat(np.add.reduceat(new, starts), np.diff(np.append(starts, len(new))))
            for name, chosen in (("repeats", ~first), ("asks", first & (kinds > 1))):
                some, found = _cut_by_piece(np.sort(at[order[chosen]]), bounds, places)
                other = "asks" if name == "repeats" else "repeats"
                yield pd.DataFrame({"piece": numbers[some], name: pd.Series(found, dtype=object), other: None, **dict.fromkeys(kept[1:])})

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        book = frame[frame["docs"].notna()].iloc[0]
        step, span, back = _steps(book["first"]), *(np.frombuffer(book[c], "<u1").astype(np.int64) for c in ("span", "back"))
        counts = np.array([d["contexts"] for d in book["docs"]], np.int64)
        ends, total = np.cumsum(counts), np.concatenate(([0], np.cumsum(step)))
        first = total[1:] - np.repeat(total[ends - counts], counts)
        bare = span == _BARE_SPAN
        span = np.where(bare, 0, span)
        place = {c: _places(frame[c][frame[c].notna()]) for c in ("repeats", "asks")}
        place["asks"] = place["asks"][~bare[place["asks"]]]
        cuts = {c: np.concatenate(([0], np.searchsorted(p, ends))) for c, p in place.items()}
        out = []
        for k, d in enumerate(book["docs"]):
            gone, asked = (place[c][cuts[c][k] : cuts[c][k + 1]] for c in ("repeats", "asks"))
            if len(gone) or len(asked):
                runs = merged(first[gone], first[gone] + span[gone] + length)
                triggers = first[asked] + span[asked] + back[asked]
                out.append((d["doc_id"], d["mark"], runs, list(zip(triggers.tolist(), back[asked].tolist(), (back + span)[asked].tolist(), strict=True))))
        return pd.DataFrame(out, columns=["doc_id", "mark", "runs", "open"])

    doc = "docs array<struct<doc_id: long, mark: long, contexts: int>>, first binary, span binary, back binary"
    asked = repeating.mapInPandas(
        ask, f"bucket int, piece long, places binary, low binary, context binary, owners binary, owned binary, {doc}"
    )
    told = asked.repartition(buckets, "bucket").mapInPandas(compare, f"piece long, {doc}, repeats binary, asks binary")
    return told.groupBy("piece").applyInPandas(
        gather, "doc_id long, mark long, runs array<struct<start: int, stop: int>>, open array<struct<t: int, least: int, most: int>>"
    )


def _sorted_with_common(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each row of bytes (``sizes`` of them count), and in that order the bytes each has in common with the one before."""
    width = rows.shape[1]
    padded = np.ascontiguousarray(np.where(np.arange(width) < sizes[:, None], rows.astype(np.uint16) + 1, 0).astype(">u2"))
    order = np.argsort(padded.view(f"V{2 * width}").reshape(-1), kind="stable") if width else np.arange(len(rows))
    ranked = padded[order]
    differ = ranked[1:] != ranked[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width) if width else np.zeros(len(rows) - 1, np.int64)
    rank = np.empty(len(rows), np.int64)
    rank[order] = np.arange(len(rows))
    return rank, np.concatenate(([-1], common))


def repeated_strings(before: list[bytes], behind: list[bytes], least, most, doc, row, t, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, bytes before the trigger) of all strings that occur earlier among the contexts.

    ``before`` ends at the trigger, ``behind`` begins there; ``doc`` orders documents and
    ``row`` tells rows of one id apart.
    """
    most, left = np.asarray(most), np.fromiter(map(len, before), np.int64, len(before))
    right = np.fromiter(map(len, behind), np.int64, len(behind))
    fill = lambda parts, n, side: np.frombuffer(b"".join(getattr(p, side)(n, b"\0") for p in parts), np.uint8).reshape(len(parts), n)
    # Dictionary: phrases by their ends. Parse: what follows by its beginnings.
    phrase_rank, phrase_common = _sorted_with_common(fill(before, int(left.max(initial=0)), "rjust")[:, ::-1], left)
    parse_rank, parse_common = _sorted_with_common(fill(behind, int(right.max(initial=0)), "ljust"), right)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for a in range(int(np.min(least)), int(most.max()) + 1):
        has = np.flatnonzero((least <= a) & (most >= a) & (right >= length - a))
        if len(has) < 2:
            continue
        phrase = np.cumsum(phrase_common < a)[phrase_rank[has]]
        parse = np.cumsum(parse_common < length - a)[parse_rank[has]]
        order = np.lexsort((t[has], row[has], doc[has], parse, phrase))
        has, phrase, parse = has[order], phrase[order], parse[order]
        new = np.concatenate(([True], (phrase[1:] != phrase[:-1]) | (parse[1:] != parse[:-1])))
        smallest = doc[has][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        again = np.concatenate(([False], (row[has][1:] == row[has][:-1]) & (doc[has][1:] == doc[has][:-1])))
        gone = has[(doc[has] != smallest) | ~new & again]
        found.append((gone, np.full(len(gone), a)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _compared(opened: DataFrame, length: int) -> DataFrame:
    """(doc_id, mark, start, stop) of the strings among open contexts that occur earlier."""
    spark = opened.sparkSession
    out = "doc_id long, mark long, start int, stop int"
    shards = max(partitions(spark), -(-opened.count() // SHARD))
    hot = opened.groupBy("key").count().where(F.col("count") > HOT).select("key", F.lit(True).alias("hot"))
    marked = materialise(opened.join(hot, "key", "left"), "open-contexts-marked")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        column = {c: frame[c].to_numpy(np.int64) for c in ("least", "most", "doc_id", "mark", "t")}
        where, a = repeated_strings(
            frame["before"].tolist(), frame["behind"].tolist(), column["least"], column["most"], column["doc_id"], column["mark"], column["t"], length
        )
        start = column["t"][where] - a
        return pd.DataFrame({"doc_id": column["doc_id"][where], "mark": column["mark"][where], "start": start, "stop": start + length})

    few = (
        marked.where("hot IS NULL").withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
        .groupBy("shard").applyInPandas(compare, out)
    )

    # Too many different contexts follow alike for one task: string by string, by two hashes.
    def strings(frames):
        for frame in frames:
            rows = []
            for doc_id, mark, t, least, most, before, behind in frame[["doc_id", "mark", "t", "least", "most", "before", "behind"]].itertuples(index=False):
                for a in range(least, most + 1):
                    text = before[len(before) - a :] + behind[: length - a]
                    if len(text) == length:
                        h = xxhash.xxh3_128_intdigest(text)
                        rows.append((doc_id, mark, t - a, (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)))
            yield pd.DataFrame(rows, columns=["doc_id", "mark", "start", "h1", "h2"])

    many = marked.where("hot").mapInPandas(strings, "doc_id long, mark long, start int, h1 long, h2 long")
    own = many.groupBy("h1", "h2", "doc_id", "mark").agg(F.min("start").alias("earliest"), F.collect_set("start").alias("starts"))
    own = materialise(own, "hot-strings")
    least_doc = own.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"))
    again = own.join(least_doc, ["h1", "h2"]).select("doc_id", "mark", "least", "earliest", F.explode("starts").alias("start"))
    again = again.where("doc_id > least OR start > earliest").select("doc_id", "mark", "start", (F.col("start") + length).alias("stop"))
    return few.union(again)


def dedup_bytes(docs: DataFrame, length: int = LENGTH, *, keep: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans): one row per document.

    A byte of the UTF-8 text goes when a string of ``length`` bytes covers it that also
    starts earlier: in a document of a smaller doc_id, or at an earlier place of the same
    one. Strings are judged on the input, overlaps count. ``spans`` are the maximal
    removed runs (start, stop) in bytes; the digest is that of the bytes left. With
    ``keep`` these come too, as ``kept`` (binary, because a cut can split a character).

    doc_id must be an integer column. A NULL text counts as empty. A row without doc_id is
    compared with nothing and left whole. Rows of one doc_id do not touch each other.
    Texts of any length are taken whole, one at a time. Other columns are ignored, whatever
    their names; no documents: no rows.
    """
    if not isinstance(docs.schema["doc_id"].dataType, _INTEGERS):
        raise ValueError("doc_id must be an integer column")
    if not 3 * TRIGGER <= length < 3 * _BARE_SPAN // 2:
        raise ValueError(f"length must be from {3 * TRIGGER} to {3 * _BARE_SPAN // 2 - 1}")
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    every = materialise(repeating_places(texts, length), "bytes-places")
    some = every.where("places IS NOT NULL").dropDuplicates(["doc_id", "mark"]).select("doc_id", "mark", "places")
    name = f"repeating_{uuid.uuid4().hex}"
    (
        texts.join(some, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"])
        .write.format("parquet").option("path", scratch_path(spark, "bytes-repeating"))
        .bucketBy(partitions(spark), "doc_id", "mark").saveAsTable(name)
    )
    try:
        repeating = spark.table(name)
        found = materialise(repeated_contexts(repeating, length), "bytes-contexts")

        def to_open(frames):
            for part in text_batches(frames):
                rows = []
                for doc_id, mark, text, open_ in zip(part["doc_id"], part["mark"], part["text"], part["open"], strict=True):
                    raw = text.encode()
                    for c in open_:
                        t, least, most = c["t"], c["least"], c["most"]
                        level, far = next((k, x[1]) for k, x in enumerate(_ranges(length)) if x[0] <= least <= x[1])
                        key = xxhash.xxh3_64_intdigest(raw[t : t + length - far], seed=level) - (1 << 63)
                        rows.append((key, doc_id, mark, t, least, most, raw[t - most : t], raw[t : t + length - least]))
                yield pd.DataFrame(rows, columns=["key", "doc_id", "mark", "t", "least", "most", "before", "behind"])

        opened = repeating.select("doc_id", "mark", "text").join(found.where("size(open) > 0").select("doc_id", "mark", "open"), ["doc_id", "mark"])
        opened = materialise(opened.mapInPandas(
            to_open, "key long, doc_id long, mark long, t int, least int, most int, before binary, behind binary"
        ), "bytes-open")
        runs = found.select("doc_id", "mark", F.explode("runs").alias("r")).select("doc_id", "mark", "r.start", "r.stop")
        gone = runs.union(_compared(opened, length)).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))

        def shorten(frames):
            for part in text_batches(frames):
                rows = []
                for doc_id, mark, text, runs in zip(part["doc_id"], part["mark"], part["text"], part["runs"], strict=True):
                    spans = merged(np.array([r["start"] for r in runs]), np.array([r["stop"] for r in runs]))
                    raw, at, rest = text.encode(), 0, []
                    for a, z in spans:
                        rest.append(raw[at:a])
                        at = z
                    left = b"".join([*rest, raw[at:]])
                    rows.append((doc_id, mark, len(raw) - len(left), hashlib.sha256(left).hexdigest(), spans, left if keep else None))
                yield pd.DataFrame(rows, columns=["doc_id", "mark", "removed", "digest", "spans", "kept"])

        spans = "array<struct<start: int, stop: int>>"
        changed = materialise(repeating.select("doc_id", "mark", "text").join(gone, ["doc_id", "mark"]).mapInPandas(
            shorten, f"doc_id long, mark long, removed long, digest string, spans {spans}, kept binary"
        ), "bytes-changed")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # from the catalogue; the files are scratch
    joined = every.select("doc_id", "mark", "n_bytes", "sha256").join(changed, ["doc_id", "mark"], "left")
    whole = joined.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_bytes", F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), F.coalesce("digest", "sha256").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast(spans)).alias("spans"), "mark", "kept",
    )
    if not keep:
        return whole.drop("mark", "kept")
    text = texts.select(F.col("doc_id").alias("id"), "mark", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("whole")).dropDuplicates(["id", "mark"])
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("id")) & (whole["mark"] == text["mark"])
    return whole.join(text, same).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", F.coalesce("kept", "whole").alias("kept"))
