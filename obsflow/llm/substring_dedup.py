"""Removing repeated passages with suffix automata.

1. A packed exchange of all windows of ``WINDOW`` words tells for each the smallest
   doc_id it starts in. Where that is a smaller one than the document's own the window is
   suspected, where it is the own and others follow it is reference. Runs of
   neighbouring windows with one first document make spans.
2. The reference spans of a first document are turned into a suffix automaton over
   words. It is sent to the spans suspected of repeating that document, in shards of
   bounded size: a passage that a third of all documents repeat is copied to many.
3. Suspected spans are streamed through the automaton for matching statistics (the
   longest match ending at each word). Where a match has ``WINDOW`` words or more, the
   words it covers go: the union is the maximal repeated spans.

The exchange proposes passages by 64-bit hashes of their windows, the automata confirm
them on the words. So nothing is removed that does not repeat; a repeated window whose
hash is also that of another window in a smaller doc_id would stay.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.llm.common import give_back, partitions, plainly_named, text_batches
from obsflow.llm.exchange import flat, pieces, rows_by_bucket, slices, windows_within, word_values
from obsflow.operators.rownum import row_index
from obsflow.scratch import materialise

WINDOW = 50
#: Bytes of a window's hash in the exchange: all of them, since a window is compared with one first document only.
HASH = 8
#: Suspected spans of one first document that meet in one group.
SPANS = 512


class SuffixAutomaton:
    """All substrings of some word sequences; ``length`` and ``link`` by state."""

    def __init__(self):
        self.edges, self.link, self.length = [{}], [-1], [0]

    def add(self, words) -> None:
        edges, link, length = self.edges, self.link, self.length
        last = 0
        for word in words:
            if word in edges[last]:
                old = edges[last][word]
                last = old if length[old] == length[last] + 1 else self._split(last, word, old)
                continue
            new = len(edges)
            edges.append({})
            link.append(0)
            length.append(length[last] + 1)
            state = last
            while state >= 0 and word not in edges[state]:
                edges[state][word] = new
                state = link[state]
            if state >= 0:
                old = edges[state][word]
                link[new] = old if length[old] == length[state] + 1 else self._split(state, word, old)
            last = new

    def _split(self, state: int, word, old: int) -> int:
        edges, link, length = self.edges, self.link, self.length
        copy = len(edges)
        edges.append(dict(edges[old]))
        link.append(link[old])
        length.append(length[state] + 1)
        link[old] = copy
        while state >= 0 and edges[state].get(word) == old:
            edges[state][word] = copy
            state = link[state]
        return copy

    def matches(self, words) -> list[int]:
        """For each word the length of the longest match that ends with it."""
        edges, link, length = self.edges, self.link, self.length
        state, have, out = 0, 0, []
        for word in words:
            while state and word not in edges[state]:
                state = link[state]
                have = length[state]
            following = edges[state].get(word)
            if following is None:
                have = 0
            else:
                state, have = following, have + 1
            out.append(have)
        return out


def covered(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal spans (from, to) covered by matches of at least ``window`` words."""
    spans: list[tuple[int, int]] = []
    for i, n in enumerate(lengths):
        if n >= window:
            start = i + 1 - n
            if spans and start <= spans[-1][1]:
                spans[-1] = (min(spans[-1][0], start), i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def window_runs(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, mark, n_words, sha256, runs): every document once per row of the input.

    ``mark`` is a hash of the text. ``runs``: (start, stop, first) for neighbouring
    window starts whose windows first occur in document ``first`` and in a later one.
    """
    buckets = partitions(docs.sparkSession)

    def ask(frames):
        task = TaskContext.get().partitionId()
        for k, piece in enumerate(pieces(frames)):
            number = task << 24 | k
            words = [t.encode().split() if isinstance(t, str) else [] for t in piece["text"]]
            counts = np.fromiter(map(len, words), np.int64, len(words))
            in_order = np.where(piece["doc_id"].notna(), counts, 0)
            values = word_values(list(chain.from_iterable(words)))
            value, at = windows_within(values, counts, window)
            owner = np.repeat(np.arange(len(words)), np.maximum(counts - window + 1, 0))
            value, at, owner = (x[in_order[owner] > 0] for x in (value, at, owner))
            rows = rows_by_bucket(value, at, buckets, HASH)
            ids = piece["doc_id"].fillna(0).to_numpy(np.int64)
            starts = np.cumsum(counts) - counts
            owned = []
            for _, places, low in rows:
                place = np.cumsum(np.frombuffer(places, f"<u{HASH * len(places) // len(low)}"), dtype=np.int64)
                who = np.searchsorted(starts + counts, place, side="right")
                cut = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
                owned.append((ids[who[cut]].astype("<i8").tobytes(), np.diff(np.append(cut, len(who))).astype("<u4").tobytes()))
            none = [None] * len(rows)
            yield pd.DataFrame({
                "bucket": [b for b, _, _ in rows] + [number % buckets], "piece": number,
                "places": [p for _, p, _ in rows] + [None], "low": [v for _, _, v in rows] + [None],
                "owners": [o for o, _ in owned] + [None], "owned": [n for _, n in owned] + [None],
                "docs": none + [list(zip(piece["doc_id"].astype(object).where(piece["doc_id"].notna(), None), piece["mark"].tolist(), counts.tolist(), map(_digest, words), strict=True))],
            })

    def compare(frames):
        give_back()
        held = [f for f in frames if len(f)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        book = rows[rows["low"].isna()]
        if len(book):
            yield book[["piece", "docs"]].assign(places=None, firsts=None)
        rows = rows[rows["low"].notna()]
        if len(rows) == 0:
            return
        pieces_, (values, places, bounds) = rows["piece"].to_numpy(), flat(rows, HASH)
        owners = np.frombuffer(b"".join(rows["owners"]), "<i8")
        owner = np.repeat(np.arange(len(owners), dtype=np.uint32), np.frombuffer(b"".join(rows["owned"]), "<u4"))
        del rows, held
        give_back()
        for at, order, starts in slices(values):
            ranked = owners[owner[at]][order]
            least, most = np.minimum.reduceat(ranked, starts), np.maximum.reduceat(ranked, starts)
            sizes = np.diff(np.append(starts, len(order)))
            first, repeated = np.empty(len(order), np.int64), np.empty(len(order), bool)
            first[order], repeated[order] = np.repeat(least, sizes), np.repeat(least < most, sizes)
            at, first = at[repeated], first[repeated]
            place = places[at]
            cuts = np.searchsorted(at, bounds)
            some = np.flatnonzero(np.diff(cuts))
            yield pd.DataFrame({
                "piece": pieces_[some], "docs": None,
                "places": pd.Series([place[cuts[k] : cuts[k + 1]].astype("<u4").tobytes() for k in some], dtype=object),
                "firsts": pd.Series([first[cuts[k] : cuts[k + 1]].astype("<i8").tobytes() for k in some], dtype=object),
            })

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        book = frame[frame["places"].isna()].iloc[0]["docs"]
        rows = frame[frame["places"].notna()]
        place = np.frombuffer(b"".join(rows["places"]), "<u4").astype(np.int64)
        first = np.frombuffer(b"".join(rows["firsts"]), "<i8")
        order = np.argsort(place, kind="stable")
        place, first = place[order], first[order]
        counts = np.array([d["n_words"] for d in book], np.int64)
        ends = np.cumsum(counts)
        who = np.searchsorted(ends, place, side="right")
        new = np.concatenate(([True], (place[1:] != place[:-1] + 1) | (first[1:] != first[:-1]) | (who[1:] != who[:-1])))[: len(place)]
        cut = np.flatnonzero(new)
        stop = np.append(cut, len(place))[1:] - 1
        runs: list[list] = [[] for _ in book]
        for a, z in zip(cut, stop, strict=True):
            d = who[a]
            base = ends[d] - counts[d]
            runs[d].append((int(place[a] - base), int(place[z] - base) + 1, int(first[a])))
        return pd.DataFrame({
            "doc_id": pd.Series([d["doc_id"] for d in book], dtype="Int64"), "mark": [d["mark"] for d in book], "n_words": counts,
            "sha256": [d["sha256"] for d in book], "runs": runs,
        })

    doc = "array<struct<doc_id: long, mark: long, n_words: long, sha256: string>>"
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark")).mapInPandas(
        ask, f"bucket int, piece long, places binary, low binary, owners binary, owned binary, docs {doc}"
    )
    told = asked.repartition(buckets, "bucket").mapInPandas(compare, f"piece long, docs {doc}, places binary, firsts binary")
    return told.groupBy("piece").applyInPandas(
        gather, "doc_id long, mark long, n_words long, sha256 string, runs array<struct<start: int, stop: int, first: long>>"
    )


def repeated_spans(with_runs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, mark, start, stop) of removed words, from documents (doc_id, mark, text, runs)."""

    def to_spans(frames):
        for part in text_batches(frames):
            out = []
            for doc_id, mark, text, runs in zip(part["doc_id"], part["mark"], part["text"], part["runs"], strict=True):
                words = text.encode().split()
                for r in runs:
                    span = b" ".join(words[r["start"] : r["stop"] + window - 1])
                    out.append((r["first"], r["first"] == doc_id, doc_id, mark, r["start"], span))
            yield pd.DataFrame(out, columns=["first", "reference", "doc_id", "mark", "start", "span"])

    spans = materialise(
        with_runs.select("doc_id", "mark", "text", "runs").mapInPandas(
            to_spans, "first long, reference boolean, doc_id long, mark long, start int, span binary"
        ), "spans",
    )
    # A first document with many followers is copied to as many groups as they need.
    groups = spans.where("NOT reference").groupBy("first").count().select(
        "first", F.ceil(F.col("count") / SPANS).cast("int").alias("groups")
    )
    shards = 4 * partitions(with_runs.sparkSession)
    dealt = (
        spans.join(groups, "first")
        .withColumn("group", F.explode(F.when(F.col("reference"), F.sequence(F.lit(0), F.col("groups") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("doc_id", "mark", "start"), F.col("groups")).cast("int")))))
        .withColumn("shard", F.pmod(F.xxhash64("first", "group"), F.lit(shards)))
    )

    def match(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in frame.groupby(["first", "group"], sort=False):
            automaton = SuffixAutomaton()
            for span in dict.fromkeys(group["span"][group["reference"]]):
                automaton.add(span.split(b" "))
            known: dict[bytes, list] = {}
            suspects = group[~group["reference"]]
            for doc_id, mark, start, span in zip(suspects["doc_id"], suspects["mark"], suspects["start"], suspects["span"], strict=True):
                if span not in known:
                    known[span] = covered(automaton.matches(span.split(b" ")), window)
                out += [(doc_id, mark, start + a, start + z) for a, z in known[span]]
        return pd.DataFrame(out, columns=["doc_id", "mark", "start", "stop"])

    return dealt.groupBy("shard").applyInPandas(match, "doc_id long, mark long, start int, stop int")


def kept_words(text: str, spans) -> tuple[list[bytes], int]:
    """Words outside the spans, and how many are inside."""
    words = text.encode().split()
    gone = np.zeros(len(words), bool)
    for s in spans if spans is not None else ():
        gone[s["start"] : s["stop"]] = True
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g], int(gone.sum())


def _with_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    some = runs.where("size(runs) > 0").dropDuplicates(["doc_id", "mark"]).select("doc_id", "mark", "runs")
    return text.join(some, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"])


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with ``number``: the doc_id where it is a whole number, else one in the order of the doc_ids."""
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        return docs.withColumn("number", F.col("doc_id").cast("long"))
    numbers = row_index(docs.select("doc_id").where("doc_id IS NOT NULL").distinct(), ["doc_id"], "number")
    return docs.join(numbers.select("doc_id", F.col("number").cast("long").alias("number")), "doc_id", "left")


def dedup_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): one row per document.

    A word goes when a window of ``window`` consecutive words covers it whose words also
    start in a document with a smaller doc_id. Windows are judged on the input. What is
    kept is joined by single spaces for the digest. doc_ids that are no whole numbers are
    compared in their own order.

    NULL and empty texts have no words; NULL doc_ids are neither compared nor changed.
    Rows of one doc_id do not touch each other. Texts of any length are taken whole.
    Other columns are ignored; no documents: no rows.
    """
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        numbered = materialise(_numbered(docs.select("doc_id", "text")), "numbered-documents")
        names = numbered.select("doc_id", "number").where("number IS NOT NULL").distinct()
        report = dedup_report(numbered.select(F.col("number").alias("doc_id"), "text"), window)
        return report.withColumnRenamed("doc_id", "number").join(names, "number", "left").select("doc_id", *report.columns[1:])
    every = materialise(window_runs(docs, window), "window-runs")
    repeated = materialise(_with_runs(docs, every), "repeating-documents")
    spans = repeated_spans(repeated, window).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def shorten(frames):
        for part in text_batches(frames):
            kept = [kept_words(t, s) for t, s in zip(part["text"], part["spans"], strict=True)]
            yield part[["doc_id", "mark"]].assign(removed=[n for _, n in kept], rest=[_digest(w) for w, _ in kept])

    changed = repeated.select("doc_id", "mark", "text").join(spans, ["doc_id", "mark"]).mapInPandas(
        shorten, "doc_id long, mark long, removed long, rest string"
    )
    key = docs.schema["doc_id"].dataType
    return every.join(changed, ["doc_id", "mark"], "left").select(
        F.col("doc_id").cast(key).alias("doc_id"), "n_words", F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("rest", "sha256").alias("kept_sha256"),
    )


def dedup_documents(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with their repeated words removed from ``text``; see dedup_report.

    Texts that lose nothing are unchanged. In others the kept words are joined by single
    spaces; a text that loses all becomes empty. Other columns come back as they are,
    whatever their names.
    """
    plain, given = plainly_named(docs, "doc_id", "text")
    numbered = _numbered(plain)
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        numbered = materialise(numbered, "numbered-documents")
    texts = numbered.select(F.col("number").alias("doc_id"), "text")
    every = materialise(window_runs(texts, window), "window-runs")
    repeated = materialise(_with_runs(texts, every), "repeating-documents")
    spans = repeated_spans(repeated, window).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    spans = spans.withColumnsRenamed({"doc_id": "of_number", "mark": "of_text"})
    place = plain.columns.index("text")

    def shorten(batches):
        for part in batches:  # Arrow, so that the other columns pass as they are
            text, cut = part["text"].to_pylist(), part["spans"].to_pylist()
            text = [t if s is None else b" ".join(kept_words(t, s)[0]).decode() for t, s in zip(text, cut, strict=True)]
            columns = part.columns[:-1]
            columns[place] = pa.array(text, part.schema.field("text").type)
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-1])

    marked = numbered.join(spans, (F.col("number") == F.col("of_number")) & (F.xxhash64("text") == F.col("of_text")), "left")
    return marked.select(*plain.columns, "spans").mapInArrow(shorten, plain.schema).select(*given)
