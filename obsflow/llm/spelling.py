"""Grouping of spelling variants with an index of variable-length grams.

1. Words are counted over all texts.
2. The gram dictionary is pruned by frequency: a gram is extended by a letter only where
   it occurs in more than a share ``COMMON`` of the words, up to ``LONGEST`` letters. It is
   therefore given by its common prefixes alone.
3. A word is decomposed from left to right: at each place the longest gram of the
   dictionary, left out where an earlier one covers it.
4. For each place of one edit the grams are counted that it can affect: those that cover
   the place, and those behind it that a longer gram across the place could cover. The
   word's bound is the number of its grams less the largest such count: as many grams, at
   least, it shares with every word one edit away.
5. Lists are merged by that bound: words that share ``n`` grams share ``t`` of the rarest
   ``length - n + t`` ones, so they meet under a key of ``t`` grams together. ``TOGETHER``
   are taken, fewer among words whose bounds are lower.
6. What meets is verified: lengths, letters, edit distance.

A word of at least ``2 * LONGEST`` letters has a bound of one or more, because no edit
reaches its first and its last gram: nothing falls outside the index.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import LOWER, UPPER, text_batches
from obsflow.scratch import materialise

RUN = "[A-Za-zÀ-ÿ]"
SHORTEST_GRAM, LONGEST = 2, 3
COMMON = 0.01
TOGETHER = 3
#: Distinct words a task counts before it hands the counts on.
COUNTED = 200_000


def occurrences(docs: DataFrame, shortest: int, damage: int | None) -> DataFrame:
    """(word, n) of all texts, A-Z lower-cased.

    With ``damage`` a run loses one letter where ``damage`` divides the crc32 h of
    "<doc_id>:<run>": the one at h modulo its length.
    """
    runs = re.compile(f"{RUN}{{{shortest},}}")
    lower = str.maketrans(UPPER, LOWER)

    def count(frames):
        total: Counter = Counter()
        for part in text_batches(frames):
            for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                found = Counter(runs.findall(text)) if isinstance(text, str) else {}
                start = zlib.crc32(f"{doc_id}:".encode())
                for word, n in found.items():
                    word = word.translate(lower)
                    h = zlib.crc32(word.encode(), start) if damage else 0
                    if damage and h % damage == 0:
                        word = word[: h % len(word)] + word[h % len(word) + 1 :]
                    if len(word) >= shortest:
                        total[word] += n
            if len(total) >= COUNTED:
                yield pd.DataFrame({"word": list(total), "n": list(total.values())})
                total.clear()
        yield pd.DataFrame({"word": pd.Series(list(total), dtype=object), "n": pd.Series(list(total.values()), dtype="int64")})

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return texts.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def spans(word: str, common: frozenset | dict) -> list[tuple[int, int]]:
    """The grams of a word as (from, to)."""
    out, end = [], 0
    for p in range(len(word) - SHORTEST_GRAM + 1):
        to = p + SHORTEST_GRAM
        while to - p < LONGEST and to < len(word) and word[p:to] in common:
            to += 1
        if to > end:
            out.append((p, to))
            end = to
    return out


def endings(common) -> frozenset:
    """What a common prefix can end with, after at least one letter."""
    return frozenset(g[k:] for g in common for k in range(1, len(g)))


def bound(word: str, grams: list[tuple[int, int]], common, ends) -> int:
    """Grams that the word shares, at least, with any word that one edit makes of it."""
    at, before = [0] * len(word), [0] * (len(word) + 1)  # edits of a letter, insertions before one
    for a, b in grams:
        for i in range(a, b):
            at[i] += 1
        for i in range(a + 1, b):
            before[i] += 1
        for i in range(max(0, b - LONGEST), a):
            at[i] += word[i + 1 : b - 1] in ends
        for i in range(max(0, b - LONGEST + 1), a + 1):
            before[i] += word[i : b - 1] in ends
    before[-1] += word[grams[-1][0] :] in common  # a letter at the end can lengthen the last gram
    return len(grams) - max(max(at), max(before))


def keys(word: str, frequency: dict, common, ends) -> list[bytes]:
    """Keys under which the word meets every word one edit away; each is ``t`` of its grams."""
    grams = spans(word, common)
    least = bound(word, grams, common, ends)
    seen: Counter = Counter()
    items = []
    for a, b in grams:
        gram = word[a:b]
        items.append((frequency.get(gram, 0), gram, seen[gram]))
        seen[gram] += 1
    items.sort()
    out = []
    for t in range(min(least, TOGETHER), TOGETHER + 1):
        named = [f"{g}{k}" for _, g, k in items[: len(items) - max(least, t) + t]]
        out += [" ".join(c).encode() for c in combinations(named, t)]
    return out


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every two of the distinct words (word, n) that are one edit apart, both ways round.

    Words are to have ``2 * LONGEST`` code points or more.
    """
    spark = words.sparkSession
    total = words.count()
    length = F.length("word")
    # All substrings of the lengths that grams can have. Their number is bounded by the
    # alphabet: 88 letters of Latin-1 make 7,744 of two and 681,472 of three.
    grams = None
    for q in range(SHORTEST_GRAM, LONGEST + 1):
        each = words.select(F.explode(F.array_distinct(F.transform(
            F.sequence(F.lit(1), length - (q - 1)), lambda p, q=q: F.substring(F.col("word"), p, F.lit(q))
        ))).alias("gram"))
        grams = each if grams is None else grams.union(each)
    counted = {r.gram: r["count"] for r in grams.groupBy("gram").count().collect()}
    common = frozenset(g for g, c in counted.items() if len(g) < LONGEST and c > COMMON * total)
    book = spark.sparkContext.broadcast((counted, common, endings(common)))

    def to_keys(frames):
        frequency, common, ends = book.value
        for frame in frames:
            for at in range(0, len(frame), 5_000):
                part = frame["word"].iloc[at : at + 5_000]
                found, owner, letters, sizes = [], [], [], []
                for word in part:
                    mine = keys(word, frequency, common, ends)
                    odd = 0
                    for c in word:
                        odd ^= 1 << ord(c) % 31
                    found += [xxhash.xxh3_64_intdigest(k) - (1 << 63) for k in mine]
                    owner += [word] * len(mine)
                    letters += [odd] * len(mine)
                    sizes += [len(word)] * len(mine)
                yield pd.DataFrame({
                    "key": pd.Series(found, dtype="int64"), "word": owner, "odd": pd.Series(letters, dtype="int32"), "size": pd.Series(sizes, dtype="int32"),
                })

    listed = materialise(words.select("word").mapInPandas(to_keys, "key long, word string, odd int, size int"), "spelling-keys")
    a, b = listed.alias("a"), listed.alias("b")
    # One edit changes the length by at most one, and which letters occur an odd number of times by two.
    alike = (
        (F.bit_count(F.col("a.odd").bitwiseXOR(F.col("b.odd"))) <= 2)
        & (F.abs(F.col("a.size") - F.col("b.size")) <= 1)
        & (F.col("a.word") < F.col("b.word"))
        & (F.levenshtein("a.word", "b.word", 1) == 1)
    )
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & alike).select(F.col("a.word").alias("word"), F.col("b.word").alias("near"))
    pairs = materialise(pairs.distinct(), "spelling-pairs")
    both = pairs.union(pairs.select("near", "word"))
    return both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "near", "near_n")


def spelling_variants(
    docs: DataFrame, *, shortest: int = 7, least: int = 2, factor: int = 10, damage: int | None = None
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word of the texts with the spelling it varies.

    Words are maximal runs of ``RUN`` letters, A-Z lower-cased, of at least ``shortest``
    code points and ``least`` occurrences ``n`` over all texts (``damage``: see
    ``occurrences``). Two are near if one inserted, deleted or replaced code point makes
    one of the other. ``form`` is the near word of largest n, ties to the smallest in
    code-point order, if that n is at least ``factor`` times the word's own; else NULL.
    ``root`` follows forms to the last.

    NULL and empty texts have no words; texts and words of any length are taken whole. A
    NULL doc_id counts as empty text where ``damage`` needs it; rows repeat their words.
    Other columns are ignored; no documents: no rows.
    """
    if shortest < 2 * LONGEST:
        raise ValueError(f"words are to have {2 * LONGEST} letters at least")
    words = materialise(occurrences(docs, shortest, damage).where(F.col("n") >= least), "spelling-words")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    )
    strong = -F.col("best.minus") >= factor * F.col("n")
    judged = materialise(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.minus")).alias("form_n"),
        ), "spelling-forms",
    )
    # A form is ``factor`` times as frequent, so chains are short; each step doubles what is followed.
    roots = judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialise(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")), "spelling-roots")
        if roots.where("went").isEmpty():
            break
        roots = roots.select("word", "root")
    return judged.join(roots.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
