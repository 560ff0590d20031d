"""Quality rules whose cutoffs carry a guarantee.

Base counts describe each text; each rule compares one ratio of them with a cutoff
per language. Labelled documents fall into two halves by a hash of their id. The
first half proposes a cutoff per language and rule: the one that rejects most
low-quality documents net of a price for good ones. The second half certifies: from
the loosest cutoff on, one after the other, the exact binomial test asks whether the
true share of good documents rejected is at most ``risk / number of rules``; the
first failure ends the sequence (fixed-sequence testing, so the cutoffs of one rule
need no further correction). The level is ``1 - confidence`` divided by the number of
languages and rules (Bonferroni). The cutoff used is the proposed one or the strictest
certified one, whichever is looser. Hence, with the stated confidence, in every
language at most ``risk`` of the good documents fall to all rules together. A
language without enough labels has no cutoffs and loses only what fails the base.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.llm.common import plainly_named
from obsflow.scratch import materialise

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
#: rule: ratio as SQL over the measures. All lie between 0 and 1, more is worse.
RULES = {
    "symbols": "n_symbols / (word_chars + n_symbols)",
    "dup_lines": "n_dup_lines / n_lines",
    "repeats": "n_repeat_words / n_words",
    "capitals": "n_capitals / word_chars",
}
CUTS = 50  # cutoffs of a rule: i / CUTS
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
]
MIN_WORDS, MAX_REPEATED = 50, 50
#: Strata of a threshold table up to which it is sent to every executor.
BROADCAST_STRATA = 10_000


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    code = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    pair = np.unique(code[:-1] * len(seen) + code[1:], return_inverse=True)[1]
    window = pair[:-1] * np.int64(len(seen)) + code[2:]
    _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return int(covered.sum())


def measures(text: str) -> tuple[int, ...]:
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    letters = len(text) - sum(map(text.count, SPACES))
    capitals = sum(map(str.isupper, text))
    return (
        len(words), letters, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeated_words(words), len(lines), capitals,
    )


def measured(docs: DataFrame) -> DataFrame:
    """The documents with the columns of MEASURES; NULL text counts as empty, clashing names are replaced."""
    kept = docs.drop(*MEASURES)
    schema = T.StructType([*kept.schema.fields, *(T.StructField(m, T.LongType(), False) for m in MEASURES)])

    def run(batches):
        for part in batches:  # Arrow, so that the other columns pass as they are
            texts = (t.as_py() for t in part["text"])  # one at a time, not a batch of strings
            rows = [(0,) * len(MEASURES) if t is None else measures(t) for t in texts]
            found = np.array(rows, np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array(found[:, k]) for k in range(len(MEASURES)))], names=schema.names
            )

    return kept.mapInArrow(run, schema)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def _bin(rule: str):
    """How many cutoffs (i / CUTS, i from 0) the ratio exceeds; NULL ratios exceed none."""
    return F.coalesce(F.ceil(F.expr(f"try_divide({RULES[rule].replace(' / ', ', ', 1)})") * CUTS), F.lit(0)).cast("int")


def log_tail(k: int, n: int, p: float) -> float:
    """Log of the probability of at most k of n at rate p."""
    i = np.arange(k + 1)
    ways = math.lgamma(n + 1) - np.array([math.lgamma(x + 1) + math.lgamma(n - x + 1) for x in i])
    terms = ways + i * math.log(p) + (n - i) * math.log1p(-p)
    top = terms.max()
    return float(top + np.log(np.exp(terms - top).sum()))


def certified(rejected: np.ndarray, n: int, rate: float, level: float) -> int:
    """Index of the strictest cutoff that passes, testing from the last (loosest) one down; len(rejected) if none."""
    best = len(rejected)
    for i in range(len(rejected) - 1, -1, -1):
        k = int(rejected[i])
        if n == 0 or k >= rate * n or log_tail(k, n, rate) > math.log(level):
            break
        best = i
    return best


def fit_cutoffs(
    features: DataFrame, labels: DataFrame, risk: float = 0.05, confidence: float = 0.95, price: float = 5.0,
) -> DataFrame:
    """Cutoffs (stratum, rule, cut) from all labelled documents that pass the base.

    ``features``: doc_id, lang and MEASURES. ``labels``: doc_id and quality (1 good, 0
    low; NULL ignored; a document labelled twice counts once, as its highest label).
    A ratio above ``cut / CUTS`` is rejected. Only counts per language, rule and cutoff
    are gathered. No labels: no rows.
    """
    label = labels.where("quality IS NOT NULL").groupBy("doc_id").agg((F.max("quality") > 0).alias("good"))
    bins = F.array(*(F.struct(F.lit(r).alias("rule"), _bin(r).alias("bin")) for r in RULES))
    counts = (
        features.where(~base_failed()).select("doc_id", "lang", bins.alias("bins"))
        .join(label, "doc_id")
        .select(F.col("lang").alias("stratum"), "good", F.explode("bins").alias("b"),
                (F.crc32(F.col("doc_id").cast("string")) % 2 == 0).alias("proposes"))
        .groupBy("stratum", "b.rule", "b.bin", "good", "proposes").count()
    )
    counts = materialise(counts, "quality-counts")  # the texts are read once for them
    strata = counts.select("stratum").distinct().count()
    level = (1 - confidence) / (max(strata, 1) * len(RULES))
    rate = risk / len(RULES)

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        def above(good: bool, proposes: bool) -> tuple[np.ndarray, int]:
            rows = frame[(frame["good"] == good) & (frame["proposes"] == proposes)]
            per_bin = np.bincount(rows["bin"], rows["count"], CUTS + 2)
            return np.cumsum(per_bin[::-1])[::-1][1 : CUTS + 1], int(per_bin.sum())

        gain = above(False, True)[0] - price * above(True, True)[0]
        cut = max(int(np.flatnonzero(gain == gain.max())[-1]), certified(*above(True, False), rate, level))
        chosen = gain.max() > 0 and cut < CUTS
        return pd.DataFrame({"stratum": frame["stratum"].iloc[:1], "rule": frame["rule"].iloc[:1], "cut": [cut]})[: int(chosen)]

    kind = features.schema["lang"].dataType.simpleString()
    return counts.groupBy("stratum", "rule").applyInPandas(choose, f"stratum {kind}, rule string, cut int")


def judged(features: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``features`` with base_failed and kept; other columns may have any name but ``_stratum`` and ``_cut_...``.

    A document is kept when it passes the base and every rule of its language. A NULL
    language is a language of its own.
    """
    per_stratum = cutoffs.groupBy(F.col("stratum").alias("_stratum")).pivot("rule", list(RULES)).agg(F.first("cut"))
    per_stratum = per_stratum.select("_stratum", *(F.col(r).alias(f"_cut_{r}") for r in RULES))
    if per_stratum.count() <= BROADCAST_STRATA:
        per_stratum = F.broadcast(per_stratum)
    fails = [F.coalesce(_bin(r) > F.col(f"_cut_{r}"), F.lit(False)) for r in RULES]
    any_fails = fails[0]
    for f in fails[1:]:
        any_fails = any_fails | f
    return (
        features.join(per_stratum, F.col("lang").eqNullSafe(F.col("_stratum")), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~any_fails)
        .drop("_stratum", *(f"_cut_{r}" for r in RULES))
    )


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that judge_documents keeps, with the columns they had, whatever their names.

    NULL, empty and wordless texts go; repeated rows stay or go together; texts of any
    length are measured whole. No documents: no rows.
    """
    plain, given = plainly_named(docs, "doc_id", "lang", "text")
    return judge_documents(plain, labels, **options).where("kept").select(*given)


def judge_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents with MEASURES, base_failed and kept; cutoffs are fitted on the labelled ones.

    NULL and empty texts have no words and fail the base. Repeated rows are judged
    alike, texts of any length whole; no documents: no rows. Columns of ``docs`` named as
    what is returned are replaced, all others stay.
    """
    docs = docs.drop(*MEASURES, "base_failed", "kept")
    plain, given = plainly_named(docs, "doc_id", "lang", "text")
    cutoffs = fit_cutoffs(measured(docs.select("doc_id", "lang", "text")).drop("text"), labels, **options)
    return judged(measured(plain), materialise(cutoffs, "quality-cutoffs")).select(*given, *MEASURES, "base_failed", "kept")
