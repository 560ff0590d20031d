"""Mixing sources to target weights by exponential keys.

Every document draws a uniform number from a hash of its id and gets the key
``-ln(u) / weight`` (Efraimidis and Spirakis): taking documents in the order of
the keys samples without replacement with probability in proportion to weight.
A source whose target exceeds its size first gives complete epochs; the rest of
the target is filled by the order of the keys, cut by a prefix sum.

Only DataFrame functions. The prefix sums are taken in two steps: sums per slice
of the key's range, then rows within a slice. A source that holds a third of all
rows is thereby dealt over as many slices as there are shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsflow.llm.common import n_words, partitions, plainly_named

SYMBOLS = "#*$%&|<>"


def quality_weight(text, size) -> Column:
    """Share of words among words and symbol characters: near 1 for prose, low for junk."""
    plain = F.coalesce(text, F.lit(""))
    symbols = F.length(plain) - F.length(F.translate(plain, SYMBOLS, ""))
    return (size + 1.0) / (size + symbols + 1.0)


def uniform(*columns) -> Column:
    """A number above 0 and up to 1 from the md5 of the columns."""
    digest = F.md5(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 1).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """Sizes (source, source_size) with the target of each source.

    Sources by code point, NULL last, weigh ``weights`` in turn and share ``share``
    times the sum of all sizes. No target exceeds ``most`` times its size: what is
    above is shared anew by weight until none is, which is the level at which
    ``min(limit, level * weight)`` sums to the whole.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), turn + 1)
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = (
        sizes.withColumn("weight", weight)
        .withColumn("limit", most * F.col("source_size"))
        .withColumn("ratio", F.col("limit").cast("double") / F.col("weight"))
        .withColumn("all", F.sum("source_size").over(everything))
        .withColumn(
            "level",
            (share * F.col("all") - F.coalesce(F.sum("limit").over(before), F.lit(0)))
            / F.sum("weight").over(after),
        )
    )
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"]
    return levels.withColumn("final", level).select(
        "source", "source_size",
        F.least(F.col("limit").cast("double"), F.coalesce(F.col("final") * F.col("weight"), F.col("limit").cast("double"))).alias("target"),
    )


def mix_sources(
    docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 0,
) -> DataFrame:
    """The documents with mix_size, mix_source_size, mix_target, mix_copies and mix_taken.

    ``mix_copies`` says how often the document is in the mix, ``mix_taken`` how many
    words that is. Documents are taken whole; the one at the end of the budget is
    taken when that is nearer to the target. Its size in words decides, so a source
    ends within half of its longest document from its target.

    NULL text has no words; documents without words are never drawn. NULL is a
    source of its own, after the others. Repeated rows are documents of their own
    with equal keys. Columns of ``docs`` stay as they are; the helper columns begin
    with ``mix_``. No documents: no rows.
    """
    slices = partitions(docs.sparkSession)
    keyed = (
        docs.withColumn("mix_size", n_words(F.col("text")))
        .withColumn("mix_key", -F.log(uniform("doc_id").alias("u")) / quality_weight(F.col("text"), F.col("mix_size")))
        .withColumn("mix_tie", F.xxhash64("text"))
        .withColumn("mix_slice", F.floor((1 - F.exp(-F.col("mix_key"))) * slices).cast("int"))
    )
    sums = keyed.groupBy("source", "mix_slice").agg(F.sum("mix_size").alias("slice_size"))
    earlier = Window.partitionBy("source").orderBy("mix_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("mix_before", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)))
    targets = source_targets(
        keyed.groupBy("source").agg(F.sum("mix_size").alias("source_size")), weights, share, most
    )
    plan = (
        sums.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
        .select(
            F.col("s.source").alias("plan_source"), F.col("mix_slice").alias("plan_slice"), "mix_before",
            F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
        )
    )
    within = (
        Window.partitionBy(F.col("source"), "mix_slice")
        .orderBy("mix_key", "doc_id", "mix_size", "mix_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = F.col("mix_before") + F.sum("mix_size").over(within)
    epochs = F.floor(F.col("mix_target") / F.col("mix_source_size"))
    rest = F.col("mix_target") - epochs * F.col("mix_source_size")
    drawn = F.when(2 * F.col("mix_upto") - F.col("mix_size") <= 2 * rest, 1).otherwise(0)
    return (
        keyed.join(plan, F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("mix_slice") == F.col("plan_slice")))
        .withColumn("mix_upto", upto)
        .withColumn("mix_copies", F.when(F.col("mix_size") > 0, epochs + drawn).otherwise(0).cast("long"))
        .withColumn("mix_taken", F.col("mix_copies") * F.col("mix_size"))
        .drop("mix_key", "mix_tie", "mix_slice", "mix_before", "mix_upto", "plan_source", "plan_slice")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with the columns it had, whatever their names.

    See mix_sources for NULLs, empty texts, repeated rows and the end of the budget.
    """
    plain, given = plainly_named(docs, "doc_id", "text", "source")
    copies = F.explode(F.array_repeat(F.lit(0), F.col("mix_copies").cast("int"))).alias("mix_copy")
    return mix_sources(plain, **options).where("mix_copies > 0").select("*", copies).select(*given)
