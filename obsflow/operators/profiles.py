"""Profiles of columns that merge: made per hour and batch, read for any range of hours.

One row per hour and column holds exact counts and bounds and two sketches of fixed size,
so a profile of years is read from a few kilobytes an hour and not from the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.functions.times import hour_start

#: Sizes of the sketches: 2^LG_K registers for distinct values, KLL_K items a level for quantiles.
LG_K, KLL_K = 12, 800
#: Bounds that are missed by fewer than one profile in some thousand: of the share by which a
#: count of distinct values is off (three of its standard errors, 1.04 / 2^(LG_K / 2)), and of the
#: distance of a quantile's rank from the one asked for (twice its error at 99 %).
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (LG_K / 2), 2 * 2.296 / KLL_K**0.9021

QUANTILES = (0.25, 0.5, 0.75)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(field.dataType) for field in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _hash(field: T.StructField) -> Column:
    """A value as 64 bits, NULL for NULL and for what has no hash (maps and variants)."""
    value = F.col(f"`{field.name}`")
    return F.when(value.isNotNull(), F.xxhash64(value)) if _hashable(field.dataType) else F.lit(None).cast("long")


def _number(field: T.StructField) -> Column:
    """A number as a double; NULL for NaN and for other types."""
    none = F.lit(None).cast("double")
    return F.nanvl(F.col(f"`{field.name}`").cast("double"), none) if isinstance(field.dataType, T.NumericType) else none


def _fields(df: DataFrame, columns: Sequence[str]) -> list[T.StructField]:
    return [df.schema[name] for name in columns]


def hour_profiles(
    df: DataFrame, at: str, columns: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """(by, hour, column_name, rows, rows_with_value, low, high, values_sketch, quantile_sketch).

    ``columns``: all but ``at`` and ``by`` if not given. ``low``, ``high`` and the quantiles
    are of numbers, as doubles; NaN has a value but no place among them. Maps and variants
    are counted only. Rows without a time share the hour NULL. No rows: no profiles.
    """
    columns = [c for c in df.columns if c not in (at, *by)] if columns is None else columns
    entries = []
    for field in _fields(df, columns):
        number = _number(field)
        entries.append(F.struct(
            F.lit(field.name).alias("column_name"),
            F.count(F.lit(1)).alias("rows"),
            F.count(F.col(f"`{field.name}`")).alias("rows_with_value"),
            F.min(number).alias("low"),
            F.max(number).alias("high"),
            F.hll_sketch_agg(_hash(field), LG_K).alias("values_sketch"),
            F.kll_sketch_agg_double(number, F.lit(KLL_K)).alias("quantile_sketch"),
        ))
    grouped = df.groupBy(*by, hour_start(at).alias("hour")).agg(F.array(*entries).alias("profiles"))
    return grouped.select(*by, "hour", F.inline("profiles"))


def merge_profiles(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of several batches or hours as one per ``by`` and column; keep "hour" in ``by`` to keep hours apart."""
    return profiles.groupBy(*by, "column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("rows_with_value").alias("rows_with_value"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("values_sketch").alias("values_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def read_profiles(profiles: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """The profiles with ``distinct`` and ``quantiles`` (an array, NULL without numbers) for their sketches."""
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    held = F.kll_sketch_get_n_double("quantile_sketch") > 0
    return profiles.select(
        *[c for c in profiles.columns if not c.endswith("_sketch")],
        F.hll_sketch_estimate("values_sketch").alias("distinct"),
        F.when(held, F.kll_sketch_get_quantile_double("quantile_sketch", asked)).alias("quantiles"),
    )


def audit_profiles(df: DataFrame, read: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Hold read profiles against the rows they describe, one per column.

    (column_name, exact_distinct, distinct_error, rank_error): the share by which ``distinct``
    is off, and the largest distance of a quantile's rank from the one asked for (NULL
    without numbers). A column's values are counted once per distinct value, so what is
    shuffled follows those.
    """
    columns = [r.column_name for r in read.select("column_name").collect()]  # names, not rows
    values = F.array(*[
        F.struct(F.lit(field.name).alias("column_name"), _hash(field).alias("hash"), _number(field).alias("number"))
        for field in _fields(df, columns)
    ])
    counted = df.select(F.inline(values)).groupBy("column_name", "hash", "number").agg(F.count(F.lit(1)).alias("n"))
    # One row per column of a table: small by construction.
    held = counted.join(F.broadcast(read.select("column_name", "distinct", "quantiles")), "column_name")
    ranks, errors = [], []
    for i, q in enumerate(quantiles):
        found = F.col("quantiles")[i]
        numbers = F.sum(F.when(F.col("number").isNotNull(), F.col("n")))
        below = F.coalesce(F.sum(F.when(F.col("number") < found, F.col("n"))), F.lit(0)) / numbers
        upto = F.coalesce(F.sum(F.when(F.col("number") <= found, F.col("n"))), F.lit(0)) / numbers
        ranks += [below.alias(f"below_{i}"), upto.alias(f"upto_{i}")]
        errors.append(F.greatest(F.col(f"below_{i}") - q, q - F.col(f"upto_{i}"), F.lit(0.0)))
    exact = F.count("hash").alias("exact_distinct")
    worst = F.when(F.col("below_0").isNotNull(), F.array_max(F.array(*errors)))
    off = F.abs(F.col("distinct") - F.col("exact_distinct")) / F.greatest("exact_distinct", F.lit(1))
    return held.groupBy("column_name").agg(F.first("distinct").alias("distinct"), exact, *ranks).select(
        "column_name", "exact_distinct", off.alias("distinct_error"), worst.alias("rank_error")
    )
