"""Key lookup: a left join of many rows to a table with one row per key.

A dimension of measured, small size is broadcast, so the rows are not shuffled
at all. Beyond that size the join is by shuffle, and no single key may decide
how long it takes: the most frequent keys are settled by a broadcast of their
few dimension rows, and their rows, like those with a NULL key, are spread over
all tasks of the shuffle instead of meeting in one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
# No key outside the list of this length can hold more than 1 / HOT_KEYS of the rows.
HOT_KEYS = 1000

# Rough cost of one row of a hashed relation besides its text.
_ROW_BYTES = 64


def all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def measured_bytes(df: DataFrame) -> int:
    """Size of a table's rows in memory, measured by one aggregate over it."""
    row = F.lit(_ROW_BYTES + 8 * len(df.columns))
    for field in df.schema:
        if isinstance(field.dataType, T.StringType):
            row = row + F.coalesce(F.octet_length(field.name), F.lit(0))
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()[0]


def first_id_by(dim: DataFrame, keys: Sequence[str], id_col: str, out: str) -> DataFrame:
    """One row per key with its smallest id; NULL keys never match and are left out."""
    return dim.where(all_present(keys)).groupBy(*keys).agg(F.min(id_col).alias(out))


def frequent_keys(rows: DataFrame, keys: Sequence[str], n: int = HOT_KEYS) -> DataFrame:
    """The ``n`` most frequent keys, counted with partial sums before the shuffle."""
    counts = rows.where(all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.orderBy(F.desc("_rows"), *keys).limit(n).select(*keys)


def lookup(
    rows: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    *,
    broadcast: bool,
    counted: DataFrame | None = None,
    hot: DataFrame | None = None,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Left join ``rows`` to ``dim``, which has one row per ``keys``.

    ``broadcast`` says that the dimension was measured and is small. Otherwise
    the frequent keys are counted in ``counted``: the rows as they were before
    any earlier lookup, so that lookups in a chain do not repeat one another. ``hot``
    names at most ``hot_keys`` frequent keys where they are known already.
    """
    keys = list(keys)
    if broadcast:
        values = [c for c in dim.columns if c not in keys]
        return rows.join(F.broadcast(dim), keys, "left").select(*rows.columns, *values)
    if hot is None:
        hot = frequent_keys(rows if counted is None else counted, keys, hot_keys)
    return _spread_lookup(rows, dim, keys, hot)


def _spread_lookup(rows, dim, keys, hot) -> DataFrame:
    values = [c for c in dim.columns if c not in keys]
    # Which keys are listed only decides the way a row takes, never its result.
    hot_dim = (
        hot.join(F.broadcast(dim.join(F.broadcast(hot), keys, "left_semi")), keys, "left")
        .withColumnsRenamed({v: f"_hot_{v}" for v in values})
        .withColumn("_hot", F.lit(True))
    )
    routed = rows.join(F.broadcast(hot_dim), keys, "left")
    settled = F.col("_hot").isNotNull() | ~all_present(keys)

    # A settled row gets NULL join keys, which match nothing, and its partition's
    # number to spread it by: a value that a repeated task computes again.
    join_keys = {f"_key_{k}": F.when(~settled, F.col(k)) for k in keys}
    spread = F.when(settled, F.spark_partition_id() + 1).otherwise(F.lit(0))
    routed = routed.withColumns({**join_keys, "_spread": spread})

    # Always 0, but not a literal: the optimizer would take a constant out of the
    # join keys and thereby out of the hash that distributes the rows.
    zero = F.pmod(F.hash(*keys), F.lit(1))
    target = dim.withColumn("_spread", zero).withColumnsRenamed({k: f"_key_{k}" for k in keys})
    joined = routed.join(target, [*join_keys, "_spread"], "left")
    found = [F.coalesce(v, f"_hot_{v}").alias(v) for v in values]
    return joined.select(*rows.columns, *found)
