"""Running row numbers over a whole frame, without putting it in one partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsflow.scratch import materialise

# monotonically_increasing_id() holds the partition above bit 33, the position below.
_POSITION_BITS = 33


def row_index(
    df: DataFrame, order: Sequence[Column | str], out: str = "row_index", *, start: int = 1
) -> DataFrame:
    """Number the rows by ``order``, which must be total (end it with a unique column).

    Rows are range-partitioned and sorted by the whole order, so a frequent
    leading value is spread too. Each row notes its partition and position; the
    partitions' sizes, one row per partition, give the offsets to add. The rows
    are written once in between, because range bounds are sampled and a second
    evaluation could draw them differently.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = materialise(placed, "row-index")
    placed = placed.withColumn("_part", F.shiftright("_at", _POSITION_BITS))
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))

    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(out, position + F.col("_offset") + F.lit(start)).drop(
        "_at", "_part", "_offset"
    )


def head_rows(df: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by a stated order (a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)
