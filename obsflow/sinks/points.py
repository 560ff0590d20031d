"""Tables from which the rows of single keys are read without reading the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsflow.sources.landing import read_table

#: Smaller row groups skip more and cost a filter and statistics each.
ROW_GROUP_BYTES = 16 << 20
#: At most this many bytes for the Bloom filter of a row group and column.
FILTER_BYTES = 1 << 20
#: So many keys are asked for by equality; for more, join.
MOST_KEYS = 200


def write_point_table(
    df: DataFrame,
    path: str,
    sort_by: Sequence[str],
    keys: Sequence[str] = (),
    *,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Replace a table by the frame's rows, ranged and sorted by ``sort_by``, with Bloom filters on ``keys``.

    Statistics of the sorted files and row groups skip by ``sort_by``; the filters skip row
    groups without a key that the order does not gather. ``sort_by`` should end in columns
    that tell rows apart, so that a value which many rows share is dealt over several
    files. The filter's size follows the distinct keys of its row group; a column that is
    written by dictionary throughout has none, and its dictionary skips instead.
    """
    writer = (
        df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by).write.mode("overwrite")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.bloom.filter.max.bytes", FILTER_BYTES)
    )
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(path)


def read_points(spark: SparkSession, path: str, schema: StructType, key: str, values: Sequence) -> DataFrame:
    """The rows whose ``key`` is one of ``values``; of a table never written, none.

    Equalities and no IN: from some ten values on, IN reaches the files only as a range,
    which no Bloom filter answers. NULL finds nothing.
    """
    values = list(dict.fromkeys(v for v in values if v is not None))
    if len(values) > MOST_KEYS:
        raise ValueError(f"{len(values)} keys; more than {MOST_KEYS} should be joined")
    wanted = reduce(or_, [F.col(key) == F.lit(v) for v in values], F.lit(False))
    return read_table(spark, path, schema).where(wanted)
