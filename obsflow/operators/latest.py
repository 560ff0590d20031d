"""Last write wins per place and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from obsflow.schemas import HOUR_BUCKET


def first_per_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key.

    ``row_number() = 1`` is pruned to one row per key and task before the
    shuffle, so a key that holds a large part of all rows arrives as a handful.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def latest_per_city_hour(
    df: DataFrame, *, ingest_ts: str = "ingest_ts", tie: Sequence[str] = ("obs_id",)
) -> DataFrame:
    """Keep the row written last per (method, hour, city).

    A row without a city is keyed by its coordinates instead; the input holds
    identifiable rows only, so one of the two is there.
    """
    nameless = F.col("city").isNull()
    place = [
        F.col("city"),
        F.when(nameless, F.col("lat")),
        F.when(nameless, F.col("long")),
    ]
    order = [F.desc_nulls_last(ingest_ts), *[F.desc_nulls_last(t) for t in tie]]
    return first_per_key(df, [*HOUR_BUCKET, *place], order)
