"""Which payloads are to be asked for, and which are missing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.functions.times import naive_run_ts
from obsflow.schemas import REQUEST_METHODS


def request_grid(cities: DataFrame, methods: Sequence[str] = REQUEST_METHODS) -> DataFrame:
    """One (method, city) row per city and method; a city listed twice is asked for twice.

    The few methods are an array literal exploded beside each city, so no join
    is needed.
    """
    listed = F.array(*[F.lit(m) for m in methods])
    return cities.select(F.explode(listed).alias("method"), "city")


def missing_payloads(
    grid: DataFrame, landed: DataFrame, keys: Sequence[str] = ("method", "city")
) -> DataFrame:
    """Requests for which nothing has landed.

    Landed rows are reduced to their distinct keys first, before any shuffle.
    """
    return grid.join(landed.select(*keys).distinct(), list(keys), "left_anti")


def missing_in_hour(grid: DataFrame, landed: DataFrame, when: datetime) -> DataFrame:
    """Requests of the grid for which nothing has landed in one hour.

    ``landed`` has the partition columns of the landing, by which other hours are pruned.
    """
    when = naive_run_ts(when)
    hour = landed.where(
        (F.col("year") == when.year) & (F.col("month") == when.month)
        & (F.col("day") == when.day) & (F.col("hour") == when.hour)
    )
    return missing_payloads(grid, hour)
