"""Clean-up of location and fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.functions.text import clean_name, empty_to_null, strip_quotes
from obsflow.functions.times import as_wall_clock
from obsflow.schemas import FACT_COLUMNS, LOCATION_COLUMNS

NAME_COLUMNS = ("city", "country", "region", "tz_id")


def project_location(df: DataFrame) -> DataFrame:
    return df.select(*LOCATION_COLUMNS)


def project_fact(df: DataFrame) -> DataFrame:
    return df.select(*FACT_COLUMNS)


def clean_locations(df: DataFrame) -> DataFrame:
    """Clean the text columns of a location row."""
    return df.withColumns({name: clean_name(F.col(name)) for name in NAME_COLUMNS})


def clean_facts(df: DataFrame) -> DataFrame:
    """Clean a fact row: empty text to NULL, times typed, quotes off the city.

    An empty city is kept here, unlike in :func:`clean_locations`.
    """
    return df.withColumns(
        {
            "condition": empty_to_null(F.col("condition")),
            "wind_dir": empty_to_null(F.col("wind_dir")),
            "last_updated": as_wall_clock(F.col("last_updated")),
            "localtime": as_wall_clock(F.col("localtime")),
            "city": strip_quotes(F.col("city")),
        }
    )
