"""Row predicates and column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_identifiable(city: str = "city", lat: str = "lat", long: str = "long") -> Column:
    """A row is tied to a place by its city or by both coordinates."""
    return F.col(city).isNotNull() | (F.col(lat).isNotNull() & F.col(long).isNotNull())


def identifiable_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_identifiable", is_identifiable())


def identifiable_rows(df: DataFrame) -> DataFrame:
    return df.where(is_identifiable())


def identifiable_strict(df: DataFrame) -> DataFrame:
    """The stricter rule of the exploratory notes: city and both coordinates."""
    return df.dropna(subset=["city", "lat", "long"])


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: does any NULL occur. One pass, one row per column."""
    flags = [F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias(c) for c in df.columns]
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("has_null")) for c in df.columns
    ]
    return df.agg(*flags).select(F.inline(F.array(*rows)))


def type_profile(df: DataFrame) -> DataFrame:
    """Per column: its type and how many rows hold a value."""
    counts = [F.count(F.col(c)).alias(c) for c in df.columns]
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(dtype).alias("data_type"),
            F.col(name).alias("rows_with_value"),
        )
        for name, dtype in df.dtypes
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))
