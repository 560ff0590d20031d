"""String, array and map clean-up as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip_quotes(c: Column) -> Column:
    """Drop every single quote. NULL stays NULL; a lone quote becomes ``''``."""
    return F.replace(c, F.lit("'"), F.lit(""))


def clean_name(c: Column) -> Column:
    """Empty to NULL first, quotes second, so a lone quote ends as ``''``."""
    return strip_quotes(empty_to_null(c))


def strip_utc(c: Column) -> Column:
    """``UTC+01:00`` -> ``+01:00`` and ``UTC`` -> ``''``."""
    return F.replace(c, F.lit("UTC"), F.lit(""))


def first_or_empty(arr: Column) -> Column:
    """First element; ``''`` for a NULL or empty array (``arr[0]`` raises under ANSI)."""
    return F.coalesce(F.get(arr, F.lit(0)), F.lit(""))


def map_values_joined(m: Column) -> Column:
    """Map values as a comma-separated list without quotes or brackets."""
    joined = F.array_join(F.map_values(m), ", ")
    return F.coalesce(F.translate(joined, "'[]", ""), F.lit(""))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))
