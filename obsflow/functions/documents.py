"""JSON text to rows, rows to JSON text, and the country payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.functions.text import (
    first_or_empty,
    map_values_joined,
    or_empty,
    strip_quotes,
    strip_utc,
)
from obsflow.schemas import COUNTRY_PAYLOAD


def rows_to_json(df: DataFrame, out: str = "json", *, keep_nulls: bool = False) -> DataFrame:
    """One JSON text per row; NULL fields are left out unless ``keep_nulls``."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return df.select(F.to_json(F.struct("*"), options).alias(out))


def json_to_rows(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Parse ``text`` with a declared schema and put its fields beside the other columns."""
    others = [c for c in df.columns if c != text]
    parsed = df.select(*others, F.from_json(F.col(text), schema).alias("_doc"))
    return parsed.select(*others, "_doc.*")


def map_to_rows(df: DataFrame, text: str, key: str = "key", value: str = "value") -> DataFrame:
    """One JSON object as (key, value) rows."""
    others = [c for c in df.columns if c != text]
    entries = F.from_json(F.col(text), T.MapType(T.StringType(), T.StringType()))
    return df.select(*others, F.explode(entries).alias(key, value))


def country_fields(payload: Column) -> dict[str, Column]:
    """The record kept from the first document of a country payload."""
    first = F.get(payload, F.lit(0))
    return {
        "continent": strip_quotes(first_or_empty(first["continents"])),
        "tz_utc": strip_utc(strip_quotes(first_or_empty(first["timezones"]))),
        "name": strip_quotes(or_empty(first["name"]["common"])),
        "region": strip_quotes(or_empty(first["subregion"])),
        "language": map_values_joined(first["languages"]),
        "capital": strip_quotes(first_or_empty(first["capital"])),
    }


def country_records(df: DataFrame, text: str) -> DataFrame:
    """Parse country payload text and keep the six stored fields beside the other columns."""
    others = [c for c in df.columns if c != text]
    parsed = df.select(*others, F.from_json(F.col(text), COUNTRY_PAYLOAD).alias("_payload"))
    fields = [c.alias(n) for n, c in country_fields(F.col("_payload")).items()]
    return parsed.select(*others, *fields)
