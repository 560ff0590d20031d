"""Growing the countries and locations tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.functions.times import audit_stamp
from obsflow.operators.clean import clean_locations, project_location
from obsflow.operators.keys import lookup_country, lookup_location
from obsflow.operators.latest import first_per_key
from obsflow.operators.lookup import BROADCAST_BYTES, lookup, measured_bytes
from obsflow.operators.rownum import row_index


def insert_missing_countries(
    rows: DataFrame, countries: DataFrame, payloads: DataFrame, run_ts: datetime
) -> DataFrame:
    """Countries to insert: named by a row, not stored yet, and with a payload.

    ``payloads`` has one record per requested name: ``requested_as`` and the
    fields of a country record. A country is inserted once even when asked for
    under several names, and not again when it is stored under its own name.
    """
    wanted = (
        rows.where(F.col("country").isNotNull())
        .select(F.col("country").alias("requested_as"))
        .distinct()
    )
    names = countries.select(F.col("name").alias("requested_as"))
    if "requested_as" in countries.columns:
        names = names.unionByName(countries.select("requested_as"))
    # Not an anti join: the optimizer would move that below the distinct and
    # join every row instead of every name.
    known = names.where(F.col("requested_as").isNotNull()).distinct().withColumn("_known", F.lit(True))
    small = measured_bytes(names) <= BROADCAST_BYTES
    flagged = lookup(wanted, known, ["requested_as"], broadcast=small)
    unknown = flagged.where(F.col("_known").isNull()).drop("_known")
    found = unknown.join(payloads, "requested_as").join(
        countries.select("name"), "name", "left_anti"
    )
    columns = ["name", "capital", "language", "tz_utc", "region", "continent", "requested_as"]
    rest = [F.asc_nulls_last(c) for c in columns if c not in ("name", "requested_as")]
    once = first_per_key(found, ["name"], [F.col("requested_as"), *rest])
    return audit_stamp(once.select(*columns), run_ts)


def new_aliases(
    rows: DataFrame, countries: DataFrame, aliases: DataFrame, payloads: DataFrame
) -> DataFrame:
    """Further names (alias, country_id) under which rows ask for stored countries.

    Each name that a payload answers with another name is kept, so that it resolves
    in this hour and in later ones that bring no payload for it.
    """
    wanted = rows.where(F.col("country").isNotNull()).select(F.col("country").alias("requested_as")).distinct()
    named = wanted.join(payloads.select("requested_as", "name"), "requested_as").where("requested_as <> name")
    ids = countries.groupBy("name").agg(F.min("id").alias("country_id"))
    found = named.join(ids, "name").groupBy(F.col("requested_as").alias("alias")).agg(F.min("country_id").alias("country_id"))
    return found.join(aliases.select("alias"), "alias", "left_anti").select("alias", "country_id")


def unknown_locations(
    rows: DataFrame, locations: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Cleaned location rows that no stored location answers for, as often as they occur."""
    seen = clean_locations(project_location(rows))
    resolved = lookup_location(seen, locations, "id", broadcast_bytes=broadcast_bytes)
    return resolved.where(F.col("id").isNull()).drop("id")


def one_per_place(rows: DataFrame) -> DataFrame:
    """One row per city; a row without a city counts by its coordinates.

    The row with the fewest gaps at the front of the order is kept. A row without a city
    at the coordinates of one with a city is that place and goes too.
    """
    nameless = F.col("city").isNull()
    key = [F.col("city"), F.when(nameless, F.col("lat")), F.when(nameless, F.col("long"))]
    rest = ("lat", "long", "country", "region", "tz_id")
    once = first_per_key(rows, key, [F.asc_nulls_last(c) for c in rest])
    named = once.where("city IS NOT NULL").select("lat", "long").distinct()
    unnamed = once.where("city IS NULL").join(named, ["lat", "long"], "left_anti")
    return once.where("city IS NOT NULL").unionByName(unnamed)


def new_locations(
    rows: DataFrame,
    locations: DataFrame,
    countries: DataFrame,
    run_ts: datetime,
    *,
    dedup: bool = True,
    aliases: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Locations to insert, with their country key and the audit stamp.

    With ``dedup`` a place that occurs several times in the batch is inserted
    once. Rows are reduced to distinct ones before any join then.
    """
    if dedup:
        rows = project_location(rows).distinct()
    fresh = unknown_locations(rows, locations, broadcast_bytes=broadcast_bytes)
    if dedup:
        fresh = one_per_place(fresh)
    keyed = lookup_country(fresh, countries, aliases=aliases, broadcast_bytes=broadcast_bytes).drop("country")
    return audit_stamp(keyed, run_ts)


def assign_ids(new: DataFrame, stored: DataFrame, order: Sequence) -> DataFrame:
    """Number new rows after the largest stored id, in the stated order."""
    last = stored.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    return row_index(new, order, "id", start=last + 1)


LOCATION_ORDER = ("city", "lat", "long")
