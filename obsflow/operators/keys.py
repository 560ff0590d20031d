"""Resolution of location and country keys.

A stored location answers for a row when the city is equal OR both coordinates
are equal. A join on that disjunction would be a nested loop, so it is taken
apart into two equality lookups whose smaller id wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.operators.lookup import (
    BROADCAST_BYTES,
    HOT_KEYS,
    all_present,
    first_id_by,
    lookup,
    measured_bytes,
)
from obsflow.scratch import materialise


def lookup_location(
    rows: DataFrame,
    locations: DataFrame,
    out: str = "location_id",
    *,
    use_city: bool = True,
    use_coords: bool = True,
    carry: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the smallest id of the locations that match by city or by coordinates.

    NULL never matches; an unresolved row keeps a NULL id. With ``carry`` the result is
    a struct of the id and these columns of the location.

    Locations that are not small are looked up for distinct places only, and the places
    joined back to the rows: a frequent place is one row before any shuffle.
    """
    known = locations.select("id", "city", "lat", "long")
    # Keys are at most as many as stored rows, so this bounds both lookups.
    small = measured_bytes(known) <= broadcast_bytes
    value = F.struct("id", *carry) if carry else F.col("id")

    def resolved(places: DataFrame) -> DataFrame:
        found = []
        sides = [(use_city, ["city"], "_by_city"), (use_coords, ["lat", "long"], "_by_coords")]
        for used, on, name in sides:
            if used:
                one = known.where(all_present(on)).groupBy(*on).agg(F.min(value).alias(name))
                places = lookup(places, one, on, broadcast=small)
                found.append(name)
        # least() skips NULLs but wants two arguments.
        best = F.least(*found) if len(found) > 1 else F.col(found[0])
        return places.withColumn(out, best).drop(*found)

    if small:
        return resolved(rows)
    on = [c for c, used in (("city", use_city), ("lat", use_coords), ("long", use_coords)) if used]
    # A struct is never NULL itself, so places with gaps find themselves again.
    placed = rows.withColumn("_place", F.struct(*on))
    # Counted once and written: the counts also name the frequent places of the last join.
    places = materialise(placed.groupBy("_place").agg(F.count(F.lit(1)).alias("_rows")), "places")
    found = resolved(places.select("_place", "_place.*")).select("_place", out)
    hot = places.orderBy(F.desc("_rows"), "_place").limit(HOT_KEYS).select("_place")
    return lookup(placed, found, ["_place"], broadcast=False, hot=hot).drop("_place")


def lookup_country(
    rows: DataFrame,
    countries: DataFrame,
    out: str = "country_id",
    *,
    aliases: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the smallest id of the countries with the row's country name.

    A country also answers to the name it was requested by, if the table keeps it, and
    to its ``aliases`` (alias, country_id).
    """
    names = countries.select("id", F.col("name").alias("country"))
    if "requested_as" in countries.columns:
        names = names.unionByName(countries.select("id", F.col("requested_as").alias("country")))
    if aliases is not None:
        names = names.union(aliases.select("country_id", "alias"))
    small = measured_bytes(names) <= broadcast_bytes
    return lookup(rows, first_id_by(names, ["country"], "id", out), ["country"], broadcast=small)


def identified_flag(rows: DataFrame, id_col: str = "id") -> DataFrame:
    return rows.withColumn("is_identified", F.col(id_col).isNotNull())


def key_exists(keys: DataFrame, dim: DataFrame, on: str, out: str = "is_known") -> DataFrame:
    """For every key: is there a row with it in ``dim``."""
    known = dim.where(F.col(on).isNotNull()).select(on).distinct()
    small = measured_bytes(dim.select(on)) <= BROADCAST_BYTES
    flagged = lookup(keys, known.withColumn(out, F.lit(True)), [on], broadcast=small)
    return flagged.withColumn(out, F.coalesce(out, F.lit(False)))


def fill_from_dimension(
    rows: DataFrame,
    locations: DataFrame,
    columns=("city", "lat", "long"),
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Fill NULL identity fields from the location the row resolves to."""
    resolved = lookup_location(rows, locations, "_location", carry=columns, broadcast_bytes=broadcast_bytes)
    filled = resolved.withColumns({c: F.coalesce(c, f"_location.{c}") for c in columns})
    return filled.select(*rows.columns)
