"""Keys of a large stored dimension, kept so that a lookup does not shuffle them.

A table per key holds the smallest id of each value, bucketed by it. A batch brings the
distinct values it asks for to the buckets; what is found, at most one row per value
asked, goes back to the rows. The dimension itself is neither shuffled nor scanned again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.operators.lookup import BROADCAST_BYTES, all_present, lookup, measured_bytes
from obsflow.scratch import materialise

CITY, COORDINATES = ("city",), ("lat", "long")


def _key(columns: Sequence[str]) -> Column:
    """One text per value; NULL where a part is NULL.

    Doubles go by their text, with one zero, because Spark brings them to a normal form
    before it joins on them, which a bucketed column would not have.
    """
    parts = [F.col(c) if c == "city" else (F.col(c) + F.lit(0.0)).cast("string") for c in columns]
    return F.concat(parts[0], *[x for p in parts[1:] for x in (F.lit(","), p)]) if len(parts) > 1 else parts[0]


@dataclass(frozen=True)
class StoredKeys:
    """The catalogue's tables ``<name>_city`` and ``<name>_coordinates`` under ``path``, in ``buckets`` buckets."""

    spark: SparkSession
    name: str
    path: str
    buckets: int

    def table(self, on: Sequence[str]) -> DataFrame:
        return self.spark.table(self._name(on))

    def _name(self, on: Sequence[str]) -> str:
        return f"{self.name}_{'city' if tuple(on) == CITY else 'coordinates'}"

    def _write(self, rows: DataFrame, on: Sequence[str], mode: str) -> None:
        # One file a bucket: the rows are dealt as the buckets are.
        (
            rows.repartition(self.buckets, "key").write.mode(mode).format("parquet")
            .option("path", f"{self.path}/{self._name(on)}").bucketBy(self.buckets, "key").sortBy("key").saveAsTable(self._name(on))
        )

    def _first_ids(self, locations: DataFrame, on: Sequence[str]) -> DataFrame:
        return locations.where(all_present(on)).groupBy(_key(on).alias("key")).agg(F.min("id").alias("id"))

    def store(self, locations: DataFrame) -> None:
        """Write the keys of all locations (id, city, lat, long), in place of what is there."""
        for on in (CITY, COORDINATES):
            self._write(self._first_ids(locations, on), on, "overwrite")

    def add(self, locations: DataFrame) -> None:
        """Add the keys of new locations. Ids only grow, so a key that is there keeps its id."""
        for on in (CITY, COORDINATES):
            fresh = self._first_ids(locations, on).repartition(self.buckets, "key").join(self.table(on).select("key"), "key", "left_anti")
            self._write(materialise(fresh, "fresh-keys"), on, "append")

    def found(self, rows: DataFrame, on: Sequence[str], out: str) -> DataFrame:
        """(key, ``out``) of the values in ``rows`` that are stored."""
        asked = rows.where(all_present(on)).select(_key(on).alias("key")).distinct()
        # Dealt as the buckets are; else the planner might shuffle the buckets to the shape of distinct().
        asked = asked.repartition(self.buckets, "key")
        return asked.join(self.table(on).hint("merge"), "key").select("key", F.col("id").alias(out))

    def drop(self) -> None:
        """Take the tables out of the catalogue; their files stay."""
        for on in (CITY, COORDINATES):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(on)}")


def lookup_stored_location(
    rows: DataFrame, stored: StoredKeys, out: str = "location_id", *, use_coords: bool = True, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``lookup_location`` against stored keys: the smallest id of the locations that match by city or coordinates.

    What is found is measured: small, it is broadcast and the rows stay where they are.
    """
    names = []
    for on in (CITY, COORDINATES) if use_coords else (CITY,):
        name = f"_by_{on[0]}"
        one = materialise(stored.found(rows, on, name), "found-keys").withColumnRenamed("key", "_key")
        rows = lookup(rows.withColumn("_key", _key(on)), one, ["_key"], broadcast=measured_bytes(one) <= broadcast_bytes).drop("_key")
        names.append(name)
    best = F.least(*names) if len(names) > 1 else F.col(names[0])
    return rows.withColumn(out, best).drop(*names)
