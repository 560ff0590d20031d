"""Lookup against stored, bucketed keys."""

import random
import re

from conftest import plan, rows

from obsflow.operators.keys import lookup_location
from obsflow.operators.stored_keys import CITY, COORDINATES, StoredKeys, lookup_stored_location

PLACES = "id long, city string, lat double, long double"


def texts(df):
    """Rows as text, in which NaN equals NaN."""
    return [repr(r) for r in rows(df)]


def test_equal_to_the_lookup_by_scan(spark, tmp_path):
    rng = random.Random(2)
    value = lambda *some: rng.choice([None, *some])
    made = lambda n: [(i, value("a", "b", "'", ""), value(0.0, -0.0, 1.5, float("nan")), value(0.0, 2.5)) for i in range(n)]
    known, asked = spark.createDataFrame(made(40), PLACES), spark.createDataFrame(made(300), PLACES)
    stored = StoredKeys(spark, "test_places", str(tmp_path / "keys"), 4)
    try:
        stored.store(known.where("id < 15"))
        assert texts(lookup_stored_location(asked, stored)) == texts(lookup_location(asked, known.where("id < 15")))
        stored.add(known.where("id >= 15"))
        stored.add(known.where("id >= 15"))
        for more in ({}, {"broadcast_bytes": 0}):
            assert texts(lookup_stored_location(asked, stored, **more)) == texts(lookup_location(asked, known))
        assert texts(lookup_stored_location(asked, stored, use_coords=False)) == texts(lookup_location(asked, known, use_coords=False))
        assert lookup_stored_location(asked.limit(0), stored).count() == 0
        stored.store(known.limit(0))
        assert {r.location_id for r in lookup_stored_location(asked, stored).collect()} == {None}
    finally:
        stored.drop()


def test_the_dimension_is_not_shuffled(spark, tmp_path, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    known = spark.range(5000).selectExpr("id", "concat('c', id) AS city", "id / 2 AS lat", "id / 3 AS long")
    asked = known.where("id % 7 = 0")
    stored = StoredKeys(spark, "test_plan", str(tmp_path / "keys"), 4)
    try:
        stored.store(known)
        for on in (CITY, COORDINATES):
            text = plan(stored.found(asked, on, "x"))
            join = text[text.index("SortMergeJoin") :]
            stored_side = join[: join.rindex("FileScan parquet")].splitlines()[-4:]
            assert re.search(r"SelectedBucketsCount: 4 out of 4", join)
            assert not any("Exchange" in line for line in stored_side)
            assert stored.found(asked, on, "x").count() == asked.count()
    finally:
        stored.drop()
