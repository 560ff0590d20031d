from collections import Counter

import pytest
from conftest import rows
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsflow.operators import keys
from obsflow.operators.lookup import first_id_by, frequent_keys, lookup, measured_bytes

CITY = st.sampled_from([None, "", "a", "b", "c"])
COORD = st.sampled_from([None, 0.0, -0.0, 1.5, float("nan")])
ROW = st.tuples(CITY, COORD, COORD)


def brute_force(seen, stored):
    def equal(a, b):
        # Spark's equality: NaN equals NaN; NULL equals nothing.
        return a is not None and b is not None and (a == b or (a != a and b != b))

    ids = []
    for city, lat, long in seen:
        hits = [
            i for i, (c, x, y) in enumerate(stored)
            if equal(city, c) or (equal(lat, x) and equal(long, y))
        ]
        ids.append(min(hits, default=None))
    return ids


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
@given(seen=st.lists(ROW, max_size=12), stored=st.lists(ROW, max_size=8))
@hypothesis_settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
def test_lookup_location_equals_brute_force(spark, broadcast_bytes, seen, stored):
    place = "city string, lat double, long double"
    facts = spark.createDataFrame([(n, *r) for n, r in enumerate(seen)], f"n int, {place}")
    dim = spark.createDataFrame([(n, *r) for n, r in enumerate(stored)], f"id bigint, {place}")
    got = keys.lookup_location(facts, dim, "found", broadcast_bytes=broadcast_bytes)
    by_row = {r.n: r.found for r in got.select("n", "found").collect()}
    assert [by_row[n] for n in range(len(seen))] == brute_force(seen, stored)


def test_city_only_and_coords_only(spark):
    facts = spark.createDataFrame([("a", 1.0, 2.0)], "city string, lat double, long double")
    dim = spark.createDataFrame(
        [(5, "a", None, None), (3, "z", 1.0, 2.0)], "id bigint, city string, lat double, long double"
    )
    look = lambda **kw: keys.lookup_location(facts, dim, **kw).first()["location_id"]
    assert look() == 3
    assert look(use_coords=False) == 5
    assert look(use_city=False) == 3


def test_country_answers_to_the_name_it_was_requested_by(spark):
    dim = spark.createDataFrame(
        [(1, "Iran", "Persia"), (2, "Chad", None), (0, "Iran", None)],
        "id bigint, name string, requested_as string",
    )
    facts = spark.createDataFrame([("Persia",), ("Iran",), ("Chad",), ("X",), (None,)], "country string")
    got = rows(keys.lookup_country(facts, dim))
    assert got == sorted([("Persia", 1), ("Iran", 0), ("Chad", 2), ("X", None), (None, None)], key=repr)


def test_fill_from_dimension(spark):
    place = "city string, lat double, long double"
    dim = spark.createDataFrame([(1, "a", 1.0, 2.0)], f"id bigint, {place}")
    facts = spark.createDataFrame([("a", None, None), (None, 1.0, 2.0), ("q", None, 3.0)], place)
    expected = sorted([("a", 1.0, 2.0), ("a", 1.0, 2.0), ("q", None, 3.0)], key=repr)
    assert rows(keys.fill_from_dimension(facts, dim)) == expected
    assert rows(keys.fill_from_dimension(facts, dim, broadcast_bytes=0)) == expected


def test_key_exists(spark):
    dim = spark.createDataFrame([("a",), ("a",), (None,)], "city string")
    known = spark.createDataFrame([("a",), ("b",), (None,)], "city string")
    assert rows(keys.key_exists(known, dim, "city")) == sorted(
        [("a", True), ("b", False), (None, False)], key=repr
    )


def test_measured_bytes_grows_with_rows_and_text(spark):
    assert measured_bytes(spark.createDataFrame([], "a string, b bigint")) == 0
    short = measured_bytes(spark.createDataFrame([("x", 1)], "a string, b bigint"))
    assert measured_bytes(spark.createDataFrame([("x" * 100, 1)], "a string, b bigint")) == short + 99
    assert measured_bytes(spark.createDataFrame([("x", 1)] * 3, "a string, b bigint")) == 3 * short


def test_skewed_keys_are_spread_over_the_shuffle(spark, settings):
    """A third of the rows on one key and a third on NULL: no task gets either whole."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
    )
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id"))
    facts = spark.range(0, n, 1, 16).select("id", key.alias("k"))
    dim = spark.range(0, n, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).union(
        spark.createDataFrame([(7, 70)], "k bigint, v bigint")
    )
    got = lookup(facts, dim, ["k"], broadcast=False, hot_keys=5)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < n / 3
    plain = facts.join(dim, "k", "left")
    uneven = [r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()]
    assert max(uneven) >= n / 3
    assert Counter(map(tuple, got.select("id", "k", "v").collect())) == Counter(
        map(tuple, plain.select("id", "k", "v").collect())
    )


def test_frequent_keys_lists_the_largest(spark):
    df = spark.createDataFrame([(k,) for k in "aaabbc"] + [(None,)] * 9, "k string")
    assert [r.k for r in frequent_keys(df, ["k"], 2).collect()] == ["a", "b"]


def test_first_id_by_skips_null_keys(spark):
    dim = spark.createDataFrame([(2, "a"), (1, "a"), (0, None)], "id bigint, city string")
    assert first_id_by(dim, ["city"], "id", "first").collect() == [("a", 1)]
