from datetime import datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from obsflow.operators.latest import first_per_key, latest_per_city_hour
from obsflow.operators.rownum import head_rows, row_index

COLUMNS = (
    "obs_id int, ingest_ts timestamp_ntz, method string, year int, month int, day int, hour int, "
    "city string, lat double, long double"
)


def obs(spark, *data):
    return spark.createDataFrame(
        [(i, datetime(2024, 1, 1, 0, m), "current", 2024, 1, 1, h, c, la, lo)
         for i, m, h, c, la, lo in data],
        COLUMNS,
    )


def test_last_write_wins_with_ties(spark):
    df = obs(
        spark,
        (1, 5, 0, "a", 1.0, 1.0), (2, 9, 0, "a", None, None), (3, 9, 0, "a", 2.0, 2.0),
        (4, 1, 1, "a", 1.0, 1.0),
        (5, 1, 0, None, 1.0, 1.0), (6, 2, 0, None, 1.0, 1.0), (7, 1, 0, None, 2.0, 1.0),
    )
    assert [r[0] for r in rows(latest_per_city_hour(df).select("obs_id"))] == [3, 4, 6, 7]


def test_keys_are_pruned_before_the_shuffle(spark):
    text = plan(latest_per_city_hour(obs(spark)))
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below


def test_first_per_key_on_a_hot_key(spark):
    df = spark.range(0, 9000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    )
    kept = first_per_key(df, ["k"], [F.desc("id")])
    assert kept.count() == 6001
    assert kept.where("k = -1").first()["id"] == 8997


@pytest.mark.parametrize("partitions", [1, 7])
def test_row_index_is_dense_and_ordered(spark, settings, partitions):
    settings(spark__sql__shuffle__partitions=str(partitions))
    # A third of the rows share the leading value.
    df = spark.range(0, 5000, 1, 5).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11).alias("a"), F.col("id").alias("b")
    )
    got = [tuple(r) for r in row_index(df, ["a", "b"], start=10).collect()]
    expected = sorted((r.a, r.b) for r in df.collect())
    assert sorted(got, key=lambda r: r[2]) == [(a, b, 10 + i) for i, (a, b) in enumerate(expected)]


def test_row_index_spreads_a_frequent_leading_value(spark):
    df = spark.range(0, 8000, 1, 4).select(F.lit(1).alias("a"), "id")
    placed = df.repartitionByRange(8, "a", "id").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in placed.collect()) < 4000


def test_row_index_of_nothing(spark):
    assert row_index(spark.range(0), ["id"]).count() == 0


def test_head_rows_is_a_top_n(spark):
    df = spark.range(100)
    top = head_rows(df, [F.desc("id")], 3)
    assert [r.id for r in top.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in plan(top)
