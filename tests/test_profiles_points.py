"""Profiles that merge, tables for point reads, and feeds that count what they write."""

import json
import math
import random
from datetime import datetime, timedelta

import pytest
from conftest import plan, rows
from fixtures import current
from pyspark.sql import functions as F

from obsflow.operators import profiles
from obsflow.plans import feeds
from obsflow.schemas import RAW_CURRENT
from obsflow.sinks import points
from obsflow.sinks.tables import write_hour_partitions

START = datetime(2024, 1, 1)
SCHEMA = "at timestamp_ntz, feed string, n long, x double, t string, hour int, m map<string, int>, `a.b` array<int>"


def history(spark, count=4000, seed=5):
    rng = random.Random(seed)
    made = []
    for i in range(count):
        x = rng.choice([None, math.nan, rng.gauss(0, 10), 3.0, 3.0])
        made.append((START + timedelta(minutes=rng.randrange(600)), rng.choice("ab"), i, x, rng.choice([None, "", "u", f"t{i % 700}"]), 1, {"k": i}, [i % 5, None]))
    return spark.createDataFrame(made, SCHEMA), made


def exact(read):
    return {r.column_name: (r.rows, r.rows_with_value, r.low, r.high) for r in read.collect()}


def test_profiles_merge_in_any_order(spark):
    frame, made = history(spark)
    whole = profiles.hour_profiles(frame, "at")
    parts = [profiles.hour_profiles(frame.where(f"n % 3 = {k}"), "at") for k in (2, 0, 1)]
    united = parts[0].unionByName(parts[1]).unionByName(parts[2])
    numbers = [r[3] for r in made if r[3] is not None and r[3] == r[3]]
    for stored in (whole, united, profiles.merge_profiles(united, ["hour"])):
        found = exact(profiles.read_profiles(profiles.merge_profiles(stored)))
        assert found["n"] == (4000, 4000, 0.0, 3999.0)
        assert found["x"] == (4000, sum(r[3] is not None for r in made), min(numbers), max(numbers))
        assert found["t"] == (4000, sum(r[4] is not None for r in made), None, None)
        assert found["hour"] == (4000, 4000, 1.0, 1.0) and found["m"] == (4000, 4000, None, None)
    assert whole.count() == 10 * 7


def test_sketches_keep_their_bounds(spark):
    frame, made = history(spark, 20_000)
    read = profiles.read_profiles(profiles.merge_profiles(profiles.hour_profiles(frame, "at")))
    audit = {r.column_name: r for r in profiles.audit_profiles(frame, read).collect()}
    assert audit["n"].exact_distinct == 20_000 and audit["t"].exact_distinct == len({r[4] for r in made} - {None})
    assert audit["a.b"].exact_distinct == 5 and audit["m"].exact_distinct == 0
    assert max(r.distinct_error for r in audit.values()) <= profiles.DISTINCT_ERROR
    assert max(r.rank_error for r in audit.values() if r.rank_error is not None) <= profiles.RANK_ERROR
    assert audit["t"].rank_error is None and audit["x"].rank_error is not None
    # An audit tells a wrong profile.
    wrong = read.withColumns({"distinct": F.col("distinct") * 2, "quantiles": F.transform("quantiles", lambda q: q + 9000)})
    told = {r.column_name: r for r in profiles.audit_profiles(frame, wrong).collect()}
    assert told["n"].distinct_error > 0.9 and told["n"].rank_error > 0.4


def test_profiles_of_a_range_by_feed_and_of_nothing(spark):
    frame, made = history(spark)
    stored = profiles.hour_profiles(frame, "at", ["x", "t"], ["feed"])
    later = START + timedelta(hours=4)
    ranged = profiles.merge_profiles(stored.where(F.col("hour") >= F.lit(later)), ["feed"])
    assert {(r.feed, r.column_name): r.rows for r in ranged.collect()} == {
        (f, c): sum(r[1] == f and r[0] >= later for r in made) for f in "ab" for c in "xt"
    }
    none = profiles.hour_profiles(frame.limit(0), "at")
    assert none.count() == 0 and profiles.read_profiles(profiles.merge_profiles(none)).count() == 0
    empty = frame.where("x IS NULL").select("at", "x")
    (row,) = profiles.read_profiles(profiles.merge_profiles(profiles.hour_profiles(empty, "at"))).collect()
    assert (row.rows_with_value, row.low, row.distinct, row.quantiles) == (0, None, 0, None)


def test_profiles_are_partial_before_the_shuffle(spark):
    text = plan(profiles.hour_profiles(history(spark, 10)[0], "at"))
    assert "partial_" in text[text.index("Exchange"):] and "Python" not in text


def scanned(df) -> int:
    """Rows that the scan of a file gives after the files' own filters."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_point_reads_skip_row_groups(spark, tmp_path):
    count = 200_000
    frame = spark.range(count).select(
        F.col("id").alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("key"), F.sha2(F.concat(F.lit("x"), "id"), 256).alias("plain")
    )
    path = str(tmp_path / "points")
    points.write_point_table(frame, path, ["at"], ["key"], row_group_bytes=1 << 18)
    pick = lambda column, ids: [frame.where(F.col("at") == i).first()[column] for i in ids]
    for column, ids, most in (("key", [17], 0.2), ("key", [5, 99_000, 199_999], 0.4), ("at", [123_456], 0.1)):
        found = points.read_points(spark, path, frame.schema, column, pick(column, ids))
        assert 0 < scanned(found) < most * count
        assert rows(found) == rows(frame.where(F.col("at").isin(ids)))
    # Without a filter nothing can be skipped; a key that is not there is told by the filter.
    assert scanned(points.read_points(spark, path, frame.schema, "plain", pick("plain", [17]))) == count
    assert scanned(points.read_points(spark, path, frame.schema, "key", ["8" * 64])) < 0.1 * count


def test_point_reads_at_the_edges(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("", 3), ("it's", 4)], "k string, v int")
    path = str(tmp_path / "points")
    assert points.read_points(spark, path, frame.schema, "k", ["a"]).count() == 0
    points.write_point_table(frame, path, ["k", "v"], ["k"])
    read = lambda *values: [r.v for r in points.read_points(spark, path, frame.schema, "k", values).orderBy("v").collect()]
    assert [read("a"), read("", "it's", None, ""), read(None), read()] == [[1, 1], [3, 4], [], []]
    points.write_point_table(frame.limit(0), path, ["k"], ["k"])
    assert read("a") == []
    with pytest.raises(ValueError, match="joined"):
        read(*range(points.MOST_KEYS + 1))


def test_a_write_returns_what_it_wrote(spark, tmp_path):
    frame = spark.range(100).selectExpr("id", "id % 7 AS h")
    path = str(tmp_path / "t")
    assert write_hour_partitions(frame, path, ["h"]) == 100
    assert write_hour_partitions(frame.where("h = 3"), path, ["h"], sort_by=["id"]) == 14
    assert write_hour_partitions(frame.limit(0), path, ["h"]) == 0
    assert spark.read.parquet(path).count() == 100


def test_feeds_run_side_by_side_and_are_read_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    texts = spark.createDataFrame([(json.dumps(current(c)),) for c in "abc"], "t string")
    raw = texts.select(F.from_json("t", RAW_CURRENT).alias("d")).select("d.*")
    raw = raw.mapInPandas(passed, RAW_CURRENT)
    report = feeds.transform_feeds(spark, {"current": raw, "lightning": raw}, str(tmp_path / "out"), datetime(2024, 1, 5, 9))
    assert rows(report.select("method", "status", "rows")) == [("current", "done", 3), ("lightning", "failed", 0)]
    assert seen.value == 3
    assert spark.read.parquet(str(tmp_path / "out/current")).count() == 3
