import json
import os
import re
from datetime import datetime
from pathlib import Path

import pytest
from conftest import plan, rows
from fixtures import current
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from obsflow import scratch
from obsflow.functions.times import with_hour_bucket
from obsflow.plans.feeds import current_feed
from obsflow.schemas import HOUR_BUCKET, LOCATIONS, RAW_CURRENT
from obsflow.schemas import bucketed as bucketed_schema
from obsflow.sinks import tables
from obsflow.sources import landing, requests
from obsflow.streaming.incremental import incremental_load


def write_documents(folder: Path, **documents):
    folder.mkdir(parents=True, exist_ok=True)
    for name, doc in documents.items():
        body = doc if isinstance(doc, str) else json.dumps(doc, indent=2)
        (folder / f"{name}.json").write_text(body)


def test_scan_reads_pretty_printed_documents_and_keeps_corrupt_ones(spark, tmp_path):
    folder = tmp_path / "raw"
    write_documents(folder, a=current("a"), b=current(None, lat=None), c="{oops")
    scanned = landing.scan_json(spark, str(folder), RAW_CURRENT)
    assert scanned.count() == 3
    got = scanned.select("location.name", "location.lat", (F.col(landing.CORRUPT).isNotNull()))
    assert rows(got) == sorted([("a", 1.0, False), (None, None, False), (None, None, True)], key=repr)


def test_scan_of_several_documents_in_one_file(spark, tmp_path):
    folder = tmp_path / "raw"
    write_documents(folder, many=[current("a"), current("b")])
    scanned = landing.scan_json(spark, str(folder), RAW_CURRENT)
    assert rows(scanned.select("location.name")) == [("a",), ("b",)]


def test_declared_schema_keeps_columns_that_no_document_has(spark, tmp_path):
    write_documents(tmp_path / "raw", a=current("a"))
    row = current_feed(landing.scan_json(spark, str(tmp_path / "raw"), RAW_CURRENT)).first()
    assert row["vis_km"] is None
    assert row["localtime"] == datetime(2024, 1, 1, 9, 5)
    assert len(row) == 23


def test_city_map(spark, tmp_path):
    path = tmp_path / "cities.json"
    path.write_text('{\n  "Australia": "Canberra",\n  "Australia2": "Perth",\n  "Chad": "N\'Djamena"\n}')
    cities = landing.read_city_map(spark, str(path))
    assert rows(cities) == [("Australia", "Canberra"), ("Australia2", "Perth"), ("Chad", "N'Djamena")]


def test_request_grid_keeps_duplicates_and_needs_no_join(spark):
    cities = spark.createDataFrame([("a",), ("b",), ("a",)], "city string")
    grid = requests.request_grid(cities)
    assert grid.count() == 12
    assert grid.where("city = 'a' AND method = 'marine'").count() == 2
    assert "Join" not in plan(grid)


def test_missing_payloads(spark):
    grid = requests.request_grid(spark.createDataFrame([("a",), ("b",)], "city string"), ["x", "y"])
    landed = spark.createDataFrame([("x", "a"), ("x", "a"), ("y", "b")], "method string, city string")
    assert rows(requests.missing_payloads(grid, landed)) == [("x", "b"), ("y", "a")]


def bucketed(spark, *data):
    df = spark.createDataFrame(
        [(c, datetime(2024, 1, 1, h, m), v) for c, h, m, v in data], "city string, ts timestamp_ntz, v int"
    )
    return df.withColumn("method", F.lit("current"))


def test_land_raw_keeps_the_last_payload_and_replaces_only_its_hours(spark, tmp_path):
    path = str(tmp_path / "land")
    land = lambda *data: tables.land_raw(bucketed(spark, *data), path, ts="ts", tie=["v"])
    land(("a", 1, 0, 1), ("a", 1, 30, 2), ("b", 1, 0, 3), ("a", 2, 0, 4))
    read = lambda: rows(spark.read.parquet(path).select("city", "hour", "v"))
    assert read() == [("a", 1, 2), ("a", 2, 4), ("b", 1, 3)]
    # A later batch replaces the payloads it brings again and leaves the others.
    for _ in range(2):
        land(("a", 1, 0, 7), ("c", 2, 5, 9))
        assert read() == [("a", 1, 7), ("a", 2, 4), ("b", 1, 3), ("c", 2, 9)]


@pytest.mark.parametrize("method", ["current", "air:quality", "x=y", "p/q", "{m}", "a b", "100%", "", None])
def test_a_second_batch_of_an_hour_keeps_the_first(spark, tmp_path, method):
    path = str(tmp_path / "land")
    for city in ("a", "b"):
        batch = bucketed(spark, (city, 1, 0, 1)).withColumn("method", F.lit(method).cast("string"))
        tables.land_raw(batch, path, ts="ts")
    assert rows(spark.read.parquet(path).select("city")) == [("a",), ("b",)]
    schema = spark.read.parquet(path).drop(*HOUR_BUCKET).schema
    found = landing.read_hour_bucket(spark, path, bucketed_schema(schema), method, datetime(2024, 1, 1, 1))
    assert rows(found.select("city")) == [("a",), ("b",)]


def test_merge_with_and_without_times(spark, tmp_path):
    path = str(tmp_path / "land")
    no_time = bucketed(spark, ("a", 1, 0, 1), ("x", 1, 0, 9)).withColumn(
        "ts", F.when(F.col("city") == "a", F.col("ts"))
    )
    tables.land_raw(no_time, path, ts="ts")
    tables.land_raw(no_time.withColumns({"city": F.lit("b")}).where("v = 9"), path, ts="ts")
    tables.land_raw(bucketed(spark, ("c", 1, 0, 2), ("c", 2, 0, 3), ("x", 3, 0, 4)), path, ts="ts")
    got = rows(spark.read.parquet(path).select("city", "hour", "v"))
    assert got == sorted(
        [("a", 1, 1), ("b", None, 9), ("c", 1, 2), ("c", 2, 3), ("x", 3, 4), ("x", None, 9)], key=repr
    )


def test_merge_of_many_partitions_prunes_by_time(spark, tmp_path):
    path = str(tmp_path / "land")
    tables.land_raw(bucketed(spark, *[("a", h, 0, h) for h in range(6)]), path, ts="ts")
    batch = with_hour_bucket(bucketed(spark, ("a", 3, 0, 1), ("a", 4, 0, 1)), "current", F.col("ts"))
    found = tables._stored_rows(batch, path, HOUR_BUCKET, "parquet")
    assert sorted(r.hour for r in found.collect()) == [3, 4]
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(found)).group(1)
    assert "year" in filters and "hour" in filters


def test_merge_reads_and_writes_only_the_hours_of_the_batch(spark, tmp_path):
    path = tmp_path / "land"
    tables.land_raw(bucketed(spark, ("a", 1, 0, 1), ("a", 2, 0, 1)), str(path), ts="ts")
    files = lambda hour: {f.name for f in path.glob(f"*/*/*/*/hour={hour}/*.parquet")}
    before = files(1), files(2)
    tables.land_raw(bucketed(spark, ("b", 2, 0, 1)), str(path), ts="ts")
    assert files(1) == before[0]
    assert files(2) != before[1]


def test_land_raw_as_json(spark, tmp_path):
    path = str(tmp_path / "land")
    tables.land_raw(bucketed(spark, ("a", 1, 0, 1)), path, ts="ts", fmt="json")
    assert (tmp_path / "land/method=current/year=2024/month=1/day=1/hour=1").is_dir()
    assert spark.read.json(path).first()["city"] == "a"


def test_land_raw_minute_keeps_one_per_minute(spark, tmp_path):
    path = str(tmp_path / "land")
    tables.land_raw_minute(
        bucketed(spark, ("a", 1, 0, 1), ("a", 1, 0, 2), ("a", 1, 1, 3)), path, ts="ts", tie=["v"]
    )
    got = rows(spark.read.parquet(path).select("minute_bucket", "v"))
    assert got == [("202401010100", 2), ("202401010101", 3)]


def test_hour_bucket_scan_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "land")
    tables.land_raw(bucketed(spark, ("a", 1, 0, 1), ("b", 2, 0, 2)), path, ts="ts")
    landed = spark.read.parquet(path)
    scan = landing.hour_bucket_scan(landed, "current", datetime(2024, 1, 1, 2, 59))
    assert [r.city for r in scan.collect()] == ["b"]
    text = plan(scan)
    filters = text[text.index("PartitionFilters"):].split("PushedFilters")[0]
    for part in HOUR_BUCKET:
        assert part in filters
    missing = datetime(2024, 1, 1, 5)
    assert landing.hour_bucket_scan(landed, "current", missing).count() == 0
    with pytest.raises(ValueError, match="no data landed"):
        landing.hour_bucket_scan(landed, "current", missing, strict=True)


def test_read_hour_bucket_goes_to_its_folder(spark, tmp_path):
    path = str(tmp_path / "land")
    tables.land_raw(bucketed(spark, ("a", 1, 0, 1), ("b", 2, 0, 2)), path, ts="ts")
    schema = spark.read.parquet(path).schema
    when = datetime(2024, 1, 1, 2)
    direct = landing.read_hour_bucket(spark, path, schema, "current", when)
    scanned = landing.hour_bucket_scan(spark.read.parquet(path), "current", when)
    assert rows(direct) == rows(scanned) and direct.columns == scanned.columns
    assert all("hour=2" in f for f in direct.inputFiles())
    nothing = datetime(2025, 1, 1)
    assert landing.read_hour_bucket(spark, path, schema, "current", nothing).count() == 0
    with pytest.raises(ValueError, match="no data landed"):
        landing.read_hour_bucket(spark, path, schema, "current", nothing, strict=True)


def test_large_bucket_is_split_over_files(spark, settings, tmp_path):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    path = str(tmp_path / "t")
    df = spark.range(0, 60_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 6).cast("int").alias("hour"),
    )
    tables.write_hour_partitions(df, path, ["hour"])
    assert len(list((tmp_path / "t/hour=1").glob("*.parquet"))) > 2
    assert spark.read.parquet(path).count() == 60_000


def test_one_large_hour_is_split_over_files(spark, settings, tmp_path):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    df = spark.range(0, 60_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("text"))
    hour = with_hour_bucket(df, "current", F.lit("2024-01-01 05:00:00").cast("timestamp_ntz"))
    tables.write_hour_partitions(hour, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("*/*/*/*/hour=5/*.parquet"))) > 2


def test_read_table_that_was_never_written(spark, tmp_path):
    path = str(tmp_path / "none")
    assert landing.read_table(spark, path, LOCATIONS).columns == LOCATIONS.names
    with pytest.raises(AnalysisException):
        landing.read_table(spark, path)


def test_scratch_follows_the_session(spark, tmp_path):
    assert scratch.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_incremental_load_takes_each_file_once(spark, tmp_path):
    folder = tmp_path / "drops"
    target, marks = str(tmp_path / "out"), str(tmp_path / "marks")
    plan_ = lambda raw: with_hour_bucket(current_feed(raw), "current", F.col("localtime"))
    run = lambda: incremental_load(
        spark, str(folder), RAW_CURRENT, target, marks, plan=plan_, keys=["city"], order=[F.desc("temp_c")]
    )
    read = lambda: rows(spark.read.parquet(target).select("city", "temp_c"))
    write_documents(folder, a=current("a"), nowhere=current(None, lat=None))
    run()
    assert read() == [("a", 20.5)]
    run()
    assert read() == [("a", 20.5)]
    write_documents(folder, b=current("b", temp=1.0), c=current("c"), torn="{oops")
    long_ago = datetime(2001, 1, 1).timestamp()
    os.utime(folder / "c.json", (long_ago, long_ago))
    for _ in range(2):
        run()
        assert read() == [("a", 20.5), ("b", 1.0), ("c", 20.5)]
    aside = spark.read.parquet(f"{target}-corrupt")
    assert [r.file.endswith("torn.json") for r in aside.collect()] == [True]
    assert (tmp_path / "out/method=current/year=2024/month=1/day=1/hour=9").is_dir()


def test_incremental_load_of_a_landing_that_rewrites_its_hours(spark, tmp_path):
    land, target, marks = (str(tmp_path / n) for n in ("land", "out", "marks"))
    schema = bucketed_schema(bucketed(spark, ("a", 1, 0, 1)).drop("method").schema)
    load = lambda: incremental_load(
        spark, land, schema, target, marks, plan=lambda r: r, keys=["city"], order=[F.desc("v")], multi_line=False
    )
    for data in ([("a", 1, 0, 1)], [("b", 1, 0, 2)], [("a", 1, 1, 3)]):
        tables.land_raw(bucketed(spark, *data), land, ts="ts", fmt="json")
        load()
    assert rows(spark.read.parquet(target).select("city", "v")) == [("a", 3), ("b", 2)]


def test_missing_in_one_hour(spark):
    grid = requests.request_grid(spark.createDataFrame([("a",), ("b",)], "city string"), ["current"])
    landed = with_hour_bucket(bucketed(spark, ("a", 1, 0, 1), ("b", 2, 0, 1)), "current", F.col("ts"))
    assert rows(requests.missing_in_hour(grid, landed, datetime(2024, 1, 1, 2))) == [("current", "a")]


def test_a_merge_computes_its_batch_twice_at_most(spark, tmp_path):
    """Once for the partitions it touches and once for its rows."""
    computed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    texts = [("current", 2024, 1, 5, h, f"city{k}", h * k) for h in range(3) for k in range(4)]
    by = ["method", "year", "month", "day", "hour"]
    frame = spark.createDataFrame(texts, "method string, year int, month int, day int, hour int, city string, n int").coalesce(1)
    for _ in range(2):  # the second time there is something stored
        computed.value = 0
        tables.merge_rows(frame.mapInArrow(counted, frame.schema), str(tmp_path / "t"), by, [*by, "city"], [F.desc("n")])
        assert computed.value <= 2 * len(texts)
    assert spark.read.parquet(str(tmp_path / "t")).count() == len(texts)
