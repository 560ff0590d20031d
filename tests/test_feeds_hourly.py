import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from conftest import rows
from fixtures import COUNTRY_TEXTS, current, place
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from obsflow.functions.documents import country_records
from obsflow.functions.times import hour_bucket_values, with_hour_bucket
from obsflow.plans import dimensions, feeds, hourly
from obsflow.plans.facts import fact_with_fk
from obsflow.plans.hourly import Lakehouse, run_hour, run_landed_hour
from obsflow.schemas import (
    COUNTRIES,
    LOCATIONS,
    RAW_ASTRONOMY,
    RAW_CURRENT,
    RAW_MARINE,
    RAW_SPORTS,
)
from obsflow.scratch import scratch_root
from obsflow.sinks import tables

RUN = datetime(2024, 1, 1, 9)


def frame(spark, schema, *documents):
    texts = spark.createDataFrame([(json.dumps(d),) for d in documents], "t string")
    return texts.select(F.from_json("t", schema).alias("d")).select("d.*")


def test_current_feed_edges(spark):
    raw = frame(
        spark, RAW_CURRENT,
        current("a"), current(None), current(None, lat=None), current("", lat=None, lon=None),
        current("t", localtime="not a time"),
    )
    got = feeds.process(raw, "current").select("city", "localtime", "condition", "condition_code")
    nine = datetime(2024, 1, 1, 9, 5)
    assert rows(got) == sorted(
        [(c, t, "Sunny", 1000) for c, t in (("a", nine), (None, nine), ("", nine), ("t", None))], key=repr
    )


def test_astronomy_feed(spark):
    astro = {"sunrise": "07:05 AM", "sunset": "5:05 PM", "moonrise": "No moonrise", "moonset": "12:10 AM",
             "moon_phase": "Full", "moon_illumination": "99", "is_moon_up": 1, "is_sun_up": 0}
    raw = frame(
        spark, RAW_ASTRONOMY,
        {"location": place("a"), "astronomy": {"astro": astro}},
        {"location": place(None, lat=None), "astronomy": {"astro": astro}},
    )
    got = feeds.process(raw, "astronomy")
    assert len(got.columns) == 15
    row = got.collect()
    assert len(row) == 1
    assert row[0]["Sunrise"] == datetime(2024, 1, 1, 7, 5)
    assert row[0]["Sunset"] == datetime(2024, 1, 1, 17, 5)
    assert row[0]["Moonrise"] is None
    assert (row[0]["Moon_Up"], row[0]["Moon_Down"]) == (1, 0)


def marine_payload(name, *dates, tides=()):
    days = [
        {
            "date": d, "day": {"maxtemp_c": 9.0, "tides": [{"tide": list(tides)}], "condition": {"code": 1}},
            "astro": {"sunrise": "7:00 AM"},
            "hour": [{"time": f"{d} 0{h}:00", "temp_c": float(h)} for h in range(3)],
        }
        for d in dates
    ]
    return {"location": place(name), "forecast": {"forecastday": days}}


def test_marine_days_stay_with_their_location(spark):
    raw = frame(
        spark, RAW_MARINE,
        marine_payload("a", "2024-01-01", "2024-01-02"), marine_payload("b"),
        marine_payload("c", "2024-01-05", tides=[{"tide_time": "2024-01-05 06:30", "tide_type": "LOW"}]),
    )
    days = feeds.process(raw, "marine")
    assert rows(days.select("City", "Date", "Sunrise")) == [
        ("a", datetime(2024, 1, 1), datetime(2024, 1, 1, 7)),
        ("a", datetime(2024, 1, 2), datetime(2024, 1, 2, 7)),
        ("c", datetime(2024, 1, 5), datetime(2024, 1, 5, 7)),
    ]
    assert feeds.marine_hours(raw).count() == 9
    tides = rows(feeds.marine_tides(raw).select("City", "Date", "Tide_time", "Tide_type"))
    assert tides == [
        ("a", datetime(2024, 1, 1), None, None),
        ("a", datetime(2024, 1, 2), None, None),
        ("c", datetime(2024, 1, 5), datetime(2024, 1, 5, 6, 30), "LOW"),
    ]


def test_sports_union(spark):
    game = lambda m, region="": {"stadium": "s", "region": region, "start": "2024-01-01 15:00", "match": m}
    raw = frame(
        spark, RAW_SPORTS,
        {"football": [game("f1"), game("f2", "N")], "golf": [], "cricket": [game("c1")]},
        {"football": [], "golf": [], "cricket": []},
        {"golf": [game("g1")]},
    )
    got = feeds.process(raw, "sports").select("sport", "match", "region", "start")
    when = datetime(2024, 1, 1, 15)
    assert rows(got) == [
        ("cricket", "c1", None, when), ("football", "f1", None, when),
        ("football", "f2", "N", when), ("golf", "g1", None, when),
    ]


def test_unknown_feed(spark):
    with pytest.raises(ValueError, match="lightning"):
        feeds.process(frame(spark, RAW_CURRENT, current("a")), "lightning")


def test_one_failing_feed_does_not_stop_the_others(spark, tmp_path):
    good = frame(spark, RAW_CURRENT, current("a"), current("b"))
    breaks = good.withColumn("location", F.raise_error(F.lit("unreadable")).cast(RAW_CURRENT["location"].dataType))
    report = feeds.transform_feeds(
        spark,
        {"lightning": good, "sports": good, "astronomy": breaks, "current": good},
        str(tmp_path / "out"),
        RUN,
    )
    assert rows(report.select("method", "status", "rows")) == [
        ("astronomy", "failed", 0), ("current", "done", 2), ("lightning", "failed", 0), ("sports", "failed", 0)
    ]
    assert report.where("status = 'failed' AND error IS NULL").count() == 0


def test_feeds_keep_their_hours_and_a_failing_run_changes_nothing(spark, tmp_path):
    good = frame(spark, RAW_CURRENT, current("a"), current("b"))
    breaks = good.withColumn("location", F.raise_error(F.lit("unreadable")).cast(RAW_CURRENT["location"].dataType))
    out, later = str(tmp_path / "out"), RUN.replace(hour=RUN.hour + 1)
    for raw, when in ((good, RUN), (good.limit(1), later), (breaks, later), (breaks, RUN)):
        feeds.transform_feeds(spark, {"current": raw}, out, when)
    stored = spark.read.parquet(f"{out}/current").groupBy("hour").count()
    assert sorted(map(tuple, stored.collect())) == [(RUN.hour, 2), (later.hour, 1)]
    assert feeds.transform_feeds(spark, {}, out, RUN).count() == 0


def test_large_feeds_are_neither_shuffled_nor_sorted_to_be_written(spark, tmp_path, monkeypatch):
    """Of unknown size, so taken for large: a file per task that has rows. Sorts come with partitionBy."""
    raw = frame(spark, RAW_CURRENT, *[current(f"c{i}") for i in range(90)]).repartition(3)
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda *names: pytest.fail("sorted by partition columns"))
    report = feeds.transform_feeds(spark, {"current": raw}, str(tmp_path), RUN)
    assert rows(report) == [("current", "done", 90, None)]
    assert len(list(tmp_path.glob("current/method=current/year=2024/month=1/day=1/hour=9/*.zstd.parquet"))) == 3
    assert rows(spark.read.parquet(str(tmp_path / "current")).groupBy("method", "year", "hour").count()) == [
        ("current", 2024, 9, 90)
    ]


def test_small_feeds_are_gathered_and_large_ones_keep_to_full_files(spark, tmp_path, monkeypatch):
    spark.range(0, 4000, 1, 40).withColumn("t", F.sha2(F.col("id").cast("string"), 256)).write.parquet(f"{tmp_path}/in")
    hour = with_hour_bucket(spark.read.parquet(f"{tmp_path}/in").repartition(40), "current", F.lit(RUN))
    only = hour_bucket_values("current", RUN)
    for most, fewest, files in ((1 << 30, 1, 1), (1, 30, 40), (1 << 16, 8, 16)):
        monkeypatch.setattr(tables, "GATHERED_BYTES", most)
        path = tmp_path / f"t{most}"
        assert tables.write_hour_partitions(hour, str(path), only=only) == 4000
        assert fewest <= len(list(path.rglob("*.parquet"))) <= files
        assert spark.read.parquet(str(path)).select("id", *only).distinct().count() == 4000


@pytest.mark.parametrize("method", ["current", "air:quality", "x=y", "p/q", "{m}", "a b", "100%", "", None])
def test_one_partition_is_the_one_a_dynamic_overwrite_makes(spark, tmp_path, method):
    bucketed = lambda n, hour: with_hour_bucket(
        spark.range(n), F.lit(method).cast("string"), F.lit(RUN.replace(hour=hour))
    )
    stored = {}
    for way in ("one", "dynamic"):
        path = tmp_path / way
        for n, hour in ((3, 9), (2, 10), (0, 9), (1, 10)):
            only = {"only": hour_bucket_values(method, RUN.replace(hour=hour))} if way == "one" else {}
            assert tables.write_hour_partitions(bucketed(n, hour), str(path), **only) == n
        table = spark.read.parquet(str(path))
        folders = sorted({str(p.parent.relative_to(path)) for p in path.rglob("*.parquet")})
        others = sorted(str(p.relative_to(path)) for p in path.rglob("*") if p.is_file() and p.name[0] != "." and p.suffix != ".parquet")
        stored[way] = rows(table), table.columns, folders, others
    assert stored["one"] == stored["dynamic"]
    assert len(stored["one"][0]) == 4


def test_rows_of_another_hour_fail_the_write(spark, tmp_path):
    path, only = str(tmp_path / "t"), hour_bucket_values("current", RUN)
    bucketed = lambda n: with_hour_bucket(spark.range(n), "current", F.lit(RUN) + F.make_dt_interval(hours=F.col("id")))
    assert tables.write_hour_partitions(bucketed(1), path, only=only) == 1
    with pytest.raises(ValueError, match="2 rows do not belong"):
        tables.write_hour_partitions(bucketed(3), path, only=only)
    assert spark.read.parquet(path).count() == 1
    assert [p.name for p in (tmp_path / "t").iterdir() if p.is_dir()] == ["method=current"]


def raw_with_times(spark, *docs):
    df = frame(spark, RAW_CURRENT, *docs)
    return df.withColumns({
        "method": F.lit("current"), "ingest_ts": F.lit("2024-01-01 09:30:00").cast("timestamp_ntz"),
        "obs_id": F.monotonically_increasing_id(),
    })


def test_a_city_twice_in_an_hour_gives_one_fact(spark, tmp_path):
    raw = raw_with_times(spark, current("a", temp=1.0), current("a", temp=2.0), current("b"))
    facts = run_hour(spark, raw, Lakehouse(str(tmp_path / "h")), payloads(spark), RUN)
    assert sorted(r.temp_c for r in facts.collect()) == [2.0, 20.5]


def test_a_run_leaves_nothing_in_scratch(spark, tmp_path):
    root = Path(scratch_root(spark)) / "obsflow"
    before = set(root.glob("*"))
    run_hour(spark, raw_with_times(spark, current("a")), Lakehouse(str(tmp_path / "h")), payloads(spark), RUN)
    assert set(root.glob("*")) == before


def test_run_time_with_a_zone_is_brought_to_utc(spark, tmp_path):
    zoned = datetime(2024, 1, 1, 9, tzinfo=timezone(timedelta(hours=5)))
    facts = run_hour(spark, raw_with_times(spark, current("a")), Lakehouse(str(tmp_path / "h")), payloads(spark), zoned)
    assert [r.created_at for r in facts.collect()] == [datetime(2024, 1, 1, 4)]


def test_landing_to_facts(spark, tmp_path):
    house = Lakehouse(str(tmp_path / "h"))
    texts = [
        ("current", "x", 9, json.dumps(current("a", temp=1.0))), ("current", "x", 9, json.dumps(current("a", temp=2.0))),
        ("current", "y", 10, json.dumps(current("b"))), ("sports", "x", 9, json.dumps({"golf": []})), ("", "x", 9, "{}"),
    ]
    batch = spark.createDataFrame(
        [(m, c, datetime(2024, 1, 1, h, i), t) for i, (m, c, h, t) in enumerate(texts)],
        "method string, city string, ingest_ts timestamp_ntz, payload string",
    )
    for hour, expected in ((9, [2.0]), (10, [20.5])):
        report = run_landed_hour(spark, batch, house, payloads(spark), datetime(2024, 1, 1, hour))
        methods = [("current", "done")] + [("sports", "done")] * (hour == 9)
        assert rows(report.select("method", "status")) == methods
        facts = spark.read.parquet(house.weathers).where(F.col("hour") == hour)
        assert [r.temp_c for r in facts.collect()] == expected
    assert run_landed_hour(spark, batch, house, payloads(spark), datetime(2024, 1, 1, 11)).count() == 0


def test_every_alias_resolves_now_and_later(spark, tmp_path):
    house = Lakehouse(str(tmp_path / "h"))
    texts = {"Holland": "Holland", "The Netherlands": "Holland", "Chad": "Chad"}
    answers = spark.createDataFrame([(k, COUNTRY_TEXTS[v]) for k, v in texts.items()], "requested_as string, t string")
    first = raw_with_times(spark, current("p", country="Holland"), current("q", lat=7.0, country="The Netherlands"))
    run_hour(spark, first, house, country_records(answers, "t"), RUN)
    second = raw_with_times(spark, current("r", lat=8.0, country="The Netherlands"), current("s", lat=9.0, country="Netherlands"))
    run_hour(spark, second, house, country_records(answers, "t").limit(0), RUN.replace(hour=RUN.hour + 1))
    ids = spark.read.parquet(house.locations).select("city", "country_id")
    assert rows(ids) == [("p", 1), ("q", 1), ("r", 1), ("s", 1)]


def test_named_and_nameless_row_of_one_new_place_give_one_location(spark):
    seen = spark.createDataFrame([("d", "X", "r", 4.0, 2.0, "z"), (None, "X", "r", 4.0, 2.0, "z")], PROCESSED)
    none = spark.createDataFrame([], "id bigint, city string, lat double, long double")
    once = dimensions.new_locations(seen, none, spark.createDataFrame([], "id bigint, name string"), RUN)
    assert rows(once.select("city")) == [("d",)]


def payloads(spark):
    texts = spark.createDataFrame(list(COUNTRY_TEXTS.items()), "requested_as string, t string")
    return country_records(texts, "t")


def test_missing_countries_are_inserted_once_under_their_own_name(spark):
    seen = spark.createDataFrame(
        [(c,) for c in ("Chad", "Chad", "Holland", "Netherlands", "Atlantis", None)], "country string"
    )
    none = spark.createDataFrame([], COUNTRIES)
    got = dimensions.insert_missing_countries(seen, none, payloads(spark), RUN)
    assert rows(got.select("name", "capital", "language", "tz_utc", "requested_as")) == [
        ("Chad", "NDjamena", "Arabic, French", "+01:00", "Chad"),
        ("Netherlands", "Amsterdam", "Dutch", "+01:00", "Holland"),
    ]
    stored = got.select(F.lit(1).cast("bigint").alias("id"), *got.columns)
    assert dimensions.insert_missing_countries(seen, stored, payloads(spark), RUN).count() == 0


PROCESSED = "city string, country string, region string, lat double, long double, tz_id string"


def test_new_locations_dedup_and_reference_rows(spark):
    seen = spark.createDataFrame(
        [
            ("known", "Chad", "r", 9.0, 9.0, "z"),
            ("alias", "Chad", "r", 1.0, 1.0, "z"),
            ("fresh", "Chad", "", None, 5.0, "z"),
            ("fre'sh", "Chad", "r", 7.0, 7.0, "z"),
            ("", "Chad", "r", 8.0, 8.0, "z"),
            (None, "X", "r", 8.0, 8.0, "z"),
        ],
        PROCESSED,
    )
    stored = spark.createDataFrame([(4, "known", 1.0, 1.0)], "id bigint, city string, lat double, long double")
    countries = spark.createDataFrame([(3, "Chad")], "id bigint, name string")
    columns = ["city", "region", "lat", "long", "country_id"]
    every = dimensions.new_locations(seen, stored, countries, RUN, dedup=False)
    assert rows(every.select(*columns)) == sorted(
        [
            ("fresh", None, None, 5.0, 3), ("fresh", "r", 7.0, 7.0, 3),
            (None, "r", 8.0, 8.0, 3), (None, "r", 8.0, 8.0, None),
        ],
        key=repr,
    )
    once = dimensions.new_locations(seen, stored, countries, RUN)
    assert rows(once.select(*columns)) == sorted(
        [("fresh", "r", 7.0, 7.0, 3), (None, "r", 8.0, 8.0, 3)], key=repr
    )
    numbered = dimensions.assign_ids(once, stored, dimensions.LOCATION_ORDER)
    assert rows(numbered.select("id", "city")) == [(5, None), (6, "fresh")]


def test_facts_are_keyed_by_city_only_unless_asked(spark):
    raw = frame(spark, RAW_CURRENT, current("a'"), current(None, lat=5.0), current("zzz"))
    stored = spark.createDataFrame(
        [(1, "a", 0.0, 0.0), (2, None, 5.0, 2.0)], "id bigint, city string, lat double, long double"
    )
    seen = feeds.current_feed(raw)
    keyed = fact_with_fk(seen, stored, RUN)
    assert len(keyed.columns) == 17
    assert rows(keyed.select("location_id")) == sorted([(1,), (None,), (None,)], key=repr)
    by_coords = fact_with_fk(seen, stored, RUN, use_coords=True)
    assert by_coords.columns == keyed.columns
    assert rows(by_coords.select("location_id")) == sorted([(1,), (2,), (None,)], key=repr)


def test_three_hours_end_to_end(spark, tmp_path):
    house = Lakehouse(str(tmp_path / "house"))
    hours = [datetime(2024, 1, 1, h) for h in (9, 10, 11)]
    batches = [
        [current("a"), current("b'b", lat=3.0, country="Holland"), current(None, lat=None)],
        [current("a", temp=1.0), current("renamed", lat=3.0), current("d", lat=4.0, country="Atlantis")],
        [current("d", lat=4.0), current(None, lat=4.0), current("", lat=6.0, weather={"wind_dir": ""})],
    ]
    files = lambda: sorted(f.name for t in ("locations", "countries") for f in (tmp_path / "house" / t).glob("*.parquet"))
    for hour, batch in zip(hours, batches):
        raw = frame(spark, RAW_CURRENT, *batch)
        first = rows(run_hour(spark, raw, house, payloads(spark), hour))
        stored = files()
        again = rows(run_hour(spark, raw, house, payloads(spark), hour))
        assert first == again
        assert files() == stored

    read = lambda path, *columns: rows(spark.read.parquet(path).select(*columns))
    assert read(house.countries, "id", "name", "requested_as") == [
        (1, "Chad", "Chad"), (2, "Netherlands", "Holland")
    ]
    assert read(house.locations, "id", "city", "lat", "country_id", "created_at") == [
        (1, "a", 1.0, 1, hours[0]),
        (2, "bb", 3.0, 2, hours[0]),
        (3, "d", 4.0, None, hours[1]),
        (4, None, 6.0, 1, hours[2]),
    ]
    facts = spark.read.parquet(house.weathers)
    assert sorted(map(tuple, facts.groupBy("hour").count().collect())) == [(9, 2), (10, 3), (11, 3)]
    assert rows(facts.where("hour = 10").select("location_id", "temp_c", "created_at")) == sorted(
        [(1, 1.0, hours[1]), (3, 20.5, hours[1]), (None, 20.5, hours[1])], key=repr
    )
    assert rows(facts.where("hour = 11").select("location_id", "wind_dir")) == sorted(
        [(3, "E"), (None, "E"), (None, None)], key=repr
    )
    assert spark.read.parquet(house.locations).select(*LOCATIONS.names).count() == 4


def test_run_without_payloads_raises(spark, tmp_path):
    raw = frame(spark, RAW_CURRENT, current(None, lat=None))
    with pytest.raises(ValueError, match="no data landed"):
        run_hour(spark, raw, Lakehouse(str(tmp_path / "h")), payloads(spark), RUN)


def test_rows_of_a_run_are_not_shuffled_to_be_written(spark, tmp_path, monkeypatch):
    """The last payloads and the facts are written as they lie; payloads from files of any size are gathered."""
    written = []
    write = hourly.write_hour_partitions
    monkeypatch.setattr(hourly, "write_hour_partitions", lambda df, path, **how: written.append((Path(path).name, how.get("gathered", False))) or write(df, path, **how))
    raw = raw_with_times(spark, current("a"), current("b"))
    run_hour(spark, raw, Lakehouse(str(tmp_path / "h")), payloads(spark), RUN)
    run_hour(spark, raw.drop("ingest_ts"), Lakehouse(str(tmp_path / "i")), payloads(spark), RUN)
    assert written == [("processed", True), ("weathers", True), ("processed", False), ("weathers", True)]
    hour = with_hour_bucket(spark.range(90).repartition(3), "current", F.lit(RUN))
    for gathered, files in ((False, 1), (True, 3)):
        path = tmp_path / f"t{gathered}"
        assert tables.write_hour_partitions(hour, str(path), gathered=gathered) == 90
        assert len(list(path.rglob("*.parquet"))) == files
