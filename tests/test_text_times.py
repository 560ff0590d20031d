from datetime import datetime, timezone

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from obsflow.functions import documents, text, times
from obsflow.schemas import STRING, struct


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "value, expected",
    [("", None), (None, None), ("'", ""), ("St. John's", "St. Johns"), ("a''b'", "ab"), (" ", " ")],
)
def test_clean_name_empties_first_then_strips(spark, value, expected):
    assert one(spark, text.clean_name(F.lit(value).cast("string"))) == expected


@pytest.mark.parametrize(
    "value, expected", [("UTC+01:00", "+01:00"), ("UTC", ""), ("UTCUTC-3", "-3"), ("", "")]
)
def test_strip_utc(spark, value, expected):
    assert one(spark, text.strip_utc(F.lit(value))) == expected


def test_first_or_empty(spark):
    assert one(spark, text.first_or_empty(F.array(F.lit("a"), F.lit("b")))) == "a"
    assert one(spark, text.first_or_empty(F.array().cast("array<string>"))) == ""
    assert one(spark, text.first_or_empty(F.lit(None).cast("array<string>"))) == ""


def test_map_values_joined(spark):
    languages = F.create_map(F.lit("a"), F.lit("Ki'che"), F.lit("b"), F.lit("[x]"))
    assert one(spark, text.map_values_joined(languages)) == "Kiche, x"
    assert one(spark, text.map_values_joined(F.lit(None).cast("map<string,string>"))) == ""


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2023-12-23 14:30", datetime(2023, 12, 23, 14, 30)),
        ("2023-12-23 9:05", datetime(2023, 12, 23, 9, 5)),
        ("bad", None),
        ("", None),
        (None, None),
        ("2023-13-01 00:00", None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_as_wall_clock(spark, settings, zone, value, expected):
    settings(spark__sql__session__timeZone=zone)
    assert one(spark, times.as_wall_clock(F.lit(value).cast("string"))) == expected


@pytest.mark.parametrize(
    "clock, expected",
    [
        ("7:05 AM", datetime(2024, 3, 10, 7, 5)),
        ("07:05 AM", datetime(2024, 3, 10, 7, 5)),
        ("2:30 AM", datetime(2024, 3, 10, 2, 30)),
        ("12:00 AM", datetime(2024, 3, 10, 0, 0)),
        ("12:15 PM", datetime(2024, 3, 10, 12, 15)),
        ("No moonrise", None),
        ("", None),
        (None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_clock_ignores_session_zone(spark, settings, zone, clock, expected):
    # 2:30 on this day does not exist on a New York clock.
    settings(spark__sql__session__timeZone=zone)
    day = F.lit("2024-03-10").cast("timestamp_ntz")
    assert one(spark, times.parse_clock(day, F.lit(clock).cast("string"))) == expected


def test_hour_bucket_is_not_padded(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-05 03:04:59' AS ts")
    row = times.with_hour_bucket(df, "current", F.col("ts")).select(
        times.hour_bucket_path(root="r"), times.minute_bucket(F.col("ts")), times.iso_seconds(F.col("ts"))
    )
    assert rows(row) == [("r/current/2024/1/5/3", "202401050304", "2024-01-05T03:04:59")]


def test_run_time_keeps_kind_of_datetime(spark):
    naive = times.audit_stamp(spark.range(1), datetime(2024, 1, 1, 5))
    aware = times.audit_stamp(spark.range(1), datetime(2024, 1, 1, 5, tzinfo=timezone.utc))
    assert dict(naive.dtypes)["created_at"] == "timestamp_ntz"
    assert dict(aware.dtypes)["created_at"] == "timestamp"
    assert naive.first()["created_at"] == datetime(2024, 1, 1, 5)


def test_rows_to_json_omits_or_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert documents.rows_to_json(df).first()[0] == '{"a":1}'
    assert documents.rows_to_json(df, keep_nulls=True).first()[0] == '{"a":1,"b":null}'


def test_json_round_trip(spark):
    schema = struct(("a", STRING), ("b", STRING))
    df = spark.createDataFrame([("x", None), (None, "y'")], schema)
    back = documents.json_to_rows(documents.rows_to_json(df, "t"), "t", schema)
    assert rows(back) == rows(df)


def test_country_record_edges(spark):
    payloads = [
        (1, '[{"name":{"common":"Cote d\'Ivoire"},"continents":["Africa"],"timezones":["UTC+01:00"],'
            '"subregion":"Western Africa","languages":{"fra":"French","x":"O\'x"},"capital":["Yam\'o"]}]'),
        (2, '[{"name":{},"continents":[],"capital":[]}]'),
        (3, '[{"timezones":["UTC"]}]'),
    ]
    df = spark.createDataFrame(payloads, "k int, p string")
    got = documents.country_records(df, "p").select(
        "k", "continent", "tz_utc", "name", "region", "language", "capital"
    )
    assert rows(got) == [
        (1, "Africa", "+01:00", "Cote dIvoire", "Western Africa", "French, Ox", "Yamo"),
        (2, "", "", "", "", "", ""),
        (3, "", "", "", "", "", ""),
    ]


def test_plain_clocks_agree_with_the_parser(spark):
    """The short way and the parser give the same for any text, and the parser sees no plain or hopeless one."""
    texts = ["7:05 AM", "07:05 AM", "12:00 AM", "12:00 PM", "1:59 PM", "11:30 am", "0:30 AM", "00:30 PM", "13:00 PM", "7:60 AM",
             "7:5 AM", "7:05AM", "7:05  AM", " 7:05 AM", "7:05 AM ", "007:05 AM", "7:05 AM\n", "No moonrise", "", ":", "é:00 AM", None]
    days = ["2024-03-10 02:30:00", "2024-02-29 23:59:59", "0001-01-01 00:00:00", "9999-12-31 12:00:00", None]
    frame = spark.createDataFrame([(d, t) for d in days for t in texts], "d string, t string")
    frame = frame.withColumn("d", F.col("d").cast("timestamp_ntz"))
    both = frame.select("d", "t", times.parse_clock(F.col("d"), F.col("t")).alias("short"), times._parsed_clock(F.col("d"), F.col("t")).alias("long"))
    assert [tuple(r) for r in both.where("NOT short <=> long").collect()] == []
    assert both.where("short IS NOT NULL").count() >= 4 * 5
    # A text without a colon is settled ahead of the parser: nothing is parsed to refuse it.
    text = plan(frame.where("t = 'No moonrise'").select(times.parse_clock(F.col("d"), F.col("t"))))
    assert "contains(t#" in text.lower()
