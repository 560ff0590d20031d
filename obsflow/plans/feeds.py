"""From raw payloads of a feed to typed flat rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.functions.text import empty_to_null
from obsflow.functions.times import (
    as_wall_clock,
    hour_bucket_values,
    naive_run_ts,
    parse_clock,
    run_time,
    with_hour_bucket,
)
from obsflow.operators.flatten import drop_all_empty_lists, explode_tagged, flatten_mapped
from obsflow.operators.quality import identifiable_rows, is_identifiable
from obsflow.schemas import (
    ASTRONOMY_FIELDS,
    CURRENT_FIELDS,
    IDENTITY_FIELDS,
    MARINE_DAY_FIELDS,
    PROCESSED,
    SPORTS,
)
from obsflow.sinks.tables import write_hour_partitions


def parse_times(df: DataFrame, names=("last_updated", "localtime")) -> DataFrame:
    """Type the text times; text that is no time becomes NULL."""
    return df.withColumns({name: as_wall_clock(F.col(name)) for name in names})


def trim_current(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 23 columns of a processed observation, the condition taken apart, and those to keep."""
    flat = df.withColumns(
        {"condition": F.col("condition.text"), "condition_code": F.col("condition.code")}
    )
    return flat.select(*PROCESSED.names, *keep)


def current_feed(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    flat = parse_times(flatten_mapped(raw, CURRENT_FIELDS, keep=keep))
    return trim_current(identifiable_rows(flat), keep)


def _identified(df: DataFrame) -> DataFrame:
    return df.where(is_identifiable("City", "Lat", "Long"))


def _clocks(df: DataFrame, day: Column) -> DataFrame:
    names = ("Sunrise", "Sunset", "Moonrise", "Moonset")
    return df.withColumns({name: parse_clock(day, F.col(name)) for name in names})


def astronomy_feed(raw: DataFrame) -> DataFrame:
    """One row per city: sun and moon times of its local day."""
    typed = parse_times(flatten_mapped(raw, ASTRONOMY_FIELDS), ["Localtime"])
    return _identified(_clocks(typed, F.col("Localtime")))


def _exploded_days(raw: DataFrame) -> DataFrame:
    return raw.select("location", F.explode("forecast.forecastday").alias("day"))


def marine_days(raw: DataFrame) -> DataFrame:
    """One row per city and forecast day; the hours and tides stay nested."""
    flat = flatten_mapped(_exploded_days(raw), IDENTITY_FIELDS + MARINE_DAY_FIELDS)
    typed = parse_times(flat, ["Localtime", "Date"])
    return _identified(_clocks(typed, F.col("Date")))


def marine_hours(raw: DataFrame) -> DataFrame:
    """One row per city and forecast hour."""
    hours = _exploded_days(raw).select(
        "location", F.col("day.date").alias("Date"), F.explode("day.hour").alias("hour")
    )
    fields = (*IDENTITY_FIELDS, ("Date", "Date"), ("hour.time", "Hour"), ("hour.temp_c", "Temp_C"))
    return _identified(parse_times(flatten_mapped(hours, fields), ["Localtime", "Date", "Hour"]))


def marine_tides(raw: DataFrame) -> DataFrame:
    """One row per city, day and tide; a day without tides keeps one row with NULLs."""
    listed = F.flatten(F.transform("day.day.tides", lambda t: t["tide"]))
    tides = _exploded_days(raw).select(
        "location", F.col("day.date").alias("Date"), F.explode_outer(listed).alias("tide")
    )
    fields = (
        *IDENTITY_FIELDS,
        ("Date", "Date"),
        ("tide.tide_time", "Tide_time"),
        ("tide.tide_type", "Tide_type"),
    )
    return _identified(
        parse_times(flatten_mapped(tides, fields), ["Localtime", "Date", "Tide_time"])
    )


def sports_union(raw: DataFrame) -> DataFrame:
    """One row per fixture of any sport, tagged with the sport it came from."""
    fixtures = explode_tagged(drop_all_empty_lists(raw, SPORTS), SPORTS, "sport")
    return fixtures.withColumns(
        {"region": empty_to_null(F.col("region")), "start": as_wall_clock(F.col("start"))}
    )


FEED_PLANS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "current": current_feed,
    "astronomy": astronomy_feed,
    "marine": marine_days,
    "sports": sports_union,
}


def process(raw: DataFrame, method: str) -> DataFrame:
    """Transform the payloads of one feed."""
    if method not in FEED_PLANS:
        raise ValueError(f"unknown feed {method!r}, expected one of {sorted(FEED_PLANS)}")
    return FEED_PLANS[method](raw)


REPORT = "method string, status string, rows long, error string"


def _transform_feed(raw: DataFrame, method: str, root: str, run_ts: datetime) -> tuple:
    """One row of the report; ``rows`` is what the write itself has counted."""
    try:
        rows = with_hour_bucket(process(raw, method), method, run_time(run_ts))
        hour = hour_bucket_values(method, run_ts)
        return method, "done", write_hour_partitions(rows, f"{root}/{method}", only=hour), None
    except Exception as error:  # whatever it is, it is reported and not raised
        return method, "failed", 0, str(error)


def transform_feeds(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    root: str,
    run_ts: datetime,
    *,
    side_by_side: int = 4,
) -> DataFrame:
    """Transform each feed into the run's hour of its table below ``root`` and report the outcomes.

    Feeds are independent, so the jobs of ``side_by_side`` of them run at a time: the tasks
    of one fill what the last tasks of another leave idle. A feed that fails does not stop
    the others and leaves its table as it was; other hours stay as they are in any case.
    One row per feed: method, status, rows written, error. Each feed is passed over once.
    """
    run_ts = naive_run_ts(run_ts)
    with ThreadPoolExecutor(max_workers=side_by_side) as pool:
        # Wrapped once per feed: each thread gets its own copy of the caller's job properties.
        runs = [
            pool.submit(inheritable_thread_target(spark)(_transform_feed), raw, method, root, run_ts)
            for method, raw in frames.items()
        ]
        outcomes = [run.result() for run in runs]
    return spark.createDataFrame(outcomes, REPORT)
