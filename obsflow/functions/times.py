"""Time parsing, formatting and hour buckets.

Local times in the payloads are city wall clocks without a zone, so they are
TIMESTAMP_NTZ throughout: a session time zone with daylight saving must not move
an observation.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.schemas import HOUR_BUCKET


def as_wall_clock(c: Column) -> Column:
    """Text (or a time) to TIMESTAMP_NTZ; text that is no time becomes NULL."""
    return c.try_cast("timestamp_ntz")


def _parsed_clock(day: Column, clock: Column) -> Column:
    """Any clock text the pattern takes. Parsed as UTC and moved to NTZ by its offset from the epoch."""
    text = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), clock, F.lit("Z"))
    instant = F.try_to_timestamp(text, F.lit("yyyy-MM-dd h:mm aX"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=F.unix_seconds(instant).cast("decimal(18,6)"))


def parse_clock(day: Column, clock: Column) -> Column:
    """Clock text such as ``7:05 AM`` on a given day; sentinels become NULL.

    The session time zone plays no part. Plain spellings are added up and text without a
    colon is none: only what is left goes through the time parser, which is slow, most of
    all with text that it refuses.
    """
    date = F.to_date(day)
    plain = clock.rlike(r"^(0?[1-9]|1[0-2]):[0-5][0-9] [AP]M\z")
    plain = plain & date.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date"))
    hour = F.substring_index(clock, ":", 1).try_cast("int") % 12 + F.when(clock.endswith("PM"), 12).otherwise(0)
    minute = F.substring(clock, -5, 2).try_cast("int")
    added = date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour, minute)
    return F.when(plain, added).when(F.contains(clock, F.lit(":")), _parsed_clock(day, clock))


def hour_bucket_columns(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    }


def with_hour_bucket(df: DataFrame, method: Column | str, ts: Column) -> DataFrame:
    """Add the partition columns of the landing layout: method, year, month, day, hour."""
    method = F.lit(method) if isinstance(method, str) else method
    return df.withColumns({"method": method, **hour_bucket_columns(ts)})


def hour_bucket_values(method: str, run_ts: datetime) -> dict[str, str | int]:
    """The bucket of a run without a zone, as ``with_hour_bucket`` has it in columns."""
    values = (method, run_ts.year, run_ts.month, run_ts.day, run_ts.hour)
    return dict(zip(HOUR_BUCKET, values, strict=True))


def hour_bucket_path(*, root: str | None = None) -> Column:
    """``root/method/year/month/day/hour`` without zero padding."""
    parts = [F.col(c).cast("string") for c in HOUR_BUCKET]
    return F.concat_ws("/", *([F.lit(root)] if root else []), *parts)


def hour_start(at: str) -> Column:
    """The hour a time falls into. By date and hour: truncation would pass through the session's zone."""
    return F.to_date(at).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(at))


def minute_bucket(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmm")


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def naive_run_ts(run_ts: datetime) -> datetime:
    """The run's clock without a zone; one with a zone is brought to UTC first."""
    return run_ts if run_ts.tzinfo is None else run_ts.astimezone(timezone.utc).replace(tzinfo=None)


def run_time(run_ts: datetime) -> Column:
    """The run's clock as a literal: naive -> TIMESTAMP_NTZ, aware -> TIMESTAMP."""
    if run_ts.tzinfo is None:
        return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(run_ts)


def audit_stamp(df: DataFrame, run_ts: datetime, name: str = "created_at") -> DataFrame:
    """Add the audit column. It is a run parameter, so a repeated run writes the same rows."""
    return df.withColumn(name, run_time(run_ts))
