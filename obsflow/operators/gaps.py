"""Which hours have landed, as bitmaps, and the gaps in them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsflow.functions.times import naive_run_ts

EPOCH = datetime(1970, 1, 1)
HOUR = timedelta(hours=1)
REQUEST = ("method", "city")


def _hour_number(when: datetime) -> int:
    return (naive_run_ts(when) - EPOCH) // HOUR


def _hour(number: str) -> Column:
    """The hour of a number as TIMESTAMP_NTZ; by dates and hours, because seconds would pass through the session's zone."""
    return F.expr(
        f"CAST(date_from_unix_date(CAST(floor(({number}) / 24) AS INT)) AS TIMESTAMP_NTZ)"
        f" + make_dt_interval(0, CAST(pmod({number}, 24) AS INT))"
    )


def hour_bitmaps(landed: DataFrame, request: Sequence[str] = REQUEST, ts: str = "ingest_ts") -> DataFrame:
    """(request columns, word, hours): the hours with a payload, 64 to a word, one bit each.

    ``word`` counts from 1970 in steps of 64 hours. A word is one long however many payloads
    an hour has, and words of any two ranges of landings merge by ``merge_bitmaps``, so
    they can be stored per day and kept up as payloads come.
    """
    number = F.unix_date(F.to_date(ts)).cast("long") * 24 + F.hour(ts)
    hours = landed.where(F.col(ts).isNotNull()).select(*request, number.alias("_number"))
    bit = F.expr("shiftleft(1L, CAST(pmod(_number, 64) AS INT))")
    return hours.groupBy(*request, F.floor(F.col("_number") / 64).alias("word")).agg(F.bit_or(bit).alias("hours"))


def merge_bitmaps(bitmaps: DataFrame, request: Sequence[str] = REQUEST) -> DataFrame:
    """One row per request and word from any number of partial ones."""
    return bitmaps.groupBy(*request, "word").agg(F.bit_or("hours").alias("hours"))


def missing_spans(
    grid: DataFrame, bitmaps: DataFrame, first: datetime, last: datetime, request: Sequence[str] = REQUEST
) -> DataFrame:
    """(request columns, gap_from, gap_to, hours): maximal runs of hours without a payload.

    For every request of ``grid`` over the hours from ``first`` to ``last``, both included;
    ``gap_from`` and ``gap_to`` are the first and last hour of the run. A request that
    never answered has one gap. What the bitmaps hold for other requests or hours is ignored.

    No row is made per hour: the ends of the runs of a word are found by shifting it against
    itself, with the neighbouring words' last and first bit, and only these ends become rows.
    """
    start, end = _hour_number(first), _hour_number(last)
    request = list(request)
    inside = bitmaps.where(F.col("word").between(start // 64, end // 64))
    long = lambda n: F.lit(n).cast("long")
    # Hours outside the range count as landed by no one.
    cut = F.when(F.col("word") == start // 64, long(-1 << start % 64)).otherwise(long(-1)).bitwiseAND(
        F.when(F.col("word") == end // 64, long((2 << end % 64) - 1 if end % 64 < 63 else -1)).otherwise(long(-1))
    )
    words = inside.select(*request, "word", F.col("hours").bitwiseAND(cut).alias("hours")).where("hours <> 0")
    along = Window.partitionBy(*request).orderBy("word")
    before = F.when(F.lag("word").over(along) == F.col("word") - 1, F.shiftrightunsigned(F.lag("hours").over(along), 63)).otherwise(F.lit(0).cast("long"))
    after = F.when(F.lead("word").over(along) == F.col("word") + 1, F.shiftleft(F.lead("hours").over(along), 63)).otherwise(F.lit(0).cast("long"))
    ends = words.select(*request, "word", "hours", before.alias("_before"), after.alias("_after")).select(
        *request, "word",
        F.expr("hours & ~(shiftleft(hours, 1) | _before)").alias("_opens"),  # a run of landed hours begins
        F.expr("hours & ~(shiftrightunsigned(hours, 1) | _after)").alias("_closes"),  # and ends
    )
    places = lambda bits: f"filter(sequence(0, 63), b -> getbit({bits}, b) = 1)"
    marks = ends.select(*request, F.explode(F.expr(
        f"concat(transform({places('_opens')}, b -> struct(word * 64 + b AS at, true AS opens)),"
        f" transform({places('_closes')}, b -> struct(word * 64 + b + 1 AS at, false AS opens)))"
    )).alias("m")).select(*request, "m.at", "m.opens")
    # Every request's range closes nothing before it and opens nothing behind it.
    asked = grid.select(*request).distinct()
    border = asked.select(*request, F.explode(F.array(
        F.struct(F.lit(start).cast("long").alias("at"), F.lit(False).alias("opens")),
        F.struct(F.lit(end + 1).cast("long").alias("at"), F.lit(True).alias("opens")),
    )).alias("m")).select(*request, "m.at", "m.opens")
    same = [F.col(f"marks.{c}").eqNullSafe(F.col(f"asked.{c}")) for c in request]
    marks = marks.alias("marks").join(asked.alias("asked"), same, "left_semi").unionByName(border)
    # Openings and closings alternate; a gap goes from a closing to the next opening.
    following = F.lead("at").over(Window.partitionBy(*request).orderBy("at", "opens"))
    gaps = marks.withColumn("_next", following).where(~F.col("opens") & (F.col("_next") > F.col("at")))
    return gaps.select(
        *request, _hour("at").alias("gap_from"), _hour("_next - 1").alias("gap_to"),
        (F.col("_next") - F.col("at")).alias("hours"),
    )
