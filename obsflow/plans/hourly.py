"""The hourly run: landed payloads to processed rows of every feed, dimensions and facts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsflow.functions.times import naive_run_ts, run_time, with_hour_bucket
from obsflow.operators.clean import clean_locations
from obsflow.operators.latest import latest_per_city_hour
from obsflow.plans.dimensions import (
    LOCATION_ORDER,
    assign_ids,
    insert_missing_countries,
    new_aliases,
    new_locations,
)
from obsflow.plans.facts import fact_with_fk
from obsflow.plans.feeds import FEED_PLANS, current_feed, transform_feeds
from obsflow.schemas import (
    ALIASES,
    COUNTRIES,
    HOUR_BUCKET,
    LOCATIONS,
    PROCESSED,
    RAW_SCHEMAS,
    WEATHERS,
    bucketed,
)
from obsflow.scratch import temporary
from obsflow.sinks.tables import append_table, land_raw, write_hour_partitions
from obsflow.sources.landing import read_hour_bucket, read_table


@dataclass(frozen=True)
class Lakehouse:
    """Paths of the tables below one root folder."""

    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def feeds(self) -> str:
        return f"{self.root}/feeds"

    @property
    def processed(self) -> str:
        return f"{self.root}/processed"

    @property
    def locations(self) -> str:
        return f"{self.root}/locations"

    @property
    def countries(self) -> str:
        return f"{self.root}/countries"

    @property
    def aliases(self) -> str:
        return f"{self.root}/aliases"

    @property
    def weathers(self) -> str:
        return f"{self.root}/weathers"


def _stored(df: DataFrame, run_ts: datetime, path: str, method: str = "current", *, gathered: bool) -> None:
    """Write a run's rows into its hour bucket; a repeated run replaces them."""
    write_hour_partitions(with_hour_bucket(df, method, run_time(run_ts)), path, gathered=gathered)


def _bucket(
    spark: SparkSession, path: str, schema: StructType, run_ts: datetime, *, strict: bool = False
) -> DataFrame:
    bucket = read_hour_bucket(spark, path, bucketed(schema), "current", run_ts, strict=strict)
    return bucket.drop(*HOUR_BUCKET)


def _grow(new: DataFrame, path: str) -> None:
    """Append to a dimension; most hours bring nothing new and shall leave no file."""
    if not new.isEmpty():
        append_table(new, path)


def transform_hour(
    raw: DataFrame, house: Lakehouse, run_ts: datetime, *, tie: tuple[str, ...] = ("obs_id",)
) -> None:
    """Step 1: the run's raw payloads to the processed table, the last one of a city and hour.

    Raw payloads with ``method``, ``ingest_ts`` and the ``tie`` columns are reduced by
    them; payloads without ingest time are one per city already.
    """
    keep = tuple(c for c in ("method", "ingest_ts", *tie) if c in raw.columns)
    rows = current_feed(raw, keep)
    if "ingest_ts" in keep:
        method = F.col("method") if "method" in keep else F.lit("current")
        hours = with_hour_bucket(rows, method, F.col("ingest_ts"))
        rows = latest_per_city_hour(hours, tie=[t for t in tie if t in keep]).select(*PROCESSED.names)
    # The last payloads come from a shuffle, payloads as they are from files of any size.
    _stored(rows, naive_run_ts(run_ts), house.processed, gathered="ingest_ts" in keep)


def transform_landed(spark: SparkSession, house: Lakehouse, run_ts: datetime, schema: StructType) -> DataFrame:
    """Transform the landed bucket of every feed into its table; the report of transform_feeds.

    ``schema``: columns of the landed table besides the bucket, with the text ``payload``.
    A feed with nothing landed in the hour is skipped and has no row in the report.
    """
    run_ts = naive_run_ts(run_ts)
    frames = {}
    for method in FEED_PLANS:
        bucket = read_hour_bucket(spark, house.landing, bucketed(schema), method, run_ts)
        if not bucket.isEmpty():
            frames[method] = bucket.select(F.from_json("payload", RAW_SCHEMAS[method]).alias("p")).select("p.*")
    return transform_feeds(spark, frames, house.feeds, run_ts)


def load_hour(
    spark: SparkSession, house: Lakehouse, country_payloads: DataFrame, run_ts: datetime
) -> None:
    """Step 2: the run's processed rows to countries, locations and facts, in this order.

    Each step reads what the one before has written, so new keys resolve. A
    repeated run finds its countries and locations stored and replaces its facts.
    """
    run_ts = naive_run_ts(run_ts)
    rows = _bucket(spark, house.processed, PROCESSED, run_ts, strict=True)

    countries = read_table(spark, house.countries, COUNTRIES)
    missing = insert_missing_countries(clean_locations(rows), countries, country_payloads, run_ts)
    _grow(assign_ids(missing, countries, ["name"]).select(*COUNTRIES.names), house.countries)

    countries = read_table(spark, house.countries, COUNTRIES)
    aliases = read_table(spark, house.aliases, ALIASES)
    _grow(new_aliases(clean_locations(rows), countries, aliases, country_payloads), house.aliases)
    aliases = read_table(spark, house.aliases, ALIASES)
    locations = read_table(spark, house.locations, LOCATIONS)
    fresh = new_locations(rows, locations, countries, run_ts, aliases=aliases)
    _grow(assign_ids(fresh, locations, LOCATION_ORDER).select(*LOCATIONS.names), house.locations)

    locations = read_table(spark, house.locations, LOCATIONS)
    _stored(fact_with_fk(rows, locations, run_ts), run_ts, house.weathers, gathered=True)


def run_hour(
    spark: SparkSession,
    raw: DataFrame,
    house: Lakehouse,
    country_payloads: DataFrame,
    run_ts: datetime,
) -> DataFrame:
    """Both steps; returns the facts of the run as stored."""
    run_ts = naive_run_ts(run_ts)
    with temporary(spark):
        transform_hour(raw, house, run_ts)
        load_hour(spark, house, country_payloads, run_ts)
    return _bucket(spark, house.weathers, WEATHERS, run_ts)


def run_landed_hour(
    spark: SparkSession,
    payloads: DataFrame,
    house: Lakehouse,
    country_payloads: DataFrame,
    run_ts: datetime,
    *,
    tie: tuple[str, ...] = (),
) -> DataFrame:
    """Land a batch of payload texts (method, city, ingest_ts, payload), then run one hour of it.

    All feeds are transformed from their bucket; the observations also go on to
    dimensions and facts. Returns the report of the feeds. An hour for which no
    observations have landed loads nothing.
    """
    run_ts = naive_run_ts(run_ts)
    land_raw(payloads, house.landing, tie=tie)
    schema = payloads.drop("method").schema
    report = transform_landed(spark, house, run_ts, schema)
    landed = read_hour_bucket(spark, house.landing, bucketed(schema), "current", run_ts)
    if not landed.isEmpty():
        # One payload per requested city has been landed; two requests can name one place.
        raw = landed.select("*", F.from_json("payload", RAW_SCHEMAS["current"]).alias("p")).select(
            "method", "ingest_ts", *tie, "p.*"
        )
        with temporary(spark):
            transform_hour(raw, house, run_ts, tie=tie)
            load_hour(spark, house, country_payloads, run_ts)
    return report
