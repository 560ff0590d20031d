"""Observation, payload and dimension frames derived from the given tables.

The table-to-view SQL is plain enough to run on Spark and on the checking
engine alike; ``{name}`` stands for a table. Every view covers its whole table:
the CASE expressions put edge cases (NULLs, empty text, quotes, bad times) into
rows, they do not select rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.schemas import (
    ASTRO_FULL,
    COUNTRY_PAYLOAD,
    CURRENT,
    FORECAST_DAY,
    LOCATION,
    RAW_SPORTS,
)

# One observation per event.
OBS_SQL = """
SELECT event_id AS obs_id, ts AS ingest_ts, 'current' AS method,
  concat('Customer#', lpad(CAST(user_id AS STRING), 9, '0')) AS requested_city,
  CASE WHEN event_id % 11 = 0 THEN NULL
       WHEN event_id % 13 = 0 THEN ''
       WHEN event_id % 7 = 0 THEN concat('Customer#', lpad(CAST(user_id AS STRING), 9, '0'), chr(39))
       WHEN event_type = 'signup' THEN concat('Customer#', lpad(CAST(user_id AS STRING), 9, '0'), ' Annex')
       ELSE concat('Customer#', lpad(CAST(user_id AS STRING), 9, '0')) END AS city,
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE concat('NATION_', CAST(user_id % 30 AS STRING)) END AS country,
  CASE WHEN event_id % 17 = 0 THEN '' ELSE concat('District ', CAST(user_id % 12 AS STRING)) END AS region,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(user_id % 23 AS DOUBLE) END AS lat,
  CAST(user_id % 29 AS DOUBLE) AS long,
  CASE WHEN event_id % 41 = 0 THEN '' ELSE concat('Etc/GMT', CAST(user_id % 12 AS STRING)) END AS tz_id,
  CASE WHEN event_id % 19 = 0 THEN 'bad' ELSE substr(CAST(ts AS STRING), 1, 16) END AS localtime_txt,
  concat(substr(CAST(ts AS STRING), 1, 14), '00') AS last_updated_txt,
  CASE WHEN event_id % 31 = 0 THEN '' ELSE event_type END AS condition_txt,
  1000 + event_id % 48 AS condition_code,
  event_id % 101 AS cloud,
  value - 1 AS feelslike_c,
  value * 2 AS gust_kph,
  event_id % 100 AS humidity,
  event_id % 2 AS is_day,
  CASE WHEN event_type = 'error' THEN value ELSE NULL END AS precip_mm,
  CAST(29 + event_id % 3 AS DOUBLE) AS pressure_in,
  value AS temp_c,
  CAST(event_id % 12 AS DOUBLE) AS uv,
  CAST(NULL AS DOUBLE) AS vis_km,
  event_id % 360 AS wind_degree,
  CASE WHEN event_id % 9 = 0 THEN '' ELSE upper(substr(event_type, 1, 2)) END AS wind_dir,
  value / 2 AS wind_kph
FROM {events}
"""

# Stored locations: every customer. Coordinates repeat, so a pair has several ids.
LOCATIONS_SQL = """
SELECT c_custkey AS id, c_name AS city, c_mktsegment AS region,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_custkey % 23 AS DOUBLE) END AS lat,
  CAST(c_custkey % 29 AS DOUBLE) AS long,
  concat('Etc/GMT', CAST(c_custkey % 12 AS STRING)) AS tz_id,
  CAST(c_nationkey AS BIGINT) AS country_id
FROM {customer}
"""

# Stored countries: the nations of the first three regions, the rest is still to come.
COUNTRIES_SQL = """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM {nation} WHERE n_regionkey < 3
"""

# All of them, for lookups.
NATIONS_SQL = "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM {nation}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    return spark.sql(sql, **{name: table(spark, sf_dir, name)})


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, OBS_SQL, "events")


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, LOCATIONS_SQL, "customer")


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, COUNTRIES_SQL, "nation")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, NATIONS_SQL, "nation")


def _document(schema: T.StructType | None = None, **fields: Column | str) -> Column:
    """A struct of the given fields, each cast to its type in ``schema``.

    Casting the fields and not the struct lets the optimizer see through it.
    """
    columns = {n: F.col(c) if isinstance(c, str) else c for n, c in fields.items()}
    if schema is not None:
        columns = {n: c.cast(schema[n].dataType) for n, c in columns.items()}
    return F.struct(*[c.alias(n) for n, c in columns.items()])


def raw_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations as nested payloads, with the request they answer."""
    location = _document(
        LOCATION, name="city", region="region", country="country", lat="lat", lon="long",
        tz_id="tz_id", localtime="localtime_txt",
    )
    current = _document(
        CURRENT, cloud="cloud", condition=_document(text="condition_txt", code="condition_code"),
        feelslike_c="feelslike_c", gust_kph="gust_kph", humidity="humidity", is_day="is_day",
        last_updated="last_updated_txt", precip_mm="precip_mm", pressure_in="pressure_in",
        temp_c="temp_c", uv="uv", vis_km="vis_km", wind_degree="wind_degree",
        wind_dir="wind_dir", wind_kph="wind_kph",
    )
    return observations(spark, sf_dir).select(
        "obs_id", "ingest_ts", "method", "requested_city",
        location.alias("location"), current.alias("current"),
    )


def payload_text(raw: DataFrame, fields=("location", "current")) -> Column:
    return F.to_json(F.struct(*fields))


# Orders as payloads of the other feeds: who and where, from the order's customer.
ORDER_PLACE_SQL = """
SELECT o_orderkey, o_orderdate,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat('Customer#', lpad(CAST(o_custkey AS STRING), 9, '0')) END AS city,
  o_orderpriority AS region,
  concat('NATION_', CAST(o_custkey % 30 AS STRING)) AS country,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 23 AS DOUBLE) END AS lat,
  CAST(o_custkey % 29 AS DOUBLE) AS long,
  concat('Etc/GMT', CAST(o_custkey % 12 AS STRING)) AS tz_id,
  concat(substr(CAST(o_orderdate AS STRING), 1, 10), ' 06:30') AS localtime_txt,
  substr(CAST(o_orderdate AS STRING), 1, 10) AS date_txt,
  concat(CAST(1 + o_orderkey % 12 AS STRING), ':', lpad(CAST(o_orderkey % 60 AS STRING), 2, '0'), ' AM') AS rise_txt,
  concat(lpad(CAST(1 + o_orderkey % 12 AS STRING), 2, '0'), ':', lpad(CAST(o_orderkey % 59 AS STRING), 2, '0'), ' PM') AS set_txt,
  CASE WHEN o_orderkey % 17 = 0 THEN 'No moonrise' ELSE concat(CAST(1 + o_orderkey % 7 AS STRING), ':05 PM') END AS moon_txt,
  o_orderstatus, o_totalprice
FROM {orders}
"""


def order_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, ORDER_PLACE_SQL, "orders")


def _order_location() -> Column:
    return _document(
        LOCATION, name="city", region="region", country="country", lat="lat", lon="long",
        tz_id="tz_id", localtime="localtime_txt",
    )


def raw_astronomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    astro = _document(
        ASTRO_FULL, sunrise="rise_txt", sunset="set_txt", moonrise="moon_txt", moonset="set_txt",
        moon_phase="o_orderstatus",
        moon_illumination=(F.col("o_orderkey") % 100).cast("string"),
        is_moon_up=(F.col("o_orderkey") % 2).cast("int"),
        is_sun_up=((F.col("o_orderkey") + 1) % 2).cast("int"),
    )
    return order_places(spark, sf_dir).select(
        _order_location().alias("location"), _document(astro=astro).alias("astronomy")
    )


def _counted(n: Column, item) -> Column:
    """Array of ``item(1) .. item(n)``; empty for n = 0 (sequence would run backwards)."""
    return F.transform(F.slice(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(1), n), item)


def raw_marine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 to 3 days per payload, 1 to 4 hours and 0 to 2 tides per day."""
    key = F.col("o_orderkey")

    def dated(i: Column) -> Column:
        date = F.date_add(F.col("o_orderdate").cast("date"), i.cast("int"))
        return F.struct(i.alias("i"), date.cast("string").alias("date"))

    def day(of: Column) -> Column:
        i, date = of["i"], of["date"]  # one text for all hours and tides
        hours = _counted(
            (1 + key % 4).cast("int"),
            lambda h: _document(
                time=F.concat(date, F.lit(" "), F.lpad(h.cast("string"), 2, "0"), F.lit(":00")),
                temp_c=(key % 40 + h).cast("double"),
            ),
        )
        tides = _counted(
            (key % 3).cast("int"),
            lambda t: _document(
                tide_time=F.concat(date, F.lit(" "), F.lpad((t * 6).cast("string"), 2, "0"), F.lit(":30")),
                tide_type=F.when(t == 1, "HIGH").otherwise("LOW"),
            ),
        )
        measures = _document(
            maxtemp_c=F.col("o_totalprice"), mintemp_c=(key % 50).cast("double"),
            avgtemp_c=(key % 60 + i).cast("double"), maxwind_kph=(key % 70).cast("double"),
            totalprecip_mm=F.lit(None).cast("double"), totalsnow_cm=F.lit(0.0),
            avgvis_km=F.lit(10.0), avghumidity=(key % 80).cast("double"),
            tides=F.array(_document(tide=tides)),
            condition=_document(text="o_orderstatus", code=1000 + key % 9),
            uv=(key % 12).cast("double"),
        )
        astro = _document(sunrise="rise_txt", sunset="set_txt", moonrise="moon_txt", moonset="set_txt")
        return _document(date=date, day=measures, astro=astro, hour=hours)

    days = F.transform(_counted((1 + key % 3).cast("int"), dated), day)
    return order_places(spark, sf_dir).select(
        _order_location().alias("location"),
        _document(forecastday=days.cast(T.ArrayType(FORECAST_DAY))).alias("forecast"),
    )


def raw_sports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0 to 2 fixtures of each sport; the cricket array is NULL instead of empty."""
    key = F.col("o_orderkey")

    def fixture(sport: str):
        return lambda i: _document(
            stadium=F.concat(F.lit(f"{sport} ground "), i.cast("string")),
            country="country",
            region=F.when(key % 4 == 0, "").otherwise(F.col("region")),
            tournament="o_orderstatus",
            start=F.when(key % 19 == 0, "tbd").otherwise(F.col("localtime_txt")),
            match=F.concat(key.cast("string"), F.lit("-"), i.cast("string")),
        )

    football = _counted((key % 3).cast("int"), fixture("football"))
    golf = _counted((key % 2).cast("int"), fixture("golf"))
    cricket = F.when(key % 5 > 2, _counted((key % 5 - 2).cast("int"), fixture("cricket")))
    return order_places(spark, sf_dir).select(
        "o_orderkey",
        *[
            array.cast(RAW_SPORTS[name].dataType).alias(name)
            for name, array in (("football", football), ("golf", golf), ("cricket", cricket))
        ],
    )


def request_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An array of answered requests per order, NULL for every third order."""
    key = F.col("o_orderkey")
    answer = lambda i: _document(
        method=F.element_at(F.array(F.lit("current"), F.lit("marine")), i),
        city="city",
        result=_document(status=F.col("o_orderstatus"), total=F.col("o_totalprice")),
    )
    answers = F.when(key % 3 > 0, _counted((key % 3).cast("int"), answer))
    return order_places(spark, sf_dir).select(answers.alias("result"))


def country_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A country document per customer, with missing, empty and quoted parts."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    document = _document(
        name=_document(common=F.when(key % 7 == 0, F.concat("c_name", F.lit("'s"))).otherwise(F.col("c_name"))),
        continents=F.when(key % 6 == 0, None)
        .when(key % 5 == 0, F.array().cast("array<string>"))
        .otherwise(F.array("c_mktsegment", F.lit("Elsewhere"))),
        timezones=F.when(key % 9 == 0, F.array(F.lit("UTC"))).otherwise(
            F.array(F.concat(F.lit("UTC+0"), nation, F.lit(":00")), F.lit("UTC"))
        ),
        subregion=F.when(key % 4 > 0, F.concat(F.lit("Sub "), nation)),
        languages=F.when(
            key % 8 > 0,
            F.create_map(F.lit("a"), F.concat(F.lit("Lang"), nation), F.lit("b"), F.lit("O'b")),
        ),
        capital=F.array(F.concat(F.lit("Port "), key.cast("string"))),
    )
    payload = F.array(document).cast(COUNTRY_PAYLOAD)
    return table(spark, sf_dir, "customer").select("c_custkey", F.to_json(payload).alias("payload"))


def nation_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country document of every nation, under the name it is requested by.

    Nations of the last region are known to the service under a longer name.
    """
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    document = _document(
        name=_document(
            common=F.when(F.col("n_regionkey") == 4, F.concat(F.lit("Republic of "), "n_name"))
            .otherwise(F.col("n_name"))
        ),
        continents=F.array("r_name"),
        timezones=F.array(F.concat(F.lit("UTC+0"), F.col("n_regionkey").cast("string"), F.lit(":00"))),
        subregion="r_name",
        languages=F.create_map(F.lit("x"), F.concat(F.lit("Lang "), F.col("n_nationkey").cast("string"))),
        capital=F.array(F.concat(F.lit("Capital "), F.col("n_nationkey").cast("string"))),
    )
    payload = F.array(document).cast(COUNTRY_PAYLOAD)
    return joined.select(F.col("n_name").alias("requested_as"), F.to_json(payload).alias("payload"))


# Event properties as payload text, some of it broken.
PROPS_SQL = """
SELECT event_id, CASE
  WHEN event_id % 31 = 0 THEN substr(props, 1, length(props) - 1)
  WHEN event_id % 29 = 0 THEN replace(props, '"k"', '"q"')
  WHEN event_id % 23 = 0 THEN '{{"k": "x"}}'
  WHEN event_id % 19 = 0 THEN replace(props, '}}', ', "note": null}}')
  WHEN event_id % 17 = 0 THEN replace(props, '}}', ', "note": 5}}')
  WHEN event_id % 13 = 0 THEN replace(props, '}}', ', "note": "ok"}}')
  ELSE props END AS payload
FROM {events}
"""


def props_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, PROPS_SQL, "events")
