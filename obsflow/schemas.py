"""Declared schemas of the payload feeds and of the stored tables.

Nothing here is inferred from data: a feed is always read with its declared
schema, so no extra pass over the input is needed and a column keeps its type
even in an hour where every value is NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING = T.StringType()
LONG = T.LongType()
INT = T.IntegerType()
DOUBLE = T.DoubleType()
NTZ = T.TimestampNTZType()


def struct(*fields: tuple) -> T.StructType:
    """Build a struct from ``(name, type)`` or ``(name, type, nullable)`` tuples."""
    return T.StructType([T.StructField(*field) for field in fields])


# --------------------------------------------------------------------------
# Raw payloads: one document per (method, city, hour).
# A non-nullable field is one the contract check requires to be present.
# --------------------------------------------------------------------------

LOCATION = struct(
    ("name", STRING),
    ("region", STRING),
    ("country", STRING),
    ("lat", DOUBLE),
    ("lon", DOUBLE),
    ("tz_id", STRING),
    ("localtime", STRING),
)

CONDITION = struct(("text", STRING), ("code", LONG))

CURRENT = struct(
    ("cloud", LONG),
    ("condition", CONDITION),
    ("feelslike_c", DOUBLE),
    ("gust_kph", DOUBLE),
    ("humidity", LONG),
    ("is_day", LONG),
    ("last_updated", STRING),
    ("precip_mm", DOUBLE),
    ("pressure_in", DOUBLE),
    ("temp_c", DOUBLE),
    ("uv", DOUBLE),
    ("vis_km", DOUBLE),
    ("wind_degree", LONG),
    ("wind_dir", STRING),
    ("wind_kph", DOUBLE),
)

RAW_CURRENT = struct(("location", LOCATION, False), ("current", CURRENT, False))

ASTRO_FULL = struct(
    ("sunrise", STRING),
    ("sunset", STRING),
    ("moonrise", STRING),
    ("moonset", STRING),
    ("moon_phase", STRING),
    ("moon_illumination", STRING),
    ("is_moon_up", INT),
    ("is_sun_up", INT),
)

RAW_ASTRONOMY = struct(
    ("location", LOCATION, False),
    ("astronomy", struct(("astro", ASTRO_FULL, False)), False),
)

TIDE = struct(("tide_time", STRING), ("tide_type", STRING))
HOUR = struct(("time", STRING), ("temp_c", DOUBLE))

FORECAST_DAY = struct(
    ("date", STRING),
    (
        "day",
        struct(
            ("maxtemp_c", DOUBLE),
            ("mintemp_c", DOUBLE),
            ("avgtemp_c", DOUBLE),
            ("maxwind_kph", DOUBLE),
            ("totalprecip_mm", DOUBLE),
            ("totalsnow_cm", DOUBLE),
            ("avgvis_km", DOUBLE),
            ("avghumidity", DOUBLE),
            ("tides", T.ArrayType(struct(("tide", T.ArrayType(TIDE))))),
            ("condition", CONDITION),
            ("uv", DOUBLE),
        ),
    ),
    (
        "astro",
        struct(
            ("sunrise", STRING),
            ("sunset", STRING),
            ("moonrise", STRING),
            ("moonset", STRING),
        ),
    ),
    ("hour", T.ArrayType(HOUR)),
)

RAW_MARINE = struct(
    ("location", LOCATION, False),
    ("forecast", struct(("forecastday", T.ArrayType(FORECAST_DAY), False)), False),
)

FIXTURE = struct(
    ("stadium", STRING),
    ("country", STRING),
    ("region", STRING),
    ("tournament", STRING),
    ("start", STRING),
    ("match", STRING),
)

RAW_SPORTS = struct(
    ("football", T.ArrayType(FIXTURE)),
    ("golf", T.ArrayType(FIXTURE)),
    ("cricket", T.ArrayType(FIXTURE)),
)

RAW_SCHEMAS = {
    "current": RAW_CURRENT,
    "astronomy": RAW_ASTRONOMY,
    "marine": RAW_MARINE,
    "sports": RAW_SPORTS,
}

COUNTRY_PAYLOAD = T.ArrayType(
    struct(
        ("name", struct(("common", STRING))),
        ("continents", T.ArrayType(STRING)),
        ("timezones", T.ArrayType(STRING)),
        ("subregion", STRING),
        ("languages", T.MapType(STRING, STRING)),
        ("capital", T.ArrayType(STRING)),
    )
)

# --------------------------------------------------------------------------
# Stored tables.
# --------------------------------------------------------------------------

LOCATIONS = struct(
    ("id", LONG),
    ("city", STRING),
    ("region", STRING),
    ("lat", DOUBLE),
    ("long", DOUBLE),
    ("tz_id", STRING),
    ("country_id", LONG),
    ("created_at", NTZ),
)

COUNTRIES = struct(
    ("id", LONG),
    ("name", STRING),
    ("capital", STRING),
    ("language", STRING),
    ("tz_utc", STRING),
    ("region", STRING),
    ("continent", STRING),
    ("requested_as", STRING),
    ("created_at", NTZ),
)

# Partition columns of the landing, processed and fact tables.
BUCKET_FIELDS = (("method", STRING), ("year", INT), ("month", INT), ("day", INT), ("hour", INT))
HOUR_BUCKET = tuple(name for name, _ in BUCKET_FIELDS)

# Columns of a processed observation and of a fact, in output order.
PROCESSED = struct(
    ("cloud", LONG),
    ("condition", STRING),
    ("condition_code", LONG),
    ("feelslike_C", DOUBLE),
    ("gust_kph", DOUBLE),
    ("humidity", LONG),
    ("is_day", LONG),
    ("last_updated", NTZ),
    ("precip_mm", DOUBLE),
    ("pressure_in", DOUBLE),
    ("temp_c", DOUBLE),
    ("uv", DOUBLE),
    ("vis_km", DOUBLE),
    ("wind_degree", LONG),
    ("wind_dir", STRING),
    ("wind_kph", DOUBLE),
    ("country", STRING),
    ("city", STRING),
    ("region", STRING),
    ("lat", DOUBLE),
    ("long", DOUBLE),
    ("localtime", NTZ),
    ("tz_id", STRING),
)

WEATHERS = struct(
    ("cloud", LONG),
    ("condition", STRING),
    ("feelslike_C", DOUBLE),
    ("gust_kph", DOUBLE),
    ("humidity", LONG),
    ("last_updated", NTZ),
    ("localtime", NTZ),
    ("precip_mm", DOUBLE),
    ("pressure_in", DOUBLE),
    ("temp_c", DOUBLE),
    ("uv", DOUBLE),
    ("vis_km", DOUBLE),
    ("wind_degree", LONG),
    ("wind_dir", STRING),
    ("wind_kph", DOUBLE),
    ("location_id", LONG),
    ("created_at", NTZ),
)


ALIASES = struct(("alias", STRING), ("country_id", LONG))


def bucketed(schema: T.StructType) -> T.StructType:
    """A table's schema with the partition columns of an hour bucket."""
    return struct(*[(f.name, f.dataType) for f in schema], *BUCKET_FIELDS)


# --------------------------------------------------------------------------
# Payload path -> output column, per feed, in output order.
# --------------------------------------------------------------------------

CURRENT_FIELDS = (
    ("current.cloud", "cloud"),
    ("current.condition", "condition"),
    ("current.feelslike_c", "feelslike_C"),
    ("current.gust_kph", "gust_kph"),
    ("current.humidity", "humidity"),
    ("current.is_day", "is_day"),
    ("current.last_updated", "last_updated"),
    ("current.precip_mm", "precip_mm"),
    ("current.pressure_in", "pressure_in"),
    ("current.temp_c", "temp_C"),
    ("current.uv", "uv"),
    ("current.vis_km", "vis_km"),
    ("current.wind_degree", "wind_degree"),
    ("current.wind_dir", "wind_dir"),
    ("current.wind_kph", "wind_kph"),
    ("location.country", "country"),
    ("location.name", "city"),
    ("location.region", "region"),
    ("location.lat", "lat"),
    ("location.lon", "long"),
    ("location.localtime", "localtime"),
    ("location.tz_id", "tz_id"),
)

LOCATION_COLUMNS = ("city", "country", "region", "lat", "long", "tz_id")

# Columns a fact takes from a processed observation; ``city`` only finds the key.
FACT_COLUMNS = (
    "city",
    "cloud",
    "condition",
    "feelslike_C",
    "gust_kph",
    "humidity",
    "last_updated",
    "localtime",
    "precip_mm",
    "pressure_in",
    "temp_c",
    "uv",
    "vis_km",
    "wind_degree",
    "wind_dir",
    "wind_kph",
)

IDENTITY_FIELDS = (
    ("location.name", "City"),
    ("location.region", "Region"),
    ("location.country", "Country"),
    ("location.lat", "Lat"),
    ("location.lon", "Long"),
    ("location.tz_id", "TZ_ID"),
    ("location.localtime", "Localtime"),
)

# The last two labels are the ones users of the feed know, although the second
# holds the payload's is_sun_up.
ASTRONOMY_FIELDS = IDENTITY_FIELDS + (
    ("astronomy.astro.sunrise", "Sunrise"),
    ("astronomy.astro.sunset", "Sunset"),
    ("astronomy.astro.moonrise", "Moonrise"),
    ("astronomy.astro.moonset", "Moonset"),
    ("astronomy.astro.moon_phase", "Moon_Phase"),
    ("astronomy.astro.moon_illumination", "Moon_Ilumination"),
    ("astronomy.astro.is_moon_up", "Moon_Up"),
    ("astronomy.astro.is_sun_up", "Moon_Down"),
)

# Paths below ``day`` are relative to one exploded forecast day.
MARINE_DAY_FIELDS = (
    ("day.date", "Date"),
    ("day.hour", "Hourly_data"),
    ("day.day.maxtemp_c", "Maxtemp_C"),
    ("day.day.mintemp_c", "Mintemp_C"),
    ("day.day.avgtemp_c", "Avgtemp_C"),
    ("day.day.maxwind_kph", "Maxwind_kph"),
    ("day.day.totalprecip_mm", "Totalprecip_mm"),
    ("day.day.totalsnow_cm", "Totalsnow_cm"),
    ("day.day.avgvis_km", "Avgvis_km"),
    ("day.day.avghumidity", "Avghumidity"),
    ("day.day.tides", "Tides"),
    ("day.day.condition.text", "Condition_text"),
    ("day.day.condition.code", "Condition_code"),
    ("day.day.uv", "UV"),
    ("day.astro.sunrise", "Sunrise"),
    ("day.astro.sunset", "Sunset"),
    ("day.astro.moonrise", "Moonrise"),
    ("day.astro.moonset", "Moonset"),
)

SPORTS = ("football", "golf", "cricket")

# Order in which requests are laid out.
REQUEST_METHODS = ("current", "sports", "astronomy", "marine")
