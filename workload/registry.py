"""One runnable query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.functions import documents, text, times
from obsflow.operators import clean, contract, drift, flatten, gaps, keys, leaves, profiles, quality, rownum
from obsflow.operators.latest import latest_per_city_hour
from obsflow.operators.lookup import first_id_by
from obsflow.operators.stored_keys import StoredKeys, lookup_stored_location
from obsflow.plans import dimensions, facts, feeds
from obsflow.plans.hourly import Lakehouse, run_hour
from obsflow.schemas import (
    ASTRONOMY_FIELDS,
    CURRENT_FIELDS,
    HOUR_BUCKET,
    IDENTITY_FIELDS,
    LONG,
    PROCESSED,
    RAW_CURRENT,
    SPORTS,
    STRING,
    bucketed,
    struct,
)
from obsflow.scratch import materialise, scratch_path
from obsflow.sinks import deltas, points, tables
from obsflow.sources import landing, requests
from obsflow.streaming.incremental import incremental_load
from obsflow.streaming.latest import stream_latest
from workload import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TS = datetime(2024, 2, 1, 9, 0)
SCAN_HOUR = datetime(2024, 1, 15, 10)
HISTORY = datetime(2024, 1, 1, 0), datetime(2024, 1, 31, 23)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- inputs ----


def processed(spark, d):
    """Processed observations, with the columns that key a write."""
    rows = feeds.parse_times(
        flatten.flatten_mapped(
            views.raw_current(spark, d), CURRENT_FIELDS, keep=("obs_id", "ingest_ts", "method")
        )
    )
    kept = quality.identifiable_rows(rows)
    return kept.withColumns(
        {"condition": F.col("condition.text"), "condition_code": F.col("condition.code")}
    )


def cleaned_places(spark, d):
    rows = processed(spark, d).select("obs_id", "city", "country", "region", "lat", "long", "tz_id")
    return clean.clean_locations(rows)


def raw_texts(spark, d):
    """Payload text with the request it answers."""
    raw = views.raw_current(spark, d)
    return raw.select(
        "obs_id", "ingest_ts", "method", F.col("requested_city").alias("city"),
        views.payload_text(raw).alias("payload"),
    )


# --------------------------------------------------------------- sources ----


@query
def scan_nested_json(spark, d):
    raw = views.raw_current(spark, d)
    line = F.when(F.col("obs_id") % 31 == 0, "not a document").otherwise(views.payload_text(raw))
    path = scratch_path(spark, "payload-lines")
    raw.select(line.alias("value")).write.text(path)
    scanned = landing.scan_json(spark, path, RAW_CURRENT, multi_line=False)
    return scanned.select(
        F.col("location.name").alias("city"), F.col("location.lat").alias("lat"),
        F.col("location.lon").alias("long"), F.col("location.localtime").alias("localtime_txt"),
        F.col("current.condition.code").alias("condition_code"),
        F.col("current.temp_c").alias("temp_c"), F.col("current.vis_km").alias("vis_km"),
        F.col(landing.CORRUPT).alias("corrupt_text"),
    )


def landed_payloads(spark, d):
    """The payload table in hour buckets."""
    path = scratch_path(spark, "landing")
    tables.land_raw(raw_texts(spark, d), path, tie=["obs_id"])
    return spark.read.parquet(path)


@query
def hour_bucket_scan(spark, d):
    landed = landed_payloads(spark, d).drop("payload")
    return landing.hour_bucket_scan(landed, "current", SCAN_HOUR)


@query
def map_to_rows(spark, d):
    nation = F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))
    cities = F.create_map(
        nation, F.col("c_name"), F.concat(nation, F.lit("2")), F.concat("c_name", F.lit(" East"))
    )
    lines = views.table(spark, d, "customer").select("c_custkey", F.to_json(cities).alias("value"))
    return documents.map_to_rows(lines, "value", "country", "city")


@query
def request_grid(spark, d):
    return requests.request_grid(views.table(spark, d, "customer").select(F.col("c_name").alias("city")))


@query
def missing_payloads(spark, d):
    """What has not landed in one hour, of all requests."""
    landed = times.with_hour_bucket(answered(spark, d), F.col("method"), F.col("ingest_ts"))
    return requests.missing_in_hour(request_grid(spark, d), landed, SCAN_HOUR)


def answered(spark, d):
    """Observations as answers to requests: (ingest_ts, city, method)."""
    kind = F.col("condition_txt")
    method = (
        F.when(kind == "click", "current").when(kind == "view", "sports")
        .when(kind == "purchase", "astronomy").otherwise("marine")
    )
    return views.observations(spark, d).select("ingest_ts", F.col("requested_city").alias("city"), method.alias("method"))


@query
def missing_spans(spark, d):
    """Runs of hours without a payload, per request, over the whole history; bitmaps of two halves merged."""
    landed = answered(spark, d)
    early = F.col("ingest_ts") < F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    halves = gaps.hour_bitmaps(landed.where(early)).unionByName(gaps.hour_bitmaps(landed.where(~early)))
    return gaps.missing_spans(request_grid(spark, d), gaps.merge_bitmaps(halves), *HISTORY)


@query
def explode_results(spark, d):
    return flatten.explode_results(views.request_results(spark, d), "result")


# ----------------------------------------------------------------- sinks ----


@query
def latest_per_city_hour_rows(spark, d):
    rows = times.with_hour_bucket(processed(spark, d), F.col("method"), F.col("ingest_ts"))
    kept = latest_per_city_hour(rows)
    return kept.select("obs_id", "ingest_ts", *HOUR_BUCKET, "city", "lat", "long", "temp_c")


QUERIES["latest_per_city_hour"] = QUERIES.pop("latest_per_city_hour_rows")


@query
def save_processed(spark, d):
    """The kept rows as written into hour partitions."""
    path = scratch_path(spark, "processed")
    rows = times.with_hour_bucket(processed(spark, d), F.col("method"), F.col("ingest_ts"))
    kept = latest_per_city_hour(rows).select("obs_id", "city", "temp_c", *HOUR_BUCKET)
    tables.write_hour_partitions(kept, path)
    return spark.read.parquet(path)


@query
def land_raw(spark, d):
    """Two overlapping batches: the second replaces what it brings again, the rest stays."""
    path, texts = scratch_path(spark, "landing"), raw_texts(spark, d)
    for batch in ("obs_id % 3 <> 0", "obs_id % 3 <> 1"):
        tables.land_raw(texts.where(batch), path, tie=["obs_id"])
    temp = F.get_json_object("payload", "$.current.temp_c").cast("double")
    return spark.read.parquet(path).select("obs_id", "city", *HOUR_BUCKET, temp.alias("temp_c"))


@query
def land_raw_deltas(spark, d):
    """Overlapping batches, the later payloads first; some of the days compacted between them."""
    texts = raw_texts(spark, d)
    landing_ = deltas.hour_landing(spark, scratch_path(spark, "landing-deltas"), texts.schema, tie=["obs_id"], by=deltas.DAY_BUCKET)
    landing_.land(texts.where("obs_id % 3 <> 1"))
    landing_.table.compact(datetime(2024, 1, 16), most=12)
    landing_.land(texts.where("obs_id % 3 <> 2"))
    temp = F.get_json_object("payload", "$.current.temp_c").cast("double")
    return landing_.table.read().select("obs_id", "city", *HOUR_BUCKET, temp.alias("temp_c"))


@query
def land_raw_minute_deltas(spark, d):
    """Many batches in no order, one of them twice, with compactions between."""
    texts = raw_texts(spark, d)
    landing_ = deltas.minute_landing(spark, scratch_path(spark, "landing-deltas"), texts.schema, tie=["obs_id"])
    for k, batch in enumerate((5, 0, 3, 6, 1, 5, 2, 4)):
        landing_.land(texts.where(F.pmod(F.xxhash64("obs_id"), F.lit(7)) == batch))
        if k in (2, 5):
            landing_.table.compact(datetime(2024, 1, 20), most=12)
    return landing_.table.read().select("obs_id", "method", "minute_bucket", "city")


@query
def land_raw_minute(spark, d):
    path = scratch_path(spark, "landing-minute")
    tables.land_raw_minute(raw_texts(spark, d), path, tie=["obs_id"])
    return spark.read.parquet(path).select("obs_id", "method", "minute_bucket", "city")


@query
def append_fact(spark, d):
    path = scratch_path(spark, "weathers")
    tables.append_table(fact_with_fk(spark, d), path)
    return spark.read.parquet(path)


def nation_records(spark, d):
    return documents.country_records(views.nation_payloads(spark, d), "payload")


@query
def insert_missing_countries(spark, d):
    return dimensions.insert_missing_countries(
        cleaned_places(spark, d), views.countries(spark, d), nation_records(spark, d), RUN_TS
    )


# ------------------------------------------------- projections, filters ----


@query
def flatten_mapped(spark, d):
    flat = flatten.flatten_mapped(views.raw_current(spark, d), CURRENT_FIELDS, keep=("obs_id",))
    return flat.withColumn("condition", F.to_json("condition"))


@query
def flatten_all_leaves(spark, d):
    return flatten.flatten_leaves(views.raw_current(spark, d).select("location", "current"))


@query
def flatten_one_branch(spark, d):
    return flatten.flatten_leaves(views.raw_current(spark, d), "location")


@query
def identifiable_flag(spark, d):
    return quality.identifiable_flag(views.observations(spark, d).select("obs_id", "city", "lat", "long"))


@query
def identifiable_rows(spark, d):
    return quality.identifiable_rows(views.observations(spark, d).select("obs_id", "city", "lat", "long"))


@query
def identifiable_strict(spark, d):
    return quality.identifiable_strict(views.observations(spark, d).select("obs_id", "city", "lat", "long"))


@query
def trim_current(spark, d):
    flat = flatten.flatten_mapped(views.raw_current(spark, d), CURRENT_FIELDS)
    return feeds.trim_current(feeds.parse_times(flat))


@query
def current_feed(spark, d):
    return feeds.process(views.raw_current(spark, d), "current")


@query
def feed_outcomes(spark, d):
    """Two hours; in the second one feed fails, and its first hour stays."""
    frames = {
        "current": views.raw_current(spark, d),
        "astronomy": views.raw_astronomy(spark, d),
        "marine": views.raw_marine(spark, d),
        "sports": views.raw_sports(spark, d),
        "lightning": views.raw_current(spark, d),
    }
    root = scratch_path(spark, "feeds")
    feeds.transform_feeds(spark, frames, root, RUN_TS)
    unreadable = frames["current"].withColumn(
        "location", F.raise_error(F.lit("unreadable")).cast(RAW_CURRENT["location"].dataType)
    )
    report = feeds.transform_feeds(spark, frames | {"current": unreadable}, root, RUN_TS + timedelta(hours=1))
    stored = None
    for method in feeds.FEED_PLANS:
        counted = spark.read.parquet(f"{root}/{method}").agg(F.count(F.lit(1)).alias("stored"))
        counted = counted.select(F.lit(method).alias("method"), "stored")
        stored = counted if stored is None else stored.unionByName(counted)
    return report.join(stored, "method", "left").select(
        "method", "status", "rows", F.coalesce("stored", F.lit(0)).alias("stored")
    )


@query
def project_location(spark, d):
    return clean.project_location(current_feed(spark, d))


@query
def project_fact(spark, d):
    return clean.project_fact(current_feed(spark, d))


@query
def identified_flag(spark, d):
    found = keys.lookup_location(cleaned_places(spark, d), views.locations(spark, d), "id")
    return keys.identified_flag(found).select("obs_id", "id", "is_identified")


@query
def rename_positional(spark, d):
    names = [name for _, name in IDENTITY_FIELDS]
    branch = flatten.flatten_leaves(views.raw_current(spark, d), "location")
    return flatten.rename_positional(branch, names)


@query
def select_identity_plus(spark, d):
    flat = flatten.flatten_mapped(views.raw_astronomy(spark, d), ASTRONOMY_FIELDS)
    identity = [name for _, name in IDENTITY_FIELDS]
    return flatten.select_identity_plus(flat, identity, ["Moon_Phase", "Moon_Ilumination"])


@query
def audit_stamp(spark, d):
    return times.audit_stamp(views.observations(spark, d).select("obs_id", "city"), RUN_TS)


@query
def drop_all_empty_lists(spark, d):
    kept = flatten.drop_all_empty_lists(views.raw_sports(spark, d), SPORTS)
    sizes = [F.coalesce(F.array_size(s), F.lit(0)).alias(f"n_{s}") for s in SPORTS]
    return kept.select("o_orderkey", *sizes)


@query
def fill_from_dimension(spark, d):
    rows = cleaned_places(spark, d).select("obs_id", "city", "lat", "long")
    return keys.fill_from_dimension(rows, views.locations(spark, d))


# ----------------------------------------------------------------- joins ----


@query
def lookup_location_or(spark, d):
    rows = cleaned_places(spark, d).select("obs_id", "city", "lat", "long")
    return keys.lookup_location(rows, views.locations(spark, d))


@query
def lookup_location_or_shuffled(spark, d):
    """The same lookup by the route a dimension too large to broadcast takes."""
    rows = cleaned_places(spark, d).select("obs_id", "city", "lat", "long")
    return keys.lookup_location(rows, views.locations(spark, d), broadcast_bytes=0)


@query
def lookup_location_stored(spark, d):
    """The same lookup against stored keys, the second half of the locations added to them later."""
    rows = cleaned_places(spark, d).select("obs_id", "city", "lat", "long")
    known = views.locations(spark, d)
    path = scratch_path(spark, "stored-keys")
    stored = StoredKeys(spark, f"locations_{path[-32:]}", path, 8)
    early = known.where(F.col("id") <= known.agg(F.floor(F.max("id") / 2).alias("m")).first().m)
    stored.store(early)
    stored.add(known.join(early.select("id"), "id", "left_anti"))
    found = materialise(lookup_stored_location(rows, stored), "looked-up")
    stored.drop()
    return found


@query
def lookup_country(spark, d):
    rows = cleaned_places(spark, d).select("obs_id", "country")
    return keys.lookup_country(rows, views.nations(spark, d))


@query
def new_locations(spark, d):
    return dimensions.new_locations(
        current_feed(spark, d), views.locations(spark, d), views.nations(spark, d), RUN_TS
    )


@query
def new_locations_all(spark, d):
    """Every unresolved row, repeated places included."""
    return dimensions.new_locations(
        current_feed(spark, d), views.locations(spark, d), views.nations(spark, d), RUN_TS,
        dedup=False,
    )


@query
def new_location_ids(spark, d):
    return dimensions.assign_ids(
        new_locations(spark, d).select("city", "lat", "long"),
        views.locations(spark, d),
        dimensions.LOCATION_ORDER,
    )


@query
def fact_with_fk(spark, d):
    return facts.fact_with_fk(current_feed(spark, d), views.locations(spark, d), RUN_TS)


@query
def fact_with_fk_coords(spark, d):
    return facts.fact_with_fk(
        current_feed(spark, d), views.locations(spark, d), RUN_TS, use_coords=True
    )


# ---------------------------------------------------------- aggregations ----


@query
def null_profile(spark, d):
    return quality.null_profile(views.observations(spark, d))


@query
def type_profile(spark, d):
    return quality.type_profile(views.observations(spark, d))


@query
def profile_range(spark, d):
    """Profiles of two batches that share hours, stored, merged over the history and held against its rows."""
    obs = views.observations(spark, d)
    odd = F.col("obs_id") % 2 == 1
    halves = [profiles.hour_profiles(obs.where(half), "ingest_ts") for half in (odd, ~odd)]
    stored = materialise(halves[0].unionByName(halves[1]), "profiles")
    read = materialise(profiles.read_profiles(profiles.merge_profiles(stored)), "profile")
    audit = profiles.audit_profiles(obs, read)
    return read.join(audit, "column_name").select(
        "column_name", "rows", "rows_with_value", "low", "high", "exact_distinct",
        (F.col("distinct_error") <= profiles.DISTINCT_ERROR).alias("distinct_close"),
        (F.col("rank_error") <= profiles.RANK_ERROR).alias("quantiles_close"),
    )


@query
def dim_key_min_id(spark, d):
    return first_id_by(views.locations(spark, d), ["lat", "long"], "id", "first_id")


@query
def key_exists(spark, d):
    cities = views.observations(spark, d).select("city").distinct()
    return keys.key_exists(cities, views.locations(spark, d), "city")


# ------------------------------------------------------ windows, limits ----


@query
def row_index(spark, d):
    orders = views.table(spark, d, "orders").select("o_orderstatus", "o_orderdate", "o_orderkey")
    return rownum.row_index(orders, ["o_orderstatus", "o_orderdate", "o_orderkey"])


@query
def head_rows(spark, d):
    rows = views.observations(spark, d).select("obs_id", "city", "temp_c")
    return rownum.head_rows(rows, [F.desc("temp_c"), "obs_id"], 5)


@query
def head_row(spark, d):
    rows = views.observations(spark, d).select("obs_id", "ingest_ts", "wind_dir")
    return rownum.head_rows(rows, ["ingest_ts", "obs_id"], 1).select("wind_dir")


# ------------------------------------------------------ scalar functions ----


@query
def empty_to_null(spark, d):
    obs = views.observations(spark, d)
    names = ["city", "country", "region", "tz_id", "condition_txt", "wind_dir"]
    return obs.select("obs_id", *[text.empty_to_null(F.col(n)).alias(n) for n in names])


@query
def strip_quotes(spark, d):
    return views.table(spark, d, "documents").select(
        "doc_id", text.strip_quotes(F.col("text")).alias("text")
    )


@query
def clean_locations(spark, d):
    return clean.clean_locations(
        views.observations(spark, d).select("obs_id", "city", "country", "region", "lat", "long", "tz_id")
    )


@query
def clean_facts(spark, d):
    rows = views.observations(spark, d).select(
        "obs_id", "city", F.col("condition_txt").alias("condition"), "wind_dir",
        F.col("last_updated_txt").alias("last_updated"), F.col("localtime_txt").alias("localtime"),
    )
    return clean.clean_facts(rows)


def _payloads(spark, d):
    parsed = views.country_payloads(spark, d).select(
        "c_custkey", F.from_json("payload", documents.COUNTRY_PAYLOAD).alias("p")
    )
    return parsed.select("c_custkey", F.get("p", F.lit(0)).alias("p"))


@query
def strip_utc(spark, d):
    zones = _payloads(spark, d).select("c_custkey", F.explode("p.timezones").alias("zone"))
    return zones.withColumn("tz_utc", text.strip_utc(F.col("zone")))


@query
def map_values_joined(spark, d):
    return _payloads(spark, d).select(
        "c_custkey", text.map_values_joined(F.col("p.languages")).alias("language")
    )


@query
def array_first(spark, d):
    return _payloads(spark, d).select(
        "c_custkey", text.first_or_empty(F.col("p.continents")).alias("continent")
    )


@query
def nested_default(spark, d):
    return _payloads(spark, d).select(
        "c_custkey",
        text.or_empty(F.col("p.name.common")).alias("name"),
        text.or_empty(F.col("p.subregion")).alias("region"),
    )


@query
def country_record(spark, d):
    return documents.country_records(views.country_payloads(spark, d), "payload")


@query
def parse_times(spark, d):
    rows = views.observations(spark, d).select(
        "obs_id", F.col("last_updated_txt").alias("last_updated"), F.col("localtime_txt").alias("localtime")
    )
    return feeds.parse_times(rows)


@query
def cast_times(spark, d):
    written = current_feed(spark, d).select(
        "city", F.date_format("localtime", "yyyy-MM-dd'T'HH:mm:ss").alias("localtime"), "last_updated"
    )
    return feeds.parse_times(written)


@query
def hour_bucket(spark, d):
    obs = views.observations(spark, d).select("obs_id", "ingest_ts")
    bucketed = times.with_hour_bucket(obs, "current", F.col("ingest_ts"))
    return bucketed.withColumn("path", times.hour_bucket_path(root="raw"))


@query
def format_times(spark, d):
    ts = F.col("ingest_ts")
    return views.observations(spark, d).select(
        "obs_id", times.iso_seconds(ts).alias("iso"), times.minute_bucket(ts).alias("minute_bucket")
    )


@query
def parse_clock(spark, d):
    day = F.col("o_orderdate")
    return views.order_places(spark, d).select(
        "o_orderkey",
        *[
            times.parse_clock(day, F.col(c)).alias(c.removesuffix("_txt"))
            for c in ("rise_txt", "set_txt", "moon_txt")
        ],
    )


@query
def rows_to_json(spark, d):
    rows = views.observations(spark, d).select("obs_id", "city", "country", "humidity", "vis_km")
    return documents.rows_to_json(rows)


@query
def json_to_rows(spark, d):
    texts = raw_texts(spark, d).select("obs_id", "payload")
    parsed = documents.json_to_rows(texts, "payload", RAW_CURRENT)
    return parsed.select(
        "obs_id", F.col("location.name").alias("city"), F.col("location.lat").alias("lat"),
        F.col("current.wind_kph").alias("wind_kph"),
        F.col("current.condition.text").alias("condition"),
    )


@query
def contract_violations(spark, d):
    agreed = struct(("k", LONG, False), ("note", STRING))
    return contract.contract_violations(
        views.props_payloads(spark, d), "payload", agreed, keep=("event_id",)
    )


@query
def contract_conforming(spark, d):
    """Strict mode over nested payloads: further keys pass, anything else is set aside."""
    lines = nested_texts(spark, d)
    return contract.conforming(lines, "payload", RAW_CURRENT).select("obs_id")


@query
def contract_nested(spark, d):
    """Every violation in nested payloads."""
    return contract.contract_violations(nested_texts(spark, d), "payload", RAW_CURRENT, keep=("obs_id",))


def nested_texts(spark, d):
    """Nested payloads, some broken, with other keys, or with a whole number written as 5.0."""
    raw = views.raw_current(spark, d)
    body = views.payload_text(raw)
    line = (
        F.when(F.col("obs_id") % 31 == 0, "not a document")
        .when(F.col("obs_id") % 29 == 0, F.replace(body, F.lit('"cloud":'), F.lit('"clouds":')))
        .when(F.col("obs_id") % 23 == 0, F.replace(body, F.lit('"current":'), F.lit('"now":')))
        .when(F.col("obs_id") % 19 == 0, F.regexp_replace(body, '"cloud":([0-9]+)', '"cloud":$1.0'))
        .otherwise(body)
    )
    return raw.select("obs_id", "ingest_ts", line.alias("payload"))


@query
def variant_leaves(spark, d):
    """Leaves of mixed payloads without a schema; numbers apart from their spelling."""
    found = leaves.variant_leaves(nested_texts(spark, d), "payload", keep=("obs_id",))
    numeric = F.col("kind").isin("BIGINT", "DOUBLE")
    return found.withColumns({
        "value": F.when(~numeric, F.col("value")), "number": F.when(numeric, F.col("value")).cast("double")
    })


@query
def schema_drift(spark, d):
    """New, lost and retyped paths of a history, from the shapes of two batches that share hours."""
    lines = nested_texts(spark, d)
    odd = F.col("obs_id") % 2 == 1
    shapes = [drift.hour_shapes(lines.where(half), "payload", "ingest_ts", RAW_CURRENT) for half in (odd, ~odd)]
    halves = [materialise(batch, "shapes") for batch in shapes]  # read twice by the drift
    return drift.schema_drift(drift.merge_shapes(halves[0].unionByName(halves[1])), RAW_CURRENT)


@query
def point_read(spark, d):
    """The observations of three cities, by Bloom filters of a table that is sorted by time."""
    obs, path = views.observations(spark, d), scratch_path(spark, "points")
    points.write_point_table(obs, path, ["ingest_ts", "obs_id"], ["requested_city"])
    cities = [f"Customer#{n:09d}" for n in (1, 7, 999_999_999)]
    found = points.read_points(spark, path, obs.schema, "requested_city", cities)
    return found.select("obs_id", "ingest_ts", "requested_city", "temp_c")


# ----------------------------------------------------------------- feeds ----


@query
def astronomy_feed(spark, d):
    return feeds.process(views.raw_astronomy(spark, d), "astronomy")


@query
def marine_days(spark, d):
    days = feeds.process(views.raw_marine(spark, d), "marine")
    return days.withColumns({"Hourly_data": F.to_json("Hourly_data"), "Tides": F.to_json("Tides")})


@query
def marine_hours(spark, d):
    return feeds.marine_hours(views.raw_marine(spark, d))


@query
def marine_tides(spark, d):
    return feeds.marine_tides(views.raw_marine(spark, d))


@query
def sports_union(spark, d):
    return feeds.process(views.raw_sports(spark, d), "sports")


# ----------------------------------------------- streaming, whole run ----


@query
def incremental_load_rows(spark, d):
    """A landing that rewrites its hours, a corrupt document and repeated runs: each payload once."""
    landed, target, marks = (scratch_path(spark, n) for n in ("drops", "loaded", "marks"))
    texts = raw_texts(spark, d)
    stored = bucketed(texts.drop("method").schema)

    def plan(rows):
        parsed = rows.select(
            "obs_id", "ingest_ts", *HOUR_BUCKET, F.col("city").alias("request"),
            F.from_json("payload", RAW_CURRENT).alias("p"),
        )
        return feeds.current_feed(
            parsed.select("*", "p.*"), ("obs_id", "ingest_ts", "request", *HOUR_BUCKET)
        )

    def load():
        incremental_load(
            spark, landed, stored, target, marks, plan=plan, keys=["request"],
            order=[F.desc("ingest_ts"), F.desc("obs_id")], multi_line=False,
        )

    for batch in ("obs_id % 2 = 0", "true"):
        tables.land_raw(texts.where(batch), landed, tie=["obs_id"], fmt="json")
        load()
    torn = spark.createDataFrame([("{torn", "current", 2024, 1, 15, 10)], "value string, method string, year int, month int, day int, hour int")
    torn.write.mode("append").partitionBy(*HOUR_BUCKET).text(landed)
    load()
    load()
    return spark.read.parquet(target).select(*PROCESSED.names)


QUERIES["incremental_load"] = QUERIES.pop("incremental_load_rows")


@query
def stream_latest_rows(spark, d):
    """Drops out of order, one of them twice, and a restart between: the last payload of each request and hour."""
    drops, marks = scratch_path(spark, "drops"), scratch_path(spark, "marks")
    texts = raw_texts(spark, d)
    parsed = texts.select("obs_id", "ingest_ts", "method", "city", F.lit(0.0).alias("temp_c"))
    landing_ = deltas.hour_landing(spark, scratch_path(spark, "latest"), parsed.schema, tie=["obs_id"], by=deltas.DAY_BUCKET)

    def plan(rows):
        temp = F.get_json_object("payload", "$.current.temp_c").cast("double")
        rows = rows.select("obs_id", "ingest_ts", "method", "city", temp.alias("temp_c"))
        return times.with_hour_bucket(rows, F.col("method"), F.col("ingest_ts")).withColumn("minute_bucket", times.minute_bucket(F.col("ingest_ts")))

    for batch in ("obs_id % 3 = 2", "obs_id % 3 = 0", "obs_id % 3 = 2", "obs_id % 3 = 1"):
        texts.where(batch).write.mode("append").json(drops)
        stream_latest(spark, drops, texts.schema, landing_.table, marks, plan=plan, multi_line=False)
    return landing_.table.read().select("obs_id", "city", *HOUR_BUCKET, "temp_c")


QUERIES["stream_latest"] = QUERIES.pop("stream_latest_rows")


@query
def hourly_run(spark, d):
    """Raw payloads to facts through stored dimensions, run twice: the same tables result."""
    house = Lakehouse(scratch_path(spark, "house"))
    stamped = lambda df: times.audit_stamp(df, datetime(2024, 1, 1))
    stored = stamped(views.countries(spark, d)).select(
        "id", "name", *[F.lit(None).cast("string").alias(c) for c in
                        ("capital", "language", "tz_utc", "region", "continent", "requested_as")],
        "created_at",
    )
    tables.append_table(stored, house.countries)
    tables.append_table(stamped(views.locations(spark, d)), house.locations)
    raw, payloads = views.raw_current(spark, d), nation_records(spark, d)
    run_hour(spark, raw, house, payloads, RUN_TS)
    return run_hour(spark, raw, house, payloads, RUN_TS)
