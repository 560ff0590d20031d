"""Checking SQL for the registered queries, written directly on the given tables.

It states results in the plainest way (disjunctive joins, correlated counts,
flat selects without any nesting) and shares only the view definitions with the
Spark side.
"""

from __future__ import annotations

from workload.views import (
    COUNTRIES_SQL,
    LOCATIONS_SQL,
    NATIONS_SQL,
    OBS_SQL,
    ORDER_PLACE_SQL,
    PROPS_SQL,
)

VIEWS = {
    "obs": OBS_SQL.format(events="events"),
    "loc": LOCATIONS_SQL.format(customer="customer"),
    "few": COUNTRIES_SQL.format(nation="nation"),
    "ctry": NATIONS_SQL.format(nation="nation"),
    "ord": ORDER_PLACE_SQL.format(orders="orders"),
    "props_text": PROPS_SQL.format(events="events"),
}

RUN_TS = "TIMESTAMP '2024-02-01 09:00:00'"


def _time(column: str) -> str:
    return f"try_cast({column} AS TIMESTAMP)"


def _clean(column: str) -> str:
    return f"replace(nullif({column}, ''), chr(39), '')"


def _with(sql: str, *names: str, **more: str) -> str:
    parts = [f"{n} AS ({VIEWS[n]})" for n in names] + [f"{n} AS ({q})" for n, q in more.items()]
    return f"WITH {', '.join(parts)} {sql}"


IDENTIFIABLE = "NOT (city IS NULL AND (lat IS NULL OR long IS NULL))"

BUCKET = (
    "year(ingest_ts)::INT AS year, month(ingest_ts)::INT AS month, "
    "day(ingest_ts)::INT AS day, hour(ingest_ts)::INT AS hour"
)

PROCESSED = f"""
SELECT cloud, condition_txt AS condition, condition_code, feelslike_c AS "feelslike_C", gust_kph,
  humidity, is_day::BIGINT AS is_day, {_time('last_updated_txt')} AS last_updated, precip_mm,
  pressure_in, temp_c, uv, vis_km, wind_degree, wind_dir, wind_kph, country, city, region, lat, long,
  {_time('localtime_txt')} AS "localtime", tz_id
FROM obs"""

CLEANED = f"""
SELECT obs_id, {_clean('city')} AS city, {_clean('country')} AS country,
  {_clean('region')} AS region, lat, long, {_clean('tz_id')} AS tz_id
FROM obs WHERE {IDENTIFIABLE}"""

OR_MATCH = "l.city = p.city OR (l.lat = p.lat AND l.long = p.long)"

RESOLVED = f"""
SELECT p.obs_id, min(l.id) AS id FROM places p LEFT JOIN loc l ON {OR_MATCH} GROUP BY p.obs_id"""

FACTS = f"""
SELECT cloud, nullif(condition_txt, '') AS condition, feelslike_c AS "feelslike_C", gust_kph, humidity,
  {_time('last_updated_txt')} AS last_updated, {_time('localtime_txt')} AS "localtime", precip_mm,
  pressure_in, temp_c, uv, vis_km, wind_degree, nullif(wind_dir, '') AS wind_dir, wind_kph,
  @key AS location_id, {RUN_TS} AS created_at
FROM obs o WHERE {IDENTIFIABLE}"""

CITY_KEY = "(SELECT min(l.id) FROM @dim l WHERE l.city = replace(o.city, chr(39), ''))"

LOCATION_LEAVES = """city AS location_name, region AS location_region, country AS location_country,
  lat AS location_lat, long AS location_lon, tz_id AS location_tz_id, localtime_txt AS location_localtime"""

# Rows of new locations before and after a place is kept only once.
UNRESOLVED = "SELECT p.* FROM places p JOIN resolved r ON p.obs_id = r.obs_id WHERE r.id IS NULL"
ONCE = """
SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY city, CASE WHEN city IS NULL THEN lat END, CASE WHEN city IS NULL THEN long END
    ORDER BY lat NULLS LAST, long NULLS LAST, country NULLS LAST, region NULLS LAST, tz_id NULLS LAST
  ) AS rn FROM unresolved) p WHERE rn = 1 AND (city IS NOT NULL OR NOT EXISTS (
    SELECT 1 FROM named n WHERE n.lat = p.lat AND n.long = p.long))"""
# Coordinates of the rows that stand for a named place.
NAMED = """
SELECT lat, long FROM (SELECT lat, long, row_number() OVER (PARTITION BY city
    ORDER BY lat NULLS LAST, long NULLS LAST, country NULLS LAST, region NULLS LAST, tz_id NULLS LAST
  ) AS rn FROM unresolved WHERE city IS NOT NULL) WHERE rn = 1"""
NEW_LOCATIONS = f"""
SELECT n.city, n.region, n.lat, n.long, n.tz_id, c.id AS country_id, {RUN_TS} AS created_at
FROM @rows n LEFT JOIN ctry c ON c.name = n.country"""
NEW_IDS = """
SELECT city, lat, long, (SELECT max(id) FROM loc) + row_number() OVER (
  ORDER BY city NULLS FIRST, lat NULLS FIRST, long NULLS FIRST) AS id FROM once"""


def _places(sql: str, **more: str) -> str:
    steps = {"places": CLEANED, "resolved": RESOLVED, "unresolved": UNRESOLVED, "named": NAMED, "once": ONCE}
    return _with(sql, "obs", "loc", "ctry", **steps, **more)


ORD_IDENTITY = f"""city AS "City", region AS "Region", country AS "Country", lat AS "Lat", long AS "Long",
  tz_id AS "TZ_ID" """
ORD_LOCALTIME = f"{_time('localtime_txt')} AS \"Localtime\""


def _clock(date: str, text: str) -> str:
    return f"try_strptime({date} || ' ' || {text}, '%Y-%m-%d %-I:%M %p')"


def _clocks(date: str) -> str:
    pairs = (("rise_txt", "Sunrise"), ("set_txt", "Sunset"), ("moon_txt", "Moonrise"), ("set_txt", "Moonset"))
    return ", ".join(f'{_clock(date, t)} AS "{n}"' for t, n in pairs)


ORD_DAYS = """
SELECT *, d, strftime(o_orderdate + to_days(d::INT), '%Y-%m-%d') AS day_txt
FROM (SELECT *, unnest(range(1, 2 + o_orderkey % 3)) AS d FROM ord)"""

PAYLOAD_PARTS = """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
  CASE WHEN c_custkey % 7 = 0 THEN c_name || chr(39) || 's' ELSE c_name END AS common,
  CASE WHEN c_custkey % 6 = 0 OR c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS continent,
  CASE WHEN c_custkey % 9 = 0 THEN 'UTC' ELSE 'UTC+0' || c_nationkey || ':00' END AS zone,
  CASE WHEN c_custkey % 4 > 0 THEN 'Sub ' || c_nationkey ELSE '' END AS subregion,
  CASE WHEN c_custkey % 8 > 0 THEN 'Lang' || c_nationkey || ', Ob' ELSE '' END AS language
FROM customer"""

SPORTS_ROWS = " UNION ALL ".join(
    f"""SELECT '{sport}' AS sport, '{sport} ground ' || i AS stadium, country,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE region END AS region, o_orderstatus AS tournament,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE {_time('localtime_txt')} END AS start,
  o_orderkey || '-' || i AS match
FROM (SELECT *, unnest(range(1, 1 + {n})) AS i FROM ord)"""
    for sport, n in (
        ("football", "o_orderkey % 3"),
        ("golf", "o_orderkey % 2"),
        ("cricket", "greatest(o_orderkey % 5 - 2, 0)"),
    )
)

LATEST = f"""
SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY method, date_trunc('hour', ingest_ts), city,
      CASE WHEN city IS NULL THEN lat END, CASE WHEN city IS NULL THEN long END
    ORDER BY ingest_ts DESC, obs_id DESC) AS rn
  FROM obs WHERE {IDENTIFIABLE}) WHERE rn = 1"""

LANDED = """
SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY method, date_trunc('@unit', ingest_ts), requested_city
    ORDER BY ingest_ts DESC, obs_id DESC) AS rn FROM obs) WHERE rn = 1"""

OBS_TYPES = {
    "obs_id": "bigint", "ingest_ts": "timestamp_ntz", "method": "string", "requested_city": "string",
    "city": "string", "country": "string", "region": "string", "lat": "double", "long": "double",
    "tz_id": "string", "localtime_txt": "string", "last_updated_txt": "string",
    "condition_txt": "string", "condition_code": "bigint", "cloud": "bigint",
    "feelslike_c": "double", "gust_kph": "double", "humidity": "bigint", "is_day": "bigint",
    "precip_mm": "double", "pressure_in": "double", "temp_c": "double", "uv": "double",
    "vis_km": "double", "wind_degree": "bigint", "wind_dir": "string", "wind_kph": "double",
}

ORACLE_SQL = {
    # sources
    "scan_nested_json": _with(
        """SELECT CASE WHEN ok THEN city END AS city, CASE WHEN ok THEN lat END AS lat,
  CASE WHEN ok THEN long END AS long, CASE WHEN ok THEN localtime_txt END AS localtime_txt,
  CASE WHEN ok THEN condition_code END AS condition_code, CASE WHEN ok THEN temp_c END AS temp_c,
  vis_km, CASE WHEN NOT ok THEN 'not a document' END AS corrupt_text
FROM (SELECT *, obs_id % 31 <> 0 AS ok FROM obs)""",
        "obs",
    ),
    "hour_bucket_scan": _with(
        f"""SELECT obs_id, ingest_ts, requested_city AS city, method, {BUCKET} FROM landed
WHERE ingest_ts >= TIMESTAMP '2024-01-15 10:00:00' AND ingest_ts < TIMESTAMP '2024-01-15 11:00:00'""",
        "obs", landed=LANDED.replace("@unit", "hour"),
    ),
    "map_to_rows": """
SELECT c_custkey, 'NATION_' || c_nationkey AS country, c_name AS city FROM customer
UNION ALL SELECT c_custkey, 'NATION_' || c_nationkey || '2', c_name || ' East' FROM customer""",
    "request_grid": """
SELECT m.method, c.c_name AS city FROM customer c
CROSS JOIN (VALUES ('current'), ('sports'), ('astronomy'), ('marine')) m(method)""",
    "missing_payloads": _with(
        """SELECT m.method, c.c_name AS city FROM customer c
CROSS JOIN (VALUES ('current'), ('sports'), ('astronomy'), ('marine')) m(method)
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.method = m.method AND l.city = c.c_name)""",
        "obs",
        landed="""SELECT CASE condition_txt WHEN 'click' THEN 'current' WHEN 'view' THEN 'sports'
  WHEN 'purchase' THEN 'astronomy' ELSE 'marine' END AS method, requested_city AS city FROM obs
WHERE ingest_ts >= TIMESTAMP '2024-01-15 10:00:00' AND ingest_ts < TIMESTAMP '2024-01-15 11:00:00'""",
    ),
    "explode_results": _with(
        """SELECT CASE i WHEN 1 THEN 'current' ELSE 'marine' END AS results_method, city AS results_city,
  o_orderstatus AS results_result_status, o_totalprice AS results_result_total
FROM (SELECT *, unnest(range(1, 1 + o_orderkey % 3)) AS i FROM ord)""",
        "ord",
    ),
    # sinks
    "latest_per_city_hour": _with(
        f"SELECT obs_id, ingest_ts, method, {BUCKET}, city, lat, long, temp_c FROM latest",
        "obs", latest=LATEST,
    ),
    "save_processed": _with(
        f"SELECT obs_id, city, temp_c, method, {BUCKET} FROM latest", "obs", latest=LATEST
    ),
    "land_raw": _with(
        f"SELECT obs_id, requested_city AS city, method, {BUCKET}, temp_c FROM landed",
        "obs", landed=LANDED.replace("@unit", "hour").replace("ORDER BY ", "ORDER BY (obs_id % 3 <> 1) DESC, "),
    ),
    "land_raw_minute": _with(
        """SELECT obs_id, method, strftime(ingest_ts, '%Y%m%d%H%M') AS minute_bucket,
  requested_city AS city FROM landed""",
        "obs", landed=LANDED.replace("@unit", "minute"),
    ),
    "append_fact": _with(FACTS.replace("@key", CITY_KEY.replace("@dim", "loc")), "obs", "loc"),
    "insert_missing_countries": _with(
        f"""SELECT CASE WHEN n_regionkey = 4 THEN 'Republic of ' || n_name ELSE n_name END AS name,
  'Capital ' || n_nationkey AS capital, 'Lang ' || n_nationkey AS language,
  '+0' || n_regionkey || ':00' AS tz_utc, r_name AS region, r_name AS continent,
  n_name AS requested_as, {RUN_TS} AS created_at
FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE n_name IN (SELECT country FROM places) AND n_name NOT IN (SELECT name FROM few)""",
        "obs", "few", places=CLEANED,
    ),
    # projections, filters
    "flatten_mapped": _with(
        """SELECT obs_id, cloud,
  '{"text":"' || condition_txt || '","code":' || condition_code || '}' AS condition,
  feelslike_c AS "feelslike_C", gust_kph, humidity, is_day::BIGINT AS is_day,
  last_updated_txt AS last_updated, precip_mm, pressure_in, temp_c AS "temp_C", uv, vis_km,
  wind_degree, wind_dir, wind_kph, country, city, region, lat, long,
  localtime_txt AS "localtime", tz_id FROM obs""",
        "obs",
    ),
    "flatten_all_leaves": _with(
        f"""SELECT {LOCATION_LEAVES}, cloud AS current_cloud, condition_txt AS current_condition_text,
  condition_code AS current_condition_code, feelslike_c AS current_feelslike_c,
  gust_kph AS current_gust_kph, humidity AS current_humidity, is_day::BIGINT AS current_is_day,
  last_updated_txt AS current_last_updated, precip_mm AS current_precip_mm,
  pressure_in AS current_pressure_in, temp_c AS current_temp_c, uv AS current_uv,
  vis_km AS current_vis_km, wind_degree AS current_wind_degree, wind_dir AS current_wind_dir,
  wind_kph AS current_wind_kph FROM obs""",
        "obs",
    ),
    "flatten_one_branch": _with(f"SELECT {LOCATION_LEAVES} FROM obs", "obs"),
    "identifiable_flag": _with(
        f"SELECT obs_id, city, lat, long, {IDENTIFIABLE} AS is_identifiable FROM obs", "obs"
    ),
    "identifiable_rows": _with(f"SELECT obs_id, city, lat, long FROM obs WHERE {IDENTIFIABLE}", "obs"),
    "identifiable_strict": _with(
        """SELECT obs_id, city, lat, long FROM obs
WHERE city IS NOT NULL AND lat IS NOT NULL AND long IS NOT NULL""",
        "obs",
    ),
    "trim_current": _with(PROCESSED, "obs"),
    "current_feed": _with(f"{PROCESSED} WHERE {IDENTIFIABLE}", "obs"),
    "feed_outcomes": _with(
        f"""SELECT 'current' AS method, 'failed' AS status, 0::BIGINT AS rows, count(*) AS stored FROM obs WHERE {IDENTIFIABLE}
UNION ALL SELECT 'astronomy', 'done', count(*), 2 * count(*) FROM ord WHERE {IDENTIFIABLE}
UNION ALL SELECT 'marine', 'done', n, 2 * n
  FROM (SELECT coalesce(sum(1 + o_orderkey % 3), 0)::BIGINT AS n FROM ord WHERE {IDENTIFIABLE})
UNION ALL SELECT 'sports', 'done', count(*), 2 * count(*) FROM fixtures
UNION ALL SELECT 'lightning', 'failed', 0, 0""",
        "obs", "ord", fixtures=SPORTS_ROWS,
    ),
    "project_location": _with(
        f"SELECT city, country, region, lat, long, tz_id FROM obs WHERE {IDENTIFIABLE}", "obs"
    ),
    "project_fact": _with(
        f"""SELECT city, cloud, condition_txt AS condition, feelslike_c AS "feelslike_C", gust_kph, humidity,
  {_time('last_updated_txt')} AS last_updated, {_time('localtime_txt')} AS "localtime", precip_mm,
  pressure_in, temp_c, uv, vis_km, wind_degree, wind_dir, wind_kph FROM obs WHERE {IDENTIFIABLE}""",
        "obs",
    ),
    "identified_flag": _places("SELECT obs_id, id, id IS NOT NULL AS is_identified FROM resolved"),
    "rename_positional": _with(
        """SELECT city AS "City", region AS "Region", country AS "Country", lat AS "Lat", long AS "Long",
  tz_id AS "TZ_ID", localtime_txt AS "Localtime" FROM obs""",
        "obs",
    ),
    "select_identity_plus": _with(
        f"""SELECT {ORD_IDENTITY}, localtime_txt AS "Localtime", o_orderstatus AS "Moon_Phase",
  CAST(o_orderkey % 100 AS VARCHAR) AS "Moon_Ilumination" FROM ord""",
        "ord",
    ),
    "audit_stamp": _with(f"SELECT obs_id, city, {RUN_TS} AS created_at FROM obs", "obs"),
    "drop_all_empty_lists": """
SELECT * FROM (SELECT o_orderkey, (o_orderkey % 3)::INT AS n_football, (o_orderkey % 2)::INT AS n_golf,
  greatest(o_orderkey % 5 - 2, 0)::INT AS n_cricket FROM orders)
WHERE n_football + n_golf + n_cricket > 0""",
    "fill_from_dimension": _places(
        """SELECT p.obs_id, coalesce(p.city, l.city) AS city, coalesce(p.lat, l.lat) AS lat,
  coalesce(p.long, l.long) AS long
FROM places p JOIN resolved r ON p.obs_id = r.obs_id LEFT JOIN loc l ON l.id = r.id"""
    ),
    # joins
    "lookup_location_or": _places(
        """SELECT p.obs_id, p.city, p.lat, p.long, r.id AS location_id
FROM places p JOIN resolved r ON p.obs_id = r.obs_id"""
    ),
    "lookup_country": _with(
        """SELECT p.obs_id, p.country, c.id AS country_id
FROM places p LEFT JOIN ctry c ON c.name = p.country""",
        "obs", "ctry", places=CLEANED,
    ),
    "new_locations": _places(NEW_LOCATIONS.replace("@rows", "once")),
    "new_locations_all": _places(NEW_LOCATIONS.replace("@rows", "unresolved")),
    "new_location_ids": _places(NEW_IDS),
    "fact_with_fk": _with(FACTS.replace("@key", CITY_KEY.replace("@dim", "loc")), "obs", "loc"),
    "fact_with_fk_coords": _with(
        FACTS.replace(
            "@key",
            """(SELECT min(l.id) FROM loc l WHERE l.city = replace(o.city, chr(39), '')
    OR (l.lat = o.lat AND l.long = o.long))""",
        ),
        "obs", "loc",
    ),
    # aggregations
    "null_profile": _with(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, coalesce(bool_or({c} IS NULL), false) AS has_null FROM obs"
            for c in OBS_TYPES
        ),
        "obs",
    ),
    "type_profile": _with(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS rows_with_value FROM obs"
            for c, t in OBS_TYPES.items()
        ),
        "obs",
    ),
    "dim_key_min_id": _with(
        """SELECT lat, long, min(id) AS first_id FROM loc
WHERE lat IS NOT NULL AND long IS NOT NULL GROUP BY lat, long""",
        "loc",
    ),
    "key_exists": _with(
        """SELECT c.city, (SELECT count(*) FROM loc l WHERE l.city = c.city) > 0 AS is_known
FROM (SELECT DISTINCT city FROM obs) c""",
        "obs", "loc",
    ),
    # windows, limits
    "row_index": """
SELECT o_orderstatus, o_orderdate, o_orderkey,
  row_number() OVER (ORDER BY o_orderstatus, o_orderdate, o_orderkey) AS row_index FROM orders""",
    "head_rows": _with(
        "SELECT obs_id, city, temp_c FROM obs ORDER BY temp_c DESC NULLS LAST, obs_id LIMIT 5", "obs"
    ),
    "head_row": _with("SELECT wind_dir FROM obs ORDER BY ingest_ts, obs_id LIMIT 1", "obs"),
    # scalar functions
    "empty_to_null": _with(
        "SELECT obs_id, "
        + ", ".join(
            f"nullif({c}, '') AS {c}"
            for c in ("city", "country", "region", "tz_id", "condition_txt", "wind_dir")
        )
        + " FROM obs",
        "obs",
    ),
    "strip_quotes": "SELECT doc_id, replace(text, chr(39), '') AS text FROM documents",
    "clean_locations": _with(CLEANED.split("WHERE NOT")[0], "obs"),
    "clean_facts": _with(
        f"""SELECT obs_id, replace(city, chr(39), '') AS city, nullif(condition_txt, '') AS condition,
  nullif(wind_dir, '') AS wind_dir, {_time('last_updated_txt')} AS last_updated,
  {_time('localtime_txt')} AS "localtime" FROM obs""",
        "obs",
    ),
    "strip_utc": """
SELECT c_custkey, zone, replace(zone, 'UTC', '') AS tz_utc FROM (
  SELECT c_custkey, 'UTC' AS zone FROM customer
  UNION ALL SELECT c_custkey, 'UTC+0' || c_nationkey || ':00' FROM customer WHERE c_custkey % 9 <> 0)""",
    "map_values_joined": f"SELECT c_custkey, language FROM ({PAYLOAD_PARTS})",
    "array_first": f"SELECT c_custkey, continent FROM ({PAYLOAD_PARTS})",
    "nested_default": f"SELECT c_custkey, common AS name, subregion AS region FROM ({PAYLOAD_PARTS})",
    "country_record": f"""
SELECT c_custkey, continent, replace(zone, 'UTC', '') AS tz_utc,
  replace(common, chr(39), '') AS name, subregion AS region, language,
  'Port ' || c_custkey AS capital FROM ({PAYLOAD_PARTS})""",
    "parse_times": _with(
        f"""SELECT obs_id, {_time('last_updated_txt')} AS last_updated,
  {_time('localtime_txt')} AS "localtime" FROM obs""",
        "obs",
    ),
    "cast_times": _with(
        f"""SELECT city, {_time('localtime_txt')} AS "localtime", {_time('last_updated_txt')} AS last_updated
FROM obs WHERE {IDENTIFIABLE}""",
        "obs",
    ),
    "hour_bucket": _with(
        f"""SELECT obs_id, ingest_ts, 'current' AS method, {BUCKET},
  'raw/current/' || year(ingest_ts) || '/' || month(ingest_ts) || '/' || day(ingest_ts) || '/'
    || hour(ingest_ts) AS path FROM obs""",
        "obs",
    ),
    "format_times": _with(
        """SELECT obs_id, strftime(ingest_ts, '%Y-%m-%dT%H:%M:%S') AS iso,
  strftime(ingest_ts, '%Y%m%d%H%M') AS minute_bucket FROM obs""",
        "obs",
    ),
    "parse_clock": _with(
        f"""SELECT o_orderkey, {_clock('date_txt', 'rise_txt')} AS rise,
  {_clock('date_txt', 'set_txt')} AS "set", {_clock('date_txt', 'moon_txt')} AS moon FROM ord""",
        "ord",
    ),
    "rows_to_json": _with(
        """SELECT CAST(json_merge_patch('{}', json_object('obs_id', obs_id, 'city', city,
  'country', country, 'humidity', humidity, 'vis_km', vis_km)) AS VARCHAR) AS json FROM obs""",
        "obs",
    ),
    "json_to_rows": _with(
        "SELECT obs_id, city, lat, wind_kph, condition_txt AS condition FROM obs", "obs"
    ),
    "contract_violations": _with(
        """
SELECT event_id, '' AS path, 'corrupt' AS kind FROM props_text WHERE NOT json_valid(payload)
UNION ALL SELECT event_id, 'k', 'missing' FROM valid WHERE NOT list_contains(json_keys(payload), 'k')
UNION ALL SELECT event_id, 'k', 'wrong_type' FROM valid
  WHERE json_type(payload, '$.k') NOT IN ('BIGINT', 'UBIGINT')
UNION ALL SELECT event_id, 'note', 'wrong_type' FROM valid
  WHERE json_type(payload, '$.note') NOT IN ('VARCHAR', 'NULL')
UNION ALL SELECT event_id, key, 'unknown_key' FROM
  (SELECT event_id, unnest(json_keys(payload)) AS key FROM valid) WHERE key NOT IN ('k', 'note')""",
        "props_text",
        valid="SELECT * FROM props_text WHERE json_valid(payload)",
    ),
    "contract_conforming": _with(
        """SELECT obs_id FROM obs WHERE NOT (obs_id % 31 = 0 OR obs_id % 29 <> 0 AND (obs_id % 23 = 0 OR obs_id % 19 = 0))""",
        "obs",
    ),
    "contract_nested": _with(
        """SELECT obs_id, '' AS path, 'corrupt' AS kind FROM obs WHERE obs_id % 31 = 0
UNION ALL SELECT obs_id, 'current.clouds', 'unknown_key' FROM obs WHERE obs_id % 31 <> 0 AND obs_id % 29 = 0
UNION ALL SELECT obs_id, 'now', 'unknown_key' FROM obs WHERE obs_id % 31 <> 0 AND obs_id % 29 <> 0 AND obs_id % 23 = 0
UNION ALL SELECT obs_id, 'current', 'missing' FROM obs WHERE obs_id % 31 <> 0 AND obs_id % 29 <> 0 AND obs_id % 23 = 0
UNION ALL SELECT obs_id, 'current.cloud', 'wrong_type' FROM obs
  WHERE obs_id % 31 <> 0 AND obs_id % 29 <> 0 AND obs_id % 23 <> 0 AND obs_id % 19 = 0""",
        "obs",
    ),
    # feeds
    "astronomy_feed": _with(
        f"""SELECT {ORD_IDENTITY}, {ORD_LOCALTIME}, {_clocks('date_txt')}, o_orderstatus AS "Moon_Phase",
  CAST(o_orderkey % 100 AS VARCHAR) AS "Moon_Ilumination", (o_orderkey % 2)::INT AS "Moon_Up",
  ((o_orderkey + 1) % 2)::INT AS "Moon_Down"
FROM ord WHERE {IDENTIFIABLE}""",
        "ord",
    ),
    "marine_days": _with(
        f"""SELECT {ORD_IDENTITY}, {ORD_LOCALTIME}, {_time('day_txt')} AS "Date",
  '[' || list_aggregate(list_transform(range(1, 2 + o_orderkey % 4), lambda h: '{{"time":"' || day_txt || ' '
    || lpad(CAST(h AS VARCHAR), 2, '0') || ':00","temp_c":' || (o_orderkey % 40 + h) || '.0}}'),
    'string_agg', ',') || ']' AS "Hourly_data",
  o_totalprice AS "Maxtemp_C", (o_orderkey % 50)::DOUBLE AS "Mintemp_C",
  (o_orderkey % 60 + d)::DOUBLE AS "Avgtemp_C", (o_orderkey % 70)::DOUBLE AS "Maxwind_kph",
  NULL::DOUBLE AS "Totalprecip_mm", 0.0::DOUBLE AS "Totalsnow_cm", 10.0::DOUBLE AS "Avgvis_km",
  (o_orderkey % 80)::DOUBLE AS "Avghumidity",
  '[{{"tide":[' || CASE o_orderkey % 3 WHEN 0 THEN ''
    WHEN 1 THEN '{{"tide_time":"' || day_txt || ' 06:30","tide_type":"HIGH"}}'
    ELSE '{{"tide_time":"' || day_txt || ' 06:30","tide_type":"HIGH"}},{{"tide_time":"' || day_txt
      || ' 12:30","tide_type":"LOW"}}' END || ']}}]' AS "Tides",
  o_orderstatus AS "Condition_text", 1000 + o_orderkey % 9 AS "Condition_code",
  (o_orderkey % 12)::DOUBLE AS "UV", {_clocks('day_txt')}
FROM days WHERE {IDENTIFIABLE}""",
        "ord", days=ORD_DAYS,
    ),
    "marine_hours": _with(
        f"""SELECT {ORD_IDENTITY}, {ORD_LOCALTIME}, {_time('day_txt')} AS "Date",
  {_time('day_txt')} + to_hours(h::INT) AS "Hour", (o_orderkey % 40 + h)::DOUBLE AS "Temp_C"
FROM (SELECT *, unnest(range(1, 2 + o_orderkey % 4)) AS h FROM days) WHERE {IDENTIFIABLE}""",
        "ord", days=ORD_DAYS,
    ),
    "marine_tides": _with(
        f"""SELECT {ORD_IDENTITY}, {ORD_LOCALTIME}, {_time('day_txt')} AS "Date",
  CASE WHEN o_orderkey % 3 > 0 THEN {_time('day_txt')} + to_minutes((t * 360 + 30)::INT) END AS "Tide_time",
  CASE WHEN o_orderkey % 3 > 0 THEN CASE t WHEN 1 THEN 'HIGH' ELSE 'LOW' END END AS "Tide_type"
FROM (SELECT *, unnest(range(1, 1 + greatest(o_orderkey % 3, 1))) AS t FROM days) WHERE {IDENTIFIABLE}""",
        "ord", days=ORD_DAYS,
    ),
    "sports_union": _with(SPORTS_ROWS, "ord"),
    # streaming, whole run
    "incremental_load": _with(
        f"{PROCESSED.replace('FROM obs', 'FROM loaded')}", every=VIEWS["obs"],
        one=LANDED.replace("@unit", "hour").replace("FROM obs", "FROM every WHERE obs_id % 2 = 0"),
        two=LANDED.replace("@unit", "hour").replace("FROM obs", "FROM every"),
        loaded=f"""SELECT * FROM two WHERE {IDENTIFIABLE}
UNION ALL SELECT * FROM one a WHERE {IDENTIFIABLE} AND NOT EXISTS (
  SELECT 1 FROM two b WHERE b.method = a.method AND b.requested_city = a.requested_city
    AND date_trunc('hour', b.ingest_ts) = date_trunc('hour', a.ingest_ts) AND {IDENTIFIABLE.replace('city', 'b.city').replace('lat', 'b.lat').replace('long', 'b.long')})""",
    ),
    "hourly_run": _with(
        FACTS.replace("@key", CITY_KEY.replace("@dim", "known")), every=VIEWS["obs"],
        obs=LATEST.replace("FROM obs", "FROM every"), loc=VIEWS["loc"], places=CLEANED, resolved=RESOLVED,
        unresolved=UNRESOLVED, named=NAMED, once=ONCE, fresh=NEW_IDS,
        known="SELECT id, city FROM loc UNION ALL SELECT id, city FROM fresh",
    ),
}

ORACLE_SQL["lookup_location_or_shuffled"] = ORACLE_SQL["lookup_location_or"]
ORACLE_SQL["land_raw_minute_deltas"] = ORACLE_SQL["land_raw_minute"]
ORACLE_SQL["land_raw_deltas"] = _with(
    f"SELECT obs_id, requested_city AS city, method, {BUCKET}, temp_c FROM landed", "obs", landed=LANDED.replace("@unit", "hour")
)
ORACLE_SQL["stream_latest"] = ORACLE_SQL["land_raw_deltas"]
ORACLE_SQL["missing_spans"] = _with(
    """SELECT method, city, min(h)::TIMESTAMP AS gap_from, max(h)::TIMESTAMP AS gap_to, count(*)::BIGINT AS hours
FROM (
  SELECT m.method, c.city, hours.h, date_diff('hour', TIMESTAMP '2024-01-01', hours.h) - row_number() OVER (PARTITION BY m.method, c.city ORDER BY hours.h) AS island
  FROM (SELECT DISTINCT c_name AS city FROM customer) c
  CROSS JOIN (VALUES ('current'), ('sports'), ('astronomy'), ('marine')) m(method)
  CROSS JOIN (SELECT unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01', INTERVAL 1 HOUR)) AS h) hours
  WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.method = m.method AND l.city = c.city AND l.h = hours.h)
)
GROUP BY method, city, island""",
    "obs",
    landed="""SELECT DISTINCT CASE condition_txt WHEN 'click' THEN 'current' WHEN 'view' THEN 'sports'
  WHEN 'purchase' THEN 'astronomy' ELSE 'marine' END AS method, requested_city AS city,
  date_trunc('hour', ingest_ts) AS h FROM obs WHERE requested_city IS NOT NULL""",
)
ORACLE_SQL["lookup_location_stored"] = ORACLE_SQL["lookup_location_or"]


# Leaves of the nested payloads, column by column.
_NOW = "CASE WHEN obs_id % 29 <> 0 AND obs_id % 23 = 0 THEN 'now.' ELSE 'current.' END"
_CLOUD = "CASE WHEN obs_id % 29 = 0 THEN 'clouds' ELSE 'cloud' END"
_CLOUD_KIND = "CASE WHEN obs_id % 29 <> 0 AND obs_id % 23 <> 0 AND obs_id % 19 = 0 THEN 'DOUBLE' ELSE 'BIGINT' END"
_LOCATION_LEAVES = {
    "name": ("city", "STRING"), "region": ("region", "STRING"), "country": ("country", "STRING"),
    "lat": ("lat", "DOUBLE"), "lon": ("long", "DOUBLE"), "tz_id": ("tz_id", "STRING"),
    "localtime": ("localtime_txt", "STRING"),
}
_CURRENT_LEAVES = {
    "condition.text": ("condition_txt", "STRING"), "condition.code": ("condition_code", "BIGINT"),
    "feelslike_c": ("feelslike_c", "DOUBLE"), "gust_kph": ("gust_kph", "DOUBLE"), "humidity": ("humidity", "BIGINT"),
    "is_day": ("is_day", "BIGINT"), "last_updated": ("last_updated_txt", "STRING"), "precip_mm": ("precip_mm", "DOUBLE"),
    "pressure_in": ("pressure_in", "DOUBLE"), "temp_c": ("temp_c", "DOUBLE"), "uv": ("uv", "DOUBLE"),
    "vis_km": ("vis_km", "DOUBLE"), "wind_degree": ("wind_degree", "BIGINT"), "wind_dir": ("wind_dir", "STRING"),
    "wind_kph": ("wind_kph", "DOUBLE"),
}


def _leaf(path: str, kind: str, column: str, text: bool) -> str:
    value, number = (column, "NULL") if text else ("NULL", column)
    return f"""SELECT obs_id, ingest_ts, {path} AS path, {kind} AS kind, {value}::VARCHAR AS value, {number}::DOUBLE AS number
FROM obs WHERE obs_id % 31 <> 0 AND {column} IS NOT NULL"""


LEAVES = " UNION ALL ".join([
    "SELECT obs_id, ingest_ts, '' AS path, 'CORRUPT' AS kind, 'not a document' AS value, NULL::DOUBLE AS number FROM obs WHERE obs_id % 31 = 0",
    _leaf(f"{_NOW} || {_CLOUD}", _CLOUD_KIND, "cloud", False),
    *(_leaf(f"'location.{p}'", f"'{k}'", c, k == "STRING") for p, (c, k) in _LOCATION_LEAVES.items()),
    *(_leaf(f"{_NOW} || '{p}'", f"'{k}'", c, k == "STRING") for p, (c, k) in _CURRENT_LEAVES.items()),
])
_DECLARED = ", ".join(
    f"('{p}')" for p in [*(f"location.{n}" for n in _LOCATION_LEAVES), "current.cloud", *(f"current.{n}" for n in _CURRENT_LEAVES)]
)
ORACLE_SQL["variant_leaves"] = _with("SELECT obs_id, path, kind, value, number FROM leaves", "obs", leaves=LEAVES)
ORACLE_SQL["schema_drift"] = _with(
    """SELECT path, kind, change, min(h) AS first_hour, max(h) AS last_hour, count(DISTINCT h)::BIGINT AS hours, count(*)::BIGINT AS payloads
FROM (SELECT path, kind, date_trunc('hour', ingest_ts) AS h, CASE WHEN kind = 'CORRUPT' THEN 'corrupt'
  WHEN path NOT IN (SELECT path FROM declared) THEN 'new' WHEN path = 'current.cloud' AND kind = 'DOUBLE' THEN 'retyped' END AS change
  FROM leaves) WHERE change IS NOT NULL GROUP BY path, kind, change
UNION ALL SELECT d.path, NULL, 'lost', min(x.h), max(x.h), count(*)::BIGINT, 0::BIGINT
FROM declared d CROSS JOIN (SELECT DISTINCT date_trunc('hour', ingest_ts) AS h FROM obs) x
WHERE NOT EXISTS (SELECT 1 FROM leaves l WHERE l.path = d.path AND date_trunc('hour', l.ingest_ts) = x.h)
GROUP BY d.path""",
    "obs", leaves=LEAVES, declared=f"SELECT * FROM (VALUES {_DECLARED}) v(path)",
)

_NUMBERS = ("bigint", "double")


def _profiled(column: str, kind: str) -> str:
    low, high = (f"{f}({column})::DOUBLE" if kind in _NUMBERS else "NULL::DOUBLE" for f in ("min", "max"))
    close = f"CASE WHEN count({column}) > 0 THEN true END" if kind in _NUMBERS else "NULL::BOOLEAN"
    return f"""SELECT '{column}' AS column_name, count(*) AS rows, count({column}) AS rows_with_value, {low} AS low, {high} AS high,
  count(DISTINCT {column}) AS exact_distinct, true AS distinct_close, {close} AS quantiles_close FROM obs"""


ORACLE_SQL["profile_range"] = _with(
    " UNION ALL ".join(_profiled(c, t) for c, t in OBS_TYPES.items() if c != "ingest_ts"), "obs"
)
ORACLE_SQL["point_read"] = _with(
    """SELECT obs_id, ingest_ts, requested_city, temp_c FROM obs
WHERE requested_city IN ('Customer#000000001', 'Customer#000000007', 'Customer#999999999')""",
    "obs",
)
