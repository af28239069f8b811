"""The registered queries as ANSI SQL over the same tables, for cross-checking.

Written apart from the operators: a chain of named subqueries from the raw
tables to each stage, and one SELECT per query.
"""

from __future__ import annotations

from aerocell.schemas import GEOHASH_ALPHABET, GOLD_SCHEMA, SILVER_SCHEMA

NOW = "TIMESTAMP '2024-01-30 00:00:00'"


def r2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(18,6)), 2) AS DOUBLE)"


def text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def ts(seconds: str) -> str:
    return f"make_timestamp(CAST({seconds} AS BIGINT) * 1000000)"


def utc_day(seconds: str) -> str:
    return f"CAST({ts(seconds)} AS DATE)"


def cell(lat: str, lon: str, precision: int = 4) -> str:
    """Geohash by interleaving the two cell numbers into one integer."""
    total = 5 * precision
    bits = {"lon": total - total // 2, "lat": total // 2}

    def number(value: str, span: float, n: int) -> str:
        size = f"CAST({span / (1 << n)!r} AS DOUBLE)"
        raw = f"CAST(ceil(({value}) / {size}) AS BIGINT) + {(1 << (n - 1)) - 1}"
        return f"greatest(0, least({(1 << n) - 1}, {raw}))"

    lon_n, lat_n = number(lon, 360.0, bits["lon"]), number(lat, 180.0, bits["lat"])
    # The last bit of an odd total belongs to the longitude.
    lon_at, lat_at = (0, 1) if total % 2 else (1, 0)
    terms = [f"(((z.lon_n >> {k}) & 1) << {2 * k + lon_at})" for k in range(bits["lon"])]
    terms += [f"(((z.lat_n >> {k}) & 1) << {2 * k + lat_at})" for k in range(bits["lat"])]
    code = " + ".join(terms)
    chars = " || ".join(
        f"substr('{GEOHASH_ALPHABET}', CAST((m.code >> {5 * (precision - 1 - p)}) & 31 AS INTEGER) + 1, 1)"
        for p in range(precision)
    )
    return (
        f"(SELECT CASE WHEN m.code IS NULL THEN NULL ELSE {chars} END FROM (SELECT {code} AS code"
        f" FROM (SELECT CASE WHEN ({lon}) IS NOT NULL THEN {lon_n} END AS lon_n,"
        f" CASE WHEN ({lat}) IS NOT NULL THEN {lat_n} END AS lat_n) z) m)"
    )


def centre(code: str, precision: int = 4) -> tuple[str, str]:
    """(lat, lon) expressions of a cell's centre."""
    total = 5 * precision
    lon_bits, lat_bits = total - total // 2, total // 2
    sums: dict[str, list[str]] = {"lon": [], "lat": []}
    seen = {"lon": 0, "lat": 0}
    for nth in range(total):
        axis, n = ("lon", lon_bits) if nth % 2 == 0 else ("lat", lat_bits)
        digit = f"(instr('{GEOHASH_ALPHABET}', substr({code}, {nth // 5 + 1}, 1)) - 1)"
        sums[axis].append(f"((({digit} >> {4 - nth % 5}) & 1) << {n - 1 - seen[axis]})")
        seen[axis] += 1

    def middle(axis: str, span: float, n: int) -> str:
        number = " + ".join(sums[axis])
        return f"round(CAST({-span / 2} AS DOUBLE) + (({number}) + CAST(0.5 AS DOUBLE)) * CAST({span / (1 << n)!r} AS DOUBLE), 4)"

    return middle("lat", 180.0, lat_bits), middle("lon", 360.0, lon_bits)


def risk(p: str, g: str, c: str, clamp: bool = False) -> str:
    rain, gust = f"coalesce({p}, 0)", f"coalesce({g}, 0)"
    if clamp:
        rain, gust = f"greatest({rain}, 0)", f"greatest({gust}, 0)"
    cloud = f"greatest(0, least(100, coalesce({c}, 0)))"
    total = f"{rain} * CAST(15 AS DOUBLE) + {gust} * CAST(1.5 AS DOUBLE) + {cloud} * CAST(0.2 AS DOUBLE)"
    if clamp:
        return r2(f"greatest(0, least(100, {total}))")
    return f"greatest(CAST(0 AS DOUBLE), least(CAST(100 AS DOUBLE), {r2(total)}))"


def category(prefix: str = "") -> str:
    p = prefix
    return (
        f"CASE WHEN {p}convective_risk_score >= 60 OR {p}precipitation_mm >= 3 OR {p}wind_gusts_mps >= 22"
        f" THEN 'SEVERE_STORM' WHEN {p}wind_speed_mps >= 14 OR {p}wind_gusts_mps >= 18 THEN 'HIGH_WIND_SHEAR'"
        f" WHEN {p}precipitation_mm >= CAST(0.5 AS DOUBLE) THEN 'MODERATE_RAIN'"
        f" WHEN {p}visibility_m < 3000 THEN 'LOW_VISIBILITY' ELSE 'CLEAR' END"
    )


def deficit(v: str) -> str:
    return f"CASE WHEN {v} > 0 THEN {r2(f'(CAST(230 AS DOUBLE) - {v}) / CAST(230 AS DOUBLE) * CAST(100 AS DOUBLE)')} ELSE CAST(0 AS DOUBLE) END"


TIER = (
    "CASE WHEN convective_risk_score >= 70 THEN 'red' WHEN convective_risk_score >= 45 THEN 'orange'"
    " WHEN convective_risk_score >= 20 THEN 'yellow' ELSE 'green' END"
)
COLOR = (
    "CASE WHEN convective_risk_score >= 70 THEN '231,76,60,220' WHEN convective_risk_score >= 45 THEN '230,126,34,210'"
    " WHEN convective_risk_score >= 20 THEN '241,196,15,200' ELSE '46,204,113,180' END"
)

_DATES = {"recorded_date", "weather_recorded_at", "ingested_at", "window_start", "window_end"}


def shown(names, prefix: str = "") -> str:
    """Select list with dates and times as text."""
    return ", ".join(f"{text(prefix + n)} AS {n}" if n in _DATES else f"{prefix}{n} AS {n}" for n in names)


SILVER_COLUMNS = SILVER_SCHEMA.names
GOLD_COLUMNS = [n for n in GOLD_SCHEMA.names if n != "computed_at"]
REPORT_COLUMNS = SILVER_COLUMNS[1:17]

FLIGHTS_RAW = f"""
base AS (
  SELECT event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS t, user_id, value FROM events
),
flights_raw AS (
  SELECT id AS event_id, copy,
    CASE WHEN id % 50 = 19 THEN 'ab' WHEN id % 3 = 0 THEN '  ' || hex(user_id + 11000000) || ' '
         ELSE lower(hex(user_id + 11000000)) END AS icao24,
    CASE WHEN id % 10 = 0 THEN NULL WHEN id % 10 = 1 THEN '   ' WHEN id % 200 = 57 THEN 'TOOLONGCALLSIGN'
         ELSE ' FLT' || user_id || '  ' END AS callsign,
    CASE WHEN id % 11 = 0 THEN NULL WHEN user_id % 3 = 0 THEN 'Canada' ELSE 'United States' END AS origin_country,
    t - t % 600 + 600 AS server_time,
    CASE WHEN id % 29 <> 0 THEN t END AS time_position,
    CASE WHEN id % 31 <> 0 THEN t + 5 END AS last_contact,
    CASE WHEN id % 23 = 5 THEN NULL WHEN id % 50 = 13 THEN CAST(200 AS DOUBLE)
         ELSE CAST(-79 AS DOUBLE) + ((id * 53) % 3200) / CAST(1000 AS DOUBLE) END AS longitude,
    CASE WHEN id % 50 = 7 THEN CAST(105 AS DOUBLE)
         ELSE CAST(38 AS DOUBLE) + ((id * 37) % 2800) / CAST(1000 AS DOUBLE) END AS latitude,
    CASE WHEN id % 13 <> 0 THEN CAST((id * 97) % 12000 AS DOUBLE) END AS baro_altitude_m,
    CASE WHEN id % 37 <> 0 THEN id % 40 = 0 END AS on_ground,
    CASE WHEN id % 17 = 0 THEN NULL WHEN id % 50 = 23 THEN CAST(-1 AS DOUBLE)
         ELSE value + CAST(150 AS DOUBLE) END AS velocity_mps,
    CASE WHEN id % 50 = 29 THEN CAST(400 AS DOUBLE) ELSE CAST((id * 7) % 361 AS DOUBLE) END AS true_track_deg,
    CAST(id % 41 - 20 AS DOUBLE) AS vertical_rate_mps,
    CASE WHEN id % 13 <> 0 THEN CAST((id * 97) % 12000 AS DOUBLE) + CAST(150 AS DOUBLE) END AS geo_altitude_m,
    CASE WHEN id % 6 <> 0 THEN lpad(CAST(id % 7778 AS VARCHAR), 4, '0') END AS squawk,
    CASE WHEN id % 37 <> 0 THEN id % 97 = 0 END AS spi,
    CASE WHEN id % 9 <> 0 THEN CAST(id % 3 AS INTEGER) END AS position_source,
    {ts("t - t % 600 + 600")} AS ingested_at
  FROM base, (VALUES (0), (1)) AS copies(copy)
  WHERE copy = 0 OR id % 20 = 3
)"""

FLIGHTS = """
flights AS (
  SELECT event_id, copy, server_time, lower(trim(icao24)) AS icao24, nullif(trim(callsign), '') AS callsign,
    CASE WHEN origin_country IS NULL OR origin_country = '' THEN 'Unknown' ELSE trim(origin_country) END AS origin_country,
    coalesce(time_position, server_time) AS time_position, coalesce(last_contact, server_time) AS last_contact,
    longitude, latitude, baro_altitude_m, coalesce(on_ground, false) AS on_ground, velocity_mps, true_track_deg,
    vertical_rate_mps, geo_altitude_m, nullif(trim(squawk), '') AS squawk, coalesce(spi, false) AS spi,
    coalesce(position_source, 0) AS position_source, ingested_at
  FROM flights_raw WHERE longitude IS NOT NULL AND latitude IS NOT NULL
),
checked AS (
  SELECT *, concat_ws(',',
    CASE WHEN length(icao24) NOT BETWEEN 4 AND 10 THEN 'icao24_length' END,
    CASE WHEN length(callsign) > 12 THEN 'callsign_length' END,
    CASE WHEN longitude NOT BETWEEN -180 AND 180 THEN 'longitude_range' END,
    CASE WHEN latitude NOT BETWEEN -90 AND 90 THEN 'latitude_range' END,
    CASE WHEN velocity_mps < 0 THEN 'velocity_mps_range' END,
    CASE WHEN true_track_deg NOT BETWEEN 0 AND 360 THEN 'true_track_deg_range' END) AS reasons
  FROM flights
)"""

TAGGED = f"""
tagged AS (
  SELECT *, sha256(icao24 || '_' || time_position) AS flight_record_id, {cell("latitude", "longitude")} AS geohash,
    {utc_day("time_position")} AS recorded_date, time_position // 86400 AS cycle_id
  FROM checked WHERE reasons = ''
)"""

WEATHER = f"""
weather_raw AS (
  SELECT o_orderkey AS o, 19723 + o_orderkey % 30 AS cycle_id,
    {cell("CAST(38 AS DOUBLE) + ((o_orderkey * 41) % 2800) / CAST(1000 AS DOUBLE)", "CAST(-79 AS DOUBLE) + ((o_orderkey * 59) % 3200) / CAST(1000 AS DOUBLE)")} AS geohash,
    {ts("(19723 + o_orderkey % 30) * 86400 + (o_orderkey % 24) * 3600 + (o_orderkey % 60) * 60")} AS weather_recorded_at,
    ((o_orderkey * 23) % 600) / CAST(10 AS DOUBLE) - CAST(20 AS DOUBLE) AS temperature_c,
    CAST((o_orderkey * 37) % 101 AS DOUBLE) AS relative_humidity_pct,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN ((o_orderkey * 13) % 50) / CAST(10 AS DOUBLE)
         ELSE ((o_orderkey * 13) % 8) / CAST(10 AS DOUBLE) END AS precipitation_mm,
    CASE WHEN o_orderkey % 19 <> 0 THEN ((o_orderkey * 19) % 170) / CAST(10 AS DOUBLE) END AS wind_speed_mps,
    CAST((o_orderkey * 43) % 361 AS DOUBLE) AS wind_direction_deg,
    ((o_orderkey * 17) % 260) / CAST(10 AS DOUBLE) AS wind_gusts_mps,
    ((o_orderkey * 29) % 1201) / CAST(10 AS DOUBLE) AS cloud_cover_pct,
    CASE WHEN o_orderkey % 4 <> 0 THEN CAST((o_orderkey * 31) % 12000 AS DOUBLE) END AS visibility_m
  FROM orders
),
weather AS (
  SELECT * EXCLUDE (o, newest) FROM (
    SELECT *, row_number() OVER (PARTITION BY cycle_id, geohash ORDER BY o DESC) AS newest FROM weather_raw
  ) WHERE newest = 1
)"""

SILVER = f"""
enriched AS (
  SELECT f.*, w.* EXCLUDE (cycle_id, geohash),
    {risk("w.precipitation_mm", "w.wind_gusts_mps", "w.cloud_cover_pct")} AS convective_risk_score
  FROM tagged f LEFT JOIN weather w ON f.cycle_id = w.cycle_id AND f.geohash = w.geohash
),
silver AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (PARTITION BY flight_record_id ORDER BY event_id, copy) AS nth FROM enriched
  ) WHERE nth = 1
)"""


def gold_from(source: str) -> str:
    speed = "avg(velocity_mps)"
    return f"""
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, recorded_date, geohash,
    weather_condition_category, count(DISTINCT icao24) AS total_active_flights,
    count(*) FILTER (baro_altitude_m >= 3000) AS total_cruising_flights,
    {r2(speed)} AS avg_velocity_mps, CAST(230 AS DOUBLE) AS baseline_velocity_mps,
    {r2(f"(CAST(230 AS DOUBLE) - {speed}) / CAST(230 AS DOUBLE) * CAST(100 AS DOUBLE)")} AS velocity_deficit_pct,
    {r2("avg(coalesce(precipitation_mm, 0))")} AS avg_precipitation_mm,
    {r2("max(coalesce(precipitation_mm, 0))")} AS max_precipitation_mm,
    {r2("avg(coalesce(wind_speed_mps, 0))")} AS avg_wind_speed_mps,
    {r2("max(coalesce(wind_gusts_mps, 0))")} AS peak_wind_gust_mps,
    {r2("avg(coalesce(cloud_cover_pct, 0))")} AS avg_cloud_cover_pct,
    {r2("min(coalesce(visibility_m, 10000))")} AS min_visibility_m,
    {r2("avg(coalesce(convective_risk_score, 0))")} AS mean_convective_risk,
    count(*) FILTER (convective_risk_score >= 50) AS flights_impacted_count
  FROM (SELECT *, date_trunc('hour', weather_recorded_at) AS window_start,
          {category()} AS weather_condition_category FROM {source}
        WHERE weather_recorded_at IS NOT NULL AND velocity_mps IS NOT NULL)
  GROUP BY window_start, recorded_date, geohash, weather_condition_category"""


GOLD = f"""
gold AS ({gold_from("silver")}
),
morning AS (SELECT * FROM silver WHERE hour({ts("time_position")}) < 12),
gold_old AS ({gold_from("morning")}
),
delta AS (SELECT * FROM gold WHERE recorded_date >= DATE '2024-01-16'),
explorer AS (
  SELECT *, {category()} AS hazard_category, {TIER} AS risk_tier, {COLOR} AS color,
    {deficit("velocity_mps")} AS velocity_deficit_pct FROM silver
)"""

AUDIT = f"""
audit AS (
  SELECT 'audit-' || {text("recorded_date")} AS audit_id,
    CAST(recorded_date + INTERVAL 7 DAY AS TIMESTAMP) AS archival_timestamp,
    recorded_date AS target_partition_date, n AS record_count_evicted, n * 220 AS raw_uncompressed_bytes,
    n * 31 AS compressed_parquet_bytes,
    {r2("(n * 220) / CAST(greatest(1, n * 31) AS DOUBLE)")} AS compression_ratio,
    sha256(archive_key || ':' || n) AS sha256_checksum, 'local://' || archive_key AS storage_destination_uri,
    CASE WHEN day(recorded_date) % 10 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS eviction_status,
    'silver' AS truncated_table_name, CAST(1.5 AS DOUBLE) AS execution_duration_seconds, '{{}}' AS metadata_json,
    archive_key
  FROM (SELECT recorded_date, count(*) AS n, 'archives/silver/' || {text("recorded_date")} || '/silver_'
          || {text("recorded_date")} || '.parquet' AS archive_key FROM silver GROUP BY recorded_date)
),
digests AS (
  SELECT archive_key, CASE WHEN day(target_partition_date) % 9 = 0 THEN reverse(sha256_checksum)
    ELSE sha256_checksum END AS actual FROM audit WHERE day(target_partition_date) % 7 <> 0
),
verified AS (
  SELECT a.*, CASE WHEN d.actual IS NULL THEN 'MISSING' WHEN d.actual = a.sha256_checksum THEN 'VERIFIED'
    ELSE 'CORRUPTED' END AS verification
  FROM audit a LEFT JOIN digests d ON a.archive_key = d.archive_key WHERE a.eviction_status = 'SUCCESS'
)"""

CHAIN = ",".join([FLIGHTS_RAW, FLIGHTS, TAGGED, WEATHER, SILVER, GOLD, AUDIT])


def q(select: str) -> str:
    return f"WITH {CHAIN}\n{select}"


def _audit_shown(names) -> str:
    times = {"archival_timestamp", "target_partition_date"}
    return ", ".join(f"{text(n)} AS {n}" if n in times else n for n in names)


AUDIT_COLUMNS = [
    "audit_id", "archival_timestamp", "target_partition_date", "record_count_evicted", "raw_uncompressed_bytes",
    "compressed_parquet_bytes", "compression_ratio", "sha256_checksum", "storage_destination_uri",
    "eviction_status", "truncated_table_name", "execution_duration_seconds", "metadata_json",
]
MANIFEST = [
    "audit_id", "archival_timestamp", "target_partition_date", "record_count_evicted", "compressed_parquet_bytes",
    "sha256_checksum", "storage_destination_uri", "truncated_table_name",
]
AUDIT_VIEW = (
    "audit_id, CAST(archival_timestamp AS VARCHAR) AS archival_timestamp,"
    " CAST(target_partition_date AS VARCHAR) AS target_partition_date, record_count_evicted,"
    f" {r2('raw_uncompressed_bytes / CAST(1048576 AS DOUBLE)')} AS uncompressed_mb,"
    f" {r2('compressed_parquet_bytes / CAST(1048576 AS DOUBLE)')} AS compressed_parquet_mb,"
    " compression_ratio, sha256_checksum, storage_destination_uri, eviction_status, truncated_table_name,"
    " execution_duration_seconds"
)
TRENDS = f"""SELECT {text("window_start")} AS window_start, weather_condition_category,
  CAST(sum(total_active_flights) AS BIGINT) AS total_flights_in_hour, {r2("avg(avg_velocity_mps)")} AS hourly_avg_velocity_mps,
  {r2("avg(velocity_deficit_pct)")} AS hourly_avg_deficit_pct, {r2("max(peak_wind_gust_mps)")} AS max_gust_in_hour,
  {r2("avg(mean_convective_risk)")} AS hourly_convective_risk,
  CAST(sum(flights_impacted_count) AS BIGINT) AS total_impacted_aircraft
FROM gold WHERE recorded_date >= DATE '2024-01-23' GROUP BY window_start, weather_condition_category"""
ALERT = (
    "flight_record_id, coalesce(callsign, icao24) AS flight, callsign, icao24, convective_risk_score,"
    " wind_gusts_mps, precipitation_mm, baro_altitude_m"
)
ALL_GOLD = f"SELECT {shown(GOLD_COLUMNS)} FROM gold"
MERGED_GOLD = (
    f"SELECT {shown(GOLD_COLUMNS)} FROM (SELECT * FROM delta UNION ALL SELECT o.* FROM gold_old o WHERE NOT EXISTS"
    " (SELECT 1 FROM delta d WHERE d.window_start = o.window_start AND d.geohash = o.geohash"
    " AND d.weather_condition_category = o.weather_condition_category AND d.recorded_date = o.recorded_date))"
)
PER_DAY = f"SELECT {text('recorded_date')} AS recorded_date, count(*) AS n"
_lat, _lon = centre("geohash")
CELLS = f"SELECT geohash, {_lat} AS lat, {_lon} AS lon FROM (SELECT DISTINCT geohash FROM tagged)"
# Which copy of a record arrives first when the events come in three batches.
ARRIVED = (
    "SELECT *, row_number() OVER (PARTITION BY flight_record_id ORDER BY event_id % 3, event_id, copy) AS nth FROM enriched"
)
BAD_CLOCK = "event_id % 500 IN (77, 177) AND given IS NOT NULL"
HOUR = "date_trunc('hour', weather_recorded_at)"
INNER_BOX = "latitude BETWEEN CAST(38.5 AS DOUBLE) AND CAST(39.5 AS DOUBLE) AND longitude BETWEEN -78 AND -77"


MEASURES = SILVER_COLUMNS[18:27]


def _enriched_at(precision: int, keys: tuple[str, ...]) -> str:
    """Reports with the last reading of their key; ties by the measures, nulls last."""
    lat = "CAST(38 AS DOUBLE) + ((o * 41) % 2800) / CAST(1000 AS DOUBLE)"
    lon = "CAST(-79 AS DOUBLE) + ((o * 59) % 3200) / CAST(1000 AS DOUBLE)"
    newest = ", ".join(f"{m} DESC NULLS LAST" for m in MEASURES)
    same = " AND ".join(f"f.{k} = w.{k}" for k in keys)
    readings = f"SELECT * EXCLUDE (geohash), {cell(lat, lon, precision)} AS geohash FROM weather_raw"
    last = (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {newest}) AS nth"
        f" FROM ({readings})) WHERE nth = 1"
    )
    flights = f"SELECT * EXCLUDE (geohash), {cell('latitude', 'longitude', precision)} AS geohash FROM tagged"
    score = risk("w.precipitation_mm", "w.wind_gusts_mps", "w.cloud_cover_pct")
    measures = ", ".join(f"w.{m}" for m in MEASURES)
    joined = f"SELECT f.*, {measures}, {score} AS convective_risk_score FROM ({flights}) f LEFT JOIN ({last}) w ON {same}"
    return f"SELECT event_id, copy, {shown(SILVER_COLUMNS)} FROM ({joined})"


def _from_payloads() -> str:
    """Reports and readings that the response texts hold, joined; the first report of an id by its position."""
    newest = ", ".join(f"{m} DESC NULLS LAST" for m in MEASURES)
    measures = ", ".join(f"w.{m}" for m in MEASURES)
    readings = f"""SELECT * REPLACE (CASE WHEN o % 41 = 0 THEN {NOW} ELSE weather_recorded_at END AS weather_recorded_at)
      FROM (SELECT *, row_number() OVER (PARTITION BY cycle_id, o // 1500 ORDER BY o DESC) AS back FROM weather_raw)
      WHERE NOT (back = 1 AND (o // 1500) % 3 = 2)"""
    last = (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cycle_id, geohash ORDER BY {newest}) AS nth"
        f" FROM ({readings})) WHERE nth = 1"
    )
    first = (
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY flight_record_id ORDER BY longitude, latitude) AS place"
        " FROM tagged WHERE event_id % 101 <> 7 AND (event_id // 50) % 40 <> 39) WHERE place = 1"
    )
    score = risk("w.precipitation_mm", "w.wind_gusts_mps", "w.cloud_cover_pct")
    return (
        f"(SELECT f.*, {measures}, {score} AS convective_risk_score FROM ({first}) f"
        f" LEFT JOIN ({last}) w ON f.cycle_id = w.cycle_id AND f.geohash = w.geohash)"
    )


def sql_by_name() -> dict[str, str]:
    """Query name -> SQL."""
    raw = "event_id, copy"
    selects = {
        # sources and tables
        "s01_parse_state_payload": f"SELECT server_time, {shown(REPORT_COLUMNS)} FROM flights"
        " WHERE event_id % 101 <> 7 AND (event_id // 50) % 40 <> 39",
        "s02_bounding_box": f"SELECT 'northeast' AS box, {raw}, latitude, longitude FROM flights"
        " WHERE latitude BETWEEN 38 AND 45 AND longitude BETWEEN -79 AND -71"
        f" UNION ALL SELECT 'inner' AS box, {raw}, latitude, longitude FROM flights WHERE {INNER_BOX}"
        f" UNION ALL SELECT 'latitude_only' AS box, {raw}, latitude, longitude FROM flights WHERE latitude BETWEEN 39 AND 40",
        "s03_parse_weather_payload": f"""SELECT cycle_id, geohash,
            {text(f"CASE WHEN o % 41 = 0 THEN {NOW} ELSE weather_recorded_at END")} AS weather_recorded_at, temperature_c,
            relative_humidity_pct, precipitation_mm, wind_speed_mps, wind_direction_deg, wind_gusts_mps,
            cloud_cover_pct, visibility_m
          FROM (SELECT *, row_number() OVER (PARTITION BY cycle_id, o // 1500 ORDER BY o DESC) AS back FROM weather_raw)
          WHERE NOT (back = 1 AND (o // 1500) % 3 = 2)""",
        "s04_weather_request_plan": f"""SELECT cycle_id, (rn - 1) // 50 AS request_no, count(*) AS cells,
            string_agg(printf('%.4f', {_lat}), ',' ORDER BY geohash) AS latitude,
            string_agg(printf('%.4f', {_lon}), ',' ORDER BY geohash) AS longitude,
            string_agg(geohash, ',' ORDER BY geohash) AS geohashes
          FROM (SELECT cycle_id, geohash, row_number() OVER (PARTITION BY cycle_id ORDER BY geohash) AS rn
                FROM (SELECT DISTINCT cycle_id, geohash FROM tagged)) GROUP BY cycle_id, (rn - 1) // 50""",
        "s05_append_json": f"SELECT {shown(SILVER_COLUMNS)} FROM (SELECT * FROM silver UNION ALL SELECT * FROM silver)",
        "s06_export_parquet": f"{PER_DAY}, CAST(sum(length(flight_record_id)) AS BIGINT) AS id_bytes FROM silver GROUP BY recorded_date",
        "s07_read_partition": f"SELECT {shown(SILVER_COLUMNS)} FROM silver WHERE recorded_date = DATE '2024-01-15'",
        "s08_table_layout": f"{PER_DAY}, min(geohash) AS first_cell, max(geohash) AS last_cell FROM silver GROUP BY recorded_date",
        "s09_parameterised_sql": "SELECT geohash, count(*) AS n, max(convective_risk_score) AS worst FROM silver"
        " WHERE recorded_date = DATE '2024-01-15' AND convective_risk_score >= 50 GROUP BY geohash",
        "s09_sql_functions": f"SELECT {raw}, flight_record_id, geohash, convective_risk_score AS risk,"
        f" {category()} AS category FROM enriched",
        "s02_stored_box": "SELECT flight_record_id, geohash, latitude, longitude FROM silver"
        " WHERE latitude BETWEEN 38.4 AND 39.9 AND longitude BETWEEN -78.6 AND -76.1",
        "s10_file_digests": "SELECT day, CAST(strlen(line) + 1 AS BIGINT) AS length, sha256(line || chr(10)) AS sha256_checksum"
        f" FROM (SELECT {text('recorded_date')} AS day, {text('recorded_date')} || ',' || count(*) AS line FROM silver"
        " GROUP BY recorded_date)",
        "s11_restore_archives": f"{PER_DAY} FROM silver GROUP BY recorded_date",
        "s11_sync_archives": "SELECT n AS total_manifests_evaluated, n AS newly_downloaded, n AS verified_valid,"
        " CAST(0 AS BIGINT) AS corrupted_detected FROM (SELECT count(DISTINCT recorded_date) AS n FROM silver"
        " WHERE recorded_date <= DATE '2024-01-03')",
        # scalar functions
        "p01_norm_icao24": f"SELECT {raw}, lower(trim(icao24)) AS icao24 FROM flights_raw",
        "p02_clean_callsign": f"SELECT {raw}, nullif(trim(callsign), '') AS callsign FROM flights_raw",
        "p03_default_country": f"SELECT {raw}, coalesce(origin_country, 'Unknown') AS origin_country FROM flights_raw",
        "p04_default_time": f"SELECT {raw}, coalesce(time_position, server_time) AS time_position,"
        " coalesce(last_contact, server_time) AS last_contact FROM flights_raw",
        "p05_normalise_flights": f"SELECT {raw}, {shown(REPORT_COLUMNS + ['ingested_at'])} FROM flights",
        "p06_record_id": f"SELECT {raw}, sha256(icao24 || '_' || time_position) AS flight_record_id FROM flights",
        "p07_recorded_date": f"SELECT {raw}, {text(utc_day('time_position'))} AS recorded_date FROM flights",
        "p08_geohash_encode": "SELECT " + raw + "".join(
            f", {cell('latitude', 'longitude', p)} AS gh{p}" for p in (3, 4, 5, 8)
        ) + " FROM checked WHERE reasons = ''",
        "p09_geohash_centroid": CELLS,
        "p10_convective_risk": f"SELECT o, {risk('precipitation_mm', 'wind_gusts_mps', 'cloud_cover_pct')} AS risk FROM weather_raw",
        "p11_convective_risk_clamped": "SELECT o, "
        + risk("precipitation_mm - 1", "wind_gusts_mps - 5", "cloud_cover_pct - 10", clamp=True) + " AS risk FROM weather_raw",
        "p12_hazard_category": f"SELECT flight_record_id, {category()} AS hazard_category FROM silver",
        "p13_risk_color": "SELECT flight_record_id, risk_tier, color FROM explorer",
        "p14_velocity_deficit": f"SELECT {raw}, {deficit('velocity_mps')} AS velocity_deficit_pct FROM flights",
        "p15_hour_window": f"SELECT o, {text(HOUR)} AS window_start, {text(HOUR + ' + INTERVAL 1 HOUR')} AS window_end FROM weather_raw",
        "p16_unit_conversions": f"SELECT {raw}, {r2('velocity_mps * CAST(1.94384 AS DOUBLE)')} AS knots,"
        f" {r2('(event_id * 4099) / CAST(1048576 AS DOUBLE)')} AS mb, {r2('(event_id * 4099) / CAST(1024 AS DOUBLE)')} AS kb FROM flights",
        "p17_nan_to_null": "SELECT event_id, CASE WHEN user_id % 7 <> 0 THEN value END AS value FROM events",
        "p18_safe_divide": f"SELECT event_id, CASE WHEN user_id % 5 <> 0 THEN {r2('value / CAST(user_id % 5 AS DOUBLE)')} END AS ratio FROM events",
        "p19_inspect_columns": "SELECT callsign, icao24, origin_country, latitude, longitude, baro_altitude_m, velocity_mps,"
        " hazard_category, convective_risk_score, precipitation_mm, wind_gusts_mps, geohash FROM explorer",
        "p20_gust_vs_deficit": "SELECT wind_gusts_mps, velocity_deficit_pct FROM explorer"
        " WHERE wind_gusts_mps IS NOT NULL AND velocity_deficit_pct IS NOT NULL",
        "p21_audit_metadata": """SELECT audit_id, '{"compression":"zstd","compression_level":9,"storage_provider":"'
            || truncated_table_name || '"}' AS metadata_json FROM audit""",
        "p22_map_layer": "SELECT longitude, latitude, baro_altitude_m AS elevation, color, callsign, icao24, baro_altitude_m,"
        " velocity_mps, hazard_category, convective_risk_score, precipitation_mm, wind_gusts_mps, velocity_deficit_pct FROM explorer",
        # contracts and filters
        "f01_flight_contract": f"SELECT {raw}, reasons = '' AS valid, reasons FROM (SELECT {raw}, concat_ws(',',"
        " nullif(regexp_extract(reasons, '^icao24_length'), ''), nullif(regexp_extract(reasons, 'callsign_length'), ''),"
        f" CASE WHEN {BAD_CLOCK} THEN 'time_position_range' END,"
        " nullif(regexp_replace(regexp_replace(reasons, '(icao24|callsign)_length,?', '', 'g'), ',$', ''), '')) AS reasons"
        " FROM checked JOIN (SELECT event_id AS e, copy AS c, time_position AS given FROM flights_raw)"
        " ON e = event_id AND c = copy)",
        "f02_weather_contract": "SELECT o, reasons = '' AS valid, reasons FROM (SELECT o, concat_ws(',',"
        " CASE WHEN o % 13 = 0 THEN 'precipitation_mm_range' END,"
        " CASE WHEN cloud_cover_pct > 100 THEN 'cloud_cover_pct_range' END) AS reasons FROM weather_raw)",
        "f03_silver_contract": "SELECT flight_record_id, origin_country <> 'Unknown' AS valid,"
        " CASE WHEN origin_country = 'Unknown' THEN 'origin_country_required' ELSE '' END AS reasons FROM silver",
        "f04_gold_eligible": f"SELECT {shown(SILVER_COLUMNS)} FROM silver WHERE recorded_date = DATE '2024-01-15'"
        " AND weather_recorded_at IS NOT NULL AND velocity_mps IS NOT NULL",
        "f05_explore_slice": "SELECT flight_record_id, convective_risk_score, baro_altitude_m FROM silver"
        " WHERE convective_risk_score >= 25 AND coalesce(baro_altitude_m, 0) BETWEEN 0 AND 8000",
        "f06_last_days": f"SELECT flight_record_id, {text('recorded_date')} AS recorded_date FROM silver WHERE recorded_date >= DATE '2024-01-23'",
        "f07_success_manifests": f"SELECT {_audit_shown(MANIFEST)} FROM audit WHERE eviction_status = 'SUCCESS'",
        "f08_hazard_alerts": f"SELECT {ALERT} FROM silver WHERE convective_risk_score >= 50",
        "f09_today": f"SELECT {shown(SILVER_COLUMNS)} FROM silver WHERE recorded_date = DATE '2024-01-30'",
        # joins
        "j01_enrich": f"SELECT {raw}, {shown(SILVER_COLUMNS)} FROM enriched",
        "j01_enrich_many_readings": _enriched_at(4, ("geohash",)),
        "j01_enrich_small_cells": _enriched_at(5, ("cycle_id", "geohash")),
        "j02_latest_weather": "SELECT cycle_id, geohash, CAST(weather_recorded_at AS VARCHAR) AS weather_recorded_at,"
        " temperature_c, relative_humidity_pct, precipitation_mm, wind_speed_mps, wind_direction_deg, wind_gusts_mps,"
        " cloud_cover_pct, visibility_m FROM weather",
        "j03_gold_key_match": f"SELECT {shown(['window_start', 'geohash', 'weather_condition_category', 'recorded_date'], 'o.')}"
        " FROM gold_old o JOIN delta d ON d.window_start = o.window_start AND d.geohash = o.geohash"
        " AND d.weather_condition_category = o.weather_condition_category AND d.recorded_date = o.recorded_date",
        "j04_new_records": f"SELECT {shown(SILVER_COLUMNS)} FROM silver WHERE recorded_date > DATE '2024-01-15'",
        "j05_silver_gold": f"""SELECT s.geohash, reports, report_velocity_mps, report_risk, weather_condition_category,
            matrix_rows, total_active_flights, velocity_deficit_pct
          FROM (SELECT geohash, count(*) AS reports, {r2("avg(velocity_mps)")} AS report_velocity_mps,
                  {r2("avg(convective_risk_score)")} AS report_risk FROM silver GROUP BY geohash) s
          JOIN (SELECT geohash, weather_condition_category, count(*) AS matrix_rows,
                  CAST(sum(total_active_flights) AS BIGINT) AS total_active_flights,
                  {r2("avg(velocity_deficit_pct)")} AS velocity_deficit_pct FROM gold
                GROUP BY geohash, weather_condition_category) g ON s.geohash = g.geohash""",
        "j06_flights_in_category": "SELECT flight_record_id, geohash FROM silver WHERE geohash IN"
        " (SELECT geohash FROM gold WHERE weather_condition_category = 'LOW_VISIBILITY')",
        "j07_cells_of_callsign": f"SELECT {shown(GOLD_COLUMNS)} FROM gold WHERE geohash IN (SELECT geohash FROM silver WHERE callsign = 'FLT42')",
        "j08_verify_archives": "SELECT audit_id, archive_key, verification FROM verified",
        # aggregations
        "a01_gold_matrix": ALL_GOLD,
        "a02_centroids": f"SELECT cycle_id, geohash, {_lat} AS lat, {_lon} AS lon FROM (SELECT DISTINCT cycle_id, geohash FROM tagged)",
        "a02_binning_summary": f"SELECT count(*) AS total_flights, count(DISTINCT geohash) AS distinct_geohashes,"
        f" {r2('count(*) / CAST(greatest(1, count(DISTINCT geohash)) AS DOUBLE)')} AS compression_ratio FROM tagged",
        "a03_hourly_trends": TRENDS,
        "a04_scorecards": f"SELECT CAST(sum(total_active_flights) AS BIGINT) AS active_tracked_aircraft,"
        f" {r2('avg(velocity_deficit_pct)')} AS average_airspeed_deficit,"
        " CAST(sum(flights_impacted_count) AS BIGINT) AS aircraft_in_severe_weather, max(peak_wind_gust_mps) AS maximum_wind_gusts FROM gold",
        "a05_explore_kpis": f"SELECT count(*) AS total_active_aircraft, {r2('avg(velocity_mps)')} AS avg_ground_speed_mps,"
        f" {r2('avg(velocity_mps) * CAST(1.94384 AS DOUBLE)')} AS avg_ground_speed_knots,"
        f" {r2('avg(velocity_deficit_pct)')} AS avg_speed_deficit_pct,"
        " count(*) FILTER (convective_risk_score >= 50) AS severe_weather_encounters,"
        " count(DISTINCT geohash) AS active_weather_grids FROM explorer"
        " WHERE convective_risk_score >= 10 AND coalesce(baro_altitude_m, 0) BETWEEN 0 AND 10000",
        "a06_category_counts": "SELECT hazard_category, count(*) AS flights FROM explorer GROUP BY hazard_category",
        "a07_run_metrics": "SELECT (SELECT count(*) FROM flights) AS raw_flights, (SELECT count(*) FROM tagged) AS valid_flights,"
        " (SELECT count(*) FROM checked WHERE reasons <> '') AS quarantined_flights,"
        " (SELECT count(DISTINCT geohash) FROM tagged) AS unique_weather_grids,"
        " (SELECT count(*) FROM weather) AS weather_observations, (SELECT count(*) FROM enriched) AS silver_records_produced,"
        " (SELECT count(DISTINCT flight_record_id) FROM tagged) AS records_committed, 'SUCCESS' AS status",
        "a08_verify_summary": "SELECT count(*) AS total_manifests_evaluated, CAST(0 AS BIGINT) AS newly_downloaded,"
        " count(*) FILTER (verification = 'VERIFIED') AS verified_valid,"
        " count(*) FILTER (verification = 'CORRUPTED') AS corrupted_detected FROM verified",
        "a09_map_center": "SELECT round(avg(latitude), 6) AS center_lat, round(avg(longitude), 6) AS center_lon FROM silver",
        "a10_hazard_map": f"SELECT geohash, weather_condition_category, CAST(sum(flights_impacted_count) AS BIGINT) AS flights_impacted_count,"
        f" {r2('avg(avg_velocity_mps)')} AS avg_velocity_mps, {r2('avg(mean_convective_risk)')} AS mean_convective_risk"
        " FROM gold GROUP BY geohash, weather_condition_category",
        "a11_export_artifact": "SELECT count(*) AS record_count, CAST(sum(170 + strlen(flight_record_id) + strlen(icao24)"
        " + coalesce(strlen(callsign), 0) + strlen(origin_country) + coalesce(strlen(squawk), 0) + strlen(geohash)) AS BIGINT)"
        " AS uncompressed_bytes, true AS smaller, 64 AS digest_length FROM silver",
        # top-k
        "t01_latest_silver": f"SELECT {shown(SILVER_COLUMNS)} FROM (SELECT * FROM silver"
        " ORDER BY weather_recorded_at DESC NULLS LAST, flight_record_id LIMIT 2000)",
        "t01_latest_silver_nulls_first": f"SELECT {shown(SILVER_COLUMNS)} FROM (SELECT * FROM silver WHERE recorded_date = DATE '2024-01-15'"
        " ORDER BY weather_recorded_at DESC NULLS FIRST, flight_record_id LIMIT 2000)",
        "t03_manifest_order": "SELECT audit_id, CAST(row_number() OVER (ORDER BY target_partition_date DESC, audit_id)"
        " AS INTEGER) AS place FROM audit WHERE eviction_status = 'SUCCESS'",
        "t02_latest_audit": f"SELECT {_audit_shown(AUDIT_COLUMNS)} FROM (SELECT * FROM audit ORDER BY archival_timestamp DESC, audit_id LIMIT 50)",
        # maintenance and custody
        "d01_insert_ignore": f"SELECT {shown(SILVER_COLUMNS)} FROM silver",
        "d01_insert_ignore_by_keys": f"SELECT {shown(SILVER_COLUMNS)} FROM silver",
        "d02_upsert_gold": MERGED_GOLD,
        "d03_delete_partition": f"{PER_DAY} FROM silver WHERE recorded_date <> DATE '2024-01-15' GROUP BY recorded_date",
        "d04_evict_partition": "SELECT eviction_status, record_count_evicted, hot_rows, archived_rows FROM"
        " (SELECT 'SUCCESS' AS eviction_status, count(*) FILTER (recorded_date = DATE '2024-01-15') AS record_count_evicted,"
        " count(*) FILTER (recorded_date <> DATE '2024-01-15') AS hot_rows,"
        " count(*) FILTER (recorded_date = DATE '2024-01-15') AS archived_rows FROM silver)",
        "d05_write_audit": f"SELECT {_audit_shown(AUDIT_COLUMNS)} FROM audit",
        "d06_expired_partitions": f"SELECT DISTINCT 'due' AS rule, {text('recorded_date')} AS recorded_date FROM silver"
        " WHERE recorded_date <= DATE '2024-01-23' UNION ALL SELECT DISTINCT 'exact' AS rule,"
        f" {text('recorded_date')} AS recorded_date FROM silver WHERE recorded_date = DATE '2024-01-23'",
        "d07_refresh_gold": f"SELECT {shown(GOLD_COLUMNS)} FROM gold WHERE recorded_date BETWEEN DATE '2024-01-14' AND DATE '2024-01-20'",
        "d08_archive_key": f"SELECT DISTINCT {text('recorded_date')} AS recorded_date, archive_key FROM"
        " (SELECT target_partition_date AS recorded_date, archive_key FROM audit)",
        # views
        "v01_realtime_hotspots": f"SELECT {shown(GOLD_COLUMNS)} FROM gold WHERE recorded_date >= DATE '2024-01-23'",
        "v02_hourly_delay_trends": TRENDS,
        "v03_archival_audit_trail": f"SELECT {AUDIT_VIEW} FROM audit",
        # streams
        "st1_stream_pipeline": ALL_GOLD,
        "st1_payload_stream": f"SELECT {shown(GOLD_COLUMNS)} FROM ({gold_from(_from_payloads())})",
        "st2_stream_dedupe": f"SELECT {shown(SILVER_COLUMNS)} FROM ({ARRIVED}) WHERE nth = 1",
        "st2_stream_dedupe_stateful": f"SELECT flight_record_id, icao24, {text('recorded_date')} AS recorded_date"
        f" FROM ({ARRIVED}) WHERE nth = 1",
        "st3_stream_enrich": f"SELECT {raw}, {shown(SILVER_COLUMNS)} FROM enriched",
        "st4_stream_gold": f"SELECT {shown(GOLD_COLUMNS)} FROM ({gold_from(f'(SELECT * FROM ({ARRIVED}) WHERE nth = 1)')})",
        "st5_refresh_touched_days": ALL_GOLD,
        "st6_stream_metrics": f"""SELECT c.iteration_id, raw_flights, valid_flights, unique_weather_grids,
            weather_observations, valid_flights AS silver_records_produced, coalesce(n, 0) AS records_committed,
            raw_flights - valid_flights AS quarantined_flights, 'SUCCESS' AS status
          FROM (SELECT event_id % 3 AS iteration_id, count(*) AS raw_flights, count(*) FILTER (reasons = '') AS valid_flights
                FROM checked GROUP BY event_id % 3) c
          JOIN (SELECT event_id % 3 AS iteration_id, count(DISTINCT geohash) AS unique_weather_grids,
                  count(DISTINCT CASE WHEN weather_recorded_at IS NOT NULL THEN geohash || {text("weather_recorded_at")} END)
                    AS weather_observations FROM enriched GROUP BY event_id % 3) e ON e.iteration_id = c.iteration_id
          LEFT JOIN (SELECT event_id % 3 AS iteration_id, count(*) AS n FROM ({ARRIVED}) WHERE nth = 1
                GROUP BY event_id % 3) s ON s.iteration_id = c.iteration_id""",
        "st8_empty_batch": f"""SELECT CAST(0 AS BIGINT) AS iteration_id, raw_flights, stored AS records_committed,
            raw_flights - good AS quarantined_flights, stored, raw_flights - good AS rejected
          FROM (SELECT count(*) AS raw_flights, count(*) FILTER (reasons = '' AND NOT bad) AS good,
                  count(DISTINCT CASE WHEN reasons = '' AND NOT bad THEN sha256(icao24 || '_' || time_position) END) AS stored
                FROM (SELECT *, {BAD_CLOCK} AS bad FROM checked
                      JOIN (SELECT event_id AS e, copy AS c, time_position AS given FROM flights_raw) ON e = event_id AND c = copy))""",
        "st7_stream_alerts": f"SELECT {ALERT} FROM enriched WHERE convective_risk_score >= 50",
    }
    return {name: q(select) for name, select in selects.items()}
