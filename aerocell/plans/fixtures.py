"""Flight, weather and ledger inputs derived from the benchmark tables.

``events`` plays the aircraft feed and ``orders`` the weather feed. The formulas
place every case the operators must handle: blanks, defaults, broken bounds,
duplicates, missing weather. All of them are column expressions, so the inputs
grow with the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocell import functions as fn
from aerocell.operators.custody import archive_key
from aerocell.operators.enrich import latest_weather
from aerocell.operators.gold import gold_matrix
from aerocell.plans.pipeline import silver_rows
from aerocell.sources.payloads import WEATHER_VARIABLES

AS_OF = dt.date(2024, 1, 30)
FLAGSHIP_DAY = dt.date(2024, 1, 15)
UPSERT_FROM = dt.date(2024, 1, 16)
TABLE_NAME = "silver"

_FLIGHT_FORMULAS = {
    "icao24": "CASE WHEN id % 50 = 19 THEN 'ab'"
    " WHEN id % 3 = 0 THEN concat('  ', hex(user_id + 11000000), ' ')"
    " ELSE lower(hex(user_id + 11000000)) END",
    "callsign": "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 10 = 1 THEN '   '"
    " WHEN id % 200 = 57 THEN 'TOOLONGCALLSIGN' ELSE concat(' FLT', user_id, '  ') END",
    "origin_country": "CASE WHEN id % 11 = 0 THEN NULL WHEN user_id % 3 = 0 THEN 'Canada' ELSE 'United States' END",
    "server_time": "t - t % 600 + 600",
    "time_position": "CASE WHEN id % 29 = 0 THEN NULL ELSE t END",
    "last_contact": "CASE WHEN id % 31 = 0 THEN NULL ELSE t + 5 END",
    "longitude": "CASE WHEN id % 23 = 5 THEN NULL WHEN id % 50 = 13 THEN 200D"
    " ELSE -79D + ((id * 53) % 3200) / 1000D END",
    "latitude": "CASE WHEN id % 50 = 7 THEN 105D ELSE 38D + ((id * 37) % 2800) / 1000D END",
    "baro_altitude_m": "CASE WHEN id % 13 = 0 THEN NULL ELSE CAST((id * 97) % 12000 AS DOUBLE) END",
    "on_ground": "CASE WHEN id % 37 = 0 THEN NULL ELSE id % 40 = 0 END",
    "velocity_mps": "CASE WHEN id % 17 = 0 THEN NULL WHEN id % 50 = 23 THEN -1D ELSE value + 150D END",
    "true_track_deg": "CASE WHEN id % 50 = 29 THEN 400D ELSE CAST((id * 7) % 361 AS DOUBLE) END",
    "vertical_rate_mps": "CAST((id % 41) - 20 AS DOUBLE)",
    "geo_altitude_m": "CASE WHEN id % 13 = 0 THEN NULL ELSE CAST((id * 97) % 12000 AS DOUBLE) + 150D END",
    "squawk": "CASE WHEN id % 6 = 0 THEN NULL ELSE lpad(CAST(id % 7778 AS STRING), 4, '0') END",
    "spi": "CASE WHEN id % 37 = 0 THEN NULL ELSE id % 97 = 0 END",
    "position_source": "CASE WHEN id % 9 = 0 THEN NULL ELSE CAST(id % 3 AS INT) END",
    "ingested_at": "timestamp_seconds(t - t % 600 + 600)",
}

_WEATHER_FORMULAS = {
    "cycle_id": "19723 + o % 30",
    "lat": "38D + ((o * 41) % 2800) / 1000D",
    "lon": "-79D + ((o * 59) % 3200) / 1000D",
    "weather_recorded_at": "timestamp_seconds((19723 + o % 30) * 86400 + (o % 24) * 3600 + (o % 60) * 60)",
    "temperature_c": "((o * 23) % 600) / 10D - 20D",
    "relative_humidity_pct": "CAST((o * 37) % 101 AS DOUBLE)",
    "precipitation_mm": "CASE WHEN o % 7 = 0 THEN NULL WHEN o % 5 = 0 THEN ((o * 13) % 50) / 10D"
    " ELSE ((o * 13) % 8) / 10D END",
    "wind_speed_mps": "CASE WHEN o % 19 = 0 THEN NULL ELSE ((o * 19) % 170) / 10D END",
    "wind_direction_deg": "CAST((o * 43) % 361 AS DOUBLE)",
    "wind_gusts_mps": "((o * 17) % 260) / 10D",
    "cloud_cover_pct": "((o * 29) % 1201) / 10D",
    "visibility_m": "CASE WHEN o % 4 = 0 THEN NULL ELSE CAST((o * 31) % 12000 AS DOUBLE) END",
}


# Given schemas spare the job that would infer them.
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
ORDERS = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf}/events.parquet")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.schema(ORDERS).parquet(f"{sf}/orders.parquet")


def flights_from(events: DataFrame) -> DataFrame:
    """Raw reports; every twentieth event is reported twice. Works on streams too."""
    base = events.select(
        F.col("event_id").alias("id"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"),
        "user_id",
        "value",
    )
    copies = F.explode(F.expr("CASE WHEN id % 20 = 3 THEN array(0, 1) ELSE array(0) END"))
    fields = [F.expr(sql).alias(name) for name, sql in _FLIGHT_FORMULAS.items()]
    return base.select(F.col("id").alias("event_id"), copies.alias("copy"), *fields)


def flights_raw(spark: SparkSession, sf: str) -> DataFrame:
    return flights_from(events(spark, sf))


def with_bad_clocks(flights: DataFrame) -> DataFrame:
    """Some times in milliseconds and in nanoseconds."""
    scale = F.expr("CASE event_id % 500 WHEN 77 THEN 1000L WHEN 177 THEN 1000000000L ELSE 1L END")
    return flights.withColumn("time_position", F.col("time_position") * scale)


def with_nan(observations: DataFrame) -> DataFrame:
    """Some rain that is not a number."""
    rain = F.when(F.col("o") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("precipitation_mm"))
    return observations.withColumn("precipitation_mm", rain)


def observations_from(orders: DataFrame) -> DataFrame:
    """Weather readings, several per cell and cycle, numbered by ``o``."""
    base = orders.select(F.col("o_orderkey").alias("o"))
    fields = [F.expr(sql).alias(name) for name, sql in _WEATHER_FORMULAS.items()]
    return base.select("o", *fields).withColumn("geohash", fn.geohash(F.col("lat"), F.col("lon")))


def weather_raw(spark: SparkSession, sf: str) -> DataFrame:
    return observations_from(orders(spark, sf))


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """All readings; the last one of a cell and cycle is that with the largest ``o``."""
    return weather_raw(spark, sf).drop("lat", "lon")


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """The last reading of every cell and cycle."""
    return latest_weather(readings(spark, sf), ["cycle_id", "geohash"], ["o"]).drop("o")


def silver(spark: SparkSession, sf: str) -> DataFrame:
    flights, last = flights_raw(spark, sf), ("o",)
    return silver_rows(flights, readings(spark, sf), first_by=["event_id", "copy"], weather_order=last)


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold_matrix(silver(spark, sf))


def audit_from(silver: DataFrame) -> DataFrame:
    """A ledger row per day of the enriched table."""
    day = F.col("recorded_date")
    key = archive_key(F.lit(TABLE_NAME), day)
    counted = silver.groupBy("recorded_date").agg(F.count("*").alias("n"))
    return counted.select(
        F.concat(F.lit("audit-"), day.cast("string")).alias("audit_id"),
        F.timestamp_seconds((F.unix_date(day) + 7).cast("bigint") * 86400).alias("archival_timestamp"),
        day.alias("target_partition_date"),
        F.col("n").alias("record_count_evicted"),
        (F.col("n") * 220).alias("raw_uncompressed_bytes"),
        (F.col("n") * 31).alias("compressed_parquet_bytes"),
        fn.round2(F.col("n") * 220 / F.greatest(F.lit(1), F.col("n") * 31)).alias("compression_ratio"),
        F.sha2(F.concat_ws(":", key, F.col("n").cast("string")), 256).alias("sha256_checksum"),
        F.concat(F.lit("local://"), key).alias("storage_destination_uri"),
        F.when(F.dayofmonth(day) % 10 == 0, "FAILED").otherwise("SUCCESS").alias("eviction_status"),
        F.lit(TABLE_NAME).alias("truncated_table_name"),
        F.lit(1.5).alias("execution_duration_seconds"),
        F.lit("{}").alias("metadata_json"),
    )


def audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit_from(silver(spark, sf))


def digests_from(audit: DataFrame) -> DataFrame:
    """What a scan of the archive finds: some files altered, some missing."""
    number = F.dayofmonth("target_partition_date")
    altered = F.when(number % 9 == 0, F.reverse("sha256_checksum")).otherwise(F.col("sha256_checksum"))
    return audit.filter(number % 7 != 0).select(
        F.regexp_replace("storage_destination_uri", "^local://", "").alias("archive_key"),
        altered.alias("sha256_checksum"),
    )


def _json(column: str, text: bool = False) -> Column:
    value = F.col(column).cast("string")
    if text:
        value = F.concat(F.lit('"'), value, F.lit('"'))
    return F.coalesce(value, F.lit("null"))


def state_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Poll responses. A response covers at most fifty events, which bounds its
    list; some hold vectors that are too short, some hold none at all."""
    texts = {"icao24", "callsign", "origin_country", "squawk"}
    order = [
        "icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude",
        "latitude", "baro_altitude_m", "on_ground", "velocity_mps", "true_track_deg",
        "vertical_rate_mps", None, "geo_altitude_m", "squawk", "spi", "position_source",
    ]
    parts = [F.lit("null") if n is None else _json(n, n in texts) for n in order]
    vector = F.when(F.col("event_id") % 101 == 7, F.lit('["ab1234","X"]')).otherwise(
        F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
    )
    response = F.floor(F.col("event_id") / F.lit(50))
    listed = F.concat(F.lit("["), F.array_join(F.collect_list("vector"), ","), F.lit("]"))
    return (
        flights_raw(spark, sf)
        .select("server_time", response.alias("response"), vector.alias("vector"))
        .groupBy("server_time", "response")
        .agg(listed.alias("listed"))
        .select(
            F.concat(
                F.lit('{"time":'),
                F.col("server_time").cast("string"),
                F.lit(',"states":'),
                F.when(F.col("response") % 40 == 39, F.lit("null")).otherwise(F.col("listed")),
                F.lit("}"),
            ).alias("payload")
        )
    )


def weather_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Weather responses of at most fifty readings with their list of cells.

    A response with one reading is a single object instead of a list; in every
    third response the last cell is missing from the list of cells.
    """
    minute = F.date_format("weather_recorded_at", "yyyy-MM-dd'T'HH:mm")
    time = F.when(F.col("o") % 41 == 0, F.lit(None)).otherwise(minute)
    reading = F.struct(time.alias("time"), *[F.col(c).alias(v) for v, c in WEATHER_VARIABLES.items()])
    result = F.to_json(F.struct("lat", "lon", reading.alias("current")))
    rows = F.sort_array(F.collect_list(F.struct("o", "geohash", result.alias("result"))))
    batch = F.floor(F.col("o") / F.lit(1500))
    grouped = (
        weather_raw(spark, sf).groupBy("cycle_id", batch.alias("batch")).agg(rows.alias("rows"))
    )
    joined = F.array_join("rows.result", ",")
    payload = F.when(F.size("rows") == 1, joined).otherwise(F.concat(F.lit("["), joined, F.lit("]")))
    kept = F.size("rows") - F.when(F.col("batch") % 3 == 2, 1).otherwise(0)
    return grouped.select(
        "cycle_id",
        payload.alias("payload"),
        F.slice(F.col("rows.geohash"), F.lit(1), kept).alias("geohashes"),
    )
