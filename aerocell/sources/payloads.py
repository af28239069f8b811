"""JSON payloads of the two feeds, and the plan of weather requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerocell import functions as fn
from aerocell.functions.geohash import box_cover
from aerocell.functions.numeric import without_nan
from aerocell.functions.text import strip
from aerocell.schemas import FLIGHT_SCHEMA, VECTOR_LENGTH, WEATHER_CHUNK, BoundingBox
from aerocell.session import materialise

# Position of every field in a state vector (12 is not used).
VECTOR_POSITIONS = {
    "icao24": 0,
    "callsign": 1,
    "origin_country": 2,
    "time_position": 3,
    "last_contact": 4,
    "longitude": 5,
    "latitude": 6,
    "baro_altitude_m": 7,
    "on_ground": 8,
    "velocity_mps": 9,
    "true_track_deg": 10,
    "vertical_rate_mps": 11,
    "geo_altitude_m": 13,
    "squawk": 14,
    "spi": 15,
    "position_source": 16,
}
# Weather variable -> column.
WEATHER_VARIABLES = {
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "relative_humidity_pct",
    "precipitation": "precipitation_mm",
    "wind_speed_10m": "wind_speed_mps",
    "wind_direction_10m": "wind_direction_deg",
    "wind_gusts_10m": "wind_gusts_mps",
    "cloud_cover": "cloud_cover_pct",
    "visibility": "visibility_m",
}


def parse_state_payload(
    df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = (), now: Column | None = None
) -> DataFrame:
    """One row of raw text fields per usable vector of every payload.

    Vectors that are too short or have no position are dropped; a payload
    without vectors gives no rows. ``server_time`` falls back to ``now``.
    """
    now = F.unix_timestamp(F.current_timestamp()) if now is None else now
    document = F.from_json(payload, "time BIGINT, states ARRAY<ARRAY<STRING>>")
    vectors = (
        df.select(*keep, document.alias("_document"))
        .select(
            *keep,
            F.coalesce("_document.time", now).alias("server_time"),
            F.explode("_document.states").alias("_vector"),
        )
        .filter(F.size("_vector") >= VECTOR_LENGTH)
    )
    fields = [F.get("_vector", F.lit(i)).alias(name) for name, i in VECTOR_POSITIONS.items()]
    return vectors.select(*keep, "server_time", *fields).filter(
        F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    )


def normalise_flights(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Clean and type the fields of raw reports; other columns pass through.

    Accepts text (parsed payloads) or typed columns. NaN becomes null here,
    before anything is compared. ``cast_errors`` names the
    fields whose text could not be read as their type, so the contract check
    can quarantine the row instead of taking the value for missing.
    """
    server = F.col("server_time")
    cleaned = {
        "icao24": fn.norm_icao24(F.col("icao24")),
        "callsign": fn.clean_callsign(F.col("callsign")),
        "origin_country": fn.default_country(F.col("origin_country")),
        "squawk": fn.clean_squawk(F.col("squawk")),
    }
    defaults = {
        "time_position": server,
        "last_contact": server,
        "on_ground": F.lit(False),
        "spi": F.lit(False),
        "position_source": F.lit(0),
    }
    types = dict(df.dtypes)
    errors = []
    for field in FLIGHT_SCHEMA:
        name, kind = field.name, field.dataType.simpleString()
        if name in cleaned or name not in types:
            continue
        value = F.col(name)
        if types[name] != kind:
            typed = value.try_cast(kind)
            errors.append(F.when(value.isNotNull() & typed.isNull(), F.lit(name)))
            value = typed
        if kind == "double":
            value = without_nan(value)
        cleaned[name] = F.coalesce(value, defaults[name]) if name in defaults else value
    if "ingested_at" not in types:
        cleaned["ingested_at"] = F.current_timestamp() if ingested_at is None else ingested_at
    if errors:
        cleaned["cast_errors"] = F.concat_ws(",", *errors)
    return df.withColumns(cleaned)


def bbox_filter(
    df: DataFrame, box: BoundingBox, geohash_col: str | None = None, precision: int = 4
) -> DataFrame:
    """Reports inside a box, ends included; an axis with an open end is not filtered.

    A fully bounded box also implies a few ranges of cell codes. Given the
    table's code column they are added: they reach the Parquet scan and skip row
    groups of a table sorted by cell, those between the ranges too.
    """
    has_lat = box.lamin is not None and box.lamax is not None
    has_lon = box.lomin is not None and box.lomax is not None
    if has_lat:
        df = df.filter(F.col("latitude").between(F.lit(box.lamin), F.lit(box.lamax)))
    if has_lon:
        df = df.filter(F.col("longitude").between(F.lit(box.lomin), F.lit(box.lomax)))
    if has_lat and has_lon and geohash_col is not None:
        held = F.lit(False)
        for low, high in box_cover(box.lamin, box.lamax, box.lomin, box.lomax, precision):
            held = held | F.col(geohash_col).between(F.lit(low), F.lit(high))
        df = df.filter(held)
    return df


def in_boxes(df: DataFrame, boxes: dict[str, BoundingBox]) -> DataFrame:
    """Each report once per box that holds it, with the box's name in ``box``; one pass over the reports."""

    def inside(box: BoundingBox) -> Column:
        held = F.lit(True)
        for column, low, high in (("latitude", box.lamin, box.lamax), ("longitude", box.lomin, box.lomax)):
            if low is not None and high is not None:
                held = held & F.col(column).between(F.lit(low), F.lit(high))
        return held

    named = F.array_compact(F.array(*(F.when(inside(box), F.lit(name)) for name, box in boxes.items())))
    return df.select("*", F.explode(named).alias("box"))


def weather_request_plan(
    centroids: DataFrame, chunk: int = WEATHER_CHUNK, by: tuple[str, ...] = ()
) -> DataFrame:
    """Requests of at most ``chunk`` cells each, numbered from 0 per ``by`` group.

    ``centroids`` holds distinct ``(by.., geohash, lat, lon)`` rows. Cells are
    dealt out in ranges of their order, as many as the data ask for and about
    equally large; a cell's number is its rank inside its range plus the running
    count of the group's earlier ranges. So no task sees all cells of a group,
    nor those of one code prefix, whatever the precision.
    """
    cells = centroids.select(*by, "geohash", "lat", "lon").repartitionByRange(*by, "geohash")
    # Written once: both readers below must see the same ranges.
    cells = materialise(cells.withColumn("_range", F.spark_partition_id()), "cells")
    inside = Window.partitionBy(*by, "_range").orderBy("geohash")
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cells.groupBy(*by, "_range")
        .agg(F.count("*").alias("_n"))
        .select(*by, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    numbered = (
        cells.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(offsets, [*by, "_range"])
        .withColumn("request_no", F.floor((F.col("_offset") + F.col("_rank")) / F.lit(chunk)))
    )
    # A request holds at most ``chunk`` cells, which bounds the collected lists.
    row = F.struct("geohash", F.format_string("%.4f", "lat").alias("lat"), F.format_string("%.4f", "lon").alias("lon"))
    return (
        numbered.groupBy(*by, "request_no")
        .agg(F.sort_array(F.collect_list(row)).alias("_cells"))
        .select(
            *by,
            "request_no",
            F.size("_cells").cast("bigint").alias("cells"),
            F.array_join("_cells.lat", ",").alias("latitude"),
            F.array_join("_cells.lon", ",").alias("longitude"),
            F.col("_cells.geohash").alias("geohashes"),
        )
    )


def parse_weather_payload(
    df: DataFrame,
    payload: str = "payload",
    cells: str = "geohashes",
    keep: tuple[str, ...] = (),
    now: Column | None = None,
) -> DataFrame:
    """One observation per cell: results are paired with cells by position.

    A payload may be a list or a single object. Pairing stops at the shorter
    side. Zone-less times are UTC; an offset in the text is ignored. A missing
    time becomes ``now``; an unreadable one stays null for the contract check.
    """
    now = F.current_timestamp() if now is None else now
    variables = ", ".join(f"{v}: DOUBLE" for v in WEATHER_VARIABLES)
    # Spark reads a single object as a list of one when the schema is a list.
    results = F.from_json(payload, f"ARRAY<STRUCT<current: STRUCT<time: STRING, {variables}>>>")
    paired = (
        df.select(*keep, results.alias("_results"), F.col(cells).alias("_cells"))
        .withColumn("_n", F.least(F.size("_results"), F.size("_cells")))
        .filter(F.col("_n") > 0)
        .select(*keep, F.explode(F.slice(F.arrays_zip("_results", "_cells"), F.lit(1), F.col("_n"))).alias("_pair"))
    )
    current = F.col("_pair._results.current")
    text = F.nullif(strip(current["time"]), F.lit(""))
    # Wall-clock time without its offset, taken as UTC.
    wall_clock = F.regexp_replace(text, r"(:[0-9.]+)([zZ]|[+-][0-9:]+)$", "$1")
    recorded = F.when(text.isNull(), now).otherwise(
        wall_clock.try_cast("timestamp_ntz").cast("timestamp")
    )
    return paired.select(
        *keep,
        F.col("_pair._cells").alias("geohash"),
        recorded.alias("weather_recorded_at"),
        *[without_nan(current[v]).alias(name) for v, name in WEATHER_VARIABLES.items()],
    )
