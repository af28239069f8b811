"""The column functions that queries call by name, as SQL functions that Spark writes out inline."""

from __future__ import annotations

from pyspark.sql import SparkSession

from aerocell.functions.geohash import LAT_SPAN, LON_SPAN, axis_bits, character_tables
from aerocell.functions.hazard import (
    CATEGORIES,
    LOW_VISIBILITY_M,
    RAIN_PRECIP,
    RISK_PER_CLOUD_PCT,
    RISK_PER_GUST_MPS,
    RISK_PER_MM,
    SEVERE_GUST,
    SEVERE_PRECIP,
    SEVERE_RISK,
    SHEAR_GUST,
    SHEAR_WIND,
)
from aerocell.schemas import GEOHASH_PRECISION

_MEASURES = "precipitation DOUBLE, wind DOUBLE, gusts DOUBLE, visibility DOUBLE"


def _geohash(precision: int) -> str:
    lon_left, lat_left = axis_bits(precision)
    numbers = {}
    for name, span, bits in (("lon", LON_SPAN, lon_left), ("lat", LAT_SPAN, lat_left)):
        half = 1 << (bits - 1)
        number = f"CAST(ceil({name} / {span / (1 << bits)!r}D) AS BIGINT) + {half - 1}"
        numbers[name] = f"greatest(0L, least({2 * half - 1}L, {number}))"
    tables, characters = character_tables(), []
    for position in range(precision):
        lon_take, lat_take = (3, 2) if position % 2 == 0 else (2, 3)
        lon_left, lat_left = lon_left - lon_take, lat_left - lat_take
        high = f"(shiftright({numbers['lon']}, {lon_left}) & {(1 << lon_take) - 1})"
        low = f"(shiftright({numbers['lat']}, {lat_left}) & {(1 << lat_take) - 1})"
        place = f"CAST({high} * {1 << lat_take} + {low} + 1 AS INT)"
        characters.append(f"substring('{tables[position % 2]}', {place}, 1)")
    return f"CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN concat({', '.join(characters)}) END"


def _risk() -> str:
    cover = "least(100D, greatest(0D, coalesce(cloud, 0D)))"
    score = (
        f"coalesce(precipitation, 0D) * {RISK_PER_MM}D + coalesce(gusts, 0D) * {RISK_PER_GUST_MPS}D"
        f" + {cover} * {RISK_PER_CLOUD_PCT}D"
    )
    return f"floor((rint(least(100D, greatest(0D, {score})) * 1e6D) + 5000D) / 10000D) / 100D"


def _category() -> str:
    severe, shear, rain, low_visibility, clear = CATEGORIES
    return (
        f"CASE WHEN risk >= {SEVERE_RISK}D OR precipitation >= {SEVERE_PRECIP}D OR gusts >= {SEVERE_GUST}D THEN '{severe}'"
        f" WHEN wind >= {SHEAR_WIND}D OR gusts >= {SHEAR_GUST}D THEN '{shear}'"
        f" WHEN precipitation >= {RAIN_PRECIP}D THEN '{rain}'"
        f" WHEN visibility < {LOW_VISIBILITY_M}D THEN '{low_visibility}' ELSE '{clear}' END"
    )


def sql_functions(precision: int = GEOHASH_PRECISION) -> dict[str, str]:
    """Name -> its parameters, type and body. Each equals the column function of that name."""
    identity = r"lower(btrim(icao24, ' \t\n\r\u000b\u000c'))"
    return {
        "record_id": "(icao24 STRING, time_position BIGINT) RETURNS STRING"
        f" RETURN sha2(concat_ws('_', {identity}, CAST(time_position AS STRING)), 256)",
        "geohash": f"(lat DOUBLE, lon DOUBLE) RETURNS STRING RETURN {_geohash(precision)}",
        "convective_risk": f"(precipitation DOUBLE, gusts DOUBLE, cloud DOUBLE) RETURNS DOUBLE RETURN {_risk()}",
        "hazard_category": f"(risk DOUBLE, {_MEASURES}) RETURNS STRING RETURN {_category()}",
    }


def register_sql_functions(spark: SparkSession, precision: int = GEOHASH_PRECISION) -> list[str]:
    """Make ``record_id``, ``geohash``, ``convective_risk`` and ``hazard_category`` callable in this session's SQL.

    They are expressions, written out where they are called: they run in
    generated code and filters over them are pushed down like any others.
    """
    found = sql_functions(precision)
    for name, text in found.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{text}")
    return sorted(found)
