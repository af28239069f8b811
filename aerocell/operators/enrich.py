"""Grid binning, one observation per cell, and the enriched record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerocell import functions as fn
from aerocell.functions.numeric import nan_to_null
from aerocell.operators.lookup import lookup_join
from aerocell.schemas import GEOHASH_PRECISION, SILVER_SCHEMA, WEATHER_MEASURES


def tag_flights(df: DataFrame, precision: int = GEOHASH_PRECISION) -> DataFrame:
    """Add record id, cell, partition day and weather cycle to valid reports."""
    return df.withColumns(
        {
            "flight_record_id": fn.record_id(F.col("icao24"), F.col("time_position")),
            "geohash": fn.geohash(F.col("latitude"), F.col("longitude"), precision),
            "recorded_date": fn.recorded_date(F.col("time_position")),
            "cycle_id": fn.cycle_day(F.col("time_position")),
        }
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of every key.

    Spark keeps one row per key in every map task before the exchange, so a
    key with many copies costs one row per task, not its whole group.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def extract_centroids(
    flights: DataFrame, by: tuple[str, ...] = (), precision: int = GEOHASH_PRECISION
) -> DataFrame:
    """Distinct cells (per ``by`` group) with their centres."""
    centre = fn.geohash_centroid(F.col("geohash"), precision)
    return (
        flights.select(*by, "geohash")
        .distinct()
        .withColumn("_centre", centre)
        .select(*by, "geohash", F.col("_centre.lat").alias("lat"), F.col("_centre.lon").alias("lon"))
    )


def binning_summary(flights: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Reports, cells and reports per cell; counts per cell first, so one hot cell is one row."""
    per_cell = flights.groupBy(*by, "geohash").agg(F.count("*").alias("n"))
    ratio = F.col("total_flights") / F.greatest(F.lit(1), F.col("distinct_geohashes"))
    return (
        per_cell.groupBy(*by)
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_flights"),
            F.count("geohash").alias("distinct_geohashes"),
        )
        .withColumn("compression_ratio", fn.round2(ratio))
    )


def latest_weather(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One observation per key, the last one by ``order``; combined map-side."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def enrich(
    flights: DataFrame,
    weather: DataFrame,
    keys: tuple[str, ...] = ("geohash",),
    keep: tuple[str, ...] = (),
    weather_order: tuple[str, ...] | None = None,
) -> DataFrame:
    """Every report with the weather of its cell and its risk score.

    Of several observations of a key the last counts, by the columns of
    ``weather_order``; by default by their time, ties broken by the measures. So
    a report stays one row whatever the keys and the precision of the cells. An
    empty order says that ``weather`` has one row per key already. Reports without weather are kept with
    nulls and risk 0.0; a NaN measure is null. How the join runs is Spark's
    choice by the size of the weather: see :func:`lookup_join`.
    """
    names = [c for c in WEATHER_MEASURES if c in weather.columns]
    if weather_order is None:
        weather_order = tuple(sorted(names, key=lambda n: n != "weather_recorded_at"))
    others = [c for c in weather_order if c not in names]
    right = nan_to_null(weather.select(*keys, *names, *others))
    if weather_order:
        # A struct cannot be aggregated by hash; one row per key leaves each map task here too.
        right = first_per_key(right, list(keys), [F.desc(c) for c in weather_order]).drop(*others)
    joined = lookup_join(flights, right, keys, "left")
    risk = fn.convective_risk(F.col("precipitation_mm"), F.col("wind_gusts_mps"), F.col("cloud_cover_pct"))
    scored = joined.withColumn("convective_risk_score", risk)
    return scored.select(*SILVER_SCHEMA.names, *keep)
