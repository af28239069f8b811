"""From raw reports to the enriched table, as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocell.operators.contracts import FLIGHT_CONTRACT, validate_flights
from aerocell.operators.enrich import enrich, first_per_key, tag_flights
from aerocell.sources.payloads import normalise_flights

KEY = "flight_record_id"


def located(raw: DataFrame) -> DataFrame:
    """Reports that have a position."""
    return raw.filter(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())


def checked_flights(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantine)`` of the located raw reports."""
    return validate_flights(normalise_flights(located(raw)))


def flagged_flights(raw: DataFrame) -> DataFrame:
    """Located reports with the rules they break and whether they are ``valid``, all tagged; one pass."""
    checked = FLIGHT_CONTRACT.check(normalise_flights(located(raw)))
    return tag_flights(checked.withColumn("valid", F.size("rejection_reasons") == 0))


def tagged_flights(raw: DataFrame) -> DataFrame:
    """Valid reports with record id, cell, partition day and weather cycle."""
    return tag_flights(FLIGHT_CONTRACT.valid(normalise_flights(located(raw))))


def silver_rows(
    raw: DataFrame,
    weather: DataFrame,
    keys: tuple[str, ...] = ("cycle_id", "geohash"),
    first_by: Sequence[str] = (),
    keep: tuple[str, ...] = (),
    weather_order: tuple[str, ...] | None = None,
) -> DataFrame:
    """Enriched rows, one per record id when an order is given.

    The weather lookup adds no rows, so duplicates are removed before it: the
    join then carries each report once.
    """
    flights = tagged_flights(raw)
    if first_by:
        # An id fixes its day; with the day in the key, a filter on days goes below the exchange.
        flights = first_per_key(flights, ["recorded_date", KEY], [F.col(c) for c in first_by])
    return enrich(flights, weather, keys, keep, weather_order)
