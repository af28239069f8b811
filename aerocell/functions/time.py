"""Record identity and the time keys of a report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerocell.functions.text import norm_icao24


def default_time(value: Column, server_time: Column) -> Column:
    return F.coalesce(value, server_time)


def record_id(icao24: Column, time_position: Column) -> Column:
    """Hex SHA-256 of ``<normalised id>_<epoch seconds>``."""
    return F.sha2(F.concat_ws("_", norm_icao24(icao24), time_position.cast("string")), 256)


def cycle_day(epoch_seconds: Column) -> Column:
    """UTC day number."""
    return F.floor(epoch_seconds / F.lit(86400))


# The last second of the year 9999.
LAST_SECOND = 253402300799


def recorded_date(epoch_seconds: Column) -> Column:
    """UTC calendar day, independent of the session time zone; null for a time beyond the year 9999."""
    day = F.date_from_unix_date(cycle_day(epoch_seconds).try_cast("int"))
    return F.when(epoch_seconds <= LAST_SECOND, day)


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def hour_end(ts: Column) -> Column:
    return hour_start(ts) + F.expr("INTERVAL 1 HOUR")
