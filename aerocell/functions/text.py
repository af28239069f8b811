"""Cleaning of the free-text fields of a report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerocell.schemas import UNKNOWN_COUNTRY

BLANKS = " \t\n\r\x0b\x0c"


def strip(value: Column) -> Column:
    """Trim every kind of ASCII white space, not only the space character."""
    return F.btrim(value, F.lit(BLANKS))


def norm_icao24(value: Column) -> Column:
    return F.lower(strip(value))


def clean_callsign(value: Column) -> Column:
    """Trimmed; blank becomes null."""
    return F.nullif(strip(value), F.lit(""))


def clean_squawk(value: Column) -> Column:
    """Empty becomes null; the check is on the untrimmed text, so blanks become ''."""
    return strip(F.nullif(value, F.lit("")))


def default_country(value: Column) -> Column:
    """Null or empty becomes the default; the check is on the untrimmed text."""
    return F.coalesce(strip(F.nullif(value, F.lit(""))), F.lit(UNKNOWN_COUNTRY))
