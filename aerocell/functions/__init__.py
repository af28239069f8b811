"""Column-to-column functions; all of them stay inside whole-stage codegen."""

from aerocell.functions.geohash import geohash, geohash_centroid
from aerocell.functions.hazard import (
    convective_risk,
    hazard_category,
    risk_color,
    risk_tier,
    velocity_deficit,
)
from aerocell.functions.numeric import nan_to_null, round2, safe_divide, to_kb, to_knots, to_mb
from aerocell.functions.text import clean_callsign, clean_squawk, default_country, norm_icao24
from aerocell.functions.time import cycle_day, default_time, hour_end, hour_start, recorded_date, record_id

__all__ = [
    "clean_callsign",
    "clean_squawk",
    "convective_risk",
    "cycle_day",
    "default_country",
    "default_time",
    "geohash",
    "geohash_centroid",
    "hazard_category",
    "hour_end",
    "hour_start",
    "nan_to_null",
    "norm_icao24",
    "record_id",
    "recorded_date",
    "risk_color",
    "risk_tier",
    "round2",
    "safe_divide",
    "to_kb",
    "to_knots",
    "to_mb",
    "velocity_deficit",
]
