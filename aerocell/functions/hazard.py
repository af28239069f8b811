"""Storm-risk score, hazard category, colour tier and speed deficit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerocell.functions.numeric import cents, round2
from aerocell.schemas import BASELINE_VELOCITY_MPS

# --- Fixed values -----------------------------------------------------------
RISK_PER_MM, RISK_PER_GUST_MPS, RISK_PER_CLOUD_PCT = 15.0, 1.5, 0.20
SEVERE_RISK, SEVERE_PRECIP, SEVERE_GUST = 60.0, 3.0, 22.0
SHEAR_WIND, SHEAR_GUST = 14.0, 18.0
RAIN_PRECIP = 0.5
LOW_VISIBILITY_M = 3000.0
CATEGORIES = ["SEVERE_STORM", "HIGH_WIND_SHEAR", "MODERATE_RAIN", "LOW_VISIBILITY", "CLEAR"]
RISK_TIERS = [
    ("red", 70.0, (231, 76, 60, 220)),
    ("orange", 45.0, (230, 126, 34, 210)),
    ("yellow", 20.0, (241, 196, 15, 200)),
    ("green", None, (46, 204, 113, 180)),
]
# ---------------------------------------------------------------------------


def _clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def convective_risk(
    precipitation: Column, gusts: Column, cloud: Column, clamp_inputs: bool = False
) -> Column:
    """Score in [0, 100] with two decimals; missing inputs count as zero.

    ``clamp_inputs`` also lifts negative rain and gusts to zero, which is the
    stricter form used when an observation is scored on its own.
    """
    zero = F.lit(0.0)
    rain, gust = F.coalesce(precipitation, zero), F.coalesce(gusts, zero)
    if clamp_inputs:
        rain, gust = F.greatest(zero, rain), F.greatest(zero, gust)
    cover = _clamp(F.coalesce(cloud, zero), 0.0, 100.0)
    score = rain * F.lit(RISK_PER_MM) + gust * F.lit(RISK_PER_GUST_MPS) + cover * F.lit(RISK_PER_CLOUD_PCT)
    # Both ends of the scale are whole numbers, so clamping and rounding commute.
    return cents(_clamp(score, 0.0, 100.0))


def hazard_category(
    risk: Column, precipitation: Column, wind: Column, gusts: Column, visibility: Column
) -> Column:
    """First matching category; a missing measure matches nothing."""
    severe, shear, rain, low_visibility, clear = CATEGORIES
    return (
        F.when((risk >= SEVERE_RISK) | (precipitation >= SEVERE_PRECIP) | (gusts >= SEVERE_GUST), severe)
        .when((wind >= SHEAR_WIND) | (gusts >= SHEAR_GUST), shear)
        .when(precipitation >= RAIN_PRECIP, rain)
        .when(visibility < LOW_VISIBILITY_M, low_visibility)
        .otherwise(clear)
    )


def silver_category() -> Column:
    """The category of a row of the enriched table."""
    return hazard_category(
        F.col("convective_risk_score"),
        F.col("precipitation_mm"),
        F.col("wind_speed_mps"),
        F.col("wind_gusts_mps"),
        F.col("visibility_m"),
    )


def _by_tier(risk: Column, pick) -> Column:
    chain = F
    for tier in RISK_TIERS[:-1]:
        chain = chain.when(risk >= tier[1], pick(tier))
    return chain.otherwise(pick(RISK_TIERS[-1]))


def risk_tier(risk: Column) -> Column:
    return _by_tier(risk, lambda tier: F.lit(tier[0]))


def risk_color(risk: Column) -> Column:
    """Red, green, blue, alpha of the tier."""
    return _by_tier(risk, lambda tier: F.array(*[F.lit(v) for v in tier[2]]))


def velocity_deficit(velocity: Column) -> Column:
    """Percent below the cruising baseline; 0.0 for missing or non-positive speed."""
    base = F.lit(BASELINE_VELOCITY_MPS)
    return F.when(velocity > 0, round2((base - velocity) / base * F.lit(100.0))).otherwise(F.lit(0.0))
