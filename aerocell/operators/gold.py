"""The hourly KPI matrix of cell and hazard category."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerocell import functions as fn
from aerocell.functions.hazard import silver_category
from aerocell.schemas import (
    BASELINE_VELOCITY_MPS,
    CRUISE_ALTITUDE_M,
    DEFAULT_VISIBILITY_M,
    GOLD_SCHEMA,
    IMPACT_RISK,
    TableSpec,
)

GROUP = ["window_start", "recorded_date", "geohash", "weather_condition_category"]


def on_days(df: DataFrame, days: dt.date | Sequence[dt.date] | None, column: str = "recorded_date") -> DataFrame:
    """Rows of one day, of a list of days, or all; literal days prune partitions."""
    if days is None:
        return df
    wanted = [days] if isinstance(days, dt.date) else list(days)
    return df.filter(F.col(column).isin(wanted))


def gold_eligible(silver: DataFrame, days: dt.date | Sequence[dt.date] | None = None) -> DataFrame:
    """Rows that count for the matrix: on the days, with weather and with a speed."""
    return on_days(silver, days).filter(
        F.col("weather_recorded_at").isNotNull() & F.col("velocity_mps").isNotNull()
    )


MEASURES = [
    "avg_velocity_mps",
    "avg_precipitation_mm",
    "max_precipitation_mm",
    "avg_wind_speed_mps",
    "peak_wind_gust_mps",
    "avg_cloud_cover_pct",
    "min_visibility_m",
    "mean_convective_risk",
]


def _measures() -> dict[str, tuple[str, Column]]:
    """Measure -> how it is folded and over what; nulls count as the stated value."""

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    return {
        "avg_velocity_mps": ("avg", F.col("velocity_mps")),
        "avg_precipitation_mm": ("avg", or_zero("precipitation_mm")),
        "max_precipitation_mm": ("max", or_zero("precipitation_mm")),
        "avg_wind_speed_mps": ("avg", or_zero("wind_speed_mps")),
        "peak_wind_gust_mps": ("max", or_zero("wind_gusts_mps")),
        "avg_cloud_cover_pct": ("avg", or_zero("cloud_cover_pct")),
        "min_visibility_m": ("min", F.coalesce(F.col("visibility_m"), F.lit(DEFAULT_VISIBILITY_M))),
        "mean_convective_risk": ("avg", or_zero("convective_risk_score")),
    }


def per_aircraft(silver: DataFrame, window: Column) -> DataFrame:
    """Partial sums per matrix cell and aircraft.

    Grouping by aircraft first makes the distinct count a plain count in the
    next step and spreads a hot cell over its aircraft.
    """
    folds = []
    for name, (how, value) in _measures().items():
        folds.append((F.sum if how == "avg" else getattr(F, how))(value).alias(name))
    return silver.groupBy(
        window,
        "recorded_date",
        "geohash",
        silver_category().alias("weather_condition_category"),
        "icao24",
    ).agg(
        F.count("*").alias("reports"),
        F.count_if(F.col("baro_altitude_m") >= CRUISE_ALTITUDE_M).alias("cruising"),
        F.count_if(F.col("convective_risk_score") >= IMPACT_RISK).alias("impacted"),
        *folds,
    )


def merge_partials(partials: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Partial sums of the same cell and aircraft (and ``by``) added up; sums of sums, greatest of greatest."""
    folds = [(F.sum if how == "avg" else getattr(F, how))(name).alias(name) for name, (how, _) in _measures().items()]
    counts = [F.sum(name).alias(name) for name in ("reports", "cruising", "impacted")]
    return partials.groupBy(*GROUP, "icao24", *by).agg(*counts, *folds)


def fold_partials(partials: DataFrame) -> DataFrame:
    """Cells of the matrix, not yet rounded, from partial sums of any number of batches."""
    folded = merge_partials(partials).groupBy(*GROUP).agg(*fold_aircraft())
    return folded.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 1 HOUR"))


def fold_aircraft() -> list[Column]:
    """Aggregates that combine the partial sums of :func:`per_aircraft`."""
    folds = []
    for name, (how, _) in _measures().items():
        if how == "avg":
            folds.append((F.sum(name) / F.sum("reports")).alias(name))
        else:
            folds.append(getattr(F, how)(name).alias(name))
    return [
        F.count("icao24").alias("total_active_flights"),
        F.sum("cruising").alias("total_cruising_flights"),
        F.sum("impacted").alias("flights_impacted_count"),
        *folds,
    ]


# Partial sums as they are stored: a row per batch, hour, cell, category and aircraft.
PARTIALS = TableSpec(
    T.StructType(
        [
            T.StructField("window_start", T.TimestampType()),
            *(T.StructField(n, T.StringType()) for n in ("geohash", "weather_condition_category", "icao24")),
            *(T.StructField(n, T.LongType()) for n in ("reports", "cruising", "impacted")),
            *(T.StructField(n, T.DoubleType()) for n in MEASURES),
            T.StructField("run_id", T.StringType()),
            T.StructField("iteration_id", T.LongType()),
            T.StructField("recorded_date", T.DateType()),
        ]
    ),
    "recorded_date",
    ("geohash", "window_start"),
)


def finish_gold(folded: DataFrame, computed_at: Column) -> DataFrame:
    """Constants, derived deficit and rounding; the deficit uses the unrounded mean."""
    base = F.lit(BASELINE_VELOCITY_MPS)
    deficit = fn.safe_divide(base - F.col("avg_velocity_mps"), base) * F.lit(100.0)
    return folded.withColumns(
        {
            "baseline_velocity_mps": base,
            "velocity_deficit_pct": fn.round2(deficit),
            "computed_at": computed_at,
            **{name: fn.round2(F.col(name)) for name in _measures()},
        }
    ).select(*GOLD_SCHEMA.names)


def gold_matrix(
    silver: DataFrame,
    days: dt.date | Sequence[dt.date] | None = None,
    computed_at: Column | None = None,
) -> DataFrame:
    """KPIs by hour of the weather, cell and hazard category, for many days at once.

    Flights are distinct aircraft; cruising and impacted are counts of reports.
    """
    eligible = gold_eligible(silver, days)
    aircraft = per_aircraft(eligible, fn.hour_start(F.col("weather_recorded_at")).alias("window_start"))
    folded = aircraft.groupBy(*GROUP).agg(*fold_aircraft())
    windowed = folded.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 1 HOUR"))
    return finish_gold(windowed, F.current_timestamp() if computed_at is None else computed_at)


def merge_gold(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after the upsert: matched keys replaced, the rest of both sides kept.

    A cell whose category changed keeps its old row, as an upsert by key must.
    """
    kept = target.join(delta.select(*keys), list(keys), "left_anti")
    return kept.unionByName(delta, allowMissingColumns=True)
