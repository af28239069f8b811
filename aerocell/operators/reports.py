"""Reporting views, explorer slices and KPIs, cross-filters and top-k lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocell import functions as fn
from aerocell.functions.hazard import silver_category
from aerocell.operators.lookup import lookup_join
from aerocell.schemas import (
    AUDIT_SCHEMA,
    GOLD_SCHEMA,
    IMPACT_RISK,
    LATEST_AUDITS,
    LATEST_REPORTS,
    REPORT_DAYS,
)

# Columns of the inspection table, in display order.
INSPECT_COLUMNS = [
    "callsign",
    "icao24",
    "origin_country",
    "latitude",
    "longitude",
    "baro_altitude_m",
    "velocity_mps",
    "hazard_category",
    "convective_risk_score",
    "precipitation_mm",
    "wind_gusts_mps",
    "geohash",
]
# Columns of a manifest, in order.
MANIFEST_COLUMNS = [
    "audit_id",
    "archival_timestamp",
    "target_partition_date",
    "record_count_evicted",
    "compressed_parquet_bytes",
    "sha256_checksum",
    "storage_destination_uri",
    "truncated_table_name",
]


# --- day windows -------------------------------------------------------------
def last_days(df: DataFrame, as_of: dt.date, days: int = REPORT_DAYS) -> DataFrame:
    """Rows of the trailing days; a literal bound on the partition column."""
    return df.filter(F.col("recorded_date") >= F.lit(as_of - dt.timedelta(days=days)))


def today(df: DataFrame, as_of: dt.date) -> DataFrame:
    return df.filter(F.col("recorded_date") == F.lit(as_of))


# --- views -------------------------------------------------------------------
def view_hotspots(gold: DataFrame, as_of: dt.date) -> DataFrame:
    """The matrix of the trailing week."""
    return last_days(gold, as_of).select(*GOLD_SCHEMA.names)


def hourly_trends(gold: DataFrame, as_of: dt.date) -> DataFrame:
    """Hour and category over all cells: sums, and unweighted means of the cells' means."""
    return (
        last_days(gold, as_of)
        .groupBy("window_start", "weather_condition_category")
        .agg(
            F.sum("total_active_flights").alias("total_flights_in_hour"),
            fn.round2(F.avg("avg_velocity_mps")).alias("hourly_avg_velocity_mps"),
            fn.round2(F.avg("velocity_deficit_pct")).alias("hourly_avg_deficit_pct"),
            fn.round2(F.max("peak_wind_gust_mps")).alias("max_gust_in_hour"),
            fn.round2(F.avg("mean_convective_risk")).alias("hourly_convective_risk"),
            F.sum("flights_impacted_count").alias("total_impacted_aircraft"),
        )
    )


def view_audit(audit: DataFrame) -> DataFrame:
    """The ledger with sizes in megabytes."""
    sizes = {
        "raw_uncompressed_bytes": "uncompressed_mb",
        "compressed_parquet_bytes": "compressed_parquet_mb",
    }
    shown = [
        fn.to_mb(F.col(n)).alias(sizes[n]) if n in sizes else F.col(n)
        for n in AUDIT_SCHEMA.names
        if n != "metadata_json"
    ]
    return audit.select(*shown)


def register_views(gold: DataFrame, audit: DataFrame, as_of: dt.date) -> None:
    """The three reporting views as temporary views for SQL callers."""
    view_hotspots(gold, as_of).createOrReplaceTempView("realtime_hotspots")
    hourly_trends(gold, as_of).createOrReplaceTempView("hourly_delay_trends")
    view_audit(audit).createOrReplaceTempView("archival_audit_trail")


# --- boards over the matrix ----------------------------------------------------
def scorecards(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.sum("total_active_flights").alias("active_tracked_aircraft"),
        fn.round2(F.avg("velocity_deficit_pct")).alias("average_airspeed_deficit"),
        F.sum("flights_impacted_count").alias("aircraft_in_severe_weather"),
        F.max("peak_wind_gust_mps").alias("maximum_wind_gusts"),
    )


def hazard_map(gold: DataFrame) -> DataFrame:
    """Bubble per cell and category."""
    return gold.groupBy("geohash", "weather_condition_category").agg(
        F.sum("flights_impacted_count").alias("flights_impacted_count"),
        fn.round2(F.avg("avg_velocity_mps")).alias("avg_velocity_mps"),
        fn.round2(F.avg("mean_convective_risk")).alias("mean_convective_risk"),
    )


# --- explorer ------------------------------------------------------------------
def explorer_rows(silver: DataFrame) -> DataFrame:
    """Enriched rows with category, colour tier and speed deficit."""
    risk = F.col("convective_risk_score")
    return silver.withColumns(
        {
            "hazard_category": silver_category(),
            "color": fn.risk_color(risk),
            "risk_tier": fn.risk_tier(risk),
            "velocity_deficit_pct": fn.velocity_deficit(F.col("velocity_mps")),
        }
    )


def explore_slice(df: DataFrame, min_risk: float, low: float, high: float) -> DataFrame:
    """Risk at or above a threshold, altitude (missing as 0) in an inclusive range."""
    altitude = F.coalesce(F.col("baro_altitude_m"), F.lit(0.0))
    return df.filter((F.col("convective_risk_score") >= min_risk) & altitude.between(low, high))


def explore_kpis(df: DataFrame) -> DataFrame:
    """Headline figures of a slice; one row per cell is formed before the total."""
    per_cell = df.groupBy("geohash").agg(
        F.count("*").alias("n"),
        F.sum("velocity_mps").alias("speed"),
        F.count("velocity_mps").alias("with_speed"),
        F.sum("velocity_deficit_pct").alias("deficit"),
        F.count("velocity_deficit_pct").alias("with_deficit"),
        F.count_if(F.col("convective_risk_score") >= IMPACT_RISK).alias("severe"),
    )

    def mean(total: str, count: str) -> Column:
        return fn.safe_divide(F.sum(total), F.sum(count))

    speed = mean("speed", "with_speed")
    zero = F.lit(0)
    return per_cell.agg(
        F.coalesce(F.sum("n"), zero).alias("total_active_aircraft"),
        fn.round2(speed).alias("avg_ground_speed_mps"),
        fn.round2(fn.to_knots(speed)).alias("avg_ground_speed_knots"),
        fn.round2(mean("deficit", "with_deficit")).alias("avg_speed_deficit_pct"),
        F.coalesce(F.sum("severe"), zero).alias("severe_weather_encounters"),
        F.count("geohash").alias("active_weather_grids"),
    )


def category_counts(df: DataFrame) -> DataFrame:
    """Reports per hazard category, most frequent first."""
    counts = df.groupBy("hazard_category").agg(F.count("*").alias("flights"))
    return counts.orderBy(F.desc("flights"), "hazard_category")


def gust_vs_deficit(df: DataFrame) -> DataFrame:
    """Scatter pairs; a row missing either value is dropped."""
    return df.select("wind_gusts_mps", "velocity_deficit_pct").dropna()


def inspect_columns(df: DataFrame) -> DataFrame:
    """The display columns that exist."""
    return df.select([c for c in INSPECT_COLUMNS if c in df.columns])


def map_layer(df: DataFrame) -> DataFrame:
    """Position, height, colour and tooltip fields of every report."""
    return df.select(
        "longitude",
        "latitude",
        F.col("baro_altitude_m").alias("elevation"),
        "color",
        "callsign",
        "icao24",
        "baro_altitude_m",
        "velocity_mps",
        "hazard_category",
        "convective_risk_score",
        "precipitation_mm",
        "wind_gusts_mps",
        "velocity_deficit_pct",
    )


def map_center(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("latitude").alias("center_lat"), F.avg("longitude").alias("center_lon"))


def hazard_alerts(df: DataFrame, min_risk: float = IMPACT_RISK) -> DataFrame:
    """Reports at or above a risk level, named by callsign or else by transponder id."""
    return df.filter(F.col("convective_risk_score") >= min_risk).select(
        "flight_record_id",
        F.coalesce("callsign", "icao24").alias("flight"),
        "callsign",
        "icao24",
        "convective_risk_score",
        "wind_gusts_mps",
        "precipitation_mm",
        "baro_altitude_m",
    )


# --- top-k ---------------------------------------------------------------------
def _newest_first(column: str, nulls: str) -> Column:
    return F.desc_nulls_first(column) if nulls == "first" else F.desc_nulls_last(column)


def latest_silver(
    silver: DataFrame, n: int = LATEST_REPORTS, nulls: str = "last", as_of: dt.date | None = None
) -> DataFrame:
    """Newest reports by weather time, ties by record id; optionally one day only."""
    rows = silver if as_of is None else today(silver, as_of)
    return rows.orderBy(_newest_first("weather_recorded_at", nulls), "flight_record_id").limit(n)


def latest_audit(audit: DataFrame, n: int = LATEST_AUDITS, nulls: str = "last") -> DataFrame:
    return audit.orderBy(_newest_first("archival_timestamp", nulls), "audit_id").limit(n)


def success_manifests(audit: DataFrame) -> DataFrame:
    """Manifests of completed evictions, in no order."""
    return audit.filter(F.col("eviction_status") == "SUCCESS").select(*MANIFEST_COLUMNS)


def manifest_order(audit: DataFrame) -> DataFrame:
    """Manifests of completed evictions, newest day first, then by audit id."""
    return success_manifests(audit).orderBy(F.desc("target_partition_date"), "audit_id")


# --- silver and gold together ----------------------------------------------------
def _in_cells(df: DataFrame, of: DataFrame) -> DataFrame:
    """Rows of ``df`` in the distinct cells of ``of``; Spark broadcasts the cells if they are few."""
    return lookup_join(df, of.select("geohash").distinct(), ["geohash"], "left_semi")


def flights_in_category(silver: DataFrame, gold: DataFrame, category: str) -> DataFrame:
    """Reports in the cells where a hazard category occurred."""
    return _in_cells(silver, gold.filter(F.col("weather_condition_category") == category))


def cells_of_callsign(gold: DataFrame, silver: DataFrame, callsign: str) -> DataFrame:
    """Matrix rows of the cells a callsign was seen in."""
    return _in_cells(gold, silver.filter(F.col("callsign") == callsign))


def silver_gold(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """The many-to-many link on the cell, evaluated the way a report reads it.

    Each side is folded to its grain first - reports per cell, matrix per cell
    and category - so a busy cell meets at most one row per category instead of
    every pair of its rows.
    """
    reports = silver.groupBy("geohash").agg(
        F.count("*").alias("reports"),
        fn.round2(F.avg("velocity_mps")).alias("report_velocity_mps"),
        fn.round2(F.avg("convective_risk_score")).alias("report_risk"),
    )
    matrix = gold.groupBy("geohash", "weather_condition_category").agg(
        F.count("*").alias("matrix_rows"),
        F.sum("total_active_flights").alias("total_active_flights"),
        fn.round2(F.avg("velocity_deficit_pct")).alias("velocity_deficit_pct"),
    )
    return reports.join(matrix, "geohash")


# --- run metrics -----------------------------------------------------------------
# Names of the run metrics.
METRIC_NAMES = [
    "raw_flights",
    "valid_flights",
    "unique_weather_grids",
    "weather_observations",
    "silver_records_produced",
    "records_committed",
]


def stage_counts(checked: DataFrame) -> DataFrame:
    """Counts of a run from one pass over its checked reports.

    ``checked`` has a boolean ``valid`` and, for valid reports, ``geohash`` and
    ``flight_record_id``. The lookup of the weather adds no rows, so each valid
    report is one enriched row.
    """
    own = F.col("valid")
    return checked.agg(
        F.count(F.lit(1)).alias("raw_flights"),
        F.count_if(own).alias("valid_flights"),
        F.countDistinct(F.when(own, F.col("geohash"))).alias("unique_weather_grids"),
        F.count_if(own).alias("silver_records_produced"),
        F.countDistinct(F.when(own, F.col("flight_record_id"))).alias("records_committed"),
    )


def run_metrics(checked: DataFrame, weather: DataFrame, committed: int | None = None) -> DataFrame:
    """One row with the counts of every stage of a run.

    ``checked`` as in :func:`stage_counts`; each row of ``weather`` is an
    observation. ``committed`` is how many records a store took, where one did.
    """
    counts = stage_counts(checked)
    if committed is not None:
        counts = counts.withColumn("records_committed", F.lit(committed).cast("bigint"))
    seen = weather.agg(F.count(F.lit(1)).alias("weather_observations"))
    # Both are one row, an aggregate without groups; each leaves the other's columns null.
    both = counts.unionByName(seen, allowMissingColumns=True)
    both = both.agg(*(F.max(c).alias(c) for c in METRIC_NAMES))
    status = F.when(F.col("raw_flights") == 0, "SKIPPED_EMPTY_FLIGHTS").otherwise("SUCCESS")
    return both.select(
        *METRIC_NAMES,
        (F.col("raw_flights") - F.col("valid_flights")).alias("quarantined_flights"),
        status.alias("status"),
    )
