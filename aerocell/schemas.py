"""Column names, types and constants shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
GEOHASH_PRECISION = 4
BASELINE_VELOCITY_MPS = 230.0
CRUISE_ALTITUDE_M = 3000.0
DEFAULT_VISIBILITY_M = 10000.0
IMPACT_RISK = 50.0
KNOTS_PER_MPS = 1.94384
WEATHER_CHUNK = 50
VECTOR_LENGTH = 17
RETENTION_DAYS = 7
REPORT_DAYS = 7
LATEST_REPORTS = 2000
LATEST_AUDITS = 50
POLL_SECONDS = 600
ZSTD_LEVEL = 9
UNKNOWN_COUNTRY = "Unknown"
# ---------------------------------------------------------------------------

_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
_TS, _DATE = T.TimestampType(), T.DateType()


def _struct(columns, required=()):
    return T.StructType([T.StructField(n, t, n not in required) for n, t in columns])


# --- Fixed values: names, order and types of the stored columns ---------------
_REPORT = [
    ("icao24", _S),
    ("callsign", _S),
    ("origin_country", _S),
    ("time_position", _L),
    ("last_contact", _L),
    ("longitude", _D),
    ("latitude", _D),
    ("baro_altitude_m", _D),
    ("on_ground", _B),
    ("velocity_mps", _D),
    ("true_track_deg", _D),
    ("vertical_rate_mps", _D),
    ("geo_altitude_m", _D),
    ("squawk", _S),
    ("spi", _B),
    ("position_source", _I),
]

_OBSERVATION = [
    ("weather_recorded_at", _TS),
    ("temperature_c", _D),
    ("relative_humidity_pct", _D),
    ("precipitation_mm", _D),
    ("wind_speed_mps", _D),
    ("wind_direction_deg", _D),
    ("wind_gusts_mps", _D),
    ("cloud_cover_pct", _D),
    ("visibility_m", _D),
]

FLIGHT_SCHEMA = _struct(_REPORT + [("ingested_at", _TS)])
WEATHER_SCHEMA = _struct([("geohash", _S)] + _OBSERVATION)
WEATHER_MEASURES = [name for name, _ in _OBSERVATION]

SILVER_SCHEMA = _struct(
    [("flight_record_id", _S)]
    + _REPORT
    + [("geohash", _S)]
    + _OBSERVATION
    + [("convective_risk_score", _D), ("ingested_at", _TS), ("recorded_date", _DATE)],
    required=(
        "flight_record_id",
        "icao24",
        "longitude",
        "latitude",
        "geohash",
        "ingested_at",
        "recorded_date",
    ),
)

GOLD_KEYS = ["window_start", "geohash", "weather_condition_category", "recorded_date"]

GOLD_SCHEMA = _struct(
    [
        ("window_start", _TS),
        ("window_end", _TS),
        ("recorded_date", _DATE),
        ("geohash", _S),
        ("weather_condition_category", _S),
        ("total_active_flights", _L),
        ("total_cruising_flights", _L),
        ("avg_velocity_mps", _D),
        ("baseline_velocity_mps", _D),
        ("velocity_deficit_pct", _D),
        ("avg_precipitation_mm", _D),
        ("max_precipitation_mm", _D),
        ("avg_wind_speed_mps", _D),
        ("peak_wind_gust_mps", _D),
        ("avg_cloud_cover_pct", _D),
        ("min_visibility_m", _D),
        ("mean_convective_risk", _D),
        ("flights_impacted_count", _L),
        ("computed_at", _TS),
    ]
)

AUDIT_SCHEMA = _struct(
    [
        ("audit_id", _S),
        ("archival_timestamp", _TS),
        ("target_partition_date", _DATE),
        ("record_count_evicted", _L),
        ("raw_uncompressed_bytes", _L),
        ("compressed_parquet_bytes", _L),
        ("compression_ratio", _D),
        ("sha256_checksum", _S),
        ("storage_destination_uri", _S),
        ("eviction_status", _S),
        ("truncated_table_name", _S),
        ("execution_duration_seconds", _D),
        ("metadata_json", _S),
    ]
)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """Where a table's rows go: partition column, then sort columns inside each file."""

    schema: T.StructType
    partition: str
    cluster: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        """Stored order: the partition column comes last."""
        names = [n for n in self.schema.names if n != self.partition]
        return names + [self.partition]


SILVER = TableSpec(SILVER_SCHEMA, "recorded_date", ("geohash", "callsign"))
GOLD = TableSpec(GOLD_SCHEMA, "recorded_date", ("geohash", "weather_condition_category"))
# The ledger is partitioned by the day of its timestamp, a column derived on write.
AUDIT = TableSpec(
    T.StructType(AUDIT_SCHEMA.fields + [T.StructField("archival_date", _DATE)]),
    "archival_date",
    ("target_partition_date", "eviction_status"),
)


@dataclass(frozen=True)
class BoundingBox:
    """Latitude and longitude limits; an axis counts only if both its ends are set."""

    lamin: float | None = None
    lamax: float | None = None
    lomin: float | None = None
    lomax: float | None = None


# The named boxes.
BOXES = {
    "us_northeast_corridor": BoundingBox(lamin=38.0, lamax=45.0, lomin=-79.0, lomax=-71.0),
    "europe_central": BoundingBox(lamin=45.0, lamax=55.0, lomin=2.0, lomax=15.0),
    "global_unbounded": BoundingBox(),
}
