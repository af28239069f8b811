"""Contracts: typed, bounded rows go on, the rest is quarantined with reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerocell.functions.time import LAST_SECOND
from aerocell.schemas import FLIGHT_SCHEMA, SILVER_SCHEMA, WEATHER_SCHEMA

# --- Fixed values: inclusive bounds; None leaves an end open ------------------
FLIGHT_REQUIRED = [
    "icao24",
    "origin_country",
    "time_position",
    "last_contact",
    "longitude",
    "latitude",
    "on_ground",
    "spi",
    "position_source",
    "ingested_at",
]
FLIGHT_LENGTHS = {"icao24": (4, 10), "callsign": (None, 12)}
# A later time (in milliseconds, say) has no calendar day.
FLIGHT_RANGES = {
    "time_position": (0, LAST_SECOND),
    "last_contact": (0, LAST_SECOND),
    "longitude": (-180.0, 180.0),
    "latitude": (-90.0, 90.0),
    "velocity_mps": (0.0, None),
    "true_track_deg": (0.0, 360.0),
}
WEATHER_REQUIRED = ["geohash", "weather_recorded_at"]
WEATHER_LENGTHS = {"geohash": (3, 12)}
WEATHER_RANGES = {
    "temperature_c": (-90.0, 70.0),
    "relative_humidity_pct": (0.0, 100.0),
    "precipitation_mm": (0.0, None),
    "wind_speed_mps": (0.0, None),
    "wind_direction_deg": (0.0, 360.0),
    "wind_gusts_mps": (0.0, None),
    "cloud_cover_pct": (0.0, 100.0),
    "visibility_m": (0.0, None),
}
SILVER_REQUIRED = [
    "flight_record_id",
    "icao24",
    "origin_country",
    "time_position",
    "last_contact",
    "longitude",
    "latitude",
    "on_ground",
    "spi",
    "position_source",
    "geohash",
    "convective_risk_score",
    "ingested_at",
    "recorded_date",
]
# ---------------------------------------------------------------------------


class Contract:
    """Named rules over the columns of one schema, as SQL conditions.

    A column of another type is read with ``try_cast``; text that does not fit
    breaks the rule ``<column>_type``.
    """

    def __init__(self, schema: T.StructType, required=(), lengths=None, ranges=None):
        self.schema = schema
        self.required = set(required)
        self.lengths = lengths or {}
        self.ranges = ranges or {}

    def _values(self, df: DataFrame) -> dict[str, tuple[str, bool]]:
        """Column -> (its value as SQL, whether it had to be cast)."""
        actual = dict(df.dtypes)
        found = {}
        for field in self.schema:
            kind = field.dataType.simpleString()
            if field.name in actual:
                cast = actual[field.name] != kind
                value = f"try_cast(`{field.name}` AS {kind})" if cast else f"`{field.name}`"
                found[field.name] = (value, cast)
        return found

    def rules(self, df: DataFrame) -> dict[str, str]:
        """Rule name -> condition that is true when the rule holds (never null)."""
        values = self._values(df)
        found: dict[str, str] = {}
        for name in self.schema.names:
            if name not in values:
                if name in self.required:
                    found[f"{name}_required"] = "false"
                continue
            value, cast = values[name]
            if cast:
                found[f"{name}_type"] = f"(`{name}` IS NULL OR {value} IS NOT NULL)"
            if name in self.required:
                found[f"{name}_required"] = f"({value} IS NOT NULL)"
            if name in self.lengths:
                found[f"{name}_length"] = f"coalesce({_bounds(f'length({value})', *self.lengths[name])}, true)"
            if name in self.ranges:
                found[f"{name}_range"] = f"coalesce({_bounds(value, *self.ranges[name])}, true)"
        if "cast_errors" in df.columns:
            found["unreadable_field"] = "coalesce(cast_errors = '', true)"
        return found

    def _holds(self, df: DataFrame) -> str:
        """All rules at once, with every value named as few times as possible.

        May be null instead of false: comparing a missing required value to its
        bounds already rejects it.
        """
        rules, kept = self.rules(df), []
        for name, (value, _) in self._values(df).items():
            bounds = [_bounds(f"length({value})", *self.lengths[name])] if name in self.lengths else []
            bounds += [_bounds(value, *self.ranges[name])] if name in self.ranges else []
            if name in self.required:
                kept += bounds or [f"{value} IS NOT NULL"]
            else:
                kept += [f"coalesce({bound}, true)" for bound in bounds]
            kept += [rules[f"{name}_type"]] if f"{name}_type" in rules else []
        kept += [rule for rule in rules.values() if rule == "false"]
        kept += [rules["unreadable_field"]] if "unreadable_field" in rules else []
        return " AND ".join(kept)

    def valid(self, df: DataFrame) -> DataFrame:
        """Rows that keep every rule, with the contract's types.

        One boolean filter: it stays in generated code and reaches the scan.
        """
        kept = df.filter(self._holds(df))
        typed = {n: F.expr(value) for n, (value, cast) in self._values(df).items() if cast}
        kept = kept.withColumns(typed) if typed else kept
        return kept.drop("cast_errors") if "cast_errors" in df.columns else kept

    def check(self, df: DataFrame) -> DataFrame:
        """All rows with the names of the rules they break in ``rejection_reasons``, none for valid ones.

        One pass for callers that need both sides; see :meth:`typed` for the
        valid one.
        """
        return df.withColumn("rejection_reasons", self._broken(df))

    def typed(self, checked: DataFrame) -> DataFrame:
        """The valid rows of :meth:`check`, with the contract's types."""
        kept = checked.filter(F.size("rejection_reasons") == 0).drop("rejection_reasons")
        casts = {n: F.expr(value) for n, (value, cast) in self._values(kept).items() if cast}
        kept = kept.withColumns(casts) if casts else kept
        return kept.drop("cast_errors") if "cast_errors" in kept.columns else kept

    def _broken(self, df: DataFrame):
        broken = ", ".join(f"CASE WHEN NOT {rule} THEN '{name}' END" for name, rule in self.rules(df).items())
        return F.expr(f"array_compact(array({broken}))")

    def quarantine(self, df: DataFrame) -> DataFrame:
        """Rows that break a rule, as they came, with the names of the broken rules."""
        rejected = df.filter(f"NOT coalesce({self._holds(df)}, false)")
        return rejected.withColumn("rejection_reasons", self._broken(df))

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        return self.valid(df), self.quarantine(df)


def _bounds(value: str, low, high) -> str:
    """Inclusive bounds, either end open when None.

    Names the value once where it can: the optimizer moves these conditions
    below the cleaning of the value and repeats it for every mention.
    """
    if high is None and isinstance(low, float):
        # Spark orders NaN above every number, infinity included.
        return f"({value} >= {_literal(low)} AND {value} < double('infinity'))"
    if high is None:
        return f"({value} >= {_literal(low)})"
    if low is None:
        return f"({value} <= {_literal(high)})"
    if low == -high:
        return f"(abs({value}) <= {_literal(high)})"
    if isinstance(low, int) and high < 1 << 30:
        # The distance from the middle, doubled to stay in whole numbers.
        return f"(abs(2 * {value} - {low + high}) <= {high - low})"
    return f"({value} BETWEEN {_literal(low)} AND {_literal(high)})"


def _literal(bound) -> str:
    # A bare 90.0 is a DECIMAL literal in SQL.
    return f"{bound!r}D" if isinstance(bound, float) else repr(bound)


FLIGHT_CONTRACT = Contract(FLIGHT_SCHEMA, FLIGHT_REQUIRED, FLIGHT_LENGTHS, FLIGHT_RANGES)
WEATHER_CONTRACT = Contract(WEATHER_SCHEMA, WEATHER_REQUIRED, WEATHER_LENGTHS, WEATHER_RANGES)
SILVER_CONTRACT = Contract(SILVER_SCHEMA, SILVER_REQUIRED)


def validate_flights(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Normalised reports against the flight contract."""
    return FLIGHT_CONTRACT.split(df)


def validate_weather(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observations against the weather contract."""
    return WEATHER_CONTRACT.split(df)


def validate_silver(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Enriched rows: all thirty columns must exist, then types and required values."""
    absent = [n for n in SILVER_SCHEMA.names if n not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return SILVER_CONTRACT.split(df)
