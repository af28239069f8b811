import pytest
from helpers import flight, rows_of, silver_of, silver_row
from pyspark.sql import functions as F

from aerocell.operators import contracts
from aerocell.plans.pipeline import checked_flights
from aerocell.schemas import FLIGHT_SCHEMA, WEATHER_SCHEMA
from helpers import STAMP


def reasons(quarantine):
    return sorted(r["rejection_reasons"] for r in quarantine.collect())


def test_valid_and_quarantine_partition_the_input(spark):
    rows = [
        flight(),
        flight(latitude=105.0),
        flight(longitude=200.0, velocity_mps=-1.0),
        flight(icao24="ab", callsign="THIRTEENCHARS"),
        flight(time_position=-1, true_track_deg=361.0),
        flight(icao24=None),
    ]
    valid, quarantine = contracts.validate_flights(rows_of(spark, FLIGHT_SCHEMA, rows))
    assert valid.count() == 1
    assert reasons(quarantine) == [
        ["icao24_length", "callsign_length"],
        ["icao24_required"],
        ["latitude_range"],
        ["longitude_range", "velocity_mps_range"],
        ["time_position_range", "true_track_deg_range"],
    ]


def test_bounds_are_inclusive_and_optional_fields_may_be_null(spark):
    edges = [
        flight(latitude=90.0, longitude=-180.0, velocity_mps=0.0, true_track_deg=360.0, icao24="abcd"),
        flight(latitude=-90.0, longitude=180.0, callsign="TWELVECHARS1", icao24="abcdefghij", time_position=0),
    ]
    valid, quarantine = contracts.validate_flights(rows_of(spark, FLIGHT_SCHEMA, edges))
    assert (valid.count(), quarantine.count()) == (2, 0)


def test_nulls_left_after_normalising_are_rejected(spark):
    rows = rows_of(spark, FLIGHT_SCHEMA, [flight(on_ground=None, spi=None, origin_country=None, position_source=None)])
    _, quarantine = contracts.validate_flights(rows)
    assert reasons(quarantine) == [
        ["origin_country_required", "on_ground_required", "spi_required", "position_source_required"]
    ]


def test_text_input_is_coerced_or_named(spark):
    text = rows_of(spark, FLIGHT_SCHEMA, [flight(), flight()]).withColumns(
        {"velocity_mps": F.lit("200.5"), "time_position": F.lit("17180")}
    )
    valid, _ = contracts.validate_flights(text)
    assert dict(valid.dtypes)["velocity_mps"] == "double" and valid.first()["velocity_mps"] == 200.5
    bad = text.withColumn("velocity_mps", F.lit("fast"))
    assert reasons(contracts.validate_flights(bad)[1]) == [["velocity_mps_type"], ["velocity_mps_type"]]


def test_nan_is_missing_not_large(spark):
    df = rows_of(spark, FLIGHT_SCHEMA, [flight(velocity_mps=float("nan")), flight(latitude=float("nan"))])
    valid, quarantine = checked_flights(df.withColumn("server_time", F.lit(1).cast("bigint")))
    assert valid.first()["velocity_mps"] is None
    assert reasons(quarantine) == [["latitude_required"]]


def test_weather_contract(spark):
    base = {"geohash": "dr5r", "weather_recorded_at": STAMP, "temperature_c": 20.0}
    rows = [
        base,
        {**base, "geohash": "dr", "cloud_cover_pct": 101.0},
        {**base, "temperature_c": 71.0, "wind_direction_deg": -1.0},
        {**base, "weather_recorded_at": None},
    ]
    valid, quarantine = contracts.validate_weather(rows_of(spark, WEATHER_SCHEMA, rows))
    assert valid.count() == 1
    assert reasons(quarantine) == [
        ["geohash_length", "cloud_cover_pct_range"],
        ["temperature_c_range", "wind_direction_deg_range"],
        ["weather_recorded_at_required"],
    ]


def test_silver_contract(spark):
    df = silver_of(spark, [silver_row(1), silver_row(2, geohash=None, convective_risk_score=None)])
    valid, quarantine = contracts.validate_silver(df)
    assert valid.count() == 1
    assert reasons(quarantine) == [["geohash_required", "convective_risk_score_required"]]
    with pytest.raises(ValueError, match="callsign"):
        contracts.validate_silver(df.drop("callsign"))
