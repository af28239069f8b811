"""Small typed frames and plan text for the tests."""

import datetime as dt

from aerocell.schemas import SILVER_SCHEMA

UTC = dt.timezone.utc
STAMP = dt.datetime(2027, 5, 19, 6, 20, tzinfo=UTC)

_FLIGHT = {
    "icao24": "4ca9d1",
    "origin_country": "Ireland",
    "time_position": 1810705200,
    "last_contact": 1810705203,
    "longitude": -6.27,
    "latitude": 53.42,
    "on_ground": False,
    "spi": False,
    "position_source": 0,
    "ingested_at": STAMP,
}


def rows_of(spark, schema, rows):
    """Rows given as dicts; absent fields are null."""
    data = [tuple(r.get(n) for n in schema.names) for r in rows]
    loose = type(schema)([type(f)(f.name, f.dataType, True) for f in schema])
    return spark.createDataFrame(data, loose)


def flight(**changes):
    return {**_FLIGHT, **changes}


def silver_row(number, **changes):
    base = flight(
        flight_record_id=f"id{number}",
        geohash="gc7x",
        recorded_date=dt.date(2027, 5, 19),
        weather_recorded_at=dt.datetime(2027, 5, 19, 5, 40, tzinfo=UTC),
        convective_risk_score=10.0,
        velocity_mps=200.0,
    )
    return {**base, **changes}


def silver_of(spark, rows):
    return rows_of(spark, SILVER_SCHEMA, rows)


def plan(df, mode="formatted"):
    from pyspark.sql.classic.dataframe import DataFrame

    assert isinstance(df, DataFrame)
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
