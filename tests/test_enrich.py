import datetime as dt
import random
from collections import Counter

import pytest
from helpers import STAMP, flight, plan, rows_of
from pyspark.sql import functions as F

from aerocell.operators import enrich
from aerocell.schemas import FLIGHT_SCHEMA, SILVER_SCHEMA, WEATHER_SCHEMA

STORM = {
    "geohash": "gc7x", "weather_recorded_at": STAMP, "temperature_c": 11.5, "precipitation_mm": 1.4,
    "wind_gusts_mps": 12.0, "cloud_cover_pct": 65.0,
}


def tagged(spark, rows):
    return enrich.tag_flights(rows_of(spark, FLIGHT_SCHEMA, rows))


def test_scores_reports_with_the_weather_of_their_cell(spark):
    flights = tagged(spark, [flight(), flight(latitude=-33.95, longitude=151.18)])
    rows = enrich.enrich(flights, rows_of(spark, WEATHER_SCHEMA, [STORM])).orderBy("geohash").collect()
    assert [r["geohash"] for r in rows] == ["gc7x", "r3gw"]
    # 1.4 * 15 + 12 * 1.5 + 65 * 0.2
    assert rows[0]["convective_risk_score"] == 52.0 and rows[0]["temperature_c"] == 11.5
    # No weather: the report stays, with nulls and no risk.
    assert rows[1]["convective_risk_score"] == 0.0 and rows[1]["temperature_c"] is None
    assert rows[0].asDict().keys() == set(SILVER_SCHEMA.names)


def test_no_weather_at_all(spark):
    flights = tagged(spark, [flight(), flight(icao24="ffff")])
    rows = enrich.enrich(flights, rows_of(spark, WEATHER_SCHEMA, [])).collect()
    assert [r["convective_risk_score"] for r in rows] == [0.0, 0.0]


@pytest.mark.parametrize("precision", [3, 4, 5, 8])
@pytest.mark.parametrize("keys", [("geohash",), ("cycle_id", "geohash")])
def test_last_observation_counts_whatever_the_key(spark, precision, keys):
    flights = enrich.tag_flights(rows_of(spark, FLIGHT_SCHEMA, [flight()]), precision)
    cell, cycle = flights.select("geohash", "cycle_id").first()
    earlier = {"weather_recorded_at": STAMP - dt.timedelta(hours=1), "temperature_c": 30.0}
    nan = {"wind_gusts_mps": float("nan")}
    readings = [{**STORM, **change, "geohash": cell} for change in ({}, {}, earlier, {**earlier, **nan})]
    weather = rows_of(spark, WEATHER_SCHEMA, readings).withColumn("cycle_id", F.lit(cycle))
    (row,) = enrich.enrich(flights, weather, keys).collect()
    assert row["temperature_c"] == 11.5 and row["convective_risk_score"] == 52.0


def test_nan_weather_is_no_weather(spark):
    flights = tagged(spark, [flight()])
    weather = rows_of(spark, WEATHER_SCHEMA, [{**STORM, "wind_gusts_mps": float("nan")}])
    (row,) = enrich.enrich(flights, weather).collect()
    assert row["wind_gusts_mps"] is None and row["convective_risk_score"] == 34.0


def test_hot_cell_is_split_by_the_join(spark):
    """A third of the reports in one cell: the sort-merge join reads it in several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = 120_000
        base = rows_of(spark, FLIGHT_SCHEMA, [flight()]).drop("time_position", "latitude", "longitude")
        spread = F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise((F.col("id") % 1000).cast("double"))
        reports = spark.range(n, numPartitions=8).select(
            F.col("id").alias("time_position"),
            (F.lit(30.0) + spread / 50).alias("latitude"),
            (F.lit(-100.0) + spread / 50).alias("longitude"),
            *[F.lit(v).cast(t).alias(c) for (c, t), v in zip(base.dtypes, base.first())],
        )
        flights = enrich.tag_flights(reports)
        weather = (
            flights.select("cycle_id", "geohash").distinct()
            .withColumn("precipitation_mm", F.lit(2.0))
            .withColumn("wind_gusts_mps", F.lit(10.0))
            .withColumn("cloud_cover_pct", F.lit(0.0))
        )
        for name in WEATHER_SCHEMA.names[1:]:
            if name not in weather.columns:
                weather = weather.withColumn(name, F.lit(None).cast(WEATHER_SCHEMA[name].dataType))
        joined = enrich.enrich(flights, weather, ("cycle_id", "geohash"))
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == n and joined.filter("convective_risk_score = 45.0").count() == n
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_first_per_key_keeps_the_first_and_prunes_before_the_exchange(spark):
    rng = random.Random(3)
    # One key holds a third of the rows.
    data = [("hot" if i % 3 == 0 else f"k{rng.randrange(50)}", i, rng.random()) for i in range(3000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, seq int, v double").repartition(8)
    first = enrich.first_per_key(df, ["k"], [F.col("seq")])
    expected = {}
    for key, seq, value in data:
        if key not in expected or seq < expected[key][0]:
            expected[key] = (seq, value)
    assert {r["k"]: (r["seq"], r["v"]) for r in first.collect()} == expected
    text = plan(first, "simple")
    assert "row_number(), 1, Partial" in text


def test_latest_weather_combines_before_the_exchange(spark):
    data = [(1, "dr5r", n, float(n)) for n in range(500)] + [(2, "dr5r", 3, 9.0), (1, "gcps", 1, None)]
    df = spark.createDataFrame(data, "cycle_id long, geohash string, o int, temperature_c double")
    latest = enrich.latest_weather(df, ["cycle_id", "geohash"], ["o"])
    got = {(r["cycle_id"], r["geohash"]): (r["o"], r["temperature_c"]) for r in latest.collect()}
    assert got == {(1, "dr5r"): (499, 499.0), (2, "dr5r"): (3, 9.0), (1, "gcps"): (1, None)}
    assert "partial_max_by" in plan(latest, "simple")


def test_centroids_and_summary(spark):
    flights = tagged(
        spark,
        [
            flight(latitude=40.7128, longitude=-74.006),
            flight(latitude=40.72, longitude=-74.01),
            flight(latitude=51.47, longitude=-0.4543),
        ],
    )
    cells = {r["geohash"]: (r["lat"], r["lon"]) for r in enrich.extract_centroids(flights).collect()}
    assert set(cells) == {"dr5r", "gcps"}
    assert abs(cells["dr5r"][0] - 40.7128) < 0.1 and abs(cells["dr5r"][1] + 74.006) < 0.2
    assert tuple(enrich.binning_summary(flights).first()) == (3, 2, 1.5)
    assert Counter(r["geohash"] for r in flights.collect())["dr5r"] == 2
    assert tuple(enrich.binning_summary(flights.limit(0)).first()) == (0, 0, 0.0)
