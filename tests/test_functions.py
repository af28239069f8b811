import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from aerocell import functions as fn
from aerocell.functions.geohash import axis_bits
from aerocell.schemas import GEOHASH_ALPHABET


def halving(lat, lon, precision):
    """Geohash by repeated halving, one bit at a time: the brute-force check."""
    ranges = {0: [-180.0, 180.0], 1: [-90.0, 90.0]}
    point = {0: lon, 1: lat}
    bits = ""
    for nth in range(5 * precision):
        axis = nth % 2
        low, high = ranges[axis]
        middle = (low + high) / 2
        upper = point[axis] > middle
        ranges[axis] = [middle, high] if upper else [low, middle]
        bits += "1" if upper else "0"
    code = "".join(GEOHASH_ALPHABET[int(bits[i : i + 5], 2)] for i in range(0, len(bits), 5))
    return code, round(sum(ranges[1]) / 2, 4), round(sum(ranges[0]) / 2, 4)


def points(precision, count=400):
    rng = random.Random(precision)
    lon_bits, lat_bits = axis_bits(precision)
    found = [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (40.7128, -74.0060), (51.47, -0.4543)]
    for _ in range(count):
        lat, lon = rng.uniform(-90, 90), rng.uniform(-180, 180)
        if rng.random() < 0.5:  # on a cell edge or one float step beside it
            lat = rng.randrange(1 << lat_bits) * 180 / (1 << lat_bits) - 90
            lon = rng.randrange(1 << lon_bits) * 360 / (1 << lon_bits) - 180
            step = rng.choice([-math.inf, 0, math.inf])
            lat = math.nextafter(lat, step) if step else lat
            lon = math.nextafter(lon, step) if step else lon
        found.append((max(-90.0, min(90.0, lat)), max(-180.0, min(180.0, lon))))
    return found


@pytest.mark.parametrize("precision", [3, 4, 5, 6, 8, 12])
def test_geohash_equals_halving(spark, precision):
    # 5e-324 beside zero underflows when divided; no position is that small.
    data = [p for p in points(precision) if all(v == 0 or abs(v) > 1e-300 for v in p)]
    df = spark.createDataFrame(data, "lat double, lon double")
    code = fn.geohash(F.col("lat"), F.col("lon"), precision)
    rows = df.select("lat", "lon", code.alias("code")).withColumn(
        "c", fn.geohash_centroid(F.upper("code"), precision)
    )
    for row in rows.collect():
        expected, lat, lon = halving(row["lat"], row["lon"], precision)
        assert row["code"] == expected
        assert (row["c"]["lat"], row["c"]["lon"]) == pytest.approx((lat, lon), abs=1e-9)


def test_geohash_known_cells_and_round_trip(spark):
    df = spark.createDataFrame([(40.7128, -74.0060), (51.47, -0.4543)], "lat double, lon double")
    assert [r[0] for r in df.select(fn.geohash(F.col("lat"), F.col("lon"))).collect()] == ["dr5r", "gcps"]
    cells = df.select(fn.geohash(F.col("lat"), F.col("lon")).alias("g")).withColumn("c", fn.geohash_centroid(F.col("g")))
    again = cells.select("g", fn.geohash(F.col("c.lat"), F.col("c.lon")).alias("h"))
    assert all(r["g"] == r["h"] for r in again.collect())


def test_geohash_missing_and_foreign_input(spark):
    df = spark.createDataFrame([(None, 1.0, "dr5a"), (1.0, None, "dr5")], "lat double, lon double, g string")
    rows = df.select(
        fn.geohash(F.col("lat"), F.col("lon")).alias("code"), fn.geohash_centroid(F.col("g")).alias("c")
    ).collect()
    assert all(r["code"] is None and r["c"] is None for r in rows)


def test_record_id_ignores_case_and_blanks(spark):
    df = spark.createDataFrame([("4CA9D1", 1810705200), (" 4ca9d1\t", 1810705200), ("4ca9d1", 1810705260)], "i string, t long")
    ids = [r[0] for r in df.select(fn.record_id(F.col("i"), F.col("t"))).collect()]
    assert ids[0] == ids[1] != ids[2]
    assert ids[0] == hashlib.sha256(b"4ca9d1_1810705200").hexdigest()


def test_text_cleaning(spark):
    df = spark.createDataFrame([("  UAL1 \n",), ("   ",), ("",), (None,)], "t string")
    rows = df.select(
        fn.clean_callsign(F.col("t")).alias("callsign"),
        fn.default_country(F.col("t")).alias("country"),
        fn.clean_squawk(F.col("t")).alias("squawk"),
    ).collect()
    assert [r["callsign"] for r in rows] == ["UAL1", None, None, None]
    # A blank-only text is present, so it is trimmed rather than replaced.
    assert [r["country"] for r in rows] == ["UAL1", "", "Unknown", "Unknown"]
    assert [r["squawk"] for r in rows] == ["UAL1", "", None, None]


def test_risk_forms(spark):
    df = spark.createDataFrame(
        [(0.0, 3.0, 10.0), (5.0, 25.0, 100.0), (2.5, 18.0, 80.0), (None, None, None), (-1.0, 30.0, 120.0)],
        "p double, g double, c double",
    )
    args = [F.col(c) for c in "pgc"]
    rows = df.select(
        fn.convective_risk(*args).alias("plain"), fn.convective_risk(*args, clamp_inputs=True).alias("clamped")
    ).collect()
    assert [r["plain"] for r in rows] == [6.5, 100.0, 80.5, 0.0, 50.0]
    assert [r["clamped"] for r in rows] == [6.5, 100.0, 80.5, 0.0, 65.0]


def test_hazard_categories_in_order(spark):
    df = spark.createDataFrame(
        [
            (75.0, 4.0, None, 25.0, None),
            (30.0, None, 16.0, 19.0, None),
            (15.0, 1.2, 5.0, 8.0, None),
            (5.0, 0.0, 4.0, 6.0, 2999.0),
            (5.0, 0.0, 4.0, 6.0, 15000.0),
            (None, None, None, None, None),
            (60.0, 0.0, 0.0, 0.0, 9000.0),
            (10.0, 0.5, 13.9, 17.9, 100.0),
        ],
        "r double, p double, w double, g double, v double",
    )
    got = [r[0] for r in df.select(fn.hazard_category(*[F.col(c) for c in "rpwgv"])).collect()]
    assert got == [
        "SEVERE_STORM", "HIGH_WIND_SHEAR", "MODERATE_RAIN", "LOW_VISIBILITY", "CLEAR", "CLEAR",
        "SEVERE_STORM", "MODERATE_RAIN",
    ]


def test_risk_tiers(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (55.0,), (70.0,)], "r double")
    rows = df.select(fn.risk_tier(F.col("r")), fn.risk_color(F.col("r"))).collect()
    assert [r[0] for r in rows] == ["green", "yellow", "orange", "red"]
    assert rows[3][1] == [231, 76, 60, 220] and rows[0][1] == [46, 204, 113, 180]


def test_deficit_round_and_division(spark):
    df = spark.createDataFrame([(175.0,), (0.0,), (-3.0,), (None,)], "v double")
    assert [r[0] for r in df.select(fn.velocity_deficit(F.col("v"))).collect()] == [23.91, 0.0, 0.0, 0.0]
    numbers = spark.createDataFrame([(1.005, 0.0), (2.675, 2.0), (1e15 + 0.3, 4.0), (None, 1.0)], "x double, d double")
    rows = numbers.select(fn.round2(F.col("x")), fn.safe_divide(F.col("x"), F.col("d"))).collect()
    assert [r[0] for r in rows][:2] == [1.01, 2.68] and rows[2][0] == pytest.approx(1e15 + 0.3) and rows[3][0] is None
    assert rows[0][1] is None and rows[1][1] == pytest.approx(1.3375)


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, "y")], "a double, b string")
    assert [tuple(r) for r in fn.nan_to_null(df).collect()] == [(None, "x"), (1.0, "y")]


def test_dates_and_units(spark):
    df = spark.createDataFrame([(86399,), (86400,), (-1,)], "t long")
    assert [str(r[0]) for r in df.select(fn.recorded_date(F.col("t"))).collect()] == ["1970-01-01", "1970-01-02", "1969-12-31"]
    sizes = spark.createDataFrame([(1048576, 100.0)], "b long, v double")
    row = sizes.select(fn.to_mb(F.col("b")), fn.to_kb(F.col("b")), fn.to_knots(F.col("v"))).first()
    assert tuple(row) == (1.0, 1024.0, pytest.approx(194.384))


def test_round2_equals_rounding_through_a_decimal(spark):
    """Ties, negatives and long fractions, against DECIMAL(18,6)."""
    n = F.col("id")
    values = [n / 1000, -n / 1000, n / 7, (n * 31 % 99991) / 4096, n * 12345.678, F.rand(5) * 1e6, n / 200 + 0.005]
    for value in values:
        df = spark.range(200_000).select(value.cast("double").alias("x"))
        decimal = F.round(F.col("x").cast("decimal(18,6)"), 2).cast("double")
        assert df.filter(fn.round2(F.col("x")) != decimal).count() == 0
    zero = spark.range(1).select(fn.round2(F.lit(-0.001)).alias("z")).first()["z"]
    assert math.copysign(1, zero) == 1


def test_missing_and_huge_values_round_to_themselves(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1e300,), (-1e12,)], "x double")
    got = [r[0] for r in df.select(fn.round2(F.col("x"))).collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2:] == [1e300, -1e12]
