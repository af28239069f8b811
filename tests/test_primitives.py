"""SQL functions, covers of boxes, request numbers in ranges, digests of files of any size."""

import hashlib
import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from helpers import plan
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerocell import functions as fn
from aerocell.functions.geohash import GEOHASH_ALPHABET, axis_bits, box_cover
from aerocell.functions.sql import register_sql_functions
from aerocell.plans import catalog
from aerocell.schemas import BoundingBox
from aerocell.session import shared_dir
from aerocell.sources import archive, payloads

NAMES = "precipitation double, wind double, gusts double, visibility double, cloud double"


def test_sql_functions_equal_the_column_functions(spark):
    assert register_sql_functions(spark) == ["convective_risk", "geohash", "hazard_category", "record_id"]
    own = np.random.default_rng(3)
    rows = []
    for n in range(2000):
        values = [None if own.random() < 0.15 else float(round(v, 2)) for v in own.uniform(-4, 40, 5)]
        lat, lon = float(own.uniform(-95, 95)), float(own.uniform(-185, 185))
        edge = [(0.0, 0.0), (90.0, 180.0), (-90.0, -180.0), (None, 1.0), (45.0, None)]
        lat, lon = edge[n] if n < len(edge) else (lat, lon)
        rows.append((f" \t\nAb{n}\x0b\x0c " if n % 5 else None, n * 1000 if n % 7 else None, lat, lon, *values))
    df = spark.createDataFrame(rows, f"icao24 string, time_position long, lat double, lon double, {NAMES}")
    df = df.withColumn("visibility", F.col("visibility") * 300)
    df.createOrReplaceTempView("readings")
    got = spark.sql(
        "SELECT record_id(icao24, time_position) AS id, geohash(lat, lon) AS cell,"
        " convective_risk(precipitation, gusts, cloud) AS risk,"
        " hazard_category(convective_risk(precipitation, gusts, cloud), precipitation, wind, gusts, visibility) AS category"
        " FROM readings"
    )
    risk = fn.convective_risk(F.col("precipitation"), F.col("gusts"), F.col("cloud"))
    want = df.select(
        fn.record_id(F.col("icao24"), F.col("time_position")),
        fn.geohash(F.col("lat"), F.col("lon")),
        risk,
        fn.hazard_category(risk, *(F.col(c) for c in ("precipitation", "wind", "gusts", "visibility"))),
    )
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    text = plan(got)
    assert "UDF" not in text and "BatchEval" not in text and "sha2(" in text


def test_registered_sql_functions_run_in_generated_code(spark, sf):
    text = plan(catalog.QUERIES["s09_sql_functions"](spark, sf))
    assert "Python" not in text and "UDF" not in text and "NestedLoop" not in text


def numbered(code):
    value = 0
    for c in code:
        value = value * 32 + GEOHASH_ALPHABET.index(c)
    return value


def cells_of(box, precision):
    """Every cell of a box, by the edges of the cells: the upper edge belongs to a cell."""
    lon_bits, lat_bits = axis_bits(precision)
    axes = []
    for (low, high), span, bits in (((box[2], box[3]), 360.0, lon_bits), ((box[0], box[1]), 180.0, lat_bits)):
        size = span / (1 << bits)
        first, last = (max(0, min((1 << bits) - 1, int(np.ceil(v / size)) + (1 << (bits - 1)) - 1)) for v in (low, high))
        axes.append(range(first, last + 1))
    found = set()
    for lon in axes[0]:
        for lat in axes[1]:
            code = 0
            for nth in range(lon_bits + lat_bits):
                axis, bits = (lon, lon_bits) if nth % 2 == 0 else (lat, lat_bits)
                code = 2 * code + (axis >> (bits - 1 - nth // 2) & 1)
            found.add(code)
    return found


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.floats(-90, 90), min_size=2, max_size=2),
    st.lists(st.floats(-180, 180), min_size=2, max_size=2),
    st.integers(1, 3),
    st.sampled_from([1, 4, 16, 5000]),
)
def test_a_cover_holds_the_box(lats, lons, precision, most):
    box = (*sorted(lats), *sorted(lons))
    ranges = box_cover(*box, precision=precision, most=most)
    assert 1 <= len(ranges) <= most and ranges == sorted(ranges)
    covered = set()
    for low, high in ranges:
        covered |= set(range(numbered(low), numbered(high) + 1))
    wanted = cells_of(box, precision)
    assert wanted <= covered
    if most == 5000 and len(wanted) < 1000:
        assert wanted == covered


def test_a_box_the_wrong_way_round_is_empty(spark):
    assert box_cover(40.0, 39.0, -77.0, -76.0) == [] and box_cover(39.0, 40.0, -76.0, -77.0) == []
    df = spark.createDataFrame([(39.5, -76.5, "dqcj")], "latitude double, longitude double, geohash string")
    assert payloads.bbox_filter(df, BoundingBox(40.0, 39.0, -77.0, -76.0), "geohash").count() == 0


def test_row_groups_between_the_ranges_are_skipped(spark):
    """A box across the meridian: its corners span many codes, its cover few of them."""
    points = [(-60 + i * 1.7, -170 + j * 2.3) for i in range(70) for j in range(140)]
    df = spark.createDataFrame(points, "latitude double, longitude double")
    df = df.withColumn("geohash", fn.geohash(F.col("latitude"), F.col("longitude"))).coalesce(1).sortWithinPartitions("geohash")
    path = shared_dir(spark)
    df.write.option("parquet.block.size", 2048).option("parquet.page.size", 512).parquet(path)
    box = BoundingBox(lamin=10.0, lamax=14.0, lomin=-30.0, lomax=20.0)
    stored = spark.read.parquet(path)
    pruned = payloads.bbox_filter(stored, box, "geohash")
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, payloads.bbox_filter(stored, box).collect())) != []
    assert "GreaterThanOrEqual(geohash," in plan(pruned)
    folder = path.removeprefix("file:")
    file = next(f"{folder}/{n}" for n in os.listdir(folder) if n.endswith(".parquet"))
    about = pq.ParquetFile(file).metadata
    groups = [about.row_group(i).column(2).statistics for i in range(about.num_row_groups)]
    ranges = box_cover(box.lamin, box.lamax, box.lomin, box.lomax)
    read = sum(any(g.min <= high and g.max >= low for low, high in ranges) for g in groups)
    corners = sum(g.min <= ranges[-1][1] and g.max >= ranges[0][0] for g in groups)
    assert len(groups) > 20 and read < 0.5 * corners


def test_requests_are_numbered_in_ranges_of_cells(spark):
    """All cells of precision 8 share their first five characters; no task ranks them all."""
    codes = sorted("dqcjq" + a + b + c for a in "0123456789bc" for b in GEOHASH_ALPHABET for c in "0123456789")
    df = spark.createDataFrame([(g, 1.0, 2.0, k) for g in codes for k in (1, 2)], "geohash string, lat double, lon double, k int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        planned = payloads.weather_request_plan(df, 7, by=("k",))
        rows = planned.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for k in (1, 2):
        ordered = sorted((r["request_no"], r["geohashes"]) for r in rows if r["k"] == k)
        assert [n for n, _ in ordered] == list(range(len(ordered)))
        assert [g for _, chunk in ordered for g in chunk] == codes
    stored = spark.read.parquet(planned.inputFiles()[0].rsplit("/", 1)[0])
    most = max(r["count"] for r in stored.groupBy("_range").count().collect())
    assert most < len(codes)


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_digests_are_streamed_in_blocks(spark, block):
    root = shared_dir(spark).removeprefix("file:")
    os.makedirs(f"{root}/deep")
    contents = {"a.bin": b"0", "b.bin": b"x" * 5000, "deep/c.bin": bytes(range(256)) * 9}
    for name, data in contents.items():
        with open(f"{root}/{name}", "wb") as out:
            out.write(data)
    found = archive.file_digests(spark, root, "*.bin", block)
    got = {r["file_name"]: (r["length"], r["sha256_checksum"]) for r in found.collect()}
    assert got == {n.split("/")[-1]: (len(d), hashlib.sha256(d).hexdigest()) for n, d in contents.items()}
    # No column of contents: a file of any size is a short row.
    assert "content" not in plan(found)


def test_locations_and_stores(spark):
    assert archive.resolved(spark, "/a/b/") == "file:///a/b" and archive.resolved(spark, "file:/a") == "file:///a"
    assert archive.resolved(spark, "s3a://x/y/") == "s3a://x/y"
    settings = spark._jsc.hadoopConfiguration()
    before = settings.get("fs.defaultFS")
    settings.set("fs.defaultFS", "hdfs://name:8020")
    try:
        assert archive.resolved(spark, "/a/b") == "hdfs://name:8020/a/b"
    finally:
        settings.set("fs.defaultFS", before)
    with pytest.raises(ValueError, match="fs.r2.endpoint"):
        archive._opener(spark)("r2://cold/archives")
    settings.set("fs.r2.endpoint", "https://store.example.org")
    try:
        files, path = archive._opener(spark)("r2://cold/archives/x.parquet")
        assert files.type_name == "s3" and path == "cold/archives/x.parquet"
    finally:
        settings.unset("fs.r2.endpoint")
