import datetime as dt
import hashlib
import json
import os

import pytest
from helpers import UTC, plan, silver_of, silver_row
from pyspark.sql import functions as F

from aerocell.schemas import BOXES, SILVER, SILVER_SCHEMA, BoundingBox
from aerocell.session import shared_dir
from aerocell.sources import archive, payloads, tables


def vector(**changes):
    base = dict(
        icao24=" 4CA9D1", callsign="EIN4K  ", country="Ireland", time=100, contact=103, lon=-6.1, lat=53.5,
        alt=8230.0, ground=False, speed=198.3, track=271.0, rate=-2.6, sensors=[7], geo=8410.0, squawk="6315",
        spi=False, source=2,
    )
    base.update(changes)
    return list(base.values())


def parse(spark, *documents):
    df = spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in documents], "payload string")
    return payloads.normalise_flights(payloads.parse_state_payload(df, now=F.lit(7).cast("bigint")))


def test_state_payload_keeps_usable_vectors(spark):
    document = {"time": 500, "states": [vector(), vector(lon=None), ["ab", "cd"], vector(time=None, contact=None)]}
    rows = parse(spark, document).collect()
    assert len(rows) == 2
    first = next(r for r in rows if r["time_position"] == 100)
    assert (first["icao24"], first["callsign"], first["geo_altitude_m"]) == ("4ca9d1", "EIN4K", 8410.0)
    late = next(r for r in rows if r["time_position"] == 500)
    assert late["last_contact"] == 500


def test_state_payload_defaults_and_empty_documents(spark):
    row = vector(callsign=None, country=None, alt=None, ground=None, squawk=None, spi=None, source=None, speed=None)
    got = parse(spark, {"states": [row]}, {"time": 1, "states": None}, {"time": 1}, "not json").collect()
    assert len(got) == 1
    r = got[0]
    assert (r["origin_country"], r["on_ground"], r["spi"], r["position_source"]) == ("Unknown", False, False, 0)
    assert r["callsign"] is r["squawk"] is r["velocity_mps"] is r["baro_altitude_m"] is None
    assert r["server_time"] == 7


def test_unreadable_fields_are_named(spark):
    row = parse(spark, {"time": 1, "states": [vector(speed="fast", time="soon")]}).first()
    assert row["cast_errors"] == "time_position,velocity_mps"


def test_weather_payload_pairs_by_position(spark):
    current = {"time": "2027-05-19T16:00", "temperature_2m": 18.5, "relative_humidity_2m": 65, "visibility": 9000}
    data = [
        (json.dumps([{"current": current}, {"current": {}}, {"current": current}]), ["dr5r", "dr72"]),
        (json.dumps({"current": {**current, "time": "2027-05-19T16:00+05:00"}}), ["gcps"]),
        (json.dumps([{}]), ["u0"]),
        ("[]", ["u1"]),
        ("oops", ["u2"]),
    ]
    df = spark.createDataFrame(data, "payload string, geohashes array<string>")
    now = dt.datetime(2030, 1, 1, tzinfo=UTC)
    rows = {r["geohash"]: r for r in payloads.parse_weather_payload(df, now=F.lit(now)).collect()}
    assert set(rows) == {"dr5r", "dr72", "gcps", "u0"}
    sixteen = dt.datetime(2027, 5, 19, 16)
    assert rows["dr5r"]["weather_recorded_at"] == sixteen and rows["dr5r"]["relative_humidity_pct"] == 65.0
    assert rows["gcps"]["weather_recorded_at"] == sixteen
    assert rows["dr72"]["weather_recorded_at"] == rows["u0"]["weather_recorded_at"] == now.replace(tzinfo=None)
    assert rows["dr72"]["temperature_c"] is None


@pytest.mark.parametrize("chunk,expected", [(2, [2, 2, 1]), (5, [5]), (50, [5])])
def test_request_plan_chunks(spark, chunk, expected):
    cells = [("dr5r", 40.69, -73.9), ("dr5q", 40.5, -74.1), ("gcps", 51.4, -0.5), ("u000", 0.1, 0.2), ("dr72", 41.0, -73.0)]
    df = spark.createDataFrame(cells, "geohash string, lat double, lon double")
    rows = payloads.weather_request_plan(df, chunk).orderBy("request_no").collect()
    assert [r["cells"] for r in rows] == expected
    assert [g for r in rows for g in r["geohashes"]] == sorted(c[0] for c in cells)
    assert rows[0]["latitude"].split(",")[0] == "40.5000"


def test_request_plan_numbers_across_prefixes(spark):
    codes = [a + b + c for a in "bcd" for b in "0123456789" for c in "0123456789"]
    df = spark.createDataFrame([(g, 1.0, 2.0, k) for g in codes for k in (1, 2)], "geohash string, lat double, lon double, k int")
    rows = payloads.weather_request_plan(df, 7, by=("k",)).collect()
    for k in (1, 2):
        ordered = sorted((r["request_no"], r["geohashes"]) for r in rows if r["k"] == k)
        assert [g for _, chunk in ordered for g in chunk] == sorted(codes)
        assert all(len(chunk) == 7 for _, chunk in ordered[:-1])


def test_bounding_boxes(spark):
    df = spark.createDataFrame([(38.0, -79.0), (45.0, -71.0), (37.9, -75.0), (50.0, 3.0)], "latitude double, longitude double")
    count = lambda box: payloads.bbox_filter(df, box).count()
    assert count(BOXES["us_northeast_corridor"]) == 2
    assert count(BOXES["europe_central"]) == 1
    assert count(BOXES["global_unbounded"]) == 4
    assert count(BoundingBox(lamin=40.0, lamax=51.0, lomin=0.0)) == 2


def test_box_implies_a_range_of_codes_at_the_scan(spark, database):
    from aerocell import functions as fn

    table = f"{database}.silver"
    points = [(38 + i * 0.1, -79 + j * 0.1) for i in range(60) for j in range(60)]
    rows = [silver_row(n, latitude=a, longitude=b, geohash=None) for n, (a, b) in enumerate(points)]
    df = silver_of(spark, rows).withColumn("geohash", fn.geohash(F.col("latitude"), F.col("longitude")))
    tables.write_table(df, table, SILVER)
    box = BoundingBox(39.0, 40.0, -77.5, -76.0)
    narrowed = payloads.bbox_filter(spark.table(table), box, geohash_col="geohash")
    assert narrowed.count() == payloads.bbox_filter(df, box).count() > 0
    text = plan(narrowed)
    assert "GreaterThanOrEqual(geohash," in text and "LessThanOrEqual(geohash," in text


def test_json_append_keeps_duplicates_and_drops_unknown_fields(spark, database):
    path, table = shared_dir(spark), f"{database}.silver"
    os.makedirs(path)
    record = {**silver_row(1), "ingested_at": "2027-05-19T16:00:00Z", "recorded_date": "2027-05-19", "extra": 1}
    record["weather_recorded_at"] = None
    with open(f"{path}/a.json", "w") as out:
        out.write(json.dumps(record) + "\n" + json.dumps(record) + "\n")
    assert tables.append_silver(spark, path, table) == 2
    assert tables.append_silver(spark, path, table) == 2
    assert spark.table(table).count() == 4
    assert set(spark.table(table).columns) == set(SILVER_SCHEMA.names)
    empty = shared_dir(spark)
    os.makedirs(empty)
    open(f"{empty}/b.json", "w").close()
    assert tables.append_silver(spark, empty, table) == 0


def test_partition_read_scans_one_day(spark, database):
    days = [dt.date(2027, 5, d) for d in (7, 8, 9)]
    rows = [silver_row(n, recorded_date=days[n % 3]) for n in range(30)]
    tables.write_table(silver_of(spark, rows), f"{database}.silver", SILVER)
    df = tables.read_partition(spark, f"{database}.silver", days[1])
    assert df.count() == 10
    text = plan(df)
    assert "PartitionFilters: [isnotnull(recorded_date" in text and "2027-05-08" in text
    assert [r[0] for r in tables.partition_days(spark, f"{database}.silver").orderBy("recorded_date").collect()] == days


def test_layout_sorts_each_file_and_splits_a_hot_day(spark):
    rows = spark.range(200_000).select(F.concat(F.lit("id"), "id").alias("flight_record_id"))
    for field in SILVER_SCHEMA:
        if field.name == "geohash":
            value = F.substring(F.sha2("flight_record_id", 256), 1, 4)
        elif field.name == "recorded_date":
            # Nearly everything on one day.
            value = F.when(F.rand(1) < 0.95, F.lit(dt.date(2027, 5, 19))).otherwise(F.lit(dt.date(2027, 5, 20)))
        elif field.name == "flight_record_id":
            continue
        else:
            value = F.lit(None).cast(field.dataType)
        rows = rows.withColumn(field.name, value)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        out = shared_dir(spark)
        tables.laid_out(rows, SILVER).write.parquet(out)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = [f for f in os.listdir(out) if f.endswith(".parquet")]
    sizes = [r["n"] for r in spark.read.parquet(out).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(files) > 4 and max(sizes) < 100_000 and sum(sizes) == 200_000
    one = spark.read.parquet(f"{out}/{files[0]}").select("recorded_date", "geohash").collect()
    assert [tuple(r) for r in one] == sorted(tuple(r) for r in one)


def test_parameterised_sql(spark):
    df = silver_of(spark, [silver_row(1, convective_risk_score=60.0), silver_row(2)])
    rows = tables.query(spark, "SELECT flight_record_id FROM s WHERE convective_risk_score >= :r", {"r": 50}, s=df)
    assert [r[0] for r in rows.collect()] == ["id1"]


def test_export_round_trip_and_empty_input(spark):
    path = shared_dir(spark)
    df = silver_of(spark, [silver_row(n) for n in range(1000)]).coalesce(1)
    archive.export_parquet(df, path, SILVER.cluster)
    assert spark.read.parquet(path).count() == 1000
    artifact = archive.export_artifact(spark, path).first()
    assert artifact["record_count"] == 1000 and len(artifact["sha256_checksum"]) == 64
    assert artifact["compression_ratio"] > 1
    import pyarrow.parquet as pq

    name = next(f for f in os.listdir(path) if f.endswith(".parquet"))
    column = pq.ParquetFile(f"{path}/{name}").metadata.row_group(0).column(0)
    assert column.compression == "ZSTD"
    with pytest.raises(ValueError):
        archive.export_parquet(df.limit(0), shared_dir(spark))


def test_file_digest_known_value(spark):
    path = shared_dir(spark)
    os.makedirs(path)
    content = b"deterministic_data_block_for_checksum_test"
    for name in ("a.parquet", "b.parquet"):
        with open(f"{path}/{name}", "wb") as out:
            out.write(content)
    rows = archive.file_digests(spark, path).collect()
    assert {r["sha256_checksum"] for r in rows} == {"a589b4bc2ba588af3245907effe9c83f04a3871dde5fa6cb70401ed1e6571148"}
    assert {r["length"] for r in rows} == {len(content)}
    # Two levels: lines of one part, then the parts.
    digest = hashlib.sha256(content).hexdigest()
    part = hashlib.sha256(f"a.parquet:{digest}\nb.parquet:{digest}".encode()).hexdigest()
    whole = hashlib.sha256(f"{digest[:2]}:{part}".encode()).hexdigest()
    total = archive.partition_digest(archive.file_digests(spark, path)).first()
    assert (total["files"], total["sha256_checksum"]) == (2, whole)


def test_restore_copies_only_absent_files(spark):
    root = shared_dir(spark)
    df = spark.range(100).withColumn("d", F.col("id") % 4)
    df.write.partitionBy("d").parquet(f"{root}/cold")
    first = archive.restore_archives(spark, f"{root}/cold", f"{root}/local")
    assert first["files"] == archive.list_files(spark, f"{root}/cold").count() > 0
    assert archive.restore_archives(spark, f"{root}/cold", f"{root}/local")["files"] == 0
    assert spark.read.parquet(f"{root}/local").count() == 100
    digests = lambda p: {(r["file_name"], r["sha256_checksum"]) for r in archive.file_digests(spark, p).collect()}
    assert digests(f"{root}/cold") == digests(f"{root}/local")
