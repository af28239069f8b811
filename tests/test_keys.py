"""Stored keys in buckets, and ids that a stream remembers by itself."""

import datetime as dt

from helpers import plan, silver_of, silver_row
from pyspark.sql import functions as F

from aerocell.operators import maintenance
from aerocell.schemas import SILVER
from aerocell.session import shared_dir
from aerocell.sources import tables
from aerocell.streaming import pipeline as streams

MAY = [dt.date(2027, 5, d) for d in range(32) if d]


def batch(spark, numbers, day=MAY[0]):
    return silver_of(spark, [silver_row(n, recorded_date=day, last_contact=n) for n in numbers])


def test_stored_keys_are_not_shuffled(spark, database):
    keys = f"{database}.keys"
    maintenance.create_keys(spark, keys, 16)
    for day in MAY[:5]:
        maintenance.add_keys(spark, keys, batch(spark, range(day.day * 100, day.day * 100 + 50), day))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = maintenance.rows_without_key(spark, keys, batch(spark, range(120, 170)), MAY[:1])
        assert sorted(r["last_contact"] for r in left.collect()) == list(range(150, 170))
        text = plan(left, "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    initial = text[text.index("Initial Plan") :] if "Initial Plan" in text else text
    assert initial.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in initial
    below = initial[: initial.index("Bucketed: true")].rsplit("Exchange", 1)
    assert "Scan ExistingRDD" in below[1] or "LocalTableScan" in below[1]
    assert "PartitionFilters: [isnotnull(recorded_date" in initial or "PartitionFilters: [recorded_date" in initial


def test_insert_by_keys_equals_insert_ignore(spark, database):
    table, keys = f"{database}.silver", f"{database}.keys"
    maintenance.create_keys(spark, keys, 8)
    order = ["last_contact"]
    rows = batch(spark, [*range(30), *range(10)])
    assert maintenance.insert_ignore_by_keys(spark, table, keys, rows, order) == 30
    assert maintenance.insert_ignore_by_keys(spark, table, keys, rows, order) == 0
    more = batch(spark, range(20, 40)).union(batch(spark, range(100, 105), MAY[3]))
    assert maintenance.insert_ignore_by_keys(spark, table, keys, more, order) == 15
    assert spark.table(table).count() == 45 == spark.table(keys).distinct().count()
    assert maintenance.insert_ignore_by_keys(spark, table, keys, rows.limit(0), order) == 0


def test_keys_that_a_failure_left_out_are_added(spark, database):
    table, keys = f"{database}.silver", f"{database}.keys"
    maintenance.create_keys(spark, keys, 8)
    tables.write_table(batch(spark, range(12)), table, SILVER)
    maintenance.sync_keys(spark, table, keys, MAY[:1])
    maintenance.sync_keys(spark, table, keys, MAY[:1])
    assert spark.table(keys).count() == 12
    assert maintenance.insert_ignore_by_keys(spark, table, keys, batch(spark, range(14)), ["last_contact"]) == 2


def test_stateful_ids_outlive_a_restart(spark):
    folder, out, checkpoint = shared_dir(spark), shared_dir(spark), shared_dir(spark)
    streams.with_disk_state(spark)
    for numbers in (range(20), range(10, 25), [3]):
        batch(spark, [*numbers, *numbers]).write.mode("append").parquet(folder)
        source = streams.read_files(spark, folder, SILVER.schema)
        first = streams.dedupe_stateful(source)
        streams.start(first.writeStream.format("parquet").option("path", out), checkpoint, once=True).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 25 == got.select("flight_record_id").distinct().count()
    assert got.filter(F.col("recorded_date").isNull()).count() == 0
