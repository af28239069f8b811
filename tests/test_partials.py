"""Partial sums, days replaced at one moment, and batches that fail half-way."""

import datetime as dt

import pytest
from helpers import UTC, plan, silver_of, silver_row
from pyspark.sql import functions as F
from test_streaming import ROW, SHOWN, rows, sink  # noqa: F401

from aerocell.operators import gold, maintenance
from aerocell.plans import catalog, fixtures
from aerocell.schemas import GOLD, SILVER
from aerocell.session import list_folder, materialise
from aerocell.sources import tables
from aerocell.streaming import pipeline as streams

MAY = [dt.date(2027, 5, d) for d in range(32) if d]


def flights(spark, numbers, day=MAY[0], **changes):
    at = dt.datetime(2027, 5, day.day, 5, 40, tzinfo=UTC)
    made = [
        silver_row(n, icao24=f"ac{n % 7}", recorded_date=day, weather_recorded_at=at, velocity_mps=200.0 + n, **changes)
        for n in numbers
    ]
    return silver_of(spark, made)


def test_matrix_of_partial_sums_equals_matrix_of_rows(spark, sf, database):
    """In three parts, also after the sums of past parts have been added up."""
    silver = materialise(fixtures.silver(spark, sf), "silver")
    table = f"{database}.partials"
    tables.create_table(spark, table, gold.PARTIALS)
    for n in range(3):
        part = silver.filter(F.pmod(F.xxhash64("flight_record_id"), F.lit(3)) == n)
        maintenance.add_partials(spark, table, part, "run", n)
    expected = rows(gold.gold_matrix(silver))
    assert rows(maintenance.matrix_of_partials(spark.table(table))) == expected
    before = spark.table(table).count()
    left = maintenance.compact_partials(spark, table, tables.days_of(silver))
    assert left == spark.table(table).count() < before
    assert rows(maintenance.matrix_of_partials(spark.table(table))) == expected
    assert [r[0] for r in spark.table(table).select("iteration_id").distinct().orderBy("iteration_id").collect()] == [None, 2]
    # The last part once more, as after a failure.
    last = silver.filter(F.pmod(F.xxhash64("flight_record_id"), F.lit(3)) == 2)
    maintenance.add_partials(spark, table, last, "run", 2, again=True)
    assert rows(maintenance.matrix_of_partials(spark.table(table))) == expected


def test_refresh_reads_partial_sums_of_the_touched_days_only(spark, database, monkeypatch):
    table, target = f"{database}.partials", f"{database}.gold"
    tables.create_table(spark, table, gold.PARTIALS)
    for day in MAY[:4]:
        maintenance.add_partials(spark, table, flights(spark, range(20), day), "run", day.day)
    plans = []
    swap = maintenance.swap_days
    monkeypatch.setattr(maintenance, "swap_days", lambda df, *a: (plans.append(plan(df)), swap(df, *a))[1])
    seen = []
    matrix = maintenance.matrix_of_partials
    monkeypatch.setattr(maintenance, "matrix_of_partials", lambda df: (seen.append(plan(df)), matrix(df))[1])
    assert maintenance.refresh_touched(spark, table, target, flights(spark, [50], MAY[1])) == 1
    assert len(seen) == 1 and "/partials" in seen[0] and "/silver" not in seen[0] + plans[0]
    assert [line for line in seen[0].splitlines() if line.startswith("PartitionFilters: [") and "recorded_date" in line]
    assert [r["recorded_date"] for r in spark.table(target).collect()] == [MAY[1]]


def test_a_reader_has_the_old_day_or_the_new_one(spark, database):
    table = f"{database}.gold"
    old = gold.gold_matrix(flights(spark, range(5)))
    tables.write_table(old, table, GOLD)
    reader = spark.table(table)
    assert reader.count() == 1
    # Read while the new day is written: still the old one, and again after the swap.
    seen = []
    point = tables.point_days

    def watched(*args):
        seen.append(spark.table(table).collect())
        point(*args)

    new = gold.gold_matrix(flights(spark, range(9)).union(flights(spark, [1], MAY[1])))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tables, "point_days", watched)
        assert maintenance.upsert_gold(spark, table, new) == 2
    assert [r["total_active_flights"] for r in seen[0]] == [5]
    assert sorted(r["total_active_flights"] for r in spark.table(table).collect()) == [1, 7]
    # A scan that began before the swap still finds its files.
    assert reader.first()["total_active_flights"] in (5, 7)


def test_a_failed_write_leaves_the_old_day(spark, database):
    table = f"{database}.gold"
    tables.write_table(gold.gold_matrix(flights(spark, range(5))), table, GOLD)
    broken = gold.gold_matrix(flights(spark, range(9))).withColumn(
        "avg_velocity_mps", F.raise_error(F.lit("lost")).cast("double")
    )
    with pytest.raises(Exception, match="lost"):
        tables.swap_days(broken, table, GOLD)
    assert [r["total_active_flights"] for r in spark.table(table).collect()] == [5]


def test_replaced_folders_go_and_later_rows_stay_apart(spark, database):
    table = f"{database}.silver"
    for count in (3, 5):
        tables.swap_days(flights(spark, range(count)), table, SILVER)
    tables.write_table(flights(spark, [77]), table, SILVER)
    assert spark.table(table).count() == 6
    assert tables.vacuum_days(spark, table, SILVER, grace=3600) == 0
    assert tables.vacuum_days(spark, table, SILVER, grace=-10) == 1
    assert spark.table(table).count() == 6
    # A day that began in its first folder, was swapped and then dropped: no old row comes back.
    other = MAY[3]
    tables.write_table(flights(spark, range(4), other), table, SILVER)
    tables.swap_days(flights(spark, range(2), other), table, SILVER)
    assert maintenance.delete_partition(spark, table, other) == 2
    tables.write_table(flights(spark, [9], other), table, SILVER)
    assert tables.read_partition(spark, table, other).count() == 1
    root = tables.table_folder(spark, table)
    assert [f for f, _, _ in list_folder(spark, root) if f.endswith(f"recorded_date={other}")]


FAILURES = ["write_table", "add_partials", "refresh_touched", "_store_rejected", "_store_metrics"]


@pytest.mark.parametrize("step", FAILURES)
def test_a_batch_that_failed_anywhere_is_stored_once(spark, sf, sink, step):  # noqa: F811
    raw = fixtures.with_bad_clocks(fixtures.flights_raw(spark, sf)).filter("event_id % 4 = 1")
    weather = materialise(fixtures.weather(spark, sf), "weather")

    def fail(*args, **kwargs):
        raise RuntimeError("executor lost")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(streams, step, fail)
        with pytest.raises(RuntimeError, match="executor lost"):
            streams.process_batch(raw, 0, weather, sink, order=ROW)
    metrics = streams.process_batch(raw, 0, weather, sink, order=ROW)
    stored = spark.table(sink.silver)
    assert metrics["records_committed"] == stored.count() == stored.select("flight_record_id").distinct().count() > 0
    assert [m["records_committed"] for m in spark.table(sink.metrics).collect()] == [stored.count()]
    assert spark.table(sink.quarantine).count() == metrics["quarantined_flights"]
    assert rows(spark.table(sink.gold)) == rows(gold.gold_matrix(stored))
    assert not [t.name for t in spark.catalog.listTables(sink.silver.split(".")[0]) if t.name.startswith("pending")]


def test_one_late_report_does_not_widen_the_other_days(spark, database):
    spans = {MAY[0]: (0, 10), MAY[9]: (500, 600)}
    text = plan(maintenance.known_keys(spark, f"{database}.silver", spans))
    assert "PartitionFilters: [recorded_date" in text and "GreaterThanOrEqual(time_position,500)" in text.replace(" ", "")
    hours = [(MAY[0], 3), (MAY[0], 5), (MAY[9], 7)]
    assert streams.spans_of(hours) == {MAY[0]: (10800, 21599), MAY[9]: (25200, 28799)}


@pytest.mark.parametrize("name", ["j01_enrich", "j01_enrich_many_readings", "a01_gold_matrix"])
def test_weather_is_made_unique_once_and_without_sorted_aggregates(spark, sf, name):
    text = plan(catalog.QUERIES[name](spark, sf), "simple")
    assert "SortAggregate" not in text and text.count("o_orderkey") > 0
    assert text.count("WindowGroupLimit [cycle_id" if "many" not in name else "WindowGroupLimit [geohash") <= 2


def test_a_dry_run_leaves_the_offsets(spark, sf, sink):  # noqa: F811
    source, checkpoint = catalog._event_stream(spark, sf), catalog.shared_dir(spark)
    weather = materialise(fixtures.weather(spark, sf), "weather")
    for dry in (True, False):
        streams.run_stream(source, weather, sink, checkpoint, order=ROW, dry_run=dry).awaitTermination()
        assert (spark.table(sink.silver).count() == 0) == dry
    assert spark.table(sink.metrics).first()["run_id"] == checkpoint
