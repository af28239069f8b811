import os

import pytest
from pyspark.sql import functions as F

from aerocell.operators.gold import gold_matrix
from aerocell.plans import catalog, fixtures
from aerocell.schemas import GOLD_SCHEMA
from aerocell.session import materialise, shared_dir
from aerocell.streaming import pipeline as streams

SHOWN = [n for n in GOLD_SCHEMA.names if n != "computed_at"]
ROW = ("event_id", "copy")


def rows(df):
    return sorted(tuple(r) for r in df.select(*SHOWN).collect())


@pytest.fixture
def sink(spark, database):
    return streams.Sink.in_database(spark, database)


@pytest.fixture(scope="module")
def expected(spark, sf):
    return rows(fixtures.gold(spark, sf))


def arrivals(spark, sf, start, parts=3):
    """Run a stream after each part of the events has arrived; every part spans all days."""
    folder, checkpoint = shared_dir(spark), shared_dir(spark)
    for n in range(parts):
        fixtures.events(spark, sf).filter(F.col("event_id") % parts == n).write.mode("append").parquet(folder)
        source = fixtures.flights_from(streams.read_files(spark, folder, fixtures.EVENTS))
        start(source, checkpoint).awaitTermination()
    return source, checkpoint


def test_micro_batches_equal_one_batch(spark, sf, sink, expected):
    """Batches arrive out of order; days are touched again and again."""
    weather = materialise(fixtures.weather(spark, sf))

    def start(source, checkpoint):
        return streams.run_stream(source, weather, sink, checkpoint, order=ROW)

    source, checkpoint = arrivals(spark, sf, start)
    stored = spark.table(sink.silver)
    assert stored.count() == stored.select("flight_record_id").distinct().count()
    metrics = spark.table(sink.metrics).collect()
    assert len(metrics) == 3 and {m["run_id"] for m in metrics} == {checkpoint}
    assert sum(m["records_committed"] for m in metrics) == stored.count()
    assert all(m["raw_flights"] == m["valid_flights"] + m["quarantined_flights"] for m in metrics)
    assert spark.table(sink.quarantine).count() == sum(m["quarantined_flights"] for m in metrics)
    got = rows(spark.table(sink.gold))
    # Which copy of a record came first depends on the arrival order, the keys do not.
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert not [t for t in spark.catalog.listTables(sink.silver.split(".")[0]) if t.name.startswith("staged")]
    # Starting again from the same checkpoint finds nothing new.
    start(source, checkpoint).awaitTermination()
    assert rows(spark.table(sink.gold)) == got and spark.table(sink.metrics).count() == 3


def test_replayed_batch_changes_nothing(spark, sf, sink, expected):
    raw, weather = fixtures.flights_raw(spark, sf), materialise(fixtures.weather(spark, sf))
    for _ in range(2):
        streams.process_batch(raw, 0, weather, sink, order=ROW)
        assert rows(spark.table(sink.gold)) == expected
    assert spark.table(sink.silver).count() == fixtures.silver(spark, sf).count()
    assert spark.table(sink.metrics).count() == 1


def test_empty_batch_writes_nothing(spark, sf, sink):
    raw, weather = fixtures.flights_raw(spark, sf), fixtures.weather(spark, sf)
    streams.process_batch(raw.limit(0), 0, weather, sink)
    assert spark.table(sink.silver).count() == spark.table(sink.metrics).count() == 0


def test_late_rows_refresh_their_own_day(spark, sf, sink):
    """Rows for yesterday that arrive after midnight still reach the matrix."""
    raw, weather = fixtures.flights_raw(spark, sf), materialise(fixtures.weather(spark, sf))
    raw = raw.filter(F.col("server_time") < F.lit(1704326400))
    late = F.col("event_id") % 2 == 0
    streams.process_batch(raw.filter(~late), 0, weather, sink, order=ROW)
    streams.process_batch(raw.filter(late), 1, weather, sink, order=ROW)
    everything = gold_matrix(spark.table(sink.silver))
    assert rows(spark.table(sink.gold)) == rows(everything)


def test_bad_clocks_are_quarantined_and_the_rest_is_stored(spark, sf, sink):
    raw = fixtures.flights_raw(spark, sf).limit(200)
    times = F.when(F.col("event_id") % 2 == 0, F.col("server_time") * 1_000_000_000).otherwise(F.col("time_position"))
    metrics = streams.process_batch(raw.withColumn("time_position", times), 0, fixtures.weather(spark, sf), sink, order=ROW)
    assert metrics["quarantined_flights"] > 50 and metrics["records_committed"] > 50
    reasons = spark.table(sink.quarantine).filter("rejection_reasons LIKE '%time_position_range%'").count()
    assert reasons > 50 and spark.table(sink.silver).count() == metrics["records_committed"]


def test_dry_run_counts_and_writes_nothing(spark, sf, sink):
    raw, weather = fixtures.flights_raw(spark, sf), fixtures.weather(spark, sf)
    metrics = streams.process_batch(raw, 7, weather, sink, order=ROW, dry_run=True)
    assert metrics["valid_flights"] > 0 and metrics["iteration_id"] == 7 and metrics["duration_seconds"] > 0
    for table in (sink.silver, sink.gold, sink.metrics, sink.quarantine):
        assert spark.table(table).count() == 0


def test_payload_texts_reach_the_matrix(spark, sf, sink):
    """Responses as text files on one side, weather of each batch by a function on the other."""
    folder = shared_dir(spark)
    fixtures.state_payloads(spark, sf).write.text(folder)
    texts = spark.readStream.text(folder).withColumnRenamed("value", "payload")
    readings = materialise(fixtures.weather(spark, sf))
    asked = []

    def weather(session, batch_id):
        asked.append(batch_id)
        return readings

    query = streams.run_stream(streams.reports_of(texts), weather, sink, shared_dir(spark), order=("longitude", "latitude"))
    query.awaitTermination()
    stored = spark.table(sink.silver)
    assert asked and stored.count() > 500
    assert rows(spark.table(sink.gold)) == rows(gold_matrix(stored))


def test_a_run_does_not_overwrite_another(spark, sf, sink):
    raw, weather = fixtures.flights_raw(spark, sf).limit(50), materialise(fixtures.weather(spark, sf))
    for run in ("first", "second", "first"):
        streams.process_batch(raw, 0, weather, sink, order=ROW, run_id=run)
    committed = {m["run_id"]: m["records_committed"] for m in spark.table(sink.metrics).collect()}
    assert committed["first"] > 0 and committed["second"] == 0 and len(committed) == 2


def test_quarantine_and_alert_streams(spark, sf):
    source = catalog._event_stream(spark, sf)
    rejected = catalog._to_files(streams.quarantine_stream(source))
    assert rejected.count() > 0 and rejected.filter(F.size("rejection_reasons") == 0).count() == 0
    alerts = catalog._to_files(streams.alerts_stream(catalog._stream_silver(spark, sf)))
    assert alerts.filter("convective_risk_score < 50").count() == 0 and alerts.count() > 0


def test_checkpoints_live_in_the_shared_folder(spark):
    assert not os.path.exists(shared_dir(spark))
