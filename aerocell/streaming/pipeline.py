"""Structured Streaming: the micro-batch pipeline and the continuous operators.

Nothing here drops a late row: ids are remembered by the stored table, not by a
watermark, and a matrix cell is rebuilt from the table whenever a row of it
arrives, however late.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from aerocell import functions as fn
from aerocell.functions.numeric import nan_to_null
from aerocell.operators.contracts import FLIGHT_CONTRACT
from aerocell.operators.enrich import enrich, first_per_key, tag_flights
from aerocell.operators.gold import PARTIALS
from aerocell.operators.maintenance import add_partials, database_of, fresh_rows, insert_ignore, refresh_touched
from aerocell.operators.reports import METRIC_NAMES, hazard_alerts
from aerocell.plans.pipeline import checked_flights, located
from aerocell.schemas import (
    FLIGHT_SCHEMA,
    IMPACT_RISK,
    POLL_SECONDS,
    REPORT_DAYS,
    SILVER,
    WEATHER_MEASURES,
    TableSpec,
)
from aerocell.session import remove_folder, shared_dir, staged
from aerocell.sources.payloads import normalise_flights, parse_state_payload
from aerocell.sources.tables import create_table, write_table

# A run is one start of a stream, an iteration one of its micro-batches.
METRICS = TableSpec(
    T.StructType(
        [T.StructField(n, T.LongType()) for n in (*METRIC_NAMES, "quarantined_flights")]
        + [
            T.StructField("status", T.StringType()),
            T.StructField("run_id", T.StringType()),
            T.StructField("iteration_id", T.LongType()),
            T.StructField("duration_seconds", T.DoubleType()),
            T.StructField("run_date", T.DateType()),
        ]
    ),
    "run_date",
    ("run_id", "iteration_id"),
)
QUARANTINE = TableSpec(
    T.StructType(
        [T.StructField(f.name, f.dataType) for f in FLIGHT_SCHEMA]
        + [
            T.StructField("rejection_reasons", T.StringType()),
            T.StructField("run_id", T.StringType()),
            T.StructField("iteration_id", T.LongType()),
            T.StructField("run_date", T.DateType()),
        ]
    ),
    "run_date",
    ("run_id", "iteration_id"),
)

# Weather of a batch: a frame, the name of a table read anew for every batch, or
# a function of the session and the batch number.
Weather = DataFrame | str | Callable[[SparkSession, int], DataFrame]


@dataclass(frozen=True)
class Sink:
    """Tables a run writes to."""

    silver: str
    gold: str
    metrics: str
    quarantine: str
    partials: str

    @staticmethod
    def in_database(spark: SparkSession, database: str) -> Sink:
        create_table(spark, f"{database}.metrics", METRICS)
        create_table(spark, f"{database}.quarantine", QUARANTINE)
        create_table(spark, f"{database}.partials", PARTIALS)
        return Sink(*(f"{database}.{name}" for name in ("silver", "gold", "metrics", "quarantine", "partials")))


def read_files(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None
) -> DataFrame:
    """Parquet files as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def start(writer: DataStreamWriter, checkpoint: str, once: bool, interval: int = POLL_SECONDS) -> StreamingQuery:
    """Start a sink: everything available now, or a micro-batch per interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval} seconds").start()


# --- one micro-batch -----------------------------------------------------------
def weather_now(spark: SparkSession, weather: Weather, batch_id: int) -> DataFrame:
    """The weather as it is when the batch runs."""
    if isinstance(weather, str):
        spark.catalog.refreshTable(weather)
        return spark.table(weather)
    return weather(spark, batch_id) if callable(weather) else weather


def _of_batch(spark: SparkSession, table: str, run_id: str, batch_id: int, since: dt.date) -> DataFrame:
    """What a batch has stored, of the days on which it can have run."""
    same = (F.col("run_id") == run_id) & (F.col("iteration_id") == batch_id)
    return spark.table(table).filter(same & (F.col("run_date") >= F.lit(since)))


def _pending_name(sink: Sink, run_id: str) -> str:
    return f"{database_of(sink.silver)}.pending_{hashlib.md5(run_id.encode()).hexdigest()[:16]}"


def spans_of(hours: list) -> dict[dt.date, tuple[int, int]]:
    """Of each day the seconds from its first to its last hour, from ``(day, hour since 1970)`` pairs."""
    spans: dict[dt.date, tuple[int, int]] = {}
    for day, hour in hours:
        low, high = spans.get(day, (hour * 3600, hour * 3600))
        spans[day] = (min(low, hour * 3600), max(high, hour * 3600 + 3599))
    return spans


@dataclass
class Pending:
    """The new rows of a batch, written down before any table takes them.

    They outlive a failure, so a repeated batch stores the same rows under the
    same number and date, and knows what the failed one had committed.
    """

    table: str
    run_date: dt.date
    days: list[dt.date]
    rows: int
    again: bool

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)


def _pending_of(spark: SparkSession, name: str, batch_id: int) -> Pending | None:
    """What a failed run of this batch has left."""
    table = f"{name}_{batch_id}"
    if not spark.catalog.tableExists(table):
        return None
    seen = spark.table(table).agg(F.collect_set("recorded_date").alias("days"), F.count(F.lit(1)).alias("n")).first()
    run_date = spark.sql(f"SHOW TBLPROPERTIES {table} ('run_date')").first()["value"]
    return Pending(table, dt.date.fromisoformat(run_date), sorted(seen["days"]), seen["n"], True)


def _write_pending(spark: SparkSession, name: str, batch_id: int, fresh: DataFrame) -> Pending:
    """Write the rows to a folder, and only then make them a table: there is a whole one or none."""
    table, today = f"{name}_{batch_id}", dt.datetime.now(dt.timezone.utc).date()
    folder, seen = shared_dir(spark), Observation()
    rows = fresh.observe(seen, F.collect_set("recorded_date").alias("days"), F.count(F.lit(1)).alias("n"))
    rows.write.parquet(folder)
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{folder}' TBLPROPERTIES ('run_date' = '{today}')")
    return Pending(table, today, sorted(seen.get["days"]), seen.get["n"], False)


def _drop_pending(spark: SparkSession, pending: Pending) -> None:
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {pending.table}").filter("col_name = 'Location'").first()
    spark.sql(f"DROP TABLE IF EXISTS {pending.table}")
    remove_folder(spark, about["data_type"])


def _store(spark: SparkSession, sink: Sink, pending: Pending, run_id: str, batch_id: int) -> None:
    """Bring the new rows into the tables. Every step can be repeated: what is there already is left or replaced."""
    if not pending.rows:
        return
    fresh = pending.read(spark)
    if pending.again:
        insert_ignore(spark, sink.silver, fresh, stored=True)
    else:
        write_table(fresh, sink.silver, SILVER)
    add_partials(spark, sink.partials, fresh, run_id, batch_id, again=pending.again)
    refresh_touched(spark, sink.partials, sink.gold, fresh, pending.days)


def process_batch(
    raw: DataFrame,
    batch_id: int,
    weather: Weather,
    sink: Sink,
    keys: tuple[str, ...] = ("cycle_id", "geohash"),
    order: tuple[str, ...] = (),
    run_id: str = "",
    dry_run: bool = False,
) -> dict:
    """Validate, bin, enrich and store one micro-batch, then refresh the hours and cells it touches.

    The source is read once, the weather is looked up once per cell, and the
    numbers of reports are taken while they are written. The new rows are
    written down before any table takes them, so a batch that is repeated after
    a failure anywhere adds no row twice, reports what it had committed, and
    keeps its first metrics row. Rejected reports go to the quarantine with
    their reasons. An empty batch stores nothing and returns the status
    ``SKIPPED_EMPTY_FLIGHTS``. ``order`` names the columns that decide which
    copy of a record comes first. A ``dry_run`` counts all stages and writes
    nothing but what is removed at the end. Returns the metrics.
    """
    spark, started = raw.sparkSession, time.monotonic()
    database, name = database_of(sink.silver), _pending_name(sink, run_id)
    checked = FLIGHT_CONTRACT.check(normalise_flights(located(raw)))
    own = F.size("rejection_reasons") == 0
    hour = F.when(own, F.struct(fn.recorded_date(F.col("time_position")).alias("day"), F.floor(F.col("time_position") / 3600).alias("hour")))
    # At most 24 values per calendar day of valid reports.
    seen = (F.count(F.lit(1)).alias("raw"), F.count_if(own).alias("valid"), F.collect_set(hour).alias("hours"))
    with staged(checked, database, *seen) as (reports, found):
        metrics = dict.fromkeys(METRIC_NAMES, 0) | {"raw_flights": found["raw"], "valid_flights": found["valid"]}
        since = dt.datetime.now(dt.timezone.utc).date()
        if found["raw"]:
            spans = spans_of(found["hours"])
            flights = tag_flights(FLIGHT_CONTRACT.typed(reports))
            cells = flights.select(*{*keys, "geohash"}).distinct()
            cells = observed_cells(cells, weather_now(spark, weather, batch_id), keys)
            with staged(cells, database) as weather_of:
                about = weather_of.agg(
                    F.countDistinct("geohash").alias("unique_weather_grids"),
                    F.countDistinct("geohash", "weather_recorded_at").alias("weather_observations"),
                ).first()
                metrics |= about.asDict()
                metrics["silver_records_produced"] = found["valid"]
                if not dry_run:
                    pending = _pending_of(spark, name, batch_id)
                    if pending is None:
                        rows = fresh_rows(spark, sink.silver, flights, spans, order or ("ingested_at",))
                        rows = enrich(rows, weather_of, keys, weather_order=())
                        pending = _write_pending(spark, name, batch_id, rows)
                    _store(spark, sink, pending, run_id, batch_id)
                    since = pending.run_date
                    if found["raw"] > found["valid"]:
                        _store_rejected(spark, reports, sink, run_id, batch_id, pending)
                    metrics["records_committed"] = pending.rows
        metrics |= {
            "quarantined_flights": found["raw"] - found["valid"],
            "status": "SUCCESS" if found["raw"] else "SKIPPED_EMPTY_FLIGHTS",
            "run_id": run_id,
            "iteration_id": batch_id,
            "duration_seconds": round(time.monotonic() - started, 3),
            "run_date": since,
        }
        if found["raw"] and not dry_run:
            _store_metrics(spark, sink, metrics)
            _drop_pending(spark, pending)
    return metrics


def observed_cells(cells: DataFrame, weather: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The cells of a batch, each with its last weather where there is any: one lookup per cell, not per report."""
    names = [c for c in WEATHER_MEASURES if c in weather.columns]
    asked = cells.select(*keys).distinct()
    near = weather.select(*keys, *names).join(asked, list(keys), "left_semi")
    newest = sorted(names, key=lambda n: n != "weather_recorded_at")
    last = first_per_key(nan_to_null(near), list(keys), [F.desc(n) for n in newest])
    return cells.join(last, list(keys), "left")


def _store_metrics(spark: SparkSession, sink: Sink, metrics: dict) -> None:
    """The metrics of a batch, unless it has some: a batch can be repeated for days, so its last days are looked through."""
    since = metrics["run_date"] - dt.timedelta(days=REPORT_DAYS)
    if _of_batch(spark, sink.metrics, metrics["run_id"], metrics["iteration_id"], since).isEmpty():
        write_table(spark.createDataFrame([metrics], METRICS.schema), sink.metrics, METRICS)


def _store_rejected(
    spark: SparkSession, reports: DataFrame, sink: Sink, run_id: str, batch_id: int, pending: Pending
) -> None:
    """Rejected reports with their reasons, once per run and iteration."""
    since = pending.run_date - dt.timedelta(days=REPORT_DAYS)
    if not _of_batch(spark, sink.quarantine, run_id, batch_id, since).isEmpty():
        return
    rejected = reports.filter(F.size("rejection_reasons") > 0)
    named = rejected.withColumns(
        {
            "rejection_reasons": F.array_join("rejection_reasons", ","),
            "run_id": F.lit(run_id),
            "iteration_id": F.lit(batch_id).cast("bigint"),
            "run_date": F.lit(pending.run_date),
        }
    )
    write_table(named, sink.quarantine, QUARANTINE)


def run_stream(
    reports: DataFrame,
    weather: Weather,
    sink: Sink,
    checkpoint: str,
    once: bool = True,
    interval: int = POLL_SECONDS,
    order: tuple[str, ...] = (),
    run_id: str | None = None,
    dry_run: bool = False,
) -> StreamingQuery:
    """The whole pipeline on a stream of raw reports.

    A ``run_id`` names the metrics of one checkpoint; by default it is the
    checkpoint's folder, so that a restart goes on with the same run. A
    ``dry_run`` keeps its offsets in a folder of its own, so it goes through
    all there is and the next real run still sees it.
    """
    run_id = run_id or checkpoint
    if dry_run:
        checkpoint = shared_dir(reports.sparkSession)

    def handle(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, weather, sink, order=order, run_id=run_id, dry_run=dry_run)

    return start(reports.writeStream.foreachBatch(handle), checkpoint, once, interval)


def reports_of(payloads: DataFrame) -> DataFrame:
    """Raw reports of a stream (or table) of response texts."""
    return parse_state_payload(payloads)


# --- continuous operators ---------------------------------------------------------
def dedupe_stream(
    silver: DataFrame, table: str, checkpoint: str, order: tuple[str, ...] = ("ingested_at",), once: bool = True
) -> StreamingQuery:
    """First report of every record id, appended to ``table``; the table remembers the ids for good."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        insert_ignore(batch.sparkSession, table, batch, order)

    return start(silver.writeStream.foreachBatch(handle), checkpoint, once)


def dedupe_stateful(silver: DataFrame, key: str = "flight_record_id") -> DataFrame:
    """First report of every record id as an append stream, for sinks that are not tables.

    The ids are the query's state, without a watermark, so however late a copy
    comes it is dropped and no first report ever is. The state grows with the
    ids: run it with :func:`with_disk_state`, which keeps it on disk and saves
    only what a batch changed. Of copies in one batch any may come first. A
    table as a sink needs no such state: see :func:`dedupe_stream`.
    """
    return silver.dropDuplicates([key])


def with_disk_state(spark: SparkSession) -> SparkSession:
    """Keep the state of the session's streams on the executors' disks, saved to the checkpoint as changes."""
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def enrich_stream(
    flights: DataFrame, weather: DataFrame, keys: tuple[str, ...] = ("cycle_id", "geohash")
) -> DataFrame:
    """Stream-static lookup of the weather of each report's cell."""
    return enrich(flights, weather, keys)


def gold_stream(
    silver: DataFrame, sink: Sink, checkpoint: str, order: tuple[str, ...] = ("ingested_at",), once: bool = True
) -> StreamingQuery:
    """The matrix of a stream of enriched rows, open hours and late rows included.

    Each micro-batch stores its new rows and their partial sums, and folds the
    hours and cells they fall into anew from the stored sums; a replayed batch
    changes nothing and counts stay exact.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, _pending_name(sink, checkpoint)
        pending = _pending_of(spark, name, batch_id)
        if pending is None:
            day, hour = F.col("recorded_date").alias("day"), F.floor(F.col("time_position") / 3600).alias("hour")
            with staged(batch, database_of(sink.silver), F.collect_set(F.struct(day, hour)).alias("hours")) as (rows, seen):
                if not seen["hours"]:
                    return
                fresh = fresh_rows(spark, sink.silver, rows, spans_of(seen["hours"]), order)
                pending = _write_pending(spark, name, batch_id, fresh.select(*SILVER.columns))
        _store(spark, sink, pending, checkpoint, batch_id)
        _drop_pending(spark, pending)

    return start(silver.writeStream.foreachBatch(handle), checkpoint, once)


def alerts_stream(silver: DataFrame, min_risk: float = IMPACT_RISK) -> DataFrame:
    """Severe encounters as they arrive."""
    return hazard_alerts(silver, min_risk)


def quarantine_stream(raw: DataFrame) -> DataFrame:
    """Rejected reports with their reasons."""
    return checked_flights(raw)[1]
