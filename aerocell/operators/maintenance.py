"""Table maintenance: insert-ignore, upsert, rebuild, delete, retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aerocell import functions as fn
from aerocell.operators.enrich import first_per_key
from aerocell.operators.gold import (
    PARTIALS,
    finish_gold,
    fold_partials,
    gold_eligible,
    gold_matrix,
    merge_gold,
    merge_partials,
    on_days,
    per_aircraft,
)
from aerocell.operators.lookup import lookup_join
from aerocell.schemas import GOLD, GOLD_KEYS, RETENTION_DAYS, SILVER
from aerocell.session import staged
from aerocell.sources.tables import days_of, drop_day, partition_days, read_partition, swap_days, write_table


def new_records(target: DataFrame, batch: DataFrame, key: str = "flight_record_id") -> DataFrame:
    """Rows of the batch whose key the target does not hold.

    The target's keys are made distinct first: a key stored many times by plain
    appends is then combined map-side instead of meeting the join as a hot group.
    """
    return batch.join(target.select(key).distinct(), key, "left_anti")


def database_of(table: str) -> str:
    return table.rsplit(".", 1)[0] if "." in table else "default"


def known_keys(
    spark: SparkSession, table: str, spans: dict[dt.date, tuple[int, int]], key: str = "flight_record_id"
) -> DataFrame:
    """Keys that ``table`` holds for some days, of each day only the reports within its span of seconds.

    The days are literals, so other partitions are not opened, and a day's span
    reaches the row groups of that day alone: one late report does not widen
    the others.
    """
    day, time = F.col("recorded_date"), F.col("time_position")
    within = F.lit(False)
    for wanted, (low, high) in sorted(spans.items()):
        within = within | ((day == F.lit(wanted)) & time.between(F.lit(low), F.lit(high)))
    return on_days(spark.table(table), sorted(spans)).filter(within).select(key)


def fresh_rows(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    spans: dict[dt.date, tuple[int, int]],
    order: Sequence[str] = ("ingested_at",),
    key: str = "flight_record_id",
) -> DataFrame:
    """The first row of every key of the batch that ``table`` does not hold."""
    first = first_per_key(batch, [key], [F.col(c) for c in order])
    return new_records(known_keys(spark, table, spans, key), first, key)


# Of a table of keys: enough that a bucket of a day fits a task; more than the shuffle
# partitions of a session, or Spark would rather deal the stored side out again.
KEY_BUCKETS = 256


def create_keys(spark: SparkSession, table: str, buckets: int = KEY_BUCKETS, key: str = "flight_record_id") -> None:
    """An empty table of the keys that a silver table holds, dealt into buckets by key on every day."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({key} STRING, recorded_date DATE) USING parquet"
        f" PARTITIONED BY (recorded_date) CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS"
    )


def _buckets(spark: SparkSession, table: str) -> int:
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    return int(about["data_type"])


def rows_without_key(
    spark: SparkSession, keys: str, rows: DataFrame, days: Sequence[dt.date], key: str = "flight_record_id"
) -> DataFrame:
    """Rows, unique by key, whose key the table ``keys`` does not hold on these days.

    The stored keys lie in buckets by key, so only the rows are dealt out: to as
    many partitions as there are buckets. However long the history, a batch
    moves its own rows and reads the keys of its own days in place.
    """
    dealt = rows.repartition(_buckets(spark, keys), key)
    return dealt.join(on_days(spark.table(keys), days).select(key), key, "left_anti")


def add_keys(spark: SparkSession, keys: str, rows: DataFrame, key: str = "flight_record_id") -> None:
    """Append the keys of stored rows; a key that is added twice does no harm."""
    dealt = rows.select(key, "recorded_date").repartition(_buckets(spark, keys), key)
    dealt.write.insertInto(keys)


def insert_ignore_by_keys(
    spark: SparkSession,
    table: str,
    keys: str,
    batch: DataFrame,
    order: Sequence[str] = ("ingested_at",),
    key: str = "flight_record_id",
) -> int:
    """:func:`insert_ignore` with the stored keys in a table of their own, which is not shuffled.

    The table takes the new rows before ``keys`` does: where a failure comes in
    between, :func:`sync_keys` has to follow before the batch is repeated.
    """
    first = first_per_key(batch, [key], [F.col(c) for c in order])
    seen = (F.collect_set("recorded_date").alias("days"), F.count(F.lit(1)).alias("n"))
    with staged(first, database_of(table), *seen) as (rows, known):
        if not known["n"]:
            return 0
        unknown = rows_without_key(spark, keys, rows, known["days"], key).select(*SILVER.columns)
        with staged(unknown, database_of(table), F.count(F.lit(1)).alias("n")) as (fresh, new):
            if new["n"]:
                write_table(fresh, table, SILVER)
                add_keys(spark, keys, fresh, key)
            return new["n"]


def sync_keys(
    spark: SparkSession, table: str, keys: str, days: Sequence[dt.date], key: str = "flight_record_id"
) -> None:
    """Add the keys that ``table`` holds on these days and ``keys`` does not."""
    stored = on_days(spark.table(table), days).select(key, "recorded_date").distinct()
    add_keys(spark, keys, rows_without_key(spark, keys, stored, days, key), key)


def insert_ignore(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    order: Sequence[str] = ("ingested_at",),
    key: str = "flight_record_id",
    stored: bool = False,
) -> int:
    """Append the rows with unseen keys, the first per key; returns how many were new.

    The key is made from the report's time, so equal keys share that time: of
    the target only the days of the batch are read, and in each of them only the
    files and row groups that reach into the batch's span of that day. ``stored``
    says the batch is a table and need not be written first.
    """
    if not stored:
        with staged(batch, database_of(table)) as written:
            return insert_ignore(spark, table, written, order, key, stored=True)
    # One row per day and batch, so this stays small for any batch.
    spans = batch.groupBy("recorded_date").agg(F.min("time_position").alias("low"), F.max("time_position").alias("high"))
    found = {r["recorded_date"]: (r["low"], r["high"]) for r in spans.collect() if r["recorded_date"] is not None}
    if not found:
        return 0
    return write_table(fresh_rows(spark, table, batch, found, order, key).select(*SILVER.columns), table, SILVER)


def upsert_gold(
    spark: SparkSession,
    table: str,
    delta: DataFrame,
    stored: bool = False,
    days: Sequence[dt.date] | None = None,
) -> int:
    """Replace matched keys, insert new ones, keep the rest; returns the rows of the delta.

    Only the days in the delta are read and written again, each replaced at one
    moment: see :func:`swap_days`. ``stored`` says the delta is a table and need
    not be written first; ``days``, then, which days it has.
    """
    if not stored:
        seen = (F.collect_set("recorded_date").alias("days"), F.count(F.lit(1)).alias("rows"))
        with staged(delta, database_of(table), *seen) as (written, known):
            if known["rows"]:
                upsert_gold(spark, table, written, stored=True, days=known["days"])
            return known["rows"]
    days = days_of(delta) if days is None else sorted(days)
    if not days:
        return 0
    kept = merge_gold(on_days(spark.table(table), days), delta.withColumn("_new", F.lit(1)), GOLD_KEYS)
    # The rows of the delta are counted where the merged days are written.
    new = Observation()
    merged = kept.observe(new, F.count("_new").alias("rows")).drop("_new")
    swap_days(merged, table, GOLD)
    return new.get["rows"]


# --- the matrix from partial sums ---------------------------------------------------
def add_partials(
    spark: SparkSession, table: str, fresh: DataFrame, run_id: str = "", iteration: int = 0, again: bool = False
) -> None:
    """Store the partial sums of rows that are new in the enriched table.

    ``fresh`` must hold each row once over all calls. A call that may have been
    made before (``again``) replaces what it left, day by day.
    """
    hour = fn.hour_start(F.col("weather_recorded_at")).alias("window_start")
    sums = per_aircraft(gold_eligible(fresh), hour).withColumns(
        {"run_id": F.lit(run_id), "iteration_id": F.lit(iteration).cast("bigint")}
    )
    if not again:
        write_table(sums, table, PARTIALS)
        return
    same = F.col("run_id").eqNullSafe(F.lit(run_id)) & F.col("iteration_id").eqNullSafe(F.lit(iteration))
    others = on_days(spark.table(table), days_of(fresh)).filter(~same)
    swap_days(others.unionByName(sums.select(*PARTIALS.columns)), table, PARTIALS)


def matrix_of_partials(partials: DataFrame) -> DataFrame:
    """The matrix of stored partial sums, those of an aircraft in a cell added up first."""
    return finish_gold(fold_partials(partials), F.current_timestamp())


def refresh_touched(
    spark: SparkSession, partials: str, gold: str, fresh: DataFrame, days: Sequence[dt.date] | None = None
) -> int:
    """Bring the matrix up to date for the hours and cells of ``fresh``, whose partial sums are stored.

    Reads the partial sums of the touched cells on the touched days, which are
    a row per aircraft, hour and cell; the enriched rows are not read again.
    """
    hour = fn.hour_start(F.col("weather_recorded_at")).alias("window_start")
    touched = gold_eligible(fresh).select("recorded_date", hour, "geohash").distinct()
    days = days_of(touched) if days is None else sorted(days)
    if not days:
        return 0
    found = on_days(spark.table(partials), days)
    again = lookup_join(found, touched, ["recorded_date", "window_start", "geohash"], "left_semi")
    return upsert_gold(spark, gold, matrix_of_partials(again))


def compact_partials(spark: SparkSession, table: str, days: Sequence[dt.date]) -> int:
    """Add up the partial sums of all batches but each run's last on some days; returns the rows left.

    Every batch appends, so a day holds as many rows of an aircraft in a cell as
    batches saw it. The last batch of a run stays apart, as it may be repeated.
    """
    found = on_days(spark.table(table), days)
    last = found.groupBy("run_id").agg(F.max("iteration_id").alias("_last"))
    marked = found.join(F.broadcast(last), "run_id", "left")
    newest = F.coalesce(F.col("iteration_id") == F.col("_last"), F.lit(False))
    tag = {"run_id": F.when(newest, F.col("run_id")), "iteration_id": F.when(newest, F.col("iteration_id"))}
    return swap_days(merge_partials(marked.withColumns(tag), ("run_id", "iteration_id")), table, PARTIALS)


def refresh_gold(
    spark: SparkSession, silver: str, gold: str, days: dt.date | Sequence[dt.date] | None = None
) -> int:
    """Recompute the matrix of a day or of many days in one job and upsert it; default today (UTC)."""
    wanted = dt.datetime.now(dt.timezone.utc).date() if days is None else days
    return upsert_gold(spark, gold, gold_matrix(spark.table(silver), wanted))


def delete_partition(spark: SparkSession, table: str, day: dt.date, partition: str = "recorded_date") -> int:
    """Drop one day; returns its number of rows. The count reads file footers only."""
    rows = read_partition(spark, table, day, partition).count()
    drop_day(spark, table, day, partition)
    return rows


def expired_days(
    days: DataFrame, as_of: dt.date, retention: int = RETENTION_DAYS, exact: bool = False
) -> DataFrame:
    """Days at or past the retention limit, or only the day that reaches it."""
    limit = F.lit(as_of - dt.timedelta(days=retention))
    day = F.col("recorded_date")
    return days.select("recorded_date").distinct().filter(day == limit if exact else day <= limit)


def expired_partitions(
    spark: SparkSession, table: str, as_of: dt.date, retention: int = RETENTION_DAYS, exact: bool = False
) -> DataFrame:
    """Same for a table, from its catalog entries."""
    return expired_days(partition_days(spark, table), as_of, retention, exact)
