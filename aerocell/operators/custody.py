"""Moving old days to cold storage, and proving they are still there."""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocell.operators.maintenance import delete_partition, expired_partitions
from aerocell.operators.reports import success_manifests
from aerocell.schemas import AUDIT, AUDIT_SCHEMA, RETENTION_DAYS, SILVER, ZSTD_LEVEL, TableSpec
from aerocell.sources.archive import (
    archive_path,
    archived_files,
    ensure_folder,
    export_artifact,
    export_parquet,
    partition_digest,
    restore_archives,
    row_fingerprint,
)
from aerocell.session import list_folder, move_file, read_text, remove_folder, write_text
from aerocell.sources.tables import (
    day_folder,
    days_of,
    new_day_folder,
    partition_days,
    point_days,
    read_partition,
    table_folder,
    write_table,
)

SKIPPED = "SKIPPED_EMPTY_PARTITION"


def archive_name(table: Column, day: Column) -> Column:
    """File name of a day's archive."""
    return F.format_string("%s_%s.parquet", table, day.cast("string"))


def archive_key(table: Column, day: Column) -> Column:
    """Location of a day's archive below the archive root."""
    return F.format_string("archives/%s/%s/%s", table, day.cast("string"), archive_name(table, day))


def audit_metadata(compression: Column, level: Column, provider: Column) -> Column:
    return F.to_json(
        F.struct(
            compression.alias("compression"),
            level.alias("compression_level"),
            provider.alias("storage_provider"),
        )
    )


def write_audit(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Append ledger rows."""
    dated = rows.select(*AUDIT_SCHEMA.names).withColumn("archival_date", F.to_date("archival_timestamp"))
    write_table(dated, table, AUDIT)


def _contents(df: DataFrame) -> tuple[int, str | None]:
    row = df.agg(F.count("*").alias("n"), row_fingerprint(sorted(df.columns)).alias("f")).first()
    return row["n"], row["f"]


def evict_partition(
    spark: SparkSession,
    table: str,
    day: dt.date,
    archive_root: str,
    audit_table: str,
    spec: TableSpec = SILVER,
) -> dict:
    """Export a day, verify the copy, write the ledger, then drop the day.

    Any failure before the drop leaves the hot rows in place, and the call can
    simply be repeated: an earlier archive that holds exactly the hot rows is
    taken instead of a second one. A day that was archived once and has other
    rows now (late ones) gets a file name of its own, so an earlier archive is
    never overwritten. Only the files that were compared are dropped: if the
    day has others by then, it is kept and an error raised; rows that arrive
    even later open a folder of their own, or are put back into one.
    """
    started = time.monotonic()
    finish_evictions(spark, table, day, spec)
    hot = read_partition(spark, table, day)
    if hot.isEmpty():
        return {"status": SKIPPED, "record_count": 0}
    short = table.rsplit(".", 1)[-1]
    audit_id = str(uuid.uuid4())
    earlier = spark.table(audit_table).filter(
        (F.col("target_partition_date") == F.lit(day))
        & (F.col("truncated_table_name") == short)
        & (F.col("eviction_status") == "SUCCESS")
    )
    compared, wanted = _files(hot), _contents(hot)
    for manifest in earlier.select(*AUDIT_SCHEMA.names).orderBy("archival_timestamp").toLocalIterator():
        if _holds(spark, manifest["storage_destination_uri"], hot.columns, wanted):
            _drop_compared(spark, table, day, compared, spec)
            return manifest.asDict()
    folder = f"{archive_root.rstrip('/')}/archives/{short}/{day}"
    name = f"{short}_{day}" if earlier.isEmpty() else f"{short}_{day}_{audit_id}"
    destination = f"{folder}/{name}.parquet"

    export_parquet(hot, destination, spec.cluster, mode="overwrite")
    if not _holds(spark, destination, hot.columns, wanted):
        raise RuntimeError(f"archive of {table} {day} does not match the table; nothing deleted")

    elapsed = round(time.monotonic() - started, 2)
    ledger = export_artifact(spark, destination).select(
        F.lit(audit_id).alias("audit_id"),
        F.current_timestamp().alias("archival_timestamp"),
        F.lit(day).alias("target_partition_date"),
        F.col("record_count").alias("record_count_evicted"),
        F.col("uncompressed_bytes").alias("raw_uncompressed_bytes"),
        F.col("compressed_bytes").alias("compressed_parquet_bytes"),
        "compression_ratio",
        "sha256_checksum",
        "storage_destination_uri",
        F.lit("SUCCESS").alias("eviction_status"),
        F.lit(short).alias("truncated_table_name"),
        F.lit(elapsed).alias("execution_duration_seconds"),
        audit_metadata(F.lit("zstd"), F.lit(ZSTD_LEVEL), F.lit(_provider(archive_root))).alias("metadata_json"),
    )
    row = ledger.first()
    write_audit(spark, audit_table, spark.createDataFrame([row], AUDIT_SCHEMA))
    _drop_compared(spark, table, day, compared, spec)
    return row.asDict()


def _files(df: DataFrame) -> list[str]:
    """The files behind the rows of one day."""
    return sorted(df.inputFiles())


def _holds(spark: SparkSession, uri: str, columns: list[str], wanted: tuple) -> bool:
    """Whether an archive has these contents; one that is lost, damaged or of another shape has not."""
    try:
        return _contents(spark.read.parquet(uri).select(*columns)) == wanted
    except (PySparkException, Py4JJavaError):
        return False


def _marks(spark: SparkSession, table: str, day: dt.date) -> str:
    return f"{table_folder(spark, table).rstrip('/')}/_detached/{day.isoformat()}"


def _drop_compared(spark: SparkSession, table: str, day: dt.date, compared: list[str], spec: TableSpec) -> None:
    """Drop the files of a day that were compared, and no others.

    If the day has other files already it is kept, and an error raised. Then
    the catalog points the day to an empty folder, where rows are written from
    now on, so the old folder stands still; what reached it in between is put
    back. A note of it is written first: after a failure
    :func:`finish_evictions` goes on from there.
    """
    spark.catalog.refreshTable(table)
    if _files(read_partition(spark, table, day)) != compared:
        raise RuntimeError(f"{table} {day} has new rows; nothing deleted, evict it again")
    note = {"folder": day_folder(spark, table, spec, day), "compared": compared}
    path = f"{_marks(spark, table, day)}/{uuid.uuid4().hex}"
    write_text(spark, path, json.dumps(note))
    point_days(spark, table, spec, {day: new_day_folder(spark, table, spec, day)})
    _finish(spark, table, day, path, note, spec)


def _finish(spark: SparkSession, table: str, day: dt.date, path: str, note: dict, spec: TableSpec) -> None:
    """Put back the rows that a detached folder got after the comparison, then remove it and its note."""
    folder, known = note["folder"], {f.rsplit("/", 1)[-1] for f in note["compared"]}
    now = day_folder(spark, table, spec, day)
    if now.rstrip("/") == folder.rstrip("/"):
        # Failed before the day was pointed elsewhere: nothing is detached.
        remove_folder(spark, path)
        return
    late = [f for f, _, _ in list_folder(spark, folder) if f.endswith(".parquet") and f.rsplit("/", 1)[-1] not in known]
    # Moved, not written anew: a repeated call finds them moved already.
    for path_of_late in late:
        move_file(spark, path_of_late, now)
    remove_folder(spark, folder)
    spark.catalog.refreshTable(table)
    if not list_folder(spark, now):
        delete_partition(spark, table, day, spec.partition)
    remove_folder(spark, path)


def finish_evictions(spark: SparkSession, table: str, day: dt.date, spec: TableSpec = SILVER) -> int:
    """Finish what a failed eviction of a day has begun; returns how many there were."""
    notes = [path for path, _, _ in list_folder(spark, _marks(spark, table, day)) if not path.endswith((".part", ".crc"))]
    for path in notes:
        note = json.loads(read_text(spark, path))
        if day in days_of(partition_days(spark, table, spec.partition), spec.partition):
            _finish(spark, table, day, path, note, spec)
        else:
            remove_folder(spark, path)
    return len(notes)


def evict_expired(
    spark: SparkSession,
    table: str,
    as_of: dt.date,
    archive_root: str,
    audit_table: str,
    retention: int = RETENTION_DAYS,
    exact: bool = False,
    spec: TableSpec = SILVER,
) -> list[dict]:
    """Evict every day past retention, oldest first; ``exact`` takes only the day that reaches it."""
    days = days_of(expired_partitions(spark, table, as_of, retention, exact))
    return [evict_partition(spark, table, day, archive_root, audit_table, spec) for day in days]


def _provider(root: str) -> str:
    return root.split("://", 1)[0] if "://" in root else "local"


def verify_archives(manifests: DataFrame, digests: DataFrame, key: str = "archive_key") -> DataFrame:
    """State of every archive: its digest matches, differs, or there is no file."""
    actual = digests.select(key, F.col("sha256_checksum").alias("actual_sha256"))
    status = (
        F.when(F.col("actual_sha256").isNull(), "MISSING")
        .when(F.col("actual_sha256") == F.col("sha256_checksum"), "VERIFIED")
        .otherwise("CORRUPTED")
    )
    return manifests.join(actual, key, "left").withColumn("verification", status)


def verify_summary(checked: DataFrame, newly_downloaded: int = 0) -> DataFrame:
    return checked.agg(
        F.count("*").alias("total_manifests_evaluated"),
        F.lit(newly_downloaded).cast("bigint").alias("newly_downloaded"),
        F.count_if(F.col("verification") == "VERIFIED").alias("verified_valid"),
        F.count_if(F.col("verification") == "CORRUPTED").alias("corrupted_detected"),
    )


def sync_archives(
    spark: SparkSession,
    audit: DataFrame,
    archive_root: str,
    dest: str,
    verify_only: bool = False,
    dry_run: bool = False,
) -> DataFrame:
    """Bring the archives of all successful evictions to ``dest`` and check their digests.

    One row: manifests evaluated, archives copied now, valid, corrupted. With
    ``verify_only`` or ``dry_run`` nothing is copied and absent archives count
    as neither valid nor corrupted.
    """
    ensure_folder(spark, dest)
    manifests = success_manifests(audit).withColumn(
        "archive_key", archive_path(F.col("storage_destination_uri"), archive_root)
    )
    copied = 0
    if not (verify_only or dry_run):
        copied = restore_archives(spark, archive_root, dest, only=manifests)["archives"]
    digests = partition_digest(archived_files(spark, dest, digests=True), by=("archive_key",))
    return verify_summary(verify_archives(manifests, digests), copied)
