import datetime as dt
import os

import pytest
from helpers import silver_of, silver_row
from pyspark.sql import functions as F

from aerocell.operators import custody
from aerocell.schemas import SILVER
from aerocell.session import shared_dir
from aerocell.sources import tables

DAY, NEXT = dt.date(2027, 5, 19), dt.date(2027, 5, 20)


@pytest.fixture
def hot(spark, database):
    rows = [silver_row(n, recorded_date=DAY if n % 2 else NEXT) for n in range(40)]
    tables.write_table(silver_of(spark, rows), f"{database}.silver", SILVER)
    return f"{database}.silver", f"{database}.audit"


def test_evict_moves_the_day_and_writes_the_ledger(spark, hot):
    table, ledger = hot
    before = {r["flight_record_id"] for r in spark.table(table).filter(F.col("recorded_date") == DAY).collect()}
    root = shared_dir(spark)
    row = custody.evict_partition(spark, table, DAY, root, ledger)
    assert row["eviction_status"] == "SUCCESS" and row["record_count_evicted"] == 20
    assert row["storage_destination_uri"] == f"{root}/archives/silver/2027-05-19/silver_2027-05-19.parquet"
    archived = spark.read.parquet(row["storage_destination_uri"])
    assert {r["flight_record_id"] for r in archived.collect()} == before
    assert spark.table(table).filter(F.col("recorded_date") == DAY).count() == 0
    assert spark.table(table).count() == 20
    stored = spark.table(ledger).first()
    assert stored["sha256_checksum"] == row["sha256_checksum"] and '"compression":"zstd"' in stored["metadata_json"]
    # Restoring the archive gives the table back.
    tables.write_table(archived, table, SILVER)
    assert spark.table(table).count() == 40


def test_empty_day_is_skipped(spark, hot):
    table, ledger = hot
    result = custody.evict_partition(spark, table, dt.date(2020, 1, 1), shared_dir(spark), ledger)
    assert result == {"status": "SKIPPED_EMPTY_PARTITION", "record_count": 0}
    assert spark.table(ledger).count() == 0


def test_failed_copy_keeps_the_day(spark, hot):
    table, ledger = hot
    root = shared_dir(spark)
    os.makedirs(root)
    with open(f"{root}/archives", "w") as out:  # a file where the archive folder should be
        out.write("x")
    with pytest.raises(Exception):
        custody.evict_partition(spark, table, DAY, root, ledger)
    assert spark.table(table).count() == 40 and spark.table(ledger).count() == 0


def test_mismatch_keeps_the_day(spark, hot, monkeypatch):
    table, ledger = hot
    export = custody.export_parquet
    monkeypatch.setattr(custody, "export_parquet", lambda df, *a, **k: export(df.limit(5), *a, **k))
    with pytest.raises(RuntimeError, match="nothing deleted"):
        custody.evict_partition(spark, table, DAY, shared_dir(spark), ledger)
    assert spark.table(table).count() == 40 and spark.table(ledger).count() == 0


def test_crash_before_the_drop_can_be_repeated(spark, hot, monkeypatch):
    table, ledger = hot
    root = shared_dir(spark)
    drop = custody.delete_partition

    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr(custody, "delete_partition", crash)
    with pytest.raises(OSError):
        custody.evict_partition(spark, table, DAY, root, ledger)
    monkeypatch.setattr(custody, "delete_partition", drop)
    custody.evict_partition(spark, table, DAY, root, ledger)
    # The archive of the first try holds exactly the hot rows and is taken.
    assert spark.table(table).count() == 20 and spark.table(ledger).count() == 1


def test_rows_that_come_in_before_the_drop_are_kept(spark, hot, monkeypatch):
    table, ledger = hot
    write = custody.write_audit

    def late(*args):
        write(*args)
        tables.write_table(silver_of(spark, [silver_row("late", recorded_date=DAY)]), table, SILVER)

    monkeypatch.setattr(custody, "write_audit", late)
    with pytest.raises(RuntimeError, match="new rows"):
        custody.evict_partition(spark, table, DAY, shared_dir(spark), ledger)
    assert spark.table(table).count() == 41


def test_fingerprint_sees_a_value_moved_to_another_column(spark):
    from aerocell.sources.archive import row_fingerprint

    frames = [spark.createDataFrame([row], "a double, b double") for row in ((None, 5.0), (5.0, None))]
    one, other = (df.agg(row_fingerprint(["a", "b"])).first()[0] for df in frames)
    assert one != other


def test_late_rows_do_not_overwrite_the_first_archive(spark, hot):
    table, ledger = hot
    root = shared_dir(spark)
    first = custody.evict_partition(spark, table, DAY, root, ledger)
    tables.write_table(silver_of(spark, [silver_row("late")]), table, SILVER)
    second = custody.evict_partition(spark, table, DAY, root, ledger)
    assert first["storage_destination_uri"] != second["storage_destination_uri"]
    assert spark.read.parquet(first["storage_destination_uri"]).count() == 20
    assert spark.read.parquet(second["storage_destination_uri"]).count() == 1


def test_verification_states_and_summary(spark):
    manifests = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "archive_key string, sha256_checksum string")
    digests = spark.createDataFrame([("a", "1"), ("b", "x"), ("z", "9")], "archive_key string, sha256_checksum string")
    checked = custody.verify_archives(manifests, digests)
    states = {r["archive_key"]: r["verification"] for r in checked.collect()}
    assert states == {"a": "VERIFIED", "b": "CORRUPTED", "c": "MISSING"}
    assert tuple(custody.verify_summary(checked, 1).first()) == (3, 1, 1, 1)


def test_sync_copies_verifies_and_finds_damage(spark, hot):
    table, ledger = hot
    root, dest = shared_dir(spark), shared_dir(spark)
    done = custody.evict_expired(spark, table, NEXT, root, ledger, retention=0)
    assert [r["target_partition_date"] for r in done] == [DAY, NEXT]
    audit = spark.table(ledger)

    def sync(**options):
        return tuple(custody.sync_archives(spark, audit, root, dest, **options).first())

    assert sync(dry_run=True) == sync(verify_only=True) == (2, 0, 0, 0)
    assert sync() == (2, 2, 2, 0)
    assert sync() == (2, 0, 2, 0)
    damaged = next(p for p, _, names in os.walk(dest) for n in names if n.endswith(".parquet"))
    name = next(n for n in os.listdir(damaged) if n.endswith(".parquet"))
    with open(f"{damaged}/{name}", "ab") as out:
        out.write(b"x")
    assert sync(verify_only=True) == (2, 0, 1, 1)


def test_exact_retention_takes_one_day(spark, hot):
    table, ledger = hot
    done = custody.evict_expired(spark, table, NEXT + dt.timedelta(days=7), shared_dir(spark), ledger, exact=True)
    assert [r["target_partition_date"] for r in done] == [NEXT]
    assert spark.table(table).count() == 20


def test_files_outside_the_manifests_are_not_copied(spark, hot):
    table, ledger = hot
    root, dest = shared_dir(spark), shared_dir(spark)
    custody.evict_partition(spark, table, DAY, root, ledger)
    spark.range(5).write.parquet(f"{root}/archives/silver/stray.parquet")
    assert tuple(custody.sync_archives(spark, spark.table(ledger), root, dest).first()) == (1, 1, 1, 0)
    assert not os.path.exists(f"{dest}/archives/silver/stray.parquet")
