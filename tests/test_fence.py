"""Evictions that rows run into, and evictions that fail."""

import os

import pytest
from helpers import silver_of, silver_row
from pyspark.sql import functions as F
from test_custody import DAY, hot  # noqa: F401

from aerocell.operators import custody
from aerocell.schemas import SILVER
from aerocell.session import list_folder, shared_dir
from aerocell.sources import tables


def ids(spark, table):
    return sorted(r[0] for r in spark.table(table).filter(F.col("recorded_date") == F.lit(DAY)).select("flight_record_id").collect())


def late_row(spark, table, name, day=DAY):
    tables.write_table(silver_of(spark, [silver_row(name, recorded_date=day)]), table, SILVER)


def test_rows_between_comparison_and_drop_are_kept(spark, hot, monkeypatch):  # noqa: F811
    """One lands in the folder that is being detached, one comes when it is."""
    table, ledger = hot
    point = custody.point_days

    def late(*args):
        late_row(spark, table, "before")
        point(*args)
        late_row(spark, table, "after")

    monkeypatch.setattr(custody, "point_days", late)
    row = custody.evict_partition(spark, table, DAY, shared_dir(spark), ledger)
    assert row["record_count_evicted"] == 20 and ids(spark, table) == ["idafter", "idbefore"]
    monkeypatch.undo()
    # They are evicted like any others, to an archive of their own.
    assert custody.evict_partition(spark, table, DAY, shared_dir(spark), ledger)["record_count_evicted"] == 2
    assert ids(spark, table) == [] and spark.table(table).count() == 20


@pytest.mark.parametrize("step", ["point_days", "list_folder", "move_file", "remove_folder", "delete_partition"])
def test_an_eviction_that_failed_is_finished(spark, hot, monkeypatch, step):  # noqa: F811
    table, ledger = hot
    root, point = shared_dir(spark), custody.point_days

    def fail(*args, **kwargs):
        raise OSError("lost")

    def late(*args):
        late_row(spark, table, "late")
        if step == "point_days":
            fail()
        point(*args)
        if step == "delete_partition":
            return
        monkeypatch.setattr(custody, step, fail)

    if step == "delete_partition":
        monkeypatch.setattr(custody, step, fail)
    else:
        monkeypatch.setattr(custody, "point_days", late)
    with pytest.raises(OSError):
        custody.evict_partition(spark, table, DAY, root, ledger)
    monkeypatch.undo()
    if step == "delete_partition":
        assert custody.evict_partition(spark, table, DAY, root, ledger)["status"] == custody.SKIPPED
        assert ids(spark, table) == []
    else:
        custody.finish_evictions(spark, table, DAY)
        assert "idlate" in ids(spark, table)
        custody.evict_partition(spark, table, DAY, root, ledger)
        assert ids(spark, table) == []
    counts = [r["record_count_evicted"] for r in spark.table(ledger).collect()]
    assert sorted(counts) == {"point_days": [20, 21], "delete_partition": [20]}.get(step, [1, 20])
    assert list_folder(spark, custody._marks(spark, table, DAY)) == []
    assert spark.table(table).count() == 20


def test_a_damaged_archive_does_not_stop_later_evictions(spark, hot):  # noqa: F811
    table, ledger = hot
    root = shared_dir(spark)
    first = custody.evict_partition(spark, table, DAY, root, ledger)
    folder = first["storage_destination_uri"].removeprefix("file:")
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "r+b") as out:
                out.write(b"damaged")
                out.truncate(7)
    late_row(spark, table, "late")
    second = custody.evict_partition(spark, table, DAY, root, ledger)
    assert second["record_count_evicted"] == 1 and second["storage_destination_uri"] != first["storage_destination_uri"]
