import datetime as dt

from helpers import plan, silver_of, silver_row

from aerocell.operators import maintenance
from aerocell.schemas import SILVER
from aerocell.sources import tables

MAY = [dt.date(2027, 5, d) for d in range(32) if d]


def ids(spark, table):
    return sorted(r[0] for r in spark.table(table).select("flight_record_id").collect())


def test_insert_ignore_keeps_stored_rows_and_the_first_of_a_batch(spark, database):
    table = f"{database}.silver"
    assert maintenance.insert_ignore(spark, table, silver_of(spark, [silver_row(1, velocity_mps=100.0)])) == 1
    batch = [
        silver_row(1, velocity_mps=999.0),
        silver_row(2, last_contact=9, velocity_mps=2.0),
        silver_row(2, last_contact=5, velocity_mps=1.0),
    ]
    df = silver_of(spark, batch)
    assert maintenance.insert_ignore(spark, table, df, order=["last_contact"]) == 1
    assert maintenance.insert_ignore(spark, table, df, order=["last_contact"]) == 0
    stored = {r["flight_record_id"]: r["velocity_mps"] for r in spark.table(table).collect()}
    assert stored == {"id1": 100.0, "id2": 1.0}
    assert maintenance.insert_ignore(spark, table, df.limit(0)) == 0


def test_insert_ignore_with_one_record_holding_a_third_of_the_batch(spark, database):
    table = f"{database}.silver"
    rows = [silver_row("hot" if n % 3 == 0 else n, last_contact=n) for n in range(3000)]
    assert maintenance.insert_ignore(spark, table, silver_of(spark, rows).repartition(8), order=["last_contact"]) == 2001
    assert spark.table(table).filter("flight_record_id = 'idhot'").first()["last_contact"] == 0


def test_target_keys_stored_many_times_are_combined_first(spark):
    stored = silver_of(spark, [silver_row("hot") for _ in range(500)] + [silver_row(1)])
    fresh = maintenance.new_records(stored, silver_of(spark, [silver_row("hot"), silver_row(1), silver_row(2)]))
    assert [r["flight_record_id"] for r in fresh.collect()] == ["id2"]


def test_only_the_days_of_the_batch_are_read(spark, database):
    from aerocell.operators.gold import on_days

    table = f"{database}.silver"
    tables.write_table(silver_of(spark, [silver_row(n, recorded_date=MAY[n]) for n in range(20)]), table, SILVER)
    read = on_days(spark.table(table), [MAY[3], MAY[4]])
    assert read.count() == 2
    assert "PartitionFilters: [recorded_date" in plan(read)


def test_delete_partition_counts_and_frees_one_day(spark, database):
    table = f"{database}.silver"
    tables.write_table(silver_of(spark, [silver_row(n, recorded_date=MAY[n % 3]) for n in range(30)]), table, SILVER)
    assert maintenance.delete_partition(spark, table, MAY[1]) == 10
    assert maintenance.delete_partition(spark, table, MAY[1]) == 0
    assert spark.table(table).count() == 20 and len(ids(spark, table)) == 20


def test_overwrite_days_leaves_other_days(spark, database):
    table = f"{database}.silver"
    tables.write_table(silver_of(spark, [silver_row(n, recorded_date=MAY[n % 3]) for n in range(30)]), table, SILVER)
    tables.overwrite_days(silver_of(spark, [silver_row(99, recorded_date=MAY[0])]), table, SILVER)
    counts = {r["recorded_date"]: r["count"] for r in spark.table(table).groupBy("recorded_date").count().collect()}
    assert counts == {MAY[0]: 1, MAY[1]: 10, MAY[2]: 10}


def test_expired_days(spark, database):
    table = f"{database}.silver"
    tables.write_table(silver_of(spark, [silver_row(n, recorded_date=MAY[n]) for n in range(20)]), table, SILVER)
    as_of = MAY[14]
    due = maintenance.expired_partitions(spark, table, as_of).orderBy("recorded_date").collect()
    assert [r[0] for r in due] == MAY[:8]
    exact = maintenance.expired_partitions(spark, table, as_of, exact=True).collect()
    assert [r[0] for r in exact] == [MAY[7]]
    stored = maintenance.expired_days(spark.table(table), as_of)
    assert stored.count() == 8
