"""Managed day-partitioned tables: create, write, load, read, query."""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aerocell.schemas import AUDIT, GOLD, SILVER, TableSpec
from aerocell.session import list_folder, make_folder, remove_folder, runtime_conf


def create_table(spark: SparkSession, table: str, spec: TableSpec) -> None:
    """Create an empty managed table; managed, so dropping a partition frees its files."""
    types = {f.name: f.dataType.simpleString() for f in spec.schema}
    columns = ", ".join(f"{name} {types[name]}" for name in spec.columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({spec.partition})"
    )


def create_tables(spark: SparkSession, database: str) -> None:
    for name, spec in (("silver", SILVER), ("gold", GOLD), ("audit", AUDIT)):
        create_table(spark, f"{database}.{name}", spec)


def laid_out(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows arranged for writing.

    The rebalance hint brings a day's rows together but lets AQE split a day
    that is too large for one task and merge days that are small. The local
    sort clusters each file, so its row groups have narrow min/max ranges.
    """
    return (
        df.select(*spec.columns)
        .hint("rebalance", F.col(spec.partition))
        .sortWithinPartitions(spec.partition, *spec.cluster)
    )


def write_table(df: DataFrame, table: str, spec: TableSpec) -> int:
    """Append rows in the table's layout; returns how many.

    The plan may read the table it appends to: Spark fixes the list of files
    it reads before it writes the first new one.
    """
    return _insert(laid_out(df, spec), table, overwrite=False)


def overwrite_days(df: DataFrame, table: str, spec: TableSpec) -> int:
    """Replace exactly the partitions present in ``df``; ``df`` must not read ``table``."""
    # insertInto ignores the writer option of this name, so it is set on the session.
    with runtime_conf(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        return _insert(laid_out(df, spec), table, overwrite=True)


def table_folder(spark: SparkSession, table: str) -> str:
    """Where a table's files lie."""
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return about[0]["data_type"]


def _partition(spec: TableSpec, day: dt.date) -> str:
    return f"PARTITION ({spec.partition} = DATE'{day.isoformat()}')"


def day_folder(spark: SparkSession, table: str, spec: TableSpec, day: dt.date) -> str:
    """Where the catalog says the files of a day lie."""
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {_partition(spec, day)}").filter("col_name = 'Location'").collect()
    return about[0]["data_type"]


def _versions(spark: SparkSession, table: str) -> str:
    # Spark passes over names with an underscore, and they go with the table.
    return f"{table_folder(spark, table).rstrip('/')}/_versions"


def point_days(spark: SparkSession, table: str, spec: TableSpec, folders: dict[dt.date, str]) -> None:
    """Make the catalog read each day from its folder; one metadata call per day."""
    if not folders:
        return
    known = {r[0] for r in partition_days(spark, table, spec.partition).collect()}
    for day, folder in sorted(folders.items()):
        how = "SET LOCATION" if day in known else "LOCATION"
        verb = _partition(spec, day) if day in known else f"ADD {_partition(spec, day)}"
        spark.sql(f"ALTER TABLE {table} {verb} {how} '{folder}'")
    spark.catalog.refreshTable(table)


def swap_days(df: DataFrame, table: str, spec: TableSpec) -> int:
    """Replace exactly the days present in ``df``, each at one moment; returns the rows written.

    The new files go to a folder of their own, and only then does the catalog
    point a day to it: a reader has the old day or the new one, never an empty
    or a half one, and a write that fails leaves the old ones. ``df`` may read
    ``table``. Replaced files stay for readers that have begun; see
    :func:`vacuum_days`.
    """
    spark = df.sparkSession
    folder = f"{_versions(spark, table)}/{uuid.uuid4().hex}"
    written = Observation()
    days = F.collect_set(F.col(spec.partition)).alias("days")
    # At most one value per calendar day.
    rows = laid_out(df, spec).observe(written, F.count(F.lit(1)).alias("rows"), days)
    rows.write.partitionBy(spec.partition).parquet(folder)
    seen = written.get
    point_days(spark, table, spec, {d: f"{folder}/{spec.partition}={d.isoformat()}" for d in seen["days"]})
    return seen["rows"]


def drop_day(spark: SparkSession, table: str, day: dt.date, partition: str = "recorded_date") -> None:
    """Drop a day from the catalog together with its files."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition} = DATE'{day.isoformat()}')")
    # A day that was swapped may have old files in its first folder, where its next rows would go.
    remove_folder(spark, f"{table_folder(spark, table).rstrip('/')}/{partition}={day.isoformat()}")


def new_day_folder(spark: SparkSession, table: str, spec: TableSpec, day: dt.date) -> str:
    """An empty folder for a day, not yet known to the catalog."""
    return make_folder(spark, f"{_versions(spark, table)}/{uuid.uuid4().hex}/{spec.partition}={day.isoformat()}")


def vacuum_days(spark: SparkSession, table: str, spec: TableSpec, grace: float = 3600.0) -> int:
    """Remove folders of days that the catalog no longer points to; returns how many.

    Folders that changed within ``grace`` seconds stay, for readers that began
    before a swap and for writers that have not swapped yet.
    """
    root = table_folder(spark, table).rstrip("/")
    days = [r[0] for r in partition_days(spark, table, spec.partition).collect()]
    used = {_plain(day_folder(spark, table, spec, day)) for day in days}
    mark, before = f"{spec.partition}=", time.time() - grace
    versions = list_folder(spark, f"{root}/_versions")
    found = list_folder(spark, root)
    for version, _, _ in versions:
        found += list_folder(spark, version)
    found = [f for f in found if f[0].rsplit("/", 1)[-1].startswith(mark)]
    old = [path for path, _, changed in found if _plain(path) not in used and changed <= before]
    for path in old:
        remove_folder(spark, path)
    for version, _, changed in versions:
        if changed <= before and not [f for f in list_folder(spark, version) if not f[0].endswith("_SUCCESS")]:
            remove_folder(spark, version)
    return len(old)


def _plain(path: str) -> str:
    """A location without its scheme, which Spark writes as file:/x and file:///x."""
    return "/" + path.split(":", 1)[-1].lstrip("/")


def _insert(rows: DataFrame, table: str, overwrite: bool) -> int:
    # Counted in the writing stage itself, where Spark takes each task's figure once.
    written = Observation()
    counted = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.insertInto(table, overwrite=overwrite)
    return written.get["rows"]


def append_silver(spark: SparkSession, path: str, table: str) -> int:
    """Append newline-delimited JSON records; unknown fields are ignored, nothing is deduplicated.

    Returns the number of rows loaded, 0 for an empty input.
    """
    return write_table(spark.read.schema(SILVER.schema).json(path), table, SILVER)


def read_partition(spark: SparkSession, table: str, day: dt.date, partition: str = "recorded_date") -> DataFrame:
    """Rows of one day; only that day's files are scanned."""
    return spark.table(table).filter(F.col(partition) == F.lit(day))


def query(spark: SparkSession, sql: str, params: dict | None = None, **views: DataFrame) -> DataFrame:
    """SQL with bound parameters over registered tables and the given views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=params or {})


def days_of(df: DataFrame, column: str = "recorded_date") -> list[dt.date]:
    """Distinct days of a frame, oldest first: one value per calendar day."""
    rows = df.select(column).distinct().orderBy(column).collect()
    return [r[0] for r in rows if r[0] is not None]


def partition_days(spark: SparkSession, table: str, partition: str = "recorded_date") -> DataFrame:
    """Days of a table from the catalog alone: no file is opened."""
    text = F.substring_index("partition", f"{partition}=", -1)
    return spark.sql(f"SHOW PARTITIONS {table}").select(F.to_date(text).alias(partition))
