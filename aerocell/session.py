"""Session settings every operator relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Observation, SparkSession

RUNTIME_SETTINGS = {
    # Hour windows and partition dates are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # One busy cell may hold a third of all reports: let AQE split it, even
    # when that costs the consumer of the join one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM never compiles a method above 8000 bytes; let Spark split such a
    # stage into smaller methods instead of running it interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("aerocell")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Executors reach either, as tables live in the warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/aerocell-{uuid.uuid4().hex}"
    for made in _COLLECTORS:
        made.append(folder)
    return folder


def scratch_database(spark: SparkSession) -> str:
    """Create an empty database whose managed tables live in the shared folder."""
    name = f"aerocell_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark)}'")
    return name


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Writes in this block remove their shuffle files at their end, not when the driver's memory is next cleaned."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df, name: str = "table"):
    """Write ``df`` once to the shared folder and read it back, cutting its lineage.

    For results that one plan reads more than once; unlike a cache it survives
    the loss of executors. The shuffle files of the plan go when it is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_roots(df) -> list[str]:
    """The folders and files that a frame reads, as they were given to the reader."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            paths = leaf.relation().location().rootPaths()
            found += [paths.apply(k).toString() for k in range(paths.size())]
    return found


def discard(df) -> None:
    """Delete what :func:`materialise` has written for ``df``, which is not needed any more."""
    for path in stored_roots(df):
        if "/aerocell-" in path:
            remove_folder(df.sparkSession, path.rsplit("/", 1)[0])


@contextmanager
def collected():
    """A list of the folders that :func:`shared_dir` hands out in a block, for whoever is to remove them."""
    made: list[str] = []
    _COLLECTORS.append(made)
    try:
        yield made
    finally:
        # By identity: equal lists are different ones.
        _COLLECTORS[:] = [c for c in _COLLECTORS if c is not made]


# Lists that take note of new folders, innermost last.
_COLLECTORS: list[list[str]] = []


@contextmanager
def staged(df, database: str, *seen):
    """``df`` as a table of ``database`` for the duration of a block; its files go with it.

    For what one micro-batch reads several times: unlike :func:`materialise`,
    nothing of it is left when the batch is done. With aggregates ``seen`` the
    block gets the table and a dict of their values, taken while writing.
    """
    spark = df.sparkSession
    table = f"{database}.staged_{uuid.uuid4().hex}"
    watched = Observation()
    try:
        rows = df.observe(watched, *seen) if seen else df
        rows.write.format("parquet").saveAsTable(table)
        yield (spark.table(table), watched.get) if seen else spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _folder(spark: SparkSession, path: str):
    """A folder and the file system that Spark reaches it by."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> str:
    """Create an empty folder; returns it as Spark names it."""
    hadoop, files = _folder(spark, path)
    files.mkdirs(hadoop)
    return files.makeQualified(hadoop).toString()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it; an absent one is fine."""
    hadoop, files = _folder(spark, path)
    files.delete(hadoop, True)


def move_file(spark: SparkSession, path: str, folder: str) -> None:
    """Move a file into a folder under its own name; one that is there already is not moved again."""
    hadoop, files = _folder(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(folder, hadoop.getName())
    if files.exists(target):
        files.delete(hadoop, False)
    else:
        files.rename(hadoop, target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written whole under another name and then renamed."""
    hadoop, files = _folder(spark, path)
    partial = hadoop.suffix(".part")
    out = files.create(partial, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files.rename(partial, hadoop)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file that :func:`write_text` has written."""
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """``(path, bytes, seconds of last change)`` of what lies directly in a folder, none if it is absent."""
    hadoop, files = _folder(spark, path)
    if not files.exists(hadoop):
        return []
    found = files.listStatus(hadoop)
    return sorted((f.getPath().toString(), f.getLen(), f.getModificationTime() // 1000) for f in found)


@contextmanager
def runtime_conf(spark: SparkSession, key: str, value: str):
    """Set one runtime setting for the duration of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
