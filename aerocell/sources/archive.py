"""Cold files: compressed export, digests, restore."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerocell.functions import round2
from aerocell.schemas import ZSTD_LEVEL

# Names Spark lists a store under, and the ones pyarrow opens it by.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss", "gcs": "gs"}
# Stores that speak the S3 protocol under an address of their own, set as
# ``spark.hadoop.fs.<scheme>.endpoint``.
S3_LIKE = ("r2",)

# How much of a file a task holds while it copies or hashes it.
BLOCK_BYTES = 1 << 20


def export_parquet(
    df: DataFrame,
    path: str,
    cluster: tuple[str, ...] = (),
    level: int = ZSTD_LEVEL,
    mode: str = "errorifexists",
) -> None:
    """Write ZSTD, dictionary-encoded Parquet files; an empty input is an error.

    Stored rows go from scan to file without a shuffle; the sort is local.
    """
    if df.isEmpty():
        raise ValueError("cannot export an empty data set")
    rows = df.sortWithinPartitions(*cluster) if cluster else df
    (
        rows.write.mode(mode)
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", str(level))
        .option("parquet.enable.dictionary", "true")
        .parquet(path)
    )


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """``(path, file_name, length)`` of every file below a folder that has a byte, without reading contents."""
    return _binary(spark, path, pattern).select("path", _file_name(), "length")


def file_digests(
    spark: SparkSession, path: str, pattern: str = "*.parquet", block: int = BLOCK_BYTES
) -> DataFrame:
    """SHA-256 and byte length of every file below a folder.

    Files are listed without their contents and read in blocks, so a file may be
    of any size; each is read by one task, as its digest needs its bytes in order.
    """
    files = list_files(spark, path, pattern)
    # A number of partitions of its own: AQE would merge these few short rows into one task.
    dealt = files.repartition(spark.sparkContext.defaultParallelism, "path")
    return dealt.mapInPandas(_hasher(spark, block), "path string, file_name string, length bigint, sha256_checksum string")


def _binary(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def _file_name() -> Column:
    return F.substring_index("path", "/", -1).alias("file_name")


def partition_digest(digests: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One digest for a set of files, in two levels.

    The sorted ``name:digest`` lines of the files whose digest starts with the
    same two hex characters are hashed, then the sorted ``characters:hash``
    lines of these at most 256 parts. Lists hold lines of files, never rows.
    """

    def combine(lines) -> Column:
        return F.sha2(F.array_join(F.sort_array(F.collect_list(lines)), "\n"), 256)

    parts = digests.groupBy(*by, F.substring("sha256_checksum", 1, 2).alias("part")).agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        combine(F.concat_ws(":", "file_name", "sha256_checksum")).alias("digest"),
    )
    return parts.groupBy(*by).agg(
        F.sum("files").alias("files"),
        F.sum("bytes").alias("compressed_bytes"),
        combine(F.concat_ws(":", "part", "digest")).alias("sha256_checksum"),
    )


def uncompressed_width(schema: T.StructType) -> Column:
    """Bytes of one row in memory: 8 per number or timestamp, 4 per date or int,
    1 per boolean, the UTF-8 length of a string; nulls count as their fixed width or 0."""
    fixed = {T.DateType: 4, T.IntegerType: 4, T.FloatType: 4, T.BooleanType: 1}
    width = F.lit(0).cast("bigint")
    for field in schema:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        else:
            width = width + F.lit(fixed.get(type(field.dataType), 8))
    return width


def row_fingerprint(columns: list[str]) -> Column:
    """Order-free fingerprint of a set of rows; equal sets give equal sums.

    The hash passes over nulls, so each column is hashed with whether it is
    null: a value moved to another column makes a difference.
    """
    marked = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    return F.sum(F.xxhash64(*marked).cast("decimal(38,0)")).cast("string")


def export_artifact(spark: SparkSession, path: str) -> DataFrame:
    """One row: rows, sizes, ratio and digest of an exported folder, read back from it."""
    exported = spark.read.parquet(path)
    rows = exported.agg(
        F.count("*").alias("record_count"),
        F.coalesce(F.sum(uncompressed_width(exported.schema)), F.lit(0)).alias("uncompressed_bytes"),
    ).select("record_count", "uncompressed_bytes", *_absent(files="bigint", compressed_bytes="bigint", sha256_checksum="string"))
    files = partition_digest(file_digests(spark, path)).select(
        *_absent(record_count="bigint", uncompressed_bytes="bigint"), "files", "compressed_bytes", "sha256_checksum"
    )
    ratio = F.col("uncompressed_bytes") / F.greatest(F.lit(1), F.col("compressed_bytes"))
    columns = ["record_count", "uncompressed_bytes", "files", "compressed_bytes", "sha256_checksum"]
    return (
        rows.unionByName(files)
        .agg(*[F.max(c).alias(c) for c in columns])
        .withColumn("compression_ratio", round2(ratio))
        .withColumn("storage_destination_uri", F.lit(path))
    )


def _absent(**columns: str) -> list[Column]:
    return [F.lit(None).cast(kind).alias(name) for name, kind in columns.items()]


def _opener(spark: SparkSession):
    """From a URI to its file system and path, whichever name Spark has for the store.

    A closure: it travels to the executors by value; they need pyarrow, not this package.
    """
    settings = spark._jsc.hadoopConfiguration()
    schemes, endpoints = dict(SCHEMES), {scheme: settings.get(f"fs.{scheme}.endpoint") for scheme in S3_LIKE}

    def open_uri(uri: str) -> tuple[fs.FileSystem, str]:
        scheme, _, rest = uri.partition(":")
        rest = "/" + rest.lstrip("/") if scheme == "file" else rest.removeprefix("//")
        if scheme in endpoints:
            if not endpoints[scheme]:
                raise ValueError(f"{scheme}:// needs spark.hadoop.fs.{scheme}.endpoint")
            return fs.S3FileSystem(endpoint_override=endpoints[scheme], region="auto"), rest
        return fs.FileSystem.from_uri(f"{schemes.get(scheme, scheme)}://{rest}")

    return open_uri


def _hasher(spark: SparkSession, block: int):
    """The hashing task: a file at a time, a block at a time."""
    open_uri = _opener(spark)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums, sizes = [], []
            for path in batch["path"]:
                files, name = open_uri(path)
                found, size = hashlib.sha256(), 0
                with files.open_input_stream(name) as reader:
                    while part := reader.read(block):
                        found.update(part)
                        size += len(part)
                sums.append(found.hexdigest())
                sizes.append(size)
            yield pd.DataFrame({"path": batch["path"], "file_name": batch["file_name"], "length": sizes, "sha256_checksum": sums})

    return digest


def _copier(spark: SparkSession, block: int = BLOCK_BYTES):
    """The copying task: byte-exact, streamed in blocks."""
    open_uri = _opener(spark)

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = []
            for source, target in zip(batch["source"], batch["target"]):
                source_fs, source_path = open_uri(source)
                target_fs, target_path = open_uri(target)
                folder = target_path.rsplit("/", 1)[0]
                target_fs.create_dir(folder, recursive=True)
                # Renamed when whole: a retried task never leaves half a file.
                partial = f"{folder}/.{uuid.uuid4().hex}.part"
                with source_fs.open_input_stream(source_path) as reader:
                    with target_fs.open_output_stream(partial) as writer:
                        size = 0
                        while part := reader.read(block):
                            writer.write(part)
                            size += len(part)
                target_fs.move(partial, target_path)
                sizes.append(size)
            yield pd.DataFrame({"archive_key": batch["archive_key"], "length": sizes})

    return copy


def archived_files(spark: SparkSession, root: str, digests: bool = False) -> DataFrame:
    """Files below an archive root with ``relative_path`` and ``archive_key``, the folder they form."""
    files = file_digests(spark, root) if digests else list_files(spark, root)
    relative = archive_path(F.col("path"), root)
    return files.withColumns(
        {"relative_path": relative, "archive_key": F.regexp_replace(relative, "/[^/]*$", "")}
    )


def archive_path(uri: Column, root: str) -> Column:
    """A location relative to a root. Spark may list file:/x for file:///x, so schemes are left out."""
    start = len(_bare(root.rstrip("/"))) + 2
    plain = F.regexp_replace(uri, "^[a-z0-9]+:/*", "/")
    return F.substring(plain, F.lit(start), F.length(plain))


def _bare(root: str) -> str:
    return "/" + root.split(":", 1)[1].lstrip("/") if "://" in root else root


def resolved(spark: SparkSession, path: str) -> str:
    """A location as a URI; without a scheme it lies in the cluster's default file system.

    That is the one Hadoop is set up with, in its own files or by Spark's settings.
    """
    if "://" in path:
        return path.rstrip("/")
    if not path.startswith("file:"):
        path = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").rstrip("/") + "/" + path.strip("/")
    return "file:///" + path.removeprefix("file:").strip("/") if path.startswith("file:") else path


def ensure_folder(spark: SparkSession, path: str) -> str:
    """Create a folder if needed; returns it as a URI."""
    uri = resolved(spark, path)
    target_fs, folder = _opener(spark)(uri)
    target_fs.create_dir(folder, recursive=True)
    return uri


def missing_files(spark: SparkSession, source: str, dest: str, only: DataFrame | None = None) -> DataFrame:
    """Archived files whose relative path is absent below ``dest``.

    ``only`` limits them to the archives of its ``archive_key`` column.
    """
    archived = archived_files(spark, source)
    if only is not None:
        archived = archived.join(only.select("archive_key"), "archive_key", "left_semi")
    present = archived_files(spark, dest).select("relative_path")
    return archived.join(present, "relative_path", "left_anti")


def restore_archives(
    spark: SparkSession, source: str, dest: str, only: DataFrame | None = None
) -> dict[str, int]:
    """Copy the archived files that are absent below ``dest``; files stay byte-identical.

    Every task streams its own files; nothing passes through the driver.
    """
    target = ensure_folder(spark, dest)
    to_uri = F.when(F.col("path").startswith("file:"), F.regexp_replace("path", "^file:/*", "file:///"))
    work = missing_files(spark, source, dest, only).select(
        F.coalesce(to_uri, F.col("path")).alias("source"),
        F.concat_ws("/", F.lit(target), "relative_path").alias("target"),
        "archive_key",
    )
    copied = (
        # A fixed number of partitions: AQE would merge these few short rows into one task.
        work.repartition(spark.sparkContext.defaultParallelism, "source")
        .mapInPandas(_copier(spark), "archive_key string, length bigint")
        .groupBy("archive_key")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        .agg(
            F.count("*").alias("archives"),
            F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        )
        .first()
    )
    return copied.asDict()
