"""Curated Parquet table: partitioned by city, dynamic partition overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_curated(df: DataFrame, path: str, partition_by: str | list[str] = "city") -> str:
    """Overwrite only the partitions present in ``df`` (other cities stay).

    Rows are rebalanced by the partition columns: a small city is one task's file, a city
    with a third of all rows is split over tasks of about the advisory partition size,
    so there are no tasks x cities files. (Spark plans this with adaptive execution on.)
    """
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    (
        df.hint("rebalance", *[F.col(c) for c in parts])
        .sortWithinPartitions(*parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )
    return path


def read_curated(spark: SparkSession, path: str, columns: list[str] | None = None, where=None, strings: tuple = ("city",)) -> DataFrame:
    """Scan with pruning: a filter on ``city`` becomes a partition filter,
    other predicates are pushed into the Parquet reader.

    The ``strings`` partition columns are read as strings: folder names that look
    like numbers would otherwise come back as numbers.
    """
    schema = spark.read.parquet(path).schema
    typed = T.StructType([T.StructField(f.name, T.StringType()) if f.name in strings else f for f in schema])
    df = spark.read.schema(typed).parquet(path)
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    return df


def snapshot_manifest(df: DataFrame, value_columns: list[str] | None = None):
    """Version pointer of a file-based table (raw or curated), computed by Spark.

    Returns (files, dataset): per-file rows/size/modification time from the
    hidden ``_metadata`` column, and one dataset row with file count, bytes,
    rows and an order-independent content hash: the sum of the row hashes as a
    decimal, so that repeated rows count.
    """
    cols = value_columns or [c for c in df.columns if not c.startswith("_")]
    meta = F.col("_metadata")
    # maps have no hash: their JSON text stands for them
    hashed = [F.to_json(c) if "map<" in df.schema[c].dataType.simpleString() else F.col(c) for c in cols]
    files = (
        df.select(
            meta["file_path"].alias("file_path"),
            meta["file_size"].alias("file_size"),
            meta["file_modification_time"].alias("modified"),
            F.xxhash64(*hashed).cast("decimal(38,0)").alias("h"),
        )
        .groupBy("file_path", "file_size", "modified")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("h").alias("content_hash"))
    )
    dataset = files.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_size").alias("bytes"),
        F.sum("rows").alias("rows"),
        F.sum("content_hash").alias("content_hash"),
    )
    return files, dataset


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """``file_path, file_size, modified`` of the files under ``path``; no content is read."""
    meta = F.col("_metadata")
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select(meta["file_path"].alias("file_path"), meta["file_size"].alias("file_size"), meta["file_modification_time"].alias("modified"))


FILE_KEY = ["file_path", "file_size", "modified"]


def manifest_by_difference(spark: SparkSession, path: str, previous: DataFrame | None = None, pattern: str = "*.parquet", scan=None) -> DataFrame:
    """The per-file manifest of the table at ``path``. Files that ``previous`` has with the same path, size and time keep
    their row count and hash; only the others are read: the least time among them is a
    filter on the scan's files, which prunes before anything is opened. ``scan`` reads the folder (Parquet by default)."""
    now = list_files(spark, path, pattern)
    known = None if previous is None else now.join(previous.select(*FILE_KEY, "rows", "content_hash"), FILE_KEY)
    fresh = now if previous is None else now.join(previous.select(*FILE_KEY), FILE_KEY, "left_anti")
    since = fresh.agg(F.min("modified")).first()[0]
    if since is None:
        return now.select(*FILE_KEY, F.lit(0).cast("bigint").alias("rows"), F.lit(None).cast("decimal(38,0)").alias("content_hash")).limit(0) if known is None else known
    rows = scan(path) if scan else spark.read.option("recursiveFileLookup", "true").parquet(path)
    hashed, _ = snapshot_manifest(rows.where(F.col("_metadata.file_modification_time") >= F.lit(since)))
    # a file without rows is in no group of the scan
    fresh = fresh.join(hashed.select("file_path", "rows", "content_hash"), "file_path", "left")
    fresh = fresh.select(*FILE_KEY, F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), F.col("content_hash").cast("decimal(38,0)").alias("content_hash"))
    return fresh if known is None else known.select(*fresh.columns).unionByName(fresh)


def manifest_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """``file_path, status, rows_before, rows_after``: files that were added, removed, changed, or are unchanged
    (the same rows, even if written anew)."""
    a = before.select("file_path", F.col("rows").alias("rows_before"), F.struct("rows", "content_hash").alias("a"))
    b = after.select("file_path", F.col("rows").alias("rows_after"), F.struct("rows", "content_hash").alias("b"))
    status = (
        F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed")
        .when(F.col("a").eqNullSafe(F.col("b")), "unchanged").otherwise("changed")
    )
    return a.join(b, "file_path", "full").select("file_path", status.alias("status"), "rows_before", "rows_after")
