"""Incremental runs: Structured Streaming over landed raw files with a
latest-wins upsert into the curated table, incremental feature
materialization, and drift per micro-batch.

The upsert needs no table format with MERGE: for each micro-batch the
affected (city, date) partitions are read back, unioned with the batch and
deduplicated, and become the next version of a snapshot table
(:mod:`envflow.sources.snapshots`). Readers see the version before or the one after, and
a batch that is run again after a failure is known by its stream's id and number.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DriftSpec
from ..operators.counts import KEY, value_counts
from ..operators.drift import drift_columns, drift_of_counts
from ..operators.enrich import checked_broadcast
from ..operators.flatten import flatten_with_rejects
from ..plans.curated import CURATED_KEYS, CURATED_ORDER, add_quality_label, deduplicate
from ..schemas import CORRUPT, CURATED_COLUMNS, RAW_OR_CORRUPT
from ..sources.latest import LatestTable
from ..sources.snapshots import SnapshotTable, path_exists

PARTS = ["city", "date"]


def curated_snapshots(spark: SparkSession, table_path: str) -> SnapshotTable:
    return SnapshotTable(spark, table_path, PARTS)


def affected_partitions(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The table's rows in the (city, date) partitions that ``rows`` touch. The batch's first
    and last date are literals on the scan, so that other dates' folders are never listed
    as input, and a size-checked broadcast semi-join keeps only the touched folders."""
    lo, hi = rows.agg(F.min("date"), F.max("date")).first()
    between = F.col("date").between(F.lit(lo), F.lit(hi))
    touched = rows.select(*PARTS).distinct().filter(between)
    return table.filter(between).join(checked_broadcast(touched), PARTS, "left_semi")


def upsert_latest(spark: SparkSession, batch: DataFrame, table_path: str, run: str, batch_id: int) -> int | None:
    """Merge curated rows into a (city, date)-partitioned snapshot table, newest
    version per (city, timestamp) wins. ``run`` names who writes (a stream's id): a batch that it
    has written already is left out. Returns the new version, or None."""
    # the batch is read by the date bounds, the size check and the merge:
    # keep it (a lost block is recomputed from the batch's files)
    rows = batch.withColumn("date", F.to_date("timestamp")).persist(StorageLevel.MEMORY_AND_DISK)

    def merged(table: DataFrame | None) -> tuple[DataFrame, None]:
        both = rows if table is None else rows.unionByName(affected_partitions(rows, table).select(*rows.columns))
        return deduplicate(both, CURATED_KEYS, CURATED_ORDER), None

    try:
        return None if rows.isEmpty() else curated_snapshots(spark, table_path).change(merged, run, batch_id)
    finally:
        rows.unpersist()


def curate_batch(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Micro-batch body: (labelled rows, rejects). The newest-wins dedup runs
    once, in :func:`upsert_latest`, over the batch and the affected partitions
    together (a dedup here as well would be a second shuffle)."""
    rows = flatten_with_rejects(raw)
    good = rows.filter(F.col("reject_reason").isNull())
    return add_quality_label(good).select(*CURATED_COLUMNS, "fetch_timestamp", "pos"), rows.filter(F.col("reject_reason").isNotNull())


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave to the stream of a checkpoint folder."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def start_curated_stream(
    spark: SparkSession,
    raw_path: str,
    table_path: str,
    checkpoint: str,
    multi_line: bool = False,
    max_files_per_trigger: int | None = 10000,
    reject_path: str | None = None,
) -> StreamingQuery:
    """Pick up new raw files and upsert them; ``availableNow`` drains what is
    there and stops, so schedulers can run it like a batch job. A backfill is
    cut into micro-batches of at most ``max_files_per_trigger`` files. Rejected rows
    and corrupt documents go to ``reject_path`` (``<table_path>_rejects``), a folder per
    stream and batch, so a batch that is run again writes the same folder, and another
    stream (a new checkpoint has a new id) another one."""
    reject_path = reject_path or f"{table_path.rstrip('/')}_rejects"
    reader = spark.readStream.schema(RAW_OR_CORRUPT).option("multiLine", multi_line).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(raw_path)

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        good, rejects = curate_batch(batch_df)
        run = stream_id(spark, checkpoint)
        rejects.write.mode("overwrite").parquet(f"{reject_path}/run={run}/batch={batch_id}")
        upsert_latest(spark, good, table_path, run, batch_id)

    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_upserted(spark: SparkSession, table_path: str) -> DataFrame:
    return curated_snapshots(spark, table_path).read().select(*CURATED_COLUMNS, "fetch_timestamp")


# ------------------------------------------------------------------ features
def materialize_step(spark: SparkSession, source: DataFrame, key: str, ts: str, order: list[str], end: str, table_path: str) -> LatestTable:
    """One incremental materialization ``(last end, end]`` into the bucketed latest-per-entity table at ``table_path``."""
    table = LatestTable(spark, table_path, key, ts, order)
    table.step(source, end)
    return table


# ------------------------------------------------------------------ drift
def start_drift_stream(
    spark: SparkSession,
    current_path: str,
    schema,
    reference: DataFrame,
    log_path: str,
    checkpoint: str,
    spec: DriftSpec = DriftSpec(),
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Drift of every micro-batch of current rows against a fixed reference;
    results are appended to a log table keyed by batch id. A micro-batch is what
    has landed since the last run, however the writer cut its files.

    The reference is read once in the stream's life: its value counts are stored under
    ``<checkpoint>_reference``, and a micro-batch reads these and its own rows only. ``reference`` may
    be value counts already (:meth:`DailyStatistics.counts`, any range of days)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(current_path)
    stored = f"{checkpoint.rstrip('/')}_reference"
    if set(KEY) <= set(reference.columns):
        have = {(r[0], r[1]) for r in reference.select("kind", "feature").distinct().collect()}  # a row per column
        num = [c for c in spec.numerical if ("num", c) in have and c in stream.columns]
        cat = [c for c in spec.categorical if ("cat", c) in have and c in stream.columns]
    else:
        num, cat = drift_columns(spec, reference, stream)
        reference = value_counts(reference, num, cat)
    if not path_exists(spark, f"{stored}/_SUCCESS"):
        reference.write.mode("overwrite").parquet(stored)

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.isEmpty():
            return
        d = drift_of_counts(spark.read.parquet(stored), value_counts(batch_df, num, cat), num, cat, spec).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        # idempotent per batch id: a retried batch overwrites its own partition
        d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(log_path)

    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# ------------------------------------------------------------------ first-wins variant
def first_wins(stream: DataFrame, keys: list[str], event_ts: str, watermark: str = "1 day") -> DataFrame:
    """Streaming dedup where the *first* arrival of a key wins (late copies
    inside the watermark are dropped, state older than it is evicted).

    This is Spark's built-in ``dropDuplicatesWithinWatermark``; it cannot
    express latest-wins, which is what :func:`upsert_latest` is for.
    """
    return stream.withWatermark(event_ts, watermark).dropDuplicatesWithinWatermark(keys)
