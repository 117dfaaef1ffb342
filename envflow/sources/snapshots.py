"""Snapshot-isolated tables on plain Parquet: a version is a list of folders, and a pointer to it.

::

    data/commit=<id>/<partition folders>/part-*.parquet   written once, never changed
    manifests/<id>/part-*.parquet                         the live (partition, commit) pairs of a version
    versions/<number>                                     the pointer, put in its place last

A write puts its rows into a new commit folder and the pairs of the next version into a manifest, and
then renames the pointer into place, which fails if that version is there already. A reader takes one pointer
and sees that version whole, whatever is written or breaks off meanwhile; an unfinished commit is a folder that
no version names. Of two writers that start from one version the second gets a ``Conflict`` and
starts anew from the first one's result.

A pointer also tells the last batch of every run (a stream's checkpoint has an id), so that
a batch which is written again after a crash changes nothing, and no run is taken for another; and a
few notes of the table's owner.

Partition values must not be null (an error at the write).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.enrich import checked_broadcast

COMMIT = "commit"
#: A file below half of this is small.
TARGET_BYTES = 256 << 20
ATTEMPTS = 10


class Conflict(Exception):
    """Another writer has made the next version."""


def file_system(spark: SparkSession, path: str):
    """The Hadoop path and its file system (any URI that Spark reads)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = file_system(spark, path)
    return bool(fs.exists(p))


def drop_path(spark: SparkSession, path: str) -> None:
    p, fs = file_system(spark, path)
    fs.delete(p, True)


def put_new(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all; ``Conflict`` if it exists."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    folder, name = path.rsplit("/", 1)
    to, fs = file_system(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(rename, 1)
    how[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(to), how)
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(e):
            raise Conflict(path) from e
        raise


class SnapshotTable:
    """A table of versions under ``path``, partitioned by ``parts``."""

    def __init__(self, spark: SparkSession, path: str, parts: list[str]):
        self.spark, self.path, self.parts = spark, path.rstrip("/"), list(parts)

    # ------------------------------------------------------------ versions
    def versions(self) -> list[int]:
        p, fs = file_system(self.spark, f"{self.path}/versions")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n) for n in names if n.isdigit())

    def pointer(self, version: int | None = None) -> dict | None:
        """What a version (by default the newest) consists of; None if there is none."""
        there = self.versions()
        if version is None:
            if not there:
                return None
            version = there[-1]
        elif version not in there:
            raise ValueError(f"{self.path} has no version {version}")
        p, fs = file_system(self.spark, f"{self.path}/versions/{version:020d}")
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def manifest(self, version: int | None = None) -> DataFrame:
        """The live pairs of a version: partition columns, ``commit``, ``files``, ``bytes``, ``rows``."""
        return self._manifest(self.pointer(version))

    def _manifest(self, pointer: dict) -> DataFrame:
        kinds = {f.name: f for f in self._schema(pointer)}
        fields = [*[kinds[c] for c in (*self.parts, COMMIT)], *[T.StructField(c, T.LongType()) for c in ("files", "bytes", "rows")]]
        return self.spark.read.schema(T.StructType(fields)).parquet(f"{self.path}/manifests/{pointer['commit']}")

    # ------------------------------------------------------------ reading
    def _schema(self, pointer: dict) -> T.StructType:
        """The rows' columns as that version's writer had them (folder names alone do not tell their types)."""
        return T.StructType.fromJson(json.loads(pointer["schema"]))

    def _scan(self, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/data")

    def _of(self, pairs: DataFrame, schema: T.StructType) -> DataFrame:
        """The rows of (partition, commit) pairs; the pairs prune the folders of the scan while they
        are few enough to be broadcast."""
        keys = [*self.parts, COMMIT]
        return self._scan(schema).join(checked_broadcast(pairs.select(*keys)), keys, "left_semi")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of one version. Filters on the partition columns prune folders."""
        pointer = self.pointer(version)
        return self._of(self._manifest(pointer), self._schema(pointer)).drop(COMMIT)

    # ------------------------------------------------------------ writing
    def _written(self, rows: DataFrame, commit: str) -> DataFrame:
        """Write ``rows`` as a commit; its pairs. Rebalanced by partition: small ones share a task's file,
        a large one is split over tasks."""
        for c in self.parts:
            checked = F.when(F.col(c).isNull(), F.raise_error(F.lit(f"a null value of the partition column {c}"))).otherwise(F.col(c))
            rows = rows.withColumn(c, checked.cast(rows.schema[c].dataType))
        out = f"{self.path}/data/{COMMIT}={commit}"
        rows.hint("rebalance", *[F.col(c) for c in self.parts]).sortWithinPartitions(*self.parts).write.partitionBy(*self.parts).parquet(out)
        meta = F.col("_metadata")
        scan = self._scan(self._written_schema(rows)).where(F.col(COMMIT) == commit)
        files = scan.groupBy(*self.parts, COMMIT, meta["file_path"].alias("file"), meta["file_size"].alias("size")).agg(F.count("*").alias("rows"))
        return files.groupBy(*self.parts, COMMIT).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.sum("rows").alias("rows"))

    def _written_schema(self, rows: DataFrame) -> T.StructType:
        """``rows``' columns, nullable, with the partition columns and the commit last."""
        kinds = {f.name: T.StructField(f.name, f.dataType) for f in rows.schema if f.name != COMMIT}
        return T.StructType([*[f for c, f in kinds.items() if c not in self.parts], *[kinds[c] for c in self.parts], T.StructField(COMMIT, T.StringType())])

    def _publish(self, base: dict | None, commit: str, pairs: DataFrame, run: str | None, batch: int | None, notes: dict | None, schema: T.StructType) -> int:
        version = base["version"] + 1 if base else 1
        pairs.write.parquet(f"{self.path}/manifests/{commit}")
        runs = dict(base["runs"]) if base else {}
        if run is not None:
            runs[run] = batch
        notes = (dict(base["notes"]) if base else {}) | (notes or {})
        told = {"version": version, "commit": commit, "runs": runs, "notes": notes, "schema": schema.json(), "time": time.time()}
        put_new(self.spark, f"{self.path}/versions/{version:020d}", json.dumps(told))
        return version

    def change(
        self, make: Callable[[DataFrame | None], tuple[DataFrame, DataFrame | None]], run: str | None = None, batch: int | None = None, notes: dict | None = None
    ) -> int | None:
        """One new version, with ``notes`` added to those before. ``make`` gets the newest rows (None at first) and gives the rows to write and
        the pairs that go; without pairs, all those of the partitions that are written. On a conflict it is asked again.
        None if this batch of the run is in the table already."""
        for _ in range(ATTEMPTS):
            base = self.pointer()
            if base and run is not None and base["runs"].get(run, -1) >= batch:
                return None
            old = self._manifest(base) if base else None
            rows, gone = make(self._of(old, self._schema(base)) if base else None)
            commit = uuid.uuid4().hex
            fresh = self._written(rows, commit)
            if base:
                stays = old.join(fresh.select(*self.parts), self.parts, "left_anti") if gone is None else old.join(gone, [*self.parts, COMMIT], "left_anti")
                pairs = stays.select(*fresh.columns).unionByName(fresh)
            else:
                pairs = fresh
            try:
                return self._publish(base, commit, pairs, run, batch, notes, self._written_schema(rows))
            except Conflict:
                drop_path(self.spark, f"{self.path}/data/{COMMIT}={commit}")
                drop_path(self.spark, f"{self.path}/manifests/{commit}")
        raise Conflict(f"{self.path}: other writers came first {ATTEMPTS} times")

    def replace(self, rows: DataFrame, run: str | None = None, batch: int | None = None) -> int | None:
        """The partitions that ``rows`` has are replaced by them; others stay."""
        return self.change(lambda old: (rows, None), run, batch)

    def _no_pairs(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.parts, F.lit("").alias(COMMIT)).where("false")

    def append(self, rows: DataFrame, run: str | None = None, batch: int | None = None) -> int | None:
        """``rows`` are added."""
        return self.change(lambda old: (rows, self._no_pairs(rows)), run, batch)

    # ------------------------------------------------------------ upkeep
    def small_pairs(self, target_bytes: int = TARGET_BYTES) -> DataFrame:
        """The file plan of a compaction: pairs whose files are small, in partitions that have two such files or more."""
        pairs = self.manifest().where(F.col("bytes") < F.col("files") * F.lit(target_bytes / 2))
        many = pairs.groupBy(*self.parts).agg(F.sum("files").alias("_files")).where("_files > 1").drop("_files")
        return pairs.join(many, self.parts, "left_semi")

    def compact(self, target_bytes: int = TARGET_BYTES) -> int | None:
        """Rewrite the small files of each partition together, as a new version with the same rows; large files and
        partitions with one small file are not touched. None if there is nothing to do."""
        if not self.versions():
            return None
        plan = self.small_pairs(target_bytes)
        if plan.isEmpty():
            return None

        def rewrite(old: DataFrame) -> tuple[DataFrame, DataFrame]:
            pairs = self.small_pairs(target_bytes).select(*self.parts, COMMIT)
            return old.join(checked_broadcast(pairs), [*self.parts, COMMIT], "left_semi").drop(COMMIT), pairs

        return self.change(rewrite)

    def vacuum(self, keep: int = 2, older_than_seconds: float = 7 * 86400) -> int:
        """Delete what none of the last ``keep`` versions names: their pointers, manifests and commits, and commits that
        never became a version. Commits younger than ``older_than_seconds`` stay, since a writer may be about to name
        them. Returns the number of commits deleted."""
        there = self.versions()
        kept = [self.pointer(v)["commit"] for v in there[-keep:]]
        for v in there[:-keep]:
            drop_path(self.spark, f"{self.path}/versions/{v:020d}")
        live = set()
        for commit in kept:  # one row per commit that the version still has rows of
            live |= {r[0] for r in self.spark.read.parquet(f"{self.path}/manifests/{commit}").select(COMMIT).distinct().collect()}
        p, fs = file_system(self.spark, f"{self.path}/data")
        before, gone = (time.time() - older_than_seconds) * 1000, 0
        for s in fs.listStatus(p) if there else []:
            commit = s.getPath().getName().partition("=")[2]
            if commit and commit not in live and s.getModificationTime() <= before:
                drop_path(self.spark, f"{self.path}/data/{COMMIT}={commit}")
                gone += 1
        p, fs = file_system(self.spark, f"{self.path}/manifests")
        for s in fs.listStatus(p) if there else []:
            if s.getPath().getName() not in kept and s.getModificationTime() <= before:
                drop_path(self.spark, f"{self.path}/manifests/{s.getPath().getName()}")
        return gone
