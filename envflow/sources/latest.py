"""The newest row of every key, in hash buckets.

A step merges the source rows since the last step into the buckets that these rows' keys fall into;
the other buckets' files stay as they are. A lookup reads the buckets of its keys only. Buckets are the
partitions of a snapshot table, so a reader sees the table before or after a step, and a step that
is run again changes nothing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_per_entity
from ..operators.features import online_lookup
from ..session import materialize
from .snapshots import SnapshotTable

BUCKET = "bucket"
#: Keys of a bucket that a new table is laid out for, and the range of its bucket count.
BUCKET_KEYS, LEAST_BUCKETS, MOST_BUCKETS = 1_000_000, 16, 8192


class LatestTable:
    """``path`` holds for every ``key`` the row that is newest by ``order``; ``ts`` is its event time."""

    def __init__(self, spark: SparkSession, path: str, key: str, ts: str, order: list[str]):
        self.spark, self.key, self.ts, self.order = spark, key, ts, order
        self.table = SnapshotTable(spark, path, [BUCKET])

    def _notes(self) -> dict:
        return (self.table.pointer() or {"notes": {}})["notes"]

    def bucket(self, key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def step(self, source: DataFrame, end: str, buckets: int | None = None) -> int | None:
        """Merge the rows of ``source`` with a time in ``(last end, end]``; the new version, or None if the table is
        as far already or no row is new. The number of buckets is fixed by the first step."""
        notes = self._notes()
        last, upto = notes.get("end"), F.lit(end).cast("timestamp_ntz")
        since = F.lit(last).cast("timestamp_ntz")
        if last and datetime.fromisoformat(last) >= datetime.fromisoformat(end):
            return None
        rows = source.filter(F.col(self.ts) <= upto).filter(F.col(self.key).isNotNull())
        new = materialize(latest_per_entity(rows.filter(F.col(self.ts) > since) if last else rows, self.key, self.order))
        buckets = notes.get("buckets") or buckets or self._buckets_for(new)
        new = new.withColumn(BUCKET, self.bucket(F.col(self.key), buckets))
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # MOST_BUCKETS at most
        if not touched:
            return None

        def merged(old: DataFrame | None) -> tuple[DataFrame, None]:
            if old is None:
                return new, None
            both = old.filter(F.col(BUCKET).isin(touched)).select(*new.columns).unionByName(new)
            return latest_per_entity(both, self.key, self.order), None

        return self.table.change(merged, notes={"end": end, "buckets": buckets})

    def _buckets_for(self, new: DataFrame) -> int:
        return min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-new.count() // BUCKET_KEYS)))

    def read(self, version: int | None = None) -> DataFrame:
        return self.table.read(version).drop(BUCKET)

    def of_keys(self, keys: DataFrame, key_col: str) -> DataFrame:
        """The table's rows in the buckets of ``keys``."""
        buckets = self._notes()["buckets"]
        wanted = [r[0] for r in keys.filter(F.col(key_col).isNotNull()).select(self.bucket(F.col(key_col).cast(self._key_type()), buckets)).distinct().collect()]
        return self.table.read().filter(F.col(BUCKET).isin(wanted)).drop(BUCKET)

    def _key_type(self):
        return self.table.read().schema[self.key].dataType

    def lookup(self, keys: DataFrame, feature_cols: list[str], now: str, ttl_seconds: int, key_col: str | None = None) -> DataFrame:
        """Current features of ``keys``: missing or expired -> null."""
        kc = key_col or self.key
        return online_lookup(keys, self.of_keys(keys, kc), self.key, self.ts, feature_cols, now, ttl_seconds, key_col=kc)
