"""Value counts: statistics that can be stored and added up.

One row per (kind, column, value) with the number of rows that hold it; nulls (and NaN) have a row of their own.
Counts of two sets of rows add up to the counts of both, so they are kept per day in a snapshot table and
merged for any range of days; drift, quality and quantiles are computed from counts alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.snapshots import SnapshotTable

KEY = ["kind", "feature", "num", "cat"]


def value_counts(df: DataFrame, numeric: list[str], categorical: list[str] = (), by: list[str] = ()) -> DataFrame:
    """``by..., kind, feature, num, cat, n`` in one pass over ``df``; ``kind`` is ``num`` or ``cat``."""
    none_num, none_cat = F.lit(None).cast("double"), F.lit(None).cast("string")
    cells = []
    for c in numeric:
        v = F.col(c).cast("double")
        cells.append(F.struct(F.lit("num").alias("kind"), F.lit(c).alias("feature"), F.when(~F.isnan(v), v).alias("num"), none_cat.alias("cat")))
    for c in categorical:
        cells.append(F.struct(F.lit("cat").alias("kind"), F.lit(c).alias("feature"), none_num.alias("num"), F.col(c).cast("string").alias("cat")))
    long = df.select(*by, F.inline(F.array(*cells)))
    return long.groupBy(*by, *KEY).agg(F.count(F.lit(1)).alias("n"))


def merged(counts: DataFrame) -> DataFrame:
    """Counts of several sets of rows as counts of all."""
    return counts.groupBy(*KEY).agg(F.sum("n").alias("n"))


def paired(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """``kind, feature, num, cat, c_ref, c_cur``, written once."""
    zero = F.lit(0).cast("bigint")
    both = ref.select(*KEY, F.col("n").alias("r"), zero.alias("c")).unionByName(cur.select(*KEY, zero.alias("r"), F.col("n").alias("c")))
    return materialize(both.groupBy(*KEY).agg(F.sum("r").alias("c_ref"), F.sum("c").alias("c_cur")))


def quality(counts: DataFrame) -> DataFrame:
    """Per column: ``n_rows, n_null, null_share, n_distinct, min, max, mean, most_common_share, is_constant, all_null``."""
    there = (F.col("num").isNotNull()) | (F.col("cat").isNotNull())
    n = F.when(there, F.col("n"))
    q = counts.groupBy(F.col("feature").alias("column")).agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(~there, F.col("n"))), F.lit(0)).alias("n_null"),
        F.count(n).alias("n_distinct"),
        F.min("num").alias("min"),
        F.max("num").alias("max"),
        F.try_divide(F.sum(F.col("num") * F.col("n")), F.sum(n)).alias("mean"),
        F.max(n).alias("_top"),
    )
    full = F.col("n_rows") - F.col("n_null")
    return q.select(
        "column", "n_rows", "n_null", F.try_divide("n_null", "n_rows").alias("null_share"), "n_distinct", "min", "max", "mean",
        F.try_divide(F.col("_top"), full).alias("most_common_share"), (F.col("n_distinct") <= 1).alias("is_constant"), (full == 0).alias("all_null"),
    )


class DailyStatistics:
    """Counts, and sketches of distinct values, per day of a table, in a snapshot table under ``path``.

    ``update`` replaces the days of the rows it is given; ``counts`` and ``distinct`` merge any
    range of days without reading a row of the table again.
    """

    def __init__(self, spark: SparkSession, path: str, numeric: list[str], categorical: list[str] = ()):
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.table = SnapshotTable(spark, f"{path.rstrip('/')}/counts", ["day"])
        self.sketches = SnapshotTable(spark, f"{path.rstrip('/')}/sketches", ["day"])

    def update(self, rows: DataFrame, ts: str) -> None:
        """The statistics of the days that ``rows`` has; these must be all rows of their days. Rows without a time are of day ``none``."""
        day = F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit("none")).alias("day")
        counts = materialize(value_counts(rows.withColumn("day", day), self.numeric, self.categorical, ["day"]))
        self.table.replace(counts)
        value = F.coalesce(F.col("num").cast("string"), F.col("cat"))
        self.sketches.replace(counts.filter(value.isNotNull()).groupBy("day", "feature").agg(F.hll_sketch_agg(value).alias("sketch")))

    def _between(self, table: SnapshotTable, first: str | None, last: str | None) -> DataFrame:
        rows = table.read()
        if first is not None:
            rows = rows.filter(F.col("day") >= first)
        return rows if last is None else rows.filter(F.col("day") <= last)

    def counts(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Counts of the days from ``first`` to ``last`` (both included)."""
        return merged(self._between(self.table, first, last))

    def distinct(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """``feature, n_distinct``: estimates (HyperLogLog) from the merged sketches."""
        rows = self._between(self.sketches, first, last)
        return rows.groupBy("feature").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
