"""Descriptive statistics and data-quality metrics, all as aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import exact_quantiles


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def label_shares(df: DataFrame, label: str) -> DataFrame:
    """Share of each non-null value; the total is a one-row aggregate joined
    back (broadcast), never a window without partition keys."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    # one-row total, broadcast: the counts side stays parallel (no single-task window)
    return counts.crossJoin(F.broadcast(total)).select(label, F.try_divide(F.col("n"), F.col("_total")).alias("share"))


def to_long(df: DataFrame, columns: list[str], cast: str = "double", ids: list[str] = ()) -> DataFrame:
    """Wide -> (ids..., feature, value) with one value type."""
    typed = df.select(*ids, *[F.col(c).cast(cast).alias(c) for c in columns])
    return typed.unpivot(list(ids), columns, "feature", "value")


def reference_stats(df: DataFrame, features: list[str], exact_median: bool = True) -> DataFrame:
    """Per feature: row count, mean, sample std, min, max, median (nulls and
    NaN skipped). The median is exact and distributed (running totals over
    distinct values); ``exact_median=False`` uses ``percentile_approx``."""
    long = to_long(df, features).withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    # unpivot keeps null values, so the per-feature row count is the table's row count
    base = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *([] if exact_median else [F.percentile_approx("value", 0.5, 100000).alias("median")]),
    )
    if exact_median:
        med = exact_quantiles(long, ["feature"], "value", [0.5]).withColumnRenamed("q_0", "median")
        base = base.join(med, "feature", "left")
    return base


def duplicate_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: by how many rows ``df`` exceeds its distinct rows in ``columns`` (NaN is a missing value)."""
    floats = [c for c in columns if df.schema[c].dataType.typeName() in ("float", "double")]
    df = df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in floats else F.col(c) for c in columns])
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_k")).agg(F.sum(F.col("_k") - 1).alias("duplicate_rows"))


def data_quality(df: DataFrame, numeric: list[str], categorical: list[str] = (), approx_distinct: bool = False) -> DataFrame:
    """Per column: rows, nulls, null share, distinct, min/max/mean (numeric),
    most-common-value share, constant / all-null flags, and the table's
    duplicate-row count. One long pre-aggregation per (column, value)."""
    cols = list(numeric) + list(categorical)
    # NaN is a missing value
    floats = [c for c in numeric if df.schema[c].dataType.typeName() in ("float", "double")]
    df = df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in floats else F.col(c) for c in cols])
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(c).cast("string").alias("sval"),
                        (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("dval"),
                    )
                    for c in cols
                ]
            )
        ).alias("x")
    ).select("x.*")
    per_value = long.groupBy("column", "sval").agg(
        F.count(F.lit(1)).alias("n"), F.min("dval").alias("dmin"), F.max("dval").alias("dmax"), F.sum("dval").alias("dsum")
    )
    nn = F.col("sval").isNotNull()
    summary = per_value.groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(~nn, F.col("n")).otherwise(0)).alias("n_null"),
        F.count(F.when(nn, F.lit(1))).alias("n_distinct"),
        F.min("dmin").alias("min"),
        F.max("dmax").alias("max"),
        F.try_divide(F.sum("dsum"), F.sum(F.when(nn, F.col("n")))).alias("mean"),
        F.max(F.when(nn, F.col("n"))).alias("_top"),
    )
    if approx_distinct:
        approx = long.groupBy("column").agg(F.approx_count_distinct("sval").alias("_ad"))
        summary = summary.join(approx, "column").withColumn("n_distinct", F.col("_ad")).drop("_ad")
    if approx_distinct:
        # rows minus approximate distinct row hashes: one pass, no shuffle of full rows
        dups = df.agg(
            F.greatest(F.count(F.lit(1)) - F.approx_count_distinct(F.xxhash64(*cols)), F.lit(0)).alias("duplicate_rows")
        )
    else:
        dups = duplicate_rows(df, cols)
    nonnull = F.col("n_rows") - F.col("n_null")
    # dups is a one-row table-level aggregate, broadcast onto the per-column rows
    return summary.crossJoin(F.broadcast(dups)).select(
        "column",
        "n_rows",
        "n_null",
        F.try_divide(F.col("n_null"), F.col("n_rows")).alias("null_share"),
        "n_distinct",
        "min",
        "max",
        "mean",
        F.try_divide(F.col("_top"), nonnull).alias("most_common_share"),
        (F.col("n_distinct") <= 1).alias("is_constant"),
        (nonnull == 0).alias("all_null"),
        "duplicate_rows",
    )


def payload_summary(raw: DataFrame, time_field: str = "hourly.time", by: str = "city_name") -> DataFrame:
    """Per city: docs, hours, first and last sample time (``try_element_at``
    so empty arrays give null instead of an error)."""
    t = F.col(time_field)
    return raw.groupBy(by).agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.coalesce(F.size(t), F.lit(0))).cast("bigint").alias("hours"),
        F.min(F.try_element_at(t, F.lit(1))).alias("first_time"),
        F.max(F.try_element_at(t, F.lit(-1))).alias("last_time"),
    )


def ingest_summary(df: DataFrame, by: str, ts: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("records"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def ingest_runs(df: DataFrame, by: str, ts: str, source: str, path: str, run_at: str) -> DataFrame:
    """The run summary as rows of the runs table: one run per ``by`` value, with source, path and run time, the number of
    records, and the first and last time of the data as parameters."""
    text = F.col("first_ts").cast("string"), F.col("last_ts").cast("string")
    params = F.create_map(F.lit("source"), F.lit(source), F.lit("path"), F.lit(path), F.lit("first_ts"), text[0], F.lit("last_ts"), text[1])
    return ingest_summary(df, by, ts).select(
        F.concat(F.lit("ingest_"), F.coalesce(F.col(by).cast("string"), F.lit("unknown"))).alias("run_name"),
        F.lit(run_at).cast("timestamp_ntz").alias("logged_at"),
        params.alias("params"),
        F.create_map(F.lit("records"), F.col("records").cast("double")).alias("metrics"),
    )
