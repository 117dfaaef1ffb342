"""Monitoring: drift report, data-quality checks and a pass/fail test suite
for a current table against a reference table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FEATURES, TARGET, DriftSpec
from ..operators.counts import quality, value_counts
from ..operators.drift import drift_dataset, drift_features, drift_of_counts, target_drift
from ..operators.prep import available
from ..operators.stats import data_quality, duplicate_rows
from ..session import materialize

# relative tolerance of the quality tests against the reference
QUALITY_TOLERANCE = 0.1


def detect_drift(reference: DataFrame, current: DataFrame, spec: DriftSpec = DriftSpec()):
    """(dataset verdict, per-feature rows) for the numeric features present."""
    feats = drift_features(reference, current, spec)
    return drift_dataset(feats, spec.dataset_share), feats


def quick_drift_check(reference: DataFrame, current: DataFrame, spec: DriftSpec = DriftSpec()) -> DataFrame:
    return detect_drift(reference, current, spec)[0]


#: What the tests of a suite say.
DESCRIPTIONS = {
    "column_drift": "The distribution of the column has not drifted from the reference.",
    "share_of_missing_values": "The share of missing values is not above the reference's by more than the tolerance.",
    "most_common_value_share": "The share of the most common value is not above the reference's by more than the tolerance.",
    "share_of_drifted_columns": "Fewer than half of the columns have drifted.",
    "number_of_constant_columns": "No more columns are constant than in the reference.",
    "number_of_duplicated_rows": "No more rows are repeated than in the reference, within the tolerance.",
    "number_of_rows": "The table has rows.",
}


def run_tests(
    reference: DataFrame,
    current: DataFrame,
    numeric: list[str] = FEATURES,
    target: str | None = TARGET,
    spec: DriftSpec | None = None,
    tolerance: float = QUALITY_TOLERANCE,
) -> DataFrame:
    """Named and described tests with SUCCESS/FAIL status (all columns incl. the target).

    Per column: drift, share of missing values and most-common-value share
    (current within ``1 + tolerance`` of reference). Per table: share of
    drifted columns, constant columns, duplicated rows, non-empty.
    """
    num = available(list(numeric), current)
    num = [c for c in num if c in reference.columns]
    cat = [target] if target and target in current.columns and target in reference.columns else []
    spec = spec or DriftSpec(numerical=tuple(num), categorical=tuple(cat))
    # one pass over each side gives the counts that drift and quality are computed from
    rc, cc = (materialize(value_counts(side, num, cat)) for side in (reference, current))
    # tiny (one row per column) and read twice below: compute it once
    drift = materialize(drift_of_counts(rc, cc, num, cat, spec))
    col_drift = drift.select(
        F.lit("column_drift").alias("name"),
        F.col("feature").alias("column"),
        F.col("drift_score").alias("value"),
        F.col("threshold").alias("bound"),
        F.when(F.col("drift_detected"), F.lit("FAIL")).otherwise(F.lit("SUCCESS")).alias("status"),
    )
    columns = [*num, *cat]
    qr = quality(rc).crossJoin(F.broadcast(duplicate_rows(reference, columns)))  # one row
    qc = quality(cc).crossJoin(F.broadcast(duplicate_rows(current, columns)))
    qr = qr.select("column", *[F.col(c).alias(f"r_{c}") for c in qr.columns if c != "column"])
    qc = qc.select("column", *[F.col(c).alias(f"c_{c}") for c in qc.columns if c != "column"])
    # one row per column, read by three tests below: each side's quality
    # aggregation runs once instead of once per test
    q = materialize(qc.join(qr, "column"))
    lim = F.lit(1.0 + tolerance)
    missing = q.select(
        F.lit("share_of_missing_values").alias("name"),
        F.col("column"),
        F.col("c_null_share").alias("value"),
        (F.col("r_null_share") * lim).alias("bound"),
        F.when(F.col("c_null_share") <= F.col("r_null_share") * lim + F.lit(1e-12), "SUCCESS").otherwise("FAIL").alias("status"),
    )
    common = q.select(
        F.lit("most_common_value_share").alias("name"),
        F.col("column"),
        F.col("c_most_common_share").alias("value"),
        (F.col("r_most_common_share") * lim).alias("bound"),
        F.when(
            F.coalesce(F.col("c_most_common_share"), F.lit(0.0)) <= F.coalesce(F.col("r_most_common_share"), F.lit(0.0)) * lim + F.lit(1e-12),
            "SUCCESS",
        ).otherwise("FAIL").alias("status"),
    )
    dq = q.agg(
        F.sum(F.col("c_is_constant").cast("int")).cast("double").alias("c_const"),
        F.sum(F.col("r_is_constant").cast("int")).cast("double").alias("r_const"),
        F.first("c_duplicate_rows").cast("double").alias("c_dup"),
        F.first("r_duplicate_rows").cast("double").alias("r_dup"),
        F.first("c_n_rows").cast("double").alias("c_rows"),
    )
    dd = drift_dataset(drift, 0.5).select(F.col("drift_score").alias("share"))
    # both sides are single-row aggregates
    table_tests = dq.crossJoin(dd).select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("share_of_drifted_columns").alias("name"),
                    F.lit(None).cast("string").alias("column"),
                    F.col("share").alias("value"),
                    F.lit(0.5).alias("bound"),
                    F.when(F.col("share") < 0.5, "SUCCESS").otherwise("FAIL").alias("status"),
                ),
                F.struct(
                    F.lit("number_of_constant_columns").alias("name"),
                    F.lit(None).cast("string").alias("column"),
                    F.col("c_const").alias("value"),
                    F.col("r_const").alias("bound"),
                    F.when(F.col("c_const") <= F.col("r_const"), "SUCCESS").otherwise("FAIL").alias("status"),
                ),
                F.struct(
                    F.lit("number_of_duplicated_rows").alias("name"),
                    F.lit(None).cast("string").alias("column"),
                    F.col("c_dup").alias("value"),
                    (F.col("r_dup") * lim).alias("bound"),
                    F.when(F.col("c_dup") <= F.col("r_dup") * lim, "SUCCESS").otherwise("FAIL").alias("status"),
                ),
                F.struct(
                    F.lit("number_of_rows").alias("name"),
                    F.lit(None).cast("string").alias("column"),
                    F.col("c_rows").alias("value"),
                    F.lit(0.0).alias("bound"),
                    F.when(F.col("c_rows") > 0, "SUCCESS").otherwise("FAIL").alias("status"),
                ),
            )
        )
    )
    described = F.create_map(*[F.lit(x) for pair in DESCRIPTIONS.items() for x in pair])
    tests = col_drift.unionByName(missing).unionByName(common).unionByName(table_tests)
    return tests.withColumn("description", described[F.col("name")])


def summarize_tests(tests: DataFrame) -> DataFrame:
    """total / passed / failed / all_passed; anything but SUCCESS fails."""
    ok = F.col("status") == "SUCCESS"
    return tests.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("passed"),
        F.count_if(~ok).alias("failed"),
        F.coalesce(F.bool_and(ok), F.lit(True)).alias("all_passed"),
    )


@dataclass
class Report:
    report_id: str
    path: str


def write_report(
    spark: SparkSession,
    reference: DataFrame,
    current: DataFrame,
    base_path: str,
    report_id: str | None = None,
    numeric: list[str] = FEATURES,
    target: str | None = TARGET,
    include_quality: bool = True,
    include_target_drift: bool = True,
) -> Report:
    """Persist the report tables under ``{base}/<table>/report_id=<id>``; the id is
    ``drift_report_<UTC time>`` unless given. Drift is computed once for both of its tables."""
    report_id = report_id or f"drift_report_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}"
    num = [c for c in available(list(numeric), current) if c in reference.columns]
    spec = DriftSpec(numerical=tuple(num))
    feats = materialize(drift_features(reference, current, spec))
    dataset = drift_dataset(feats, spec.dataset_share).withColumn("generated_at", F.current_timestamp())
    tables = {"feature_drift": feats, "dataset_drift": dataset}
    if include_quality:
        tables["data_quality"] = data_quality(current, num, [])
    if include_target_drift and target and target in current.columns and target in reference.columns:
        tables["target_drift"] = target_drift(reference, current, target, spec)
    for name, t in tables.items():
        (
            t.withColumn("report_id", F.lit(report_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("report_id")
            .parquet(f"{base_path}/{name}")
        )
    return Report(report_id, base_path)
