"""Model artifacts, the artifact registry table and the run log table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import metric_key



def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def latest_artifact(registry: DataFrame, per_name: bool = True) -> DataFrame:
    """Newest artifact (by saved_at, path as tie-break), overall or per name."""
    order = F.struct("saved_at", "path")
    row = F.struct(*[c for c in registry.columns])
    if per_name:
        return registry.groupBy("name").agg(F.max_by(row, order).alias("_r")).select("_r.*")
    return registry.agg(F.max_by(row, order).alias("_r")).select("_r.*")


def run_rows_from_metrics(metrics_row: DataFrame, run_name: str, prefix: str, metric_cols: list[str], params: dict | None = None) -> DataFrame:
    """Build run-log rows on Spark from a (one-row-per-run) metrics table:
    metric keys are ``prefix + lower(name)`` without dots."""
    keys = F.array(*[metric_key(prefix, F.lit(c)) for c in metric_cols])
    vals = F.array(*[F.col(c).cast("double") for c in metric_cols])
    p = params or {}
    pmap = F.create_map(*[x for k, v in p.items() for x in (F.lit(k), F.lit(str(v)))]) if p else F.create_map().cast("map<string,string>")
    return metrics_row.select(
        F.lit(run_name).alias("run_name"),
        F.current_timestamp().cast("timestamp_ntz").alias("logged_at"),
        pmap.alias("params"),
        F.map_from_arrays(keys, vals).alias("metrics"),
    )


def log_runs(runs: DataFrame, runs_path: str) -> None:
    runs.write.mode("append").parquet(runs_path)


def metrics_long(runs: DataFrame) -> DataFrame:
    """(run_name, key, value) from the metrics maps."""
    return runs.select("run_name", F.explode("metrics").alias("key", "value"))
