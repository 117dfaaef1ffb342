"""Batch scoring with a fitted pipeline, and model metadata."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FEATURES
from ..operators.prep import align_features
from .training import transformed


def model_labels(model: PipelineModel) -> list[str]:
    """Class names from the pipeline's label indexer."""
    from pyspark.ml.feature import StringIndexerModel

    for st in model.stages:
        if isinstance(st, StringIndexerModel):
            return list(st.labels)
    raise ValueError("pipeline has no fitted label indexer")


def score(model: PipelineModel, df: DataFrame, features: list[str] = FEATURES, keep: list[str] = (), labels: list[str] | None = None) -> DataFrame:
    """Predicted label, confidence (max class probability) and the class ->
    probability map. Missing feature columns score as 0. One-vs-rest models have the calibration of their margins
    as the pipeline's last stage; only a model without any probabilities gives null confidence and map."""
    labels = labels or model_labels(model)
    aligned = align_features(df, features, keep=list(keep))
    out = transformed(model, aligned)
    lab = F.array(*[F.lit(x) for x in labels])
    pred = F.element_at(lab, F.col("prediction").cast("int") + 1)
    if "probability" in out.columns:
        arr = vector_to_array("probability")
        conf = F.array_max(arr)
        probs = F.map_from_arrays(lab, arr)
    else:
        conf = F.lit(None).cast("double")
        probs = F.lit(None).cast("map<string,double>")
    return out.select(*keep, pred.alias("prediction"), conf.alias("confidence"), probs.alias("probabilities"))


def model_info(registry_row: DataFrame) -> DataFrame:
    """Name, path, features and classes of a registered model."""
    return registry_row.select("name", "path", "model_type", "features", "classes", "saved_at")


def model_stages(model: PipelineModel) -> DataFrame:
    """What a (saved) pipeline itself tells: the classifier's type, the features it takes and its classes."""
    from pyspark.ml.feature import ImputerModel

    features = next((list(st.getInputCols()) for st in model.stages if isinstance(st, ImputerModel)), [])
    row = (type(model.stages[-1]).__name__, ",".join(features), ",".join(model_labels(model)))
    return SparkSession.active().createDataFrame([row], "model_type string, features string, classes string")
