"""Training on Spark ML: split, compare candidate families, select, tune, save.

Every fit is a distributed Spark ML job; families, folds and tuning trials are fitted as
concurrent jobs. Imputing and scaling are fitted once per fold and their vectors written once for all
families. Metrics of folds, trials and the hold-out set come from the same DataFrame operators as
those of stored predictions, so any of them (AUC and kappa too) can rank.
"""

from __future__ import annotations

import functools
import itertools
import operator
import random
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FEATURES, N_SELECT, SPLIT_SEED, TARGET, TRAIN_FRACTION_PCT, TUNE_TRIALS
from ..operators.metrics import METRICS, auc_ovr, classification_metrics, confusion_matrix, leaderboard_from, select_model
from ..operators.prep import prepare_training
from ..session import materialize, scratch_path

LABEL_IDX = "label_idx"
FEATURES_VEC, SCALED_VEC, RAW_VEC = "features", "scaled_features", "_raw_features"
#: Class margins of a one-vs-rest model (a saved one keeps no other name), and its own choice; probabilities come from
#: their calibration.
MARGINS, MARGIN_CHOICE = "rawPrediction", "margin_prediction"
#: Part of a fold table that is prepared from, and is, the whole training set.
WHOLE = -1
#: Rows a core takes at once over all fits side by side: with fewer, a pass is shorter than its job's start and cores idle; with
#: more, the fits' cached rows (some 200 bytes each in a fit of trees, 80 in a linear one) push each other out of memory, and each
#: of their many passes reads them from disk again.
FIT_ROWS_PER_CORE = 2_000_000
#: Rows a task of a linear fit takes in each of its many passes, where there are as many: with fewer, its start costs more than they.
FIT_ROWS_PER_TASK = 1_000_000


def ranking_metric(metric: str) -> str:
    """A metric that candidates and trials can be scored by."""
    if metric not in METRICS:
        raise ValueError(f"models can't be ranked by {metric!r}; choose one of {METRICS}")
    return metric


def prediction_metrics(pred: DataFrame, group: list[str], auc: bool = True) -> DataFrame:
    """``group..., accuracy, recall, prec, f1, kappa, auc`` from predictions with numbered labels. AUC ranks rows by class
    probabilities, or where a model has none by its raw scores; null without either."""
    p = pred.select(*group, F.col(LABEL_IDX).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))
    m = classification_metrics(confusion_matrix(p, group=group), group=group)
    score = next((c for c in ("probability", MARGINS) if c in pred.columns), None)
    if not auc or score is None:
        return m.withColumn("auc", F.lit(None).cast("double"))
    long = pred.select(*group, F.col(LABEL_IDX).cast("int").alias("label"), F.posexplode(vector_to_array(score)).alias("class", "score"))
    return m.join(auc_ovr(long, group=group), group, "left")


class DirectOneVsRest(OneVsRest):
    """One-vs-rest whose classifiers read the rows where they are. PySpark's own keeps a copy of them in memory as long as it
    fits, beside what each of its classifiers keeps."""

    def _fit(self, dataset: DataFrame) -> OneVsRestModel:
        classifier, label, features = self.getClassifier(), self.getLabelCol(), self.getFeaturesCol()
        rows = dataset.select(label, features)

        def fit(k: int):
            own = f"mc2b${k}"
            params = {classifier.labelCol: own, classifier.featuresCol: features, classifier.predictionCol: self.getPredictionCol()}
            return classifier.fit(rows.withColumn(own, F.when(F.col(label) == float(k), 1.0).otherwise(0.0)), params)

        classes = range(int(rows.agg(F.max(label)).first()[0]) + 1)
        return self._copyValues(OneVsRestModel(models=side_by_side(fit, classes, self.getParallelism())))


class TableEvaluator(Evaluator):
    """A Spark ML evaluator whose metrics are the library's own aggregations over the prediction table."""

    def __init__(self, metric: str = "f1"):
        super().__init__()
        self.metric = ranking_metric(metric)

    def _evaluate(self, dataset: DataFrame) -> float:
        row = prediction_metrics(dataset.withColumn("_all", F.lit(0)), ["_all"], self.metric == "auc").first()
        value = row[self.metric] if row else None
        return 0.0 if value is None else float(value)

    def isLargerBetter(self) -> bool:
        return True


def split_flag(df: DataFrame, keys: list[str], seed: int = SPLIT_SEED, train_pct: int = TRAIN_FRACTION_PCT) -> DataFrame:
    """Deterministic hold-out split by key hash: stable under repartitioning
    and re-execution (unlike ``randomSplit``). The hash is the first eight hex digits
    of an MD5, so other engines can repeat it."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn("is_train", h < F.lit(train_pct))


@dataclass
class Candidate:
    name: str
    family: str
    build: object  # (n_features, n_classes, seed) -> estimator
    space: dict = field(default_factory=dict)
    scaled: bool = False
    probabilistic: bool = True


def default_candidates() -> list[Candidate]:
    def dt(nf, k, s):
        return DecisionTreeClassifier(featuresCol=FEATURES_VEC, labelCol=LABEL_IDX, seed=s)

    def rf(nf, k, s):
        return RandomForestClassifier(featuresCol=FEATURES_VEC, labelCol=LABEL_IDX, numTrees=20, seed=s)

    def lr(nf, k, s):
        return LogisticRegression(featuresCol=FEATURES_VEC, labelCol=LABEL_IDX, maxIter=50)

    def nb(nf, k, s):
        return NaiveBayes(featuresCol=FEATURES_VEC, labelCol=LABEL_IDX, modelType="gaussian")

    def one_vs_rest(classifier, k):
        return DirectOneVsRest(featuresCol=FEATURES_VEC, labelCol=LABEL_IDX, predictionCol=MARGIN_CHOICE, classifier=classifier, parallelism=k)

    def svc(nf, k, s):
        return one_vs_rest(LinearSVC(maxIter=50), k)

    def gbt(nf, k, s):
        return one_vs_rest(GBTClassifier(maxIter=10, seed=s), k)

    def mlp(nf, k, s):
        return MultilayerPerceptronClassifier(
            featuresCol=FEATURES_VEC, labelCol=LABEL_IDX, layers=[nf, 16, k], maxIter=100, seed=s
        )

    return [
        Candidate("Decision Tree Classifier", "dt", dt, {"maxDepth": [3, 5, 7, 10, 12], "minInstancesPerNode": [1, 5, 10, 20], "impurity": ["gini", "entropy"]}),
        Candidate("Random Forest Classifier", "rf", rf, {"numTrees": [10, 20, 40], "maxDepth": [4, 6, 8, 10], "featureSubsetStrategy": ["auto", "sqrt", "all"]}),
        Candidate("Logistic Regression", "lr", lr, {"regParam": [0.0, 0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]}, scaled=True),
        Candidate("Naive Bayes", "nb", nb, {"smoothing": [0.0, 1.0]}),
        Candidate("SVM - Linear Kernel (one-vs-rest)", "svc_ovr", svc, {}, scaled=True, probabilistic=False),
        Candidate("Gradient Boosting Classifier (one-vs-rest)", "gbt_ovr", gbt, {}, probabilistic=False),
        Candidate("MLP Classifier", "mlp", mlp, {"maxIter": [50, 100, 200], "stepSize": [0.01, 0.03, 0.1]}, scaled=True),
    ]


def feature_stages(features: list[str], target: str, scaled: bool):
    imputed = [f"_imp_{c}" for c in features]
    stages = [
        StringIndexer(inputCol=target, outputCol=LABEL_IDX, stringOrderType="alphabetAsc"),
        Imputer(inputCols=list(features), outputCols=imputed, strategy="median"),
    ]
    if scaled:
        stages += [
            VectorAssembler(inputCols=imputed, outputCol="_raw_features", handleInvalid="keep"),
            StandardScaler(inputCol="_raw_features", outputCol=FEATURES_VEC, withMean=True, withStd=True),
        ]
    else:
        stages.append(VectorAssembler(inputCols=imputed, outputCol=FEATURES_VEC, handleInvalid="keep"))
    return stages


def prepare(df: DataFrame, features: list[str] = FEATURES, target: str = TARGET) -> DataFrame:
    """Training table: reference cleaning rules + features as double."""
    clean = prepare_training(df, target)
    return clean.select(*[c for c in clean.columns if c not in features], *[F.col(c).cast("double").alias(c) for c in features])


def holdout_metrics(pred: DataFrame, name: str) -> DataFrame:
    """Hold-out metrics of one fitted candidate (accuracy ... kappa, auc). The predictions are written once for all of them."""
    told = [c for c in (LABEL_IDX, "prediction", "probability", MARGINS) if c in pred.columns]
    return prediction_metrics(materialize(pred.select(*told)).withColumn("model", F.lit(name)), ["model"])


@dataclass
class Fitted:
    candidate: Candidate
    model: PipelineModel
    cv_score: float
    metrics: dict


LEADERBOARD_SCHEMA = (
    "model string, accuracy double, recall double, prec double, f1 double, kappa double, auc double, cv_score double"
)


def preparation(rows: DataFrame, features: list[str]) -> list:
    """Imputer, assembler and scaler fitted on ``rows``: vectors as they are, and scaled ones beside them."""
    imputed = [f"_imp_{c}" for c in features]
    stages = [
        Imputer(inputCols=list(features), outputCols=imputed, strategy="median"),
        VectorAssembler(inputCols=imputed, outputCol=FEATURES_VEC, handleInvalid="keep"),
        StandardScaler(inputCol=FEATURES_VEC, outputCol=SCALED_VEC, withMean=True, withStd=True),
    ]
    return Pipeline(stages=stages).fit(rows).stages


@dataclass
class Folds:
    """``rows``: label, vectors, ``part`` and ``valid``. Part i is the whole training set prepared by what fold i leaves to learn
    from, with fold i as its ``valid`` rows; part WHOLE is prepared by all rows and has no valid ones."""

    rows: DataFrame
    stages: list  # label indexer and preparation of part WHOLE
    n: int
    size: int  # rows of a part

    @property
    def labels(self) -> list[str]:
        return list(self.stages[0].labels)

    def learn(self, part: int) -> DataFrame:
        return self.rows.filter((F.col("part") == part) & ~F.col("valid"))

    def check(self, part: int) -> DataFrame:
        return self.rows.filter((F.col("part") == part) & F.col("valid"))


def fold_vectors(train: DataFrame, features: list[str], target: str, labels: list[str], folds: int, seed: int) -> Folds:
    """Deal the rows into folds by hash (of the row), prepare them once per fold and write the vectors, for all
    families to read. The folds are prepared side by side."""
    indexer = StringIndexerModel.from_labels(labels, inputCol=target, outputCol=LABEL_IDX)
    fold = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in train.columns]), F.lit(max(folds, 1))).cast("int")
    rows = indexer.transform(train.withColumn("fold", fold))
    path = scratch_path(train.sparkSession, "folds")

    def part(i: int) -> list:
        own = rows if i == WHOLE else rows.filter(F.col("fold") != i)
        stages = preparation(own, features)
        out = PipelineModel(stages=stages).transform(rows)
        valid = F.lit(False) if i == WHOLE else F.col("fold") == i
        out.select(LABEL_IDX, FEATURES_VEC, SCALED_VEC, valid.alias("valid")).write.parquet(f"{path}/part={i}")
        return stages

    with ThreadPoolExecutor(folds + 1) as pool:
        stages = list(pool.map(part, [WHOLE, *range(folds)]))[0]
    vectors = train.sparkSession.read.parquet(path)
    return Folds(vectors, [indexer, *stages], folds, vectors.filter(F.col("part") == WHOLE).count())


def estimator(c: Candidate, features: list[str], labels: list[str], seed: int, params: dict | None = None):
    """A new estimator of the family, so that no two threads share one."""
    est = c.build(len(features), len(labels), seed)
    if c.scaled:
        est = est.copy({est.featuresCol: SCALED_VEC})
    return est.copy({est.getParam(k): v for k, v in (params or {}).items()})


def calibrator() -> LogisticRegression:
    """Multinomial logistic regression from class margins to probabilities that sum to 1."""
    return LogisticRegression(
        featuresCol=MARGINS, rawPredictionCol="calibrated_margins", labelCol=LABEL_IDX, family="multinomial", maxIter=50, regParam=1e-4
    )


def linear_margins(model: OneVsRestModel, df: DataFrame) -> DataFrame:
    """The margins and the choice of a one-vs-rest model of linear models, of all classes in one projection. The model's own
    ``transform`` takes every row through each of its models, one after the other."""
    x = f"_x_{uuid.uuid4().hex[:8]}"

    def margin(m: LinearSVCModel):
        terms = [F.col(x)[j] * F.lit(float(w)) for j, w in enumerate(m.coefficients.toArray())]
        return functools.reduce(operator.add, terms, F.lit(0.0)) + F.lit(float(m.intercept))

    told = df.withColumn(x, vector_to_array(model.getFeaturesCol())).withColumn(x, F.array(*[margin(m) for m in model.models]))
    choice = (F.array_position(x, F.array_max(x)) - 1).cast("double")
    return told.withColumns({model.getRawPredictionCol(): array_to_vector(x), model.getPredictionCol(): choice}).drop(x)


def transformed(model, df: DataFrame) -> DataFrame:
    """``model.transform(df)``, with the margins of linear one-vs-rest models in one projection."""
    for m in model.stages if isinstance(model, PipelineModel) else [model]:
        linear = isinstance(m, OneVsRestModel) and all(isinstance(k, LinearSVCModel) for k in m.models)
        df = linear_margins(m, df) if linear else m.transform(df)
    return df


def room(folds: Folds) -> float:
    """How many fits keep all cores busy without crowding each other out of memory; below 1 already one fills it."""
    cores = folds.rows.sparkSession.sparkContext.defaultParallelism
    return cores * FIT_ROWS_PER_CORE / max(1, folds.size)


def fits_at_once(folds: Folds) -> int:
    return max(1, int(room(folds)))


def is_linear(est) -> bool:
    return isinstance(est, OneVsRest) and isinstance(est.getClassifier(), LinearSVC)


def with_classes_at_once(est, share: float):
    """The classes of a one-vs-rest model are fits of their own, side by side as far as its share of the room goes; three linear ones take
    that of one."""
    if not isinstance(est, OneVsRest):
        return est
    return est.copy({est.parallelism: max(1, min(est.getParallelism(), int(share * (3 if is_linear(est) else 1))))})


def side_by_side(f, items, at_once: int) -> list:
    """``f`` of each item, in order, as concurrent jobs."""
    with ThreadPoolExecutor(max(1, min(len(items), at_once))) as pool:
        return list(pool.map(f, items))


def in_few_tasks(folds: Folds, rows: DataFrame) -> DataFrame:
    """Rows for a linear fit, whose many short passes each start a task per partition: partitions of few rows are read together."""
    return rows.coalesce(max(1, -(-folds.size // FIT_ROWS_PER_TASK)))


def fitted_parts(folds: Folds, build, at_once: int | None = None, families: int = 1) -> dict:
    """A model per part: of what each fold leaves to learn from, and of all rows (WHOLE), fitted side by side, as are so many ``families``."""
    parts = [WHOLE, *range(folds.n)]
    at_once = min(len(parts), at_once or fits_at_once(folds))
    share = room(folds) / (at_once * families)

    def fit(i: int):
        est, rows = with_classes_at_once(build(), share), folds.learn(i)
        return est.fit(in_few_tasks(folds, rows) if is_linear(est) else rows)

    return dict(zip(parts, side_by_side(fit, parts, at_once)))


def out_of_fold(folds: Folds, models: dict, at_once: int | None = None) -> tuple[DataFrame, LogisticRegressionModel | None]:
    """Predictions for every training row by a model that has not seen its fold, written once, with ``part``. Margins are
    calibrated by the rows of the other folds; their calibration by all rows, fitted beside these, comes with them."""
    parts = [transformed(models[i], folds.check(i)) for i in range(folds.n)]
    told = parts[0]
    for p in parts[1:]:
        told = told.unionByName(p)
    if "probability" in told.columns:
        return materialize(told.select("part", LABEL_IDX, "probability", "prediction")), None
    told = materialize(told.select("part", LABEL_IDX, MARGINS))

    def calibrated(i: int) -> LogisticRegressionModel:
        return calibrator().fit(in_few_tasks(folds, told if i == WHOLE else told.filter(F.col("part") != i)))

    parts = [WHOLE, *range(folds.n)] if folds.n > 1 else [WHOLE]  # a single fold has no others
    by = dict(zip(parts, side_by_side(calibrated, parts, at_once or fits_at_once(folds))))
    both = [by.get(i, by[WHOLE]).transform(told.filter(F.col("part") == i)) for i in range(folds.n)]
    out = both[0]
    for p in both[1:]:
        out = out.unionByName(p)
    return out.select("part", LABEL_IDX, MARGINS, "probability", "prediction"), by[WHOLE]


def fitted_pipeline(folds: Folds, models: dict, calibration: LogisticRegressionModel | None) -> PipelineModel:
    """Preparation, model and, for models with margins, their calibration, as one pipeline that takes raw rows."""
    stages = [*folds.stages, models[WHOLE]]
    if calibration is not None:
        stages.append(calibration)
    return PipelineModel(stages=stages)


def _fit_candidate(folds: Folds, test: DataFrame, c: Candidate, features, labels, sort_metric, seed, at_once: int | None = None, families: int = 1) -> Fitted:
    """Score one family by its out-of-fold predictions, fit it on all rows, evaluate on the hold-out set."""

    def build():
        return estimator(c, features, labels, seed)

    models = fitted_parts(folds, build, at_once, families)
    told, calibration = out_of_fold(folds, models, at_once)
    scores = prediction_metrics(told, ["part"], sort_metric == "auc").agg(F.avg(sort_metric)).first()[0]
    model = fitted_pipeline(folds, models, calibration)
    # one row per model: computed once here instead of re-running the model
    # transform every time the leaderboard is read
    row = holdout_metrics(transformed(model, test), c.name).first().asDict()
    row["cv_score"] = None if scores is None else float(scores)
    return Fitted(c, model, row["cv_score"], row)


def isolated_table(df: DataFrame, name: str = "training") -> DataFrame:
    """Write a training table to the shared checkpoint folder and read it back
    in a fresh session of the same SparkContext.

    Spark ML evaluators turn predictions into an RDD, which serializes the
    physical plan together with its session; a session that has used
    ``DataFrame.observe`` holds a non-serializable observation manager, so
    evaluation would fail there. The fresh session has none. The written table
    also cuts lineage for the repeated reads of cross-validation and tuning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.newSession().read.parquet(path)


def class_labels(df: DataFrame, target: str = TARGET) -> list[str]:
    """Sorted class names (a distributed distinct; bounded by the class count)."""
    return sorted(r[0] for r in df.select(target).distinct().collect())


def training_size(data: DataFrame, features: list[str] = FEATURES, target: str = TARGET) -> DataFrame:
    """One row: samples, features and classes of a training table."""
    return data.agg(F.count(F.lit(1)).alias("n_samples"), F.lit(len(features)).cast("bigint").alias("n_features"), F.count_distinct(target).alias("n_classes"))


def compare_models(
    train: DataFrame,
    test: DataFrame,
    features: list[str] = FEATURES,
    target: str = TARGET,
    candidates: list[Candidate] | None = None,
    sort_metric: str = "f1",
    n_select: int = N_SELECT,
    folds: int = 3,
    seed: int = SPLIT_SEED,
    parallelism: int = 4,
    prepared: Folds | None = None,
):
    """CV-score every candidate family by ``sort_metric`` (any of METRICS), rank by that score, and
    evaluate on the hold-out set. The hold-out rows have no part in the ranking. Rows are prepared once per
    fold for all families, which are fitted side by side as far as their rows have room in memory. ``prepared`` are the folds of these rows, where
    they are written already.

    Returns (leaderboard DataFrame, {model name: Fitted}) keeping only the
    ``n_select`` best fitted models.
    """
    ranking_metric(sort_metric)
    cands = candidates or default_candidates()
    prepared = prepared or fold_vectors(train, features, target, class_labels(train, target), folds, seed)
    labels = prepared.labels
    at_once = fits_at_once(prepared)
    families, each = min(parallelism, at_once), max(1, at_once // (2 * parallelism))  # families first, then parts of each
    fitted = side_by_side(lambda c: _fit_candidate(prepared, test, c, features, labels, sort_metric, seed, each, families), cands, families)
    spark = train.sparkSession
    rows = spark.createDataFrame([f.metrics for f in fitted], LEADERBOARD_SCHEMA)
    board = leaderboard_from(rows, "cv_score", n_select).persist()
    kept = {r["model"] for r in board.select("model").collect()}
    return board, {f.candidate.name: f for f in fitted if f.candidate.name in kept}


def param_trials(space: dict, n_trials: int, seed: int, base: dict | None = None) -> list[dict]:
    """``n_trials`` distinct points of a grid: the ``base`` parameters first, then a
    seeded random sample."""
    first = [] if base is None else [base]
    if not space:
        return first or [{}]
    keys = sorted(space)
    grid = [dict(zip(keys, p)) for p in itertools.product(*[space[k] for k in keys])]
    grid = [p for p in grid if p not in first]
    rnd = random.Random(seed)
    left = n_trials - len(first)
    return first + (grid if len(grid) <= left else rnd.sample(grid, left))


def tuning_folds(candidate: Candidate) -> int:
    """Folds that tuning needs: for the calibration of margins only."""
    return 0 if candidate.probabilistic else 3


def tune_model(
    train: DataFrame,
    test: DataFrame,
    candidate: Candidate,
    features: list[str] = FEATURES,
    target: str = TARGET,
    n_trials: int = TUNE_TRIALS,
    metric: str = "f1",
    seed: int = SPLIT_SEED,
    parallelism: int = 4,
    prepared: Folds | None = None,
):
    """Random search of ``n_trials`` parameter points with a train/validation
    split (trials evaluated in parallel, as far as their rows have room in memory). The candidate's own parameters are the
    first trial, so tuning never ends with a point that validates worse. ``prepared`` are written folds of these rows; models with margins
    are calibrated by them. Returns (best model, trials table, hold-out metrics of the best)."""
    ranking_metric(metric)
    prepared = prepared or fold_vectors(train, features, target, class_labels(train, target), tuning_folds(candidate), seed)
    labels = prepared.labels
    est = estimator(candidate, features, labels, seed)
    base = {k: est.getOrDefault(est.getParam(k)) for k in sorted(candidate.space)}
    trials = param_trials(candidate.space, n_trials, seed, base)
    maps = []
    for t in trials:
        b = ParamGridBuilder()
        for k, v in t.items():
            b = b.baseOn({est.getParam(k): v})
        maps.append(b.build()[0])
    at_once = min(parallelism, len(trials), fits_at_once(prepared))
    est = with_classes_at_once(est, room(prepared) / at_once)
    if not candidate.probabilistic:  # trials are compared by the model's own choice and margins
        est = est.copy({est.predictionCol: "prediction"})
    tvs = TrainValidationSplit(
        estimator=est, estimatorParamMaps=maps, evaluator=TableEvaluator(metric), trainRatio=0.8, seed=seed, parallelism=at_once
    )
    tm = tvs.fit(prepared.learn(WHOLE).select(LABEL_IDX, est.getFeaturesCol()))  # kept in memory, so no column too many
    spark = train.sparkSession
    table = spark.createDataFrame(
        [(i, ",".join(f"{k}={v}" for k, v in sorted(t.items())), float(m)) for i, (t, m) in enumerate(zip(trials, tm.validationMetrics))],
        "trial int, params string, validation_metric double",
    )
    if candidate.probabilistic:
        best = PipelineModel(stages=[*prepared.stages, tm.bestModel])
    else:
        chosen = trials[max(range(len(trials)), key=lambda i: tm.validationMetrics[i])]

        def build():
            return estimator(candidate, features, labels, seed, chosen)

        models = fitted_parts(prepared, build)
        best = fitted_pipeline(prepared, models, out_of_fold(prepared, models)[1])
    return best, table, holdout_metrics(transformed(best, test), candidate.name)


def training_runs(
    board: DataFrame,
    tuned: DataFrame,
    model_name: str,
    sort_metric: str,
    n_models: int,
    n_samples: int,
    n_features: int,
    tune_trials: int,
) -> DataFrame:
    """Run-log rows for one training: the comparison run (params + ``best_*``
    metrics of the top leaderboard row) and the tuning run (``tuned_*``)."""
    from ..sources.registry import run_rows_from_metrics

    metric_cols = ["accuracy", "auc", "recall", "prec", "f1", "kappa"]
    compare = run_rows_from_metrics(
        board.filter(F.col("rank") == 1),
        "compare_models",
        "best_",
        metric_cols,
        {"sort_metric": sort_metric, "n_models_compared": n_models, "n_samples": n_samples, "n_features": n_features},
    )
    tune = run_rows_from_metrics(
        tuned,
        f"tune_{model_name}",
        "tuned_",
        metric_cols,
        {"base_model": model_name, "tune_trials": tune_trials, "optimize_metric": sort_metric},
    )
    return compare.unionByName(tune)


@dataclass
class TrainingResult:
    model: PipelineModel
    model_name: str
    model_path: str | None
    metrics: dict
    leaderboard: DataFrame
    tuned_metrics: DataFrame
    trials: DataFrame
    labels: list[str]
    runs: DataFrame


def run_training(
    spark: SparkSession,
    df: DataFrame,
    keys: list[str],
    features: list[str] = FEATURES,
    target: str = TARGET,
    sort_metric: str = "f1",
    min_f1: float = 0.5,
    min_auc: float = 0.5,
    tune_trials: int = TUNE_TRIALS,
    save_path: str | None = None,
    candidates: list[Candidate] | None = None,
    folds: int = 3,
) -> TrainingResult:
    """Clean -> split -> compare -> select -> tune -> (save)."""
    data = isolated_table(split_flag(prepare(df, features, target), keys))
    train = data.filter("is_train").drop("is_train")
    test = data.filter("NOT is_train").drop("is_train")
    cands = candidates or default_candidates()
    labels = class_labels(train, target)
    prepared = fold_vectors(train, features, target, labels, folds, SPLIT_SEED)
    board, fitted = compare_models(train, test, features, target, cands, sort_metric, folds=folds, prepared=prepared)
    pick = select_model(board, min_f1, min_auc).first()
    cand = fitted[pick["model"]].candidate
    same = prepared if tuning_folds(cand) in (0, folds) else None  # the whole training set is prepared alike whatever the folds
    model, trials, tuned = tune_model(train, test, cand, features, target, tune_trials, sort_metric, prepared=same)
    path = None
    if save_path:
        model.write().overwrite().save(save_path)
        path = save_path
    n_samples = training_size(data, features, target).first()["n_samples"]
    runs = training_runs(board, tuned, pick["model"], sort_metric, len(cands), n_samples, len(features), tune_trials)
    return TrainingResult(model, pick["model"], path, pick.asDict(), board, tuned, trials, labels, runs)
