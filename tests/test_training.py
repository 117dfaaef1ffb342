import pytest
from pyspark.ml.classification import LinearSVC, OneVsRest, OneVsRestModel
from pyspark.sql import functions as F

from envflow.config import FEATURES
from envflow.plans import training as T
from envflow.plans.scoring import model_labels, score


@pytest.fixture(scope="module")
def split(spark):
    """Two features that tell three classes, one null now and then."""
    rows = spark.range(400).coalesce(2).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("label"),
        (F.col("id") % 3 + F.pmod(F.hash("id"), F.lit(100)) / 60.0).alias("x"),
        F.when(F.col("id") % 50 != 0, F.pmod(F.hash(F.col("id") + 7), F.lit(100)) / 50.0 - F.col("id") % 3).alias("y"),
    )
    data = T.isolated_table(T.split_flag(rows, ["key"]))
    return data.filter("is_train").drop("is_train"), data.filter("NOT is_train").drop("is_train")


def some(*families):
    """Candidates; the one-vs-rest SVM with a few iterations."""
    out = [c for c in T.default_candidates() if c.family in families]
    for c in out:
        if c.family == "svc_ovr":
            c.build = lambda nf, k, s: OneVsRest(
                featuresCol=T.FEATURES_VEC, labelCol=T.LABEL_IDX, predictionCol=T.MARGIN_CHOICE, classifier=LinearSVC(maxIter=5), parallelism=3
            )
    return out


@pytest.fixture(scope="module")
def by_auc(split):
    return T.compare_models(*split, features=["x", "y"], target="label", candidates=some("dt", "nb", "svc_ovr"), sort_metric="auc", folds=2)


def test_models_are_ranked_by_auc(by_auc):
    rows = by_auc[0].orderBy("rank").collect()
    assert len(rows) == 3 and [r["cv_score"] for r in rows] == sorted((r["cv_score"] for r in rows), reverse=True)
    assert all(0.6 < r["cv_score"] <= 1 and 0.6 < r["auc"] <= 1 for r in rows)


def test_margins_become_probabilities(by_auc, split, tmp_path):
    from envflow.sources.registry import load_model, save_model

    model = by_auc[1]["SVM - Linear Kernel (one-vs-rest)"].model
    assert any(isinstance(s, OneVsRestModel) for s in model.stages) and model_labels(model) == ["a", "b", "c"]
    out = score(model, split[1], ["x", "y"], keep=["key", "label"]).collect()
    for r in out:
        p = r["probabilities"]
        assert set(p) == {"a", "b", "c"} and abs(sum(p.values()) - 1) < 1e-9
        assert r["confidence"] == max(p.values()) == p[r["prediction"]]
    right = sum(r["prediction"] == r["label"] for r in out) / len(out)
    assert abs(sum(r["confidence"] for r in out) / len(out) - right) < 0.12  # calibrated
    again = score(load_model(save_model(model, str(tmp_path / "m"))), split[1], ["x", "y"], keep=["key", "label"]).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_the_preparation_is_fitted_once_per_fold(split, monkeypatch):
    calls = []
    real = T.preparation
    monkeypatch.setattr(T, "preparation", lambda rows, features: calls.append(1) or real(rows, features))
    T.compare_models(*split, features=["x", "y"], target="label", candidates=some("dt", "nb"), sort_metric="kappa", folds=3)
    assert len(calls) == 4  # three folds and the whole, whatever the families


def test_folds_hold_every_row_once_and_learn_without_it(split):
    f = T.fold_vectors(split[0], ["x", "y"], "label", ["a", "b", "c"], 3, 1)
    n = split[0].count()
    assert sum(f.check(i).count() for i in range(3)) == n == f.learn(T.WHOLE).count()
    assert all(f.learn(i).count() + f.check(i).count() == n for i in range(3))


def test_tuning_by_kappa(split):
    c = some("dt")[0]
    c.space = {"maxDepth": [1, 2, 6]}
    best, trials, held = T.tune_model(*split, c, ["x", "y"], "label", n_trials=3, metric="kappa")
    scores = {r["params"]: r["validation_metric"] for r in trials.collect()}
    assert len(scores) == 3 and all(-1 <= v <= 1 for v in scores.values())
    assert f"maxDepth={best.stages[-1].getMaxDepth()}" == max(scores, key=scores.get)
    assert held.first()["kappa"] > 0.5


def test_a_tuned_margin_model_has_probabilities(split):
    best, _, held = T.tune_model(*split, some("svc_ovr")[0], ["x", "y"], "label", metric="auc")
    assert held.first()["auc"] > 0.6
    assert score(best, split[1], ["x", "y"]).filter("confidence IS NULL").count() == 0


def test_the_evaluator_agrees_with_plain_counting(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(0, 0, [0.7, 0.3]), (0, 1, [0.4, 0.6]), (1, 1, [0.2, 0.8]), (1, 1, [0.4, 0.6]), (1, 0, [0.9, 0.1]), (0, 0, [0.6, 0.4])]
    df = spark.createDataFrame([(float(a), float(b), Vectors.dense(p)) for a, b, p in rows], [T.LABEL_IDX, "prediction", "probability"])
    n = len(rows)
    agree = sum(a == b for a, b, _ in rows) / n
    chance = sum(sum(a == k for a, _, _ in rows) * sum(b == k for _, b, _ in rows) for k in (0, 1)) / n**2
    assert abs(T.TableEvaluator("kappa").evaluate(df) - (agree - chance) / (1 - chance)) < 1e-12
    pairs = [(p[1], q[1]) for a, _, p in rows for b, _, q in rows if a == 1 and b == 0]
    want = sum((x > y) + 0.5 * (x == y) for x, y in pairs) / len(pairs)
    assert abs(T.TableEvaluator("auc").evaluate(df) - want) < 1e-12


def test_unknown_metrics_are_an_error(split):
    with pytest.raises(ValueError, match="can't be ranked by 'luck'"):
        T.compare_models(*split, features=FEATURES, sort_metric="luck")


def test_parts_are_fitted_side_by_side(split, monkeypatch):
    import threading

    folds = T.fold_vectors(split[0], ["x", "y"], "label", ["a", "b", "c"], 2, 1)
    meet = threading.Barrier(3, timeout=60)  # broken unless three fits have begun

    class Waits:
        def fit(self, rows):
            meet.wait()
            return rows.count()

    models = T.fitted_parts(folds, Waits)
    assert models == {T.WHOLE: folds.size, **{i: folds.learn(i).count() for i in range(2)}}
    monkeypatch.setattr(T, "FIT_ROWS_PER_CORE", 1)
    assert T.fits_at_once(folds) == 1  # large parts one after the other


def test_linear_margins_are_those_of_the_model(split):
    folds = T.fold_vectors(split[0], ["x", "y"], "label", ["a", "b", "c"], 2, 1)
    model = T.estimator(some("svc_ovr")[0], ["x", "y"], ["a", "b", "c"], 42).fit(folds.learn(T.WHOLE))
    rows = folds.learn(T.WHOLE).coalesce(1)
    want, got = model.transform(rows).collect(), T.transformed(model, rows).collect()
    assert len(got) == len(want) > 0
    for a, b in zip(want, got):
        assert b[T.SCALED_VEC] == a[T.SCALED_VEC] and set(a.asDict()) == set(b.asDict())
        assert b[T.MARGINS].toArray() == pytest.approx(a[T.MARGINS].toArray(), rel=1e-9, abs=1e-12)
        assert b[T.MARGIN_CHOICE] == a[T.MARGIN_CHOICE]


def test_scores_take_no_row_through_the_models_one_by_one(split, monkeypatch):
    folds = T.fold_vectors(split[0], ["x", "y"], "label", ["a", "b", "c"], 2, 1)
    models = T.fitted_parts(folds, lambda: T.estimator(some("svc_ovr")[0], ["x", "y"], ["a", "b", "c"], 42))
    monkeypatch.setattr(OneVsRestModel, "_transform", lambda *a: pytest.fail("row by row"))
    told, calibration = T.out_of_fold(folds, models)
    model = T.fitted_pipeline(folds, models, calibration)
    assert told.count() == folds.size and model.stages[-1] is calibration
    out = score(model, split[1], ["x", "y"], keep=["label"])
    assert out.filter("prediction = label").count() > 0.6 * out.count()


def test_linear_fits_start_few_tasks(split, monkeypatch):
    folds = T.fold_vectors(split[0].repartition(6), ["x", "y"], "label", ["a", "b", "c"], 2, 1)
    seen = []
    monkeypatch.setattr(OneVsRest, "fit", lambda self, rows: seen.append((rows.rdd.getNumPartitions(), rows.count())))
    T.fitted_parts(folds, lambda: T.estimator(some("svc_ovr")[0], ["x", "y"], ["a", "b", "c"], 42))
    assert sorted(seen) == sorted((1, folds.learn(i).count()) for i in (T.WHOLE, 0, 1))
    monkeypatch.setattr(T, "FIT_ROWS_PER_TASK", folds.size // 2)
    assert T.in_few_tasks(folds, folds.learn(T.WHOLE)).rdd.getNumPartitions() <= 3


def test_families_wait_for_room(split, monkeypatch):
    import threading
    import time

    running, most, lock = [0], [0], threading.Lock()

    def fit(folds, test, c, *rest):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.3)
        with lock:
            running[0] -= 1
        return T.Fitted(c, None, 0.5, {"model": c.name, "cv_score": 0.5})

    monkeypatch.setattr(T, "_fit_candidate", fit)
    monkeypatch.setattr(T, "FIT_ROWS_PER_CORE", 1)
    board, _ = T.compare_models(*split, features=["x", "y"], target="label", folds=2)
    assert most[0] == 1 and board.count() == 5
    monkeypatch.setattr(T, "FIT_ROWS_PER_CORE", 2_000_000)
    T.compare_models(*split, features=["x", "y"], target="label", folds=2)
    assert most[0] > 1


def test_classes_wait_for_room(split, monkeypatch):
    folds = T.fold_vectors(split[0], ["x", "y"], "label", ["a", "b", "c"], 2, 1)
    seen = []
    monkeypatch.setattr(OneVsRest, "fit", lambda self, rows: seen.append(self.getParallelism()))
    for family, rows_per_core, want in (("svc_ovr", 2_000_000, 3), ("svc_ovr", 1, 1), ("gbt_ovr", 2_000_000, 3), ("gbt_ovr", 1, 1)):
        monkeypatch.setattr(T, "FIT_ROWS_PER_CORE", rows_per_core)
        T.fitted_parts(folds, lambda: T.estimator(next(c for c in T.default_candidates() if c.family == family), ["x", "y"], ["a", "b", "c"], 42))
        assert seen == [want] * 3, family
        seen.clear()


def test_one_vs_rest_keeps_no_copy_of_its_rows(split, monkeypatch):
    kept = []
    folds = T.fold_vectors(split[0], ["x", "y"], "label", ["a", "b", "c"], 2, 1)
    rows, real = folds.learn(0).coalesce(1), LinearSVC.fit

    def fit(self, df, params=None):
        kept.append("InMemoryRelation" in df._jdf.queryExecution().withCachedData().toString())
        return real(self, df, params)

    monkeypatch.setattr(LinearSVC, "fit", fit)
    c = next(c for c in T.default_candidates() if c.family == "svc_ovr")
    est = T.estimator(c, ["x", "y"], ["a", "b", "c"], 42)
    model = est.setClassifier(LinearSVC(maxIter=5)).fit(rows)
    assert kept == [False] * 3
    plain = OneVsRest(featuresCol=T.SCALED_VEC, labelCol=T.LABEL_IDX, predictionCol=T.MARGIN_CHOICE, classifier=LinearSVC(maxIter=5)).fit(rows)
    assert kept == [False] * 3 + [True] * 3
    assert [m.coefficients for m in model.models] == [m.coefficients for m in plain.models]
    assert [m.intercept for m in model.models] == [m.intercept for m in plain.models]
    assert model.getPredictionCol() == plain.getPredictionCol()


def test_holdout_predictions_are_made_once(split, monkeypatch):
    told = []
    monkeypatch.setattr(T, "materialize", lambda df, real=T.materialize: told.append(df.columns) or real(df))
    rows = split[1].select(
        F.col("key"), (F.col("key") % 2).cast("double").alias(T.LABEL_IDX), (F.col("key") % 3 % 2).cast("double").alias("prediction"),
        T.array_to_vector(F.array(F.lit(0.5), F.col("key") % 7 / 7.0)).alias("probability"),
    )
    got = T.holdout_metrics(rows, "m").first()
    assert told == [[T.LABEL_IDX, "prediction", "probability"]]
    want = T.prediction_metrics(rows.withColumn("model", F.lit("m")), ["model"]).first()
    assert got == want and got["model"] == "m"


def test_a_training_prepares_its_rows_once(spark, split, monkeypatch):
    from pyspark.ml.tuning import TrainValidationSplit

    prepared, seen = [], []
    monkeypatch.setattr(T, "preparation", lambda rows, features, real=T.preparation: prepared.append(1) or real(rows, features))
    monkeypatch.setattr(TrainValidationSplit, "_fit", lambda self, rows, real=TrainValidationSplit._fit: seen.append((rows.columns, self.getParallelism())) or real(self, rows))
    monkeypatch.setattr(T, "FIT_ROWS_PER_CORE", 1)
    c = some("dt")[0]
    c.space = {"maxDepth": [1, 2, 6]}
    both = split[0].unionByName(split[1])
    got = T.run_training(spark, both, ["key"], ["x", "y"], "label", tune_trials=3, candidates=[c], folds=2)
    assert len(prepared) == 3  # two folds and the whole, for the comparison and the tuning
    assert seen == [([T.LABEL_IDX, T.FEATURES_VEC], 1)]  # the columns a trial reads; trials wait for room
    data = T.isolated_table(T.split_flag(T.prepare(both, ["x", "y"], "label"), ["key"]))
    train, test = data.filter("is_train").drop("is_train"), data.filter("NOT is_train").drop("is_train")
    _, trials, tuned = T.tune_model(train, test, c, ["x", "y"], "label", 3)
    assert sorted(got.trials.collect()) == sorted(trials.collect()) and got.tuned_metrics.collect() == tuned.collect()
    assert got.labels == ["a", "b", "c"]
