import math

import numpy as np
from pyspark.sql import functions as F

from envflow.config import DriftSpec
from envflow.operators.drift import chi2_sf, drift_dataset, drift_features, ks_pvalue, psi
from envflow.operators.metrics import auc_ovr, classification_metrics, confusion_matrix
from envflow.operators.stats import data_quality, label_shares, reference_stats
from envflow.plans.monitoring import run_tests, summarize_tests

SF01 = "/root/testdata/sf0.01"


def _measure(spark):
    from envflow import bindings as B

    return B.labeled_measurements(spark, SF01)


def test_self_drift_is_zero(spark):
    m = _measure(spark)
    feats = drift_features(m, m, DriftSpec(categorical=("air_quality_label",))).collect()
    assert all(not r["drift_detected"] for r in feats)
    assert all(abs(r["statistic"]) < 1e-12 for r in feats)
    small = drift_features(m, m, DriftSpec(numeric_test="ks")).collect()
    assert all(r["stattest"] == "ks" and r["drift_score"] == 1.0 for r in small)


def test_shifted_current_drifts(spark):
    m = _measure(spark)
    cur = m.withColumn("pm10", F.col("pm10") + 100.0)
    got = {r["feature"]: r for r in drift_features(m, cur, DriftSpec(numerical=("pm10", "pm2_5"))).collect()}
    assert got["pm10"]["drift_detected"] and not got["pm2_5"]["drift_detected"]
    p = {r["feature"]: r["psi"] for r in psi(m, cur, ["pm10", "pm2_5"]).collect()}
    assert p["pm10"] > 0.2 and p["pm2_5"] < 1e-9


def test_chi2_tail_at_many_degrees_of_freedom(spark):
    # stat, degrees of freedom, upper tail (0.05 points of tables, and far tails)
    rows = [
        (233.994, 200, 0.05), (553.127, 500, 0.05), (1074.679, 1000, 0.05), (124.342, 101, 0.057), (232.912, 199, 0.05),
        (1080.0, 200, 0.0), (2400.0, 1000, 0.0), (3.841458820694124, 1, 0.05), (100.0, 1, 0.0), (200.0, 1000, 1.0), (90.0, 1, 0.0),
    ]
    df = spark.createDataFrame([(x, k, p) for x, k, p in rows], "x double, k int, p double")
    for r in df.select("*", chi2_sf(F.col("x"), F.col("k")).alias("got")).collect():
        assert abs(r["got"] - r["p"]) < 1e-3, r


def test_one_sided_columns_have_rows(spark):
    ref = spark.createDataFrame([(1.0, 1.0, None), (2.0, 2.0, None)], "a double, b double, c double")
    cur = spark.createDataFrame([(1.0, None, None), (2.0, float("nan"), None)], "a double, b double, c double")
    for test in ("wasserstein", "ks", "psi"):
        got = {r["feature"]: r for r in drift_features(ref, cur, DriftSpec(numerical=("a", "b", "c"), numeric_test=test)).collect()}
        assert {f: r["status"] for f, r in got.items()} == {"a": "ok", "b": "no_current_data", "c": "no_data"}
        assert {f: r["drift_detected"] for f, r in got.items()} == {"a": False, "b": True, "c": False}
        assert drift_dataset(drift_features(ref, cur, DriftSpec(numerical=("a", "b", "c"), numeric_test=test))).first()["n_features"] == 3


def test_tests_are_chosen_per_column(spark):
    m = spark.createDataFrame([(float(i), float(i)) for i in range(20)], "a double, b double")
    spec = DriftSpec(numerical=("a", "b"), tests=(("b", "ks"),))
    assert {r["feature"]: r["stattest"] for r in drift_features(m, m, spec).collect()} == {"a": "wasserstein", "b": "ks"}


def test_nan_is_missing_in_data_quality(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "a double")
    r = data_quality(df, ["a"]).first()
    assert (r["n_null"], r["mean"], r["max"], r["n_distinct"]) == (2, 2.0, 3.0, 2)


def test_pvalue_series_at_known_points(spark):
    df = spark.createDataFrame([(3.841458820694124, 1), (5.991464547107979, 2), (7.814727903251178, 3), (0.0, 2), (500.0, 3)], "x double, k int")
    got = [r[0] for r in df.select(chi2_sf(F.col("x"), F.col("k"))).collect()]
    assert all(abs(a - b) < 1e-9 for a, b in zip(got, [0.05, 0.05, 0.05, 1.0, 0.0]))
    # Kolmogorov tail: Q(1.3581) ~ 0.05 (lambda = D * sqrt(n m / (n + m)), here n = m = 2)
    k = spark.createDataFrame([(1.3580986393225507,)], "d double").select(ks_pvalue(F.col("d"), F.lit(2.0), F.lit(2.0)))
    assert abs(k.first()[0] - 0.05) < 1e-6


def test_metrics_perfect_and_auc_brute_force(spark):
    rnd = np.random.default_rng(1)
    rows = []
    for i in range(300):
        lab = ["a", "b", "c"][i % 3]
        s = rnd.random(3).round(2)
        s = s / s.sum()
        rows.append(("m", i, lab, lab, float(s[0]), float(s[1]), float(s[2])))
    df = spark.createDataFrame(rows, "model string, id long, label string, prediction string, pa double, pb double, pc double")
    m = classification_metrics(confusion_matrix(df)).first()
    assert m["accuracy"] == 1.0 and m["f1"] == 1.0 and abs(m["kappa"] - 1.0) < 1e-12
    long = df.select("model", "label", F.inline(F.array(
        F.struct(F.lit("a").alias("class"), F.col("pa").alias("score")),
        F.struct(F.lit("b").alias("class"), F.col("pb").alias("score")),
        F.struct(F.lit("c").alias("class"), F.col("pc").alias("score")))))
    got = auc_ovr(long, buckets=4).first()["auc"]
    bucketed = auc_ovr(long, buckets=4, single_task_rows=None).first()["auc"]
    assert abs(got - bucketed) < 1e-12
    # brute force: pairwise with ties counted half, weighted by positives
    tot, wsum = 0.0, 0
    for ci, c in enumerate("abc"):
        pos = [r[4 + ci] for r in rows if r[2] == c]
        neg = [r[4 + ci] for r in rows if r[2] != c]
        u = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        tot += u / (len(pos) * len(neg)) * len(pos)
        wsum += len(pos)
    assert abs(got - tot / wsum) < 1e-12


def test_quality_stats_and_tests(spark):
    m = _measure(spark)
    dq = {r["column"]: r for r in data_quality(m, ["pm2_5"], ["air_quality_label"]).collect()}
    n = m.count()
    assert dq["pm2_5"]["n_rows"] == n and dq["pm2_5"]["n_null"] == m.filter("pm2_5 IS NULL").count()
    st = {r["feature"]: r for r in reference_stats(m.na.drop(subset=["pm2_5"]), ["pm2_5"]).collect()}
    vals = np.array([r[0] for r in m.select("pm2_5").na.drop().collect()])
    assert abs(st["pm2_5"]["median"] - np.median(vals)) < 1e-9
    assert abs(st["pm2_5"]["std"] - vals.std(ddof=1)) < 1e-6
    shares = {r[0]: r[1] for r in label_shares(m, "air_quality_label").collect()}
    assert abs(sum(shares.values()) - 1.0) < 1e-12
    tests = run_tests(m, m)
    s = summarize_tests(tests).first()
    assert s["all_passed"] and s["failed"] == 0 and s["total"] == tests.count()


def test_zero_row_current(spark):
    m = _measure(spark)
    empty = m.limit(0)
    s = summarize_tests(run_tests(m, empty)).first()
    assert not s["all_passed"]


def test_metrics_and_drift_invariant_under_shuffle(spark):
    from envflow import bindings as B

    ev = spark.read.parquet(f"{SF01}/events.parquet")
    pred = B.stored_predictions(ev)
    base = sorted(map(tuple, auc_ovr(B.probabilities_long(pred), single_task_rows=None).collect()))
    shuffled = sorted(map(tuple, auc_ovr(B.probabilities_long(pred.repartition(7)), single_task_rows=None).collect()))
    assert [(a, round(x, 9)) for a, x in base] == [(a, round(x, 9)) for a, x in shuffled]
    m = _measure(spark)
    ref, cur = B.reference_current(m)
    d1 = {r["feature"]: r["statistic"] for r in drift_features(ref, cur, DriftSpec(numerical=("pm10", "us_aqi"))).collect()}
    d2 = {r["feature"]: r["statistic"] for r in drift_features(ref.repartition(5), cur.repartition(3), DriftSpec(numerical=("pm10", "us_aqi"))).collect()}
    assert all(abs(d1[k] - d2[k]) < 1e-9 for k in d1)
