import math

import pytest
from pyspark.sql import functions as F

from envflow.config import FIVE_BAND
from envflow.functions.labels import band_label, three_band
from envflow.functions.rules import Rule, scoring_input_rules, split_valid, with_violations
from envflow.functions.scalars import integral_bigint, landing_key, parse_time, sanitize_name
from envflow.config import FEED_LIMIT_MAX
from envflow.operators.prep import align_features, check_limit, limit_per_entity, prepare_training


def test_three_band_edges(spark):
    vals = [None, float("nan"), -1.0, 11.99, 12.0, 35.39, 35.4, 500.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(three_band("v")).collect()]
    assert got == ["unknown", "unknown", "good", "good", "moderate", "moderate", "unhealthy", "unhealthy"]


def test_five_band(spark):
    vals = [5.0, 34.99, 35.0, 54.9, 55.0, 149.0, 150.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(band_label("v", FIVE_BAND)).collect()]
    assert got == ["good", "moderate", "unhealthy", "unhealthy", "very_unhealthy", "very_unhealthy", "hazardous"]


def test_golden_samples_from_the_request_examples(spark):
    # (pm2_5, expected three-band label)
    rows = [(15.5, "moderate"), (5.0, "good"), (25.0, "moderate"), (60.0, "unhealthy")]
    df = spark.createDataFrame(rows, "pm2_5 double, want string")
    assert all(r[0] == r[1] for r in df.select(three_band("pm2_5"), "want").collect())


def test_scoring_rules_accept_and_reject(spark):
    cols = "pm2_5 double, pm10 double, carbon_monoxide double, nitrogen_dioxide double, sulphur_dioxide double, ozone double, us_aqi bigint, european_aqi bigint"
    rows = [
        (15.5, 25.0, 200.0, 10.5, 5.0, 50.0, 42, 35),
        (5.0, 10.0, 100.0, 5.0, 2.0, 30.0, None, None),
        (-1.0, 10.0, 100.0, 5.0, 2.0, 30.0, 0, 500),
        (None, 10.0, 100.0, 5.0, 2.0, 30.0, 501, 20),
    ]
    df = spark.createDataFrame(rows, cols)
    ok, bad = split_valid(df, scoring_input_rules())
    assert ok.count() == 2
    v = sorted(tuple(r[0]) for r in bad.select("violations").collect())
    assert v == [("pm2_5:required:ge_0",), ("pm2_5:required:ge_0", "us_aqi:ge_0:le_500")]


def test_missing_required_column_is_a_violation(spark):
    df = spark.createDataFrame([(1.0,)], "pm10 double")
    r = with_violations(df, [Rule("pm2_5", lo=0.0, required=True), Rule("ozone", lo=0.0)]).first()
    assert list(r["violations"]) == ["pm2_5:required:ge_0"]


def test_parse_time_is_lenient(spark):
    df = spark.createDataFrame([("2025-01-01T00:00",), ("bad",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_time("s")).collect()]
    assert str(got[0]) == "2025-01-01 00:00:00" and got[1] is None and got[2] is None


def test_integral_cast_and_names(spark):
    df = spark.createDataFrame([(42.0, "Buenos Aires/x\\y"), (42.5, "a"), (None, "b")], "v double, c string")
    r = df.select(integral_bigint("v").alias("i"), sanitize_name("c").alias("n")).collect()
    assert [x["i"] for x in r] == [42, None, None]
    assert r[0]["n"] == "Buenos_Aires_x_y"
    t = spark.createDataFrame([("2025-03-04 05:06:07",)], "s string").select(landing_key(F.col("s").cast("timestamp_ntz")))
    assert t.first()[0] == "2025-03-04T05-06-07"


def test_prepare_training_and_align(spark):
    df = spark.createDataFrame(
        [("c", 1.0, "good"), ("c", None, "unknown"), ("c", 2.0, None)], "city string, pm2_5 double, air_quality_label string"
    )
    out = prepare_training(df)
    assert out.columns == ["pm2_5", "air_quality_label"] and out.count() == 1
    al = align_features(spark.createDataFrame([(1.0, None)], "pm2_5 double, us_aqi bigint"))
    r = al.first().asDict()
    assert r["pm2_5"] == 1.0 and r["us_aqi"] is None and r["ozone"] == 0.0 and len(r) == 8


def test_limits(spark):
    with pytest.raises(ValueError):
        check_limit(0)
    assert check_limit(10**6) == 10**6
    with pytest.raises(ValueError):
        check_limit(10**6, FEED_LIMIT_MAX)
    df = spark.range(50).select(F.col("id"), (F.col("id") % 2).alias("k"))
    top = limit_per_entity(df, "k", ["id"], 3).orderBy("k", "rank").collect()
    assert [(r["k"], r["id"]) for r in top] == [(0, 48), (0, 46), (0, 44), (1, 49), (1, 47), (1, 45)]


def test_stamp_fetch_and_prediction_rule(spark):
    from envflow.functions.rules import prediction_rules
    from envflow.sources.raw import stamp_fetch

    df = stamp_fetch(spark.createDataFrame([(1,)], "x int"), "Lima", "2025-01-01T00:00:00")
    r = df.first()
    assert r["city_name"] == "Lima" and r["fetch_timestamp"] == "2025-01-01T00:00:00"
    preds = spark.createDataFrame([(0.9,), (1.2,), (None,)], "confidence double")
    ok, bad = split_valid(preds, prediction_rules())
    assert ok.count() == 2 and [list(x[0]) for x in bad.select("violations").collect()] == [["confidence:ge_0:le_1"]]


def test_feature_source_and_approx_quality(spark, tmp_dir):
    from envflow.operators.features import FeatureSource
    from envflow.operators.stats import data_quality

    p = f"{tmp_dir}/fs"
    spark.createDataFrame([("a", 1.0, "2024-01-01 00:00:00"), ("a", 1.0, "2024-01-01 00:00:00")], "city string, v double, ts string").write.parquet(p)
    df = FeatureSource(p, "ts").load(spark, ["city", "v"])
    assert df.columns == ["city", "v", "ts"]
    exact = data_quality(df, ["v"], ["city"]).first()
    approx = data_quality(df, ["v"], ["city"], approx_distinct=True).first()
    assert exact["duplicate_rows"] == 1 and approx["duplicate_rows"] == 1
