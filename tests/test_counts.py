import pytest
from pyspark.sql import functions as F

from envflow import bindings as B
from envflow.config import FEATURES, DriftSpec
from envflow.operators import counts as C
from envflow.operators.drift import drift_features, drift_of_counts
from envflow.operators.stats import data_quality
from envflow.streaming.incremental import start_drift_stream

SF001 = "/root/testdata/sf0.001"
SPEC = DriftSpec(numerical=tuple(FEATURES), categorical=("city", "air_quality_label"), tests=(("pm10", "psi"), ("ozone", "ks"), ("city", "chisquare")))


@pytest.fixture(scope="module")
def sides(spark):
    return B.reference_current(B.labeled_measurements(spark, SF001))


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    stats = C.DailyStatistics(spark, str(tmp_path_factory.mktemp("stats")), FEATURES, ["city", "air_quality_label"])
    rows = B.labeled_measurements(spark, SF001)
    early = F.col("timestamp") < F.lit("2024-01-10").cast("timestamp_ntz")
    stats.update(rows.filter(early).limit(50), "timestamp")  # replaced below
    stats.update(rows.filter(early), "timestamp")
    stats.update(rows.filter(~early), "timestamp")
    return stats


def _rows(df):
    cols = sorted(df.columns)
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in cols)]) for r in df.collect())


def test_drift_of_stored_days_equals_the_direct_one(sides, daily):
    ref, cur = sides
    num, cat = list(SPEC.numerical), list(SPEC.categorical)
    stored = drift_of_counts(daily.counts(None, "2024-01-15"), daily.counts("2024-01-16"), num, cat, SPEC)
    assert _rows(stored) == _rows(drift_features(ref, cur, SPEC))


def test_quality_of_counts_equals_the_direct_one(sides):
    ref, _ = sides
    got = C.quality(C.value_counts(ref, FEATURES, ["city"]))
    assert _rows(got) == _rows(data_quality(ref, FEATURES, ["city"]).select(*got.columns))


def test_sketches_of_days_are_merged(sides, daily):
    ref, _ = sides
    got = {r["feature"]: r["n_distinct"] for r in daily.distinct(None, "2024-01-15").collect()}
    for c in ("pm2_5", "city", "us_aqi"):
        assert abs(got[c] - ref.select(c).dropna().distinct().count()) <= 0.05 * got[c] + 1


def test_ranges_of_days_prune_folders(daily):
    plan = daily.counts("2024-01-20", "2024-01-21")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_nan_is_missing_and_counts_add_up(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "a"), (1.0, "b")], "x double, c string")
    got = {(r["kind"], r["num"], r["cat"]): r["n"] for r in C.value_counts(df, ["x"], ["c"]).collect()}
    assert got == {("num", 1.0, None): 2, ("num", None, None): 2, ("cat", None, "a"): 2, ("cat", None, None): 1, ("cat", None, "b"): 1}
    twice = C.merged(C.value_counts(df, ["x"], ["c"]).unionByName(C.value_counts(df.limit(0), ["x"], ["c"])))
    assert sum(r["n"] for r in twice.collect()) == 8


def test_a_drift_stream_reads_the_reference_once(spark, sides, daily, tmp_path):
    ref, cur = sides
    folder, data = tmp_path / "reference", str(tmp_path / "current")
    ref.write.parquet(str(folder))
    schema, spec = cur.select(*FEATURES).schema, DriftSpec(numerical=tuple(FEATURES))
    want = [_rows(drift_features(ref, cur.filter(f"version % 2 = {i}"), spec)) for i in (0, 1)]
    for i in (0, 1):
        cur.filter(f"version % 2 = {i}").select(*FEATURES).write.mode("append").parquet(data)
        if i:  # the reference is gone by now, what was counted of it stays
            for f in folder.iterdir():
                f.unlink()
            held = daily.counts(None, "2024-01-15")
        else:
            held = spark.read.parquet(str(folder))
        q = start_drift_stream(spark, data, schema, held, str(tmp_path / "log"), str(tmp_path / "ck"), spec)
        q.awaitTermination()
        assert q.exception() is None
    log = spark.read.parquet(str(tmp_path / "log"))
    assert [_rows(log.filter(F.col("batch_id") == i).drop("batch_id")) for i in (0, 1)] == want
