"""Plan-shape checks: the physical plans we rely on for scale."""

import pytest

import __spark_entry__ as E

SF001 = "/root/testdata/sf0.001"
PYTHON_NODES = ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas")
ML_QUERIES = {
    "compare_models", "tune_model", "tune_trials", "train_run", "model_roundtrip", "model_roundtrip_same", "model_stages", "score_batch", "score_checks",
    "score_margins", "model_info", "train_test_split",
}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["dedup_latest", "limit_per_entity"])
def test_top_k_uses_partial_window_group_limit(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) + final


def test_no_python_workers_in_any_query(spark):
    qs = E.queries()
    cheap = [n for n in qs if n not in ML_QUERIES and not n.startswith("stream")]
    for n in cheap:
        plan = _plan(qs[n](spark, SF001))
        assert not any(p in plan for p in PYTHON_NODES), n


def test_curated_scan_prunes_and_pushes_down(spark):
    plan = _plan(E.queries()["curated_scan"](spark, SF001))
    assert "PartitionFilters: [isnotnull(city" in plan and "(city#" in plan
    assert "PushedFilters: [IsNotNull(pm2_5), GreaterThan(pm2_5,50.0)]" in plan


def test_no_cartesian_or_range_join(spark):
    qs = E.queries()
    for n in ["asof_features_ttl", "online_lookup", "dim_enrich", "prediction_join", "drift_features", "auc_ovr"]:
        plan = _plan(qs[n](spark, SF001))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, n


def test_raw_docs_stay_bounded_as_data_grows(spark, monkeypatch):
    """A landed doc is one hour of a fixed-size station block: its arrays do
    not grow with sf (checked with one-station blocks)."""
    from pyspark.sql import functions as F

    from envflow import bindings as B

    monkeypatch.setattr(B, "STATIONS_PER_DOC", 1)
    sizes = []
    for sf in (SF001, "/root/testdata/sf0.01"):
        docs = B.nest_hourly_docs(B.measurements_table(spark, sf))
        sizes.append(docs.agg(F.max(F.size("hourly.time"))).first()[0])
    assert sizes[1] <= 8 and sizes[1] <= sizes[0] + 2


def test_upsert_merge_prunes_target_partitions(spark, tmp_dir):
    """The affected (city, date) set is a checked broadcast, so the scan of
    the target table gets a dynamic partition filter."""
    from pyspark.sql import functions as F

    from envflow.operators.enrich import checked_broadcast

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    t = f"{tmp_dir}/t"
    ev.select(F.col("event_type").alias("city"), F.to_date("ts").alias("date"), "value").write.partitionBy("city", "date").parquet(t)
    batch = spark.read.parquet(t).filter(F.col("date") == F.lit("2024-01-05").cast("date"))
    affected = batch.select("city", "date").distinct()
    old = spark.read.parquet(t).join(checked_broadcast(affected), ["city", "date"], "left_semi")
    assert "dynamicpruning" in _plan(old).lower()


@pytest.mark.parametrize("name", ["score_batch", "model_roundtrip"])
def test_scoring_covers_the_whole_table(spark, name):
    got = E.queries()[name](spark, SF001)
    assert got.count() == spark.read.parquet(f"{SF001}/events.parquet").count()
