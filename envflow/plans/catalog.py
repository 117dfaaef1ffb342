"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them read the driver's tables (or data Spark derives from them) in
full; nothing is sampled or capped except where a limit is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import bindings as B
from ..config import CITIES, FEATURES, air_quality_view, inference_service, training_service
from ..functions.labels import five_band, three_band
from ..functions.rules import prediction_rules, scoring_input_rules, with_violations
from ..functions.scalars import landing_key, parse_time, sanitize_name
from ..operators.dedup import latest_per_entity, latest_per_key
from ..operators.enrich import checked_broadcast, enrich, unknown_entities
from ..operators.features import FeatureSource, asof_join, cast_to_view, service_frame
from ..operators.flatten import flatten_hourly, long_to_wide
from ..operators.prep import align_features, limit_per_entity, prepare_training, preview, reference_load
from ..operators.stats import ingest_runs, ingest_summary, label_counts, label_shares, payload_summary, reference_stats
from ..session import materialize, scratch_path
from ..sources.curated import read_curated, write_curated
from ..sources.raw import land_raw, read_long_feed, read_raw_json, stamp_fetch, union_feeds
from .curated import run_curated
from ..functions.rules import validate_batches
from ..config import DriftSpec
from ..operators.counts import DailyStatistics
from ..operators.drift import drift_features, drift_of_counts, target_drift
from ..operators.metrics import auc_ovr, classification_metrics, confusion_matrix, leaderboard_from, prediction_join, select_model
from ..operators.stats import data_quality
from ..sources.registry import latest_artifact, log_runs, metrics_long, run_rows_from_metrics
from .monitoring import detect_drift, quick_drift_check, run_tests, summarize_tests, write_report
from pyspark.ml import Pipeline
from ..sources.curated import manifest_by_difference, manifest_diff, snapshot_manifest
from ..sources.registry import load_model, save_model
from .scoring import model_info, model_stages, score
from ..streaming.incremental import (
    curated_snapshots,
    materialize_step,
    read_upserted,
    start_curated_stream,
    start_drift_stream,
    upsert_latest,
)
from .training import (
    class_labels,
    compare_models,
    default_candidates,
    estimator,
    feature_stages,
    fitted_parts,
    fitted_pipeline,
    fold_vectors,
    isolated_table,
    out_of_fold,
    prepare,
    run_training,
    split_flag,
    training_size,
    tune_model,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


# ---------------------------------------------------------------- fixtures
def landed_raw_path(spark: SparkSession, sf_dir: str) -> str:
    """Nest events into hourly raw docs and land them as JSON (one job)."""
    path = scratch_path(spark, "raw")
    land_raw(B.nest_hourly_docs(B.measurements_table(spark, sf_dir)), path)
    return path


def landed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw_json(spark, landed_raw_path(spark, sf_dir), multi_line=False)


def curated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated table, built end to end and read back from Parquet."""
    raw_path = landed_raw_path(spark, sf_dir)
    out = scratch_path(spark, "curated")
    run_curated(spark, raw_path, out, multi_line=False)
    return read_curated(spark, out)


# ---------------------------------------------------------------- M10
@register("curated_build")
def q_curated_build(spark, sf):
    return curated_table(spark, sf)


# ---------------------------------------------------------------- A: sources
@register("raw_json_scan")
def q_raw_json_scan(spark, sf):
    raw = landed_raw(spark, sf)
    return raw.select(
        "city",
        "city_name",
        "latitude",
        "longitude",
        "timezone",
        parse_time("fetch_timestamp").alias("fetch_timestamp"),
        F.size("hourly.time").cast("bigint").alias("n_hours"),
    )


@register("land_raw_roundtrip")
def q_land_raw_roundtrip(spark, sf):
    raw = landed_raw(spark, sf)
    return raw.groupBy("city").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.size("hourly.time")).cast("bigint").alias("n_hours"),
        F.min(landing_key(parse_time("fetch_timestamp"))).alias("first_key"),
        F.max(landing_key(parse_time("fetch_timestamp"))).alias("last_key"),
    )


@register("curated_scan")
def q_curated_scan(spark, sf):
    cur = curated_table(spark, sf)
    # city is a partition column: the filter prunes folders; pm2_5 is pushed down
    return cur.filter((F.col("city") == "click") & (F.col("pm2_5") > 50.0)).select(
        "city", "timestamp", "pm2_5", "air_quality_label"
    )


@register("curated_write_roundtrip")
def q_curated_write_roundtrip(spark, sf):
    raw_path = landed_raw_path(spark, sf)
    out = scratch_path(spark, "curated")
    run_curated(spark, raw_path, out, multi_line=False)
    cur = read_curated(spark, out)
    # rewrite one city with a subset: dynamic overwrite leaves the others alone
    write_curated(cur.filter((F.col("city") == "view") & (F.col("pm2_5") > 100.0)), out)
    back = read_curated(spark, out)
    return back.groupBy("city").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("pm2_5"), 6).alias("sum_pm2_5")
    )


@register("raw_rejects")
def q_raw_rejects(spark, sf):
    """Every reject of a run: broken JSON, unparsable times, AQI that is not whole."""
    ev = B.table(spark, sf, "events")
    raw_path = landed_raw_path(spark, sf)
    doc = F.format_string(
        '{"city_name": "odd", "fetch_timestamp": "2024-01-01T00:00:00", "hourly": {"time": ["%s"], "us_aqi": [%s]}}',
        F.when(F.col("event_id") % 3 == 1, F.lit("no time")).otherwise(F.lit("2024-01-01T00:00")),
        F.when(F.col("event_id") % 3 == 2, F.lit("41.5")).otherwise(F.lit("41")),
    )
    odd = ev.filter(F.col("event_id") % 10 == 0).select(
        F.when(F.col("event_id") % 3 == 0, F.substring(doc, 1, 60)).otherwise(doc).alias("value")
    )
    odd.write.text(f"{raw_path}/city=odd")
    run = run_curated(spark, raw_path, scratch_path(spark, "curated"), multi_line=False)
    return spark.read.parquet(run.reject_path).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


@register("long_feed_explode")
def q_long_feed_explode(spark, sf):
    path = scratch_path(spark, "feed")
    B.nest_long_feed_docs(B.measurements_table(spark, sf)).write.json(path)
    rows = read_long_feed(spark, path, multi_line=False)
    return rows.filter(F.col("parameter") == "pm25")


# ---------------------------------------------------------------- B: projections / predicates
@register("hourly_explode")
def q_hourly_explode(spark, sf):
    rows = flatten_hourly(landed_raw(spark, sf))
    return rows.select("city", "timestamp", *FEATURES, "parameter", "pos", "fetch_timestamp")


@register("parse_event_time")
def q_parse_event_time(spark, sf):
    ev = B.table(spark, sf, "events")
    raw = F.when(F.col("event_id") % 97 == 0, F.lit("not-a-time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    )
    return ev.select("event_id", raw.alias("time_raw")).select(
        "event_id", "time_raw", parse_time("time_raw").alias("timestamp")
    )


@register("quality_label")
def q_quality_label(spark, sf):
    m = B.measurements_table(spark, sf)
    return m.select("version", "pm2_5", three_band("pm2_5").alias("air_quality_label"))


@register("quality_label_five_band")
def q_quality_label_five_band(spark, sf):
    m = B.measurements_table(spark, sf)
    return m.select("version", "pm2_5", five_band("pm2_5").alias("air_quality_label"))


@register("prepare_training")
def q_prepare_training(spark, sf):
    lm = B.labeled_measurements(spark, sf).drop("version", "station_id")
    return prepare_training(lm)


@register("reference_load")
def q_reference_load(spark, sf):
    ref, _ = B.reference_current(B.labeled_measurements(spark, sf))
    return reference_load(ref)


@register("align_features")
def q_align_features(spark, sf):
    m = B.measurements_table(spark, sf).select("version", "pm2_5", "pm10", "us_aqi", "ozone")
    return align_features(m, keep=["version"])


@register("feature_view_cast")
def q_feature_view_cast(spark, sf):
    return cast_to_view(B.labeled_measurements(spark, sf), air_quality_view(tiebreak=("version",)))


@register("feature_service_training")
def q_feature_service_training(spark, sf):
    return service_frame(B.labeled_measurements(spark, sf), training_service(air_quality_view()))


@register("feature_service_inference")
def q_feature_service_inference(spark, sf):
    return service_frame(B.labeled_measurements(spark, sf), inference_service(air_quality_view()))


@register("validate_rows")
def q_validate_rows(spark, sf):
    m = B.measurements_table(spark, sf)
    checked = with_violations(m, scoring_input_rules())
    return checked.select(
        "version",
        F.size("violations").alias("n_violations"),
        F.array_join("violations", ",").alias("violations"),
    )


@register("validate_predictions")
def q_validate_predictions(spark, sf):
    """The confidence range rule over all stored predictions, some of which are out of range."""
    pred = B.stored_predictions(B.table(spark, sf, "events"))
    best = F.greatest("p_good", "p_moderate", "p_unhealthy")
    rows = pred.withColumn("confidence", F.when(F.col("event_id") % 13 == 0, best + 1.0).otherwise(best))
    checked = with_violations(rows, prediction_rules())
    return checked.groupBy("model", F.array_join("violations", ",").alias("violations")).agg(F.count(F.lit(1)).alias("n"))


@register("validate_batches")
def q_validate_batches(spark, sf):
    orders = B.table(spark, sf, "orders")
    return validate_batches(orders, "o_custkey")


@register("limit_per_entity")
def q_limit_per_entity(spark, sf):
    m = B.measurements_table(spark, sf)
    return limit_per_entity(m, "city", ["timestamp", "version"], 100).select("city", "version", "timestamp", "rank")


@register("limit_per_entity_5000")
def q_limit_per_entity_5000(spark, sf):
    """A limit beyond Spark's partial window limit: salted, in two steps."""
    m = B.measurements_table(spark, sf)
    return limit_per_entity(m, "city", ["timestamp", "version"], 5000).select("city", "version", "timestamp", "rank")


@register("sanitize_name")
def q_sanitize_name(spark, sf):
    part = B.table(spark, sf, "part")
    return part.select("p_partkey", "p_type", sanitize_name("p_type").alias("folder"))


@register("long_to_wide")
def q_long_to_wide(spark, sf):
    long = B.long_feed_rows(B.measurements_table(spark, sf))
    return long_to_wide(long, ["city", "ts"], values=[p for p, _ in B.LONG_PARAMETER_COLUMNS])


# ---------------------------------------------------------------- C: joins
def _customer_with_shifted_key(spark, sf):
    c = B.table(spark, sf, "customer")
    return c.select("c_custkey", (F.col("c_nationkey") + 3).alias("nation_key"))


def _nation_region(spark, sf):
    n = B.table(spark, sf, "nation")
    r = B.table(spark, sf, "region")
    return n.join(checked_broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


@register("dim_enrich")
def q_dim_enrich(spark, sf):
    return enrich(_customer_with_shifted_key(spark, sf), _nation_region(spark, sf), "nation_key", "n_nationkey", ["n_name", "r_name"])


@register("city_enrich")
def q_city_enrich(spark, sf):
    """Coordinates from the city table; explicit ones on the row win, unknown cities have none."""
    names = sorted(CITIES)
    cities = spark.createDataFrame([(c, *CITIES[c]) for c in names], "city string, latitude double, longitude double")
    ev = B.table(spark, sf, "events")
    city = F.get(F.array(*[F.lit(c) for c in names]), (F.col("event_id") % 8).cast("int"))
    given = F.col("event_id") % 5 == 0
    rows = ev.select(
        "event_id",
        F.coalesce(city, F.lit("elsewhere")).alias("city"),
        F.when(given, F.col("value")).alias("own_latitude"),
        F.when(given, -F.col("value")).alias("own_longitude"),
    )
    explicit = {"latitude": "own_latitude", "longitude": "own_longitude"}
    return enrich(rows, cities, "city", "city", ["latitude", "longitude"], explicit).select("event_id", "city", "latitude", "longitude")


@register("stamp_fetch")
def q_stamp_fetch(spark, sf):
    docs = stamp_fetch(B.nest_hourly_docs(B.measurements_table(spark, sf)), city="Lima", fetch_ts="2024-02-01T00:00:00")
    return docs.groupBy("city_name", "fetch_timestamp").agg(F.count("*").alias("n_docs"))


@register("preview")
def q_preview(spark, sf):
    """The first rows of an order: the limit is the feature."""
    rows = B.measurements_table(spark, sf).select("city", "timestamp", "version")
    return preview(rows, ["timestamp", "version"], 5)


@register("unknown_entities")
def q_unknown_entities(spark, sf):
    return unknown_entities(_customer_with_shifted_key(spark, sf), _nation_region(spark, sf), "nation_key", "n_nationkey")


def _spine_and_features(spark, sf):
    ev = B.table(spark, sf, "events")
    spine = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    feats = ev.filter(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("value").alias("view_value"), F.col("event_id").alias("view_id")
    )
    return spine, feats


@register("asof_features_ttl")
def q_asof_features_ttl(spark, sf):
    spine, feats = _spine_and_features(spark, sf)
    path = scratch_path(spark, "features")
    feats.write.parquet(path)
    source = FeatureSource(path, "view_ts")
    return asof_join(spine, source, "user_id", "ts", ["view_value", "view_id"], ttl_seconds=6 * 3600, tiebreak=("view_id",))


def _latest_views(spark, sf):
    _, feats = _spine_and_features(spark, sf)
    return latest_per_entity(feats, "user_id", ["view_ts", "view_id"])


ONLINE_NOW = "2024-01-30 00:00:00"


@register("online_lookup")
def q_online_lookup(spark, sf):
    keys = B.table(spark, sf, "customer").select("c_custkey")
    return _materialized_views(spark, sf).lookup(keys, ["view_value"], ONLINE_NOW, 7 * 86400, key_col="c_custkey")


# ---------------------------------------------------------------- D: aggregations
@register("label_counts")
def q_label_counts(spark, sf):
    return label_counts(B.labeled_measurements(spark, sf), "air_quality_label")


@register("label_shares")
def q_label_shares(spark, sf):
    m = B.measurements_table(spark, sf)
    lab = F.when(F.col("pm2_5").isNotNull(), three_band("pm2_5")).alias("air_quality_label")
    return label_shares(m.select(lab), "air_quality_label").withColumn("share", F.round("share", 6))


@register("stage_audit")
def q_stage_audit(spark, sf):
    raw_path = landed_raw_path(spark, sf)
    run = run_curated(spark, raw_path, scratch_path(spark, "curated"), multi_line=False)
    # the counts were observed on the write job; published as a table
    rows = [(k, int(v)) for k, v in run.counts.items()]
    return spark.createDataFrame(rows, "stage string, n_rows bigint")


@register("reference_stats")
def q_reference_stats(spark, sf):
    ref, _ = B.reference_current(B.labeled_measurements(spark, sf))
    st = reference_stats(reference_load(ref), FEATURES)
    return st.select("feature", "n_rows", *[F.round(c, 6).alias(c) for c in ["mean", "std", "min", "max", "median"]])


@register("payload_summary")
def q_payload_summary(spark, sf):
    return payload_summary(landed_raw(spark, sf))


@register("ingest_summary")
def q_ingest_summary(spark, sf):
    return ingest_summary(B.measurements_table(spark, sf), "city", "timestamp")


@register("ingest_runs")
def q_ingest_runs(spark, sf):
    """Run summaries in the runs table: what was read, from where, when."""
    path, runs = landed_raw_path(spark, sf), scratch_path(spark, "runs")
    log_runs(ingest_runs(B.measurements_table(spark, sf), "city", "timestamp", "events", path, "2024-02-01 00:00:00"), runs)
    back = spark.read.parquet(runs)
    return back.select(
        "run_name", F.col("params.source").alias("source"), (F.col("params.path") == path).alias("has_path"),
        (F.col("logged_at") == F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")).alias("has_time"), F.col("metrics.records").alias("records"),
    )


# ---------------------------------------------------------------- E: windows
@register("dedup_latest")
def q_dedup_latest(spark, sf):
    ev = B.table(spark, sf, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return latest_per_key(ev, ["user_id", "hour"], ["event_id"]).select("user_id", "hour", "event_id", "value")


@register("latest_per_entity")
def q_latest_per_entity(spark, sf):
    return _latest_views(spark, sf)


# ---------------------------------------------------------------- G / H
@register("union_feeds")
def q_union_feeds(spark, sf):
    m = B.measurements_table(spark, sf)
    hourly = flatten_hourly(landed_raw(spark, sf)).select(
        F.lit("hourly").alias("source"), "city", "timestamp", "pm2_5", "pm10"
    )
    wide = long_to_wide(B.long_feed_rows(m), ["city", "ts"], values=[p for p, _ in B.LONG_PARAMETER_COLUMNS]).select(
        F.lit("long").alias("source"), "city", F.col("ts").alias("timestamp"), F.col("pm25").alias("pm2_5"), F.col("o3").alias("ozone")
    )
    return union_feeds(hourly, wide)


@register("format_landing_key")
def q_format_landing_key(spark, sf):
    ev = B.table(spark, sf, "events")
    return ev.select("event_id", landing_key("ts").alias("landing_key"))


@register("json_props")
def q_json_props(spark, sf):
    ev = B.table(spark, sf, "events")
    parsed = F.from_json("props", "k bigint")
    return ev.select(
        "event_id",
        parsed["k"].alias("k"),
        F.to_json(F.struct(parsed["k"].alias("k"), F.col("event_type"))).alias("json"),
    )


# ---------------------------------------------------------------- D: drift, quality, tests
def _ref_cur(spark, sf):
    lm = B.labeled_measurements(spark, sf)
    ref, cur = B.reference_current(lm)
    return reference_load(ref), cur.select(*FEATURES, "air_quality_label")


def _round_cols(df, cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("drift_features")
def q_drift_features(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    return _round_cols(drift_features(ref, cur, DriftSpec()), ["statistic", "drift_score"])


@register("drift_sample_tests")
def q_drift_sample_tests(spark, sf):
    lm = B.labeled_measurements(spark, sf)
    ref, cur = B.reference_current(lm)
    spec = DriftSpec(categorical=("air_quality_label",), numeric_test="ks", categorical_test="chisquare")
    return _round_cols(drift_features(ref, cur, spec), ["statistic", "drift_score"])


@register("drift_chi2_wide")
def q_drift_chi2_wide(spark, sf):
    """Chi-square over a column of 300 categories (299 degrees of freedom)."""
    ev = B.table(spark, sf, "events").select((F.col("user_id") % 300).cast("string").alias("user_group"), F.col("ts").alias("timestamp"))
    ref, cur = B.reference_current(ev)
    spec = DriftSpec(numerical=(), categorical=("user_group",), categorical_test="chisquare")
    return _round_cols(drift_features(ref, cur, spec), ["statistic", "drift_score"])


@register("drift_dataset")
def q_drift_dataset(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    ds, _ = detect_drift(ref, cur, DriftSpec())
    return _round_cols(ds, ["drift_score"])


@register("quick_drift")
def q_quick_drift(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    return _round_cols(quick_drift_check(ref, cur), ["drift_score"])


@register("target_drift")
def q_target_drift(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    return _round_cols(target_drift(ref, cur, "air_quality_label"), ["statistic", "drift_score"])


@register("data_quality")
def q_data_quality(spark, sf):
    dq = data_quality(B.labeled_measurements(spark, sf), FEATURES, ["air_quality_label"])
    return _round_cols(dq, ["null_share", "min", "max", "mean", "most_common_share"])


@register("monitoring_tests")
def q_monitoring_tests(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    return _round_cols(run_tests(ref, cur), ["value", "bound"])


@register("monitoring_summary")
def q_monitoring_summary(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    return summarize_tests(run_tests(ref, cur))


@register("monitoring_report")
def q_monitoring_report(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    base = scratch_path(spark, "reports")
    write_report(spark, ref, cur, base, "drift_report_events")
    back = spark.read.parquet(f"{base}/feature_drift")
    return back.select("report_id", "feature", "stattest", F.round("drift_score", 6).alias("drift_score"), "drift_detected")


# ---------------------------------------------------------------- metrics on stored predictions
def _predictions(spark, sf):
    return B.stored_predictions(B.table(spark, sf, "events"))


def _metrics_table(spark, sf):
    pred = _predictions(spark, sf)
    m = classification_metrics(confusion_matrix(pred))
    auc = auc_ovr(B.probabilities_long(pred))
    return m.join(auc, "model", "left")


METRIC_NAMES = ["accuracy", "auc", "recall", "prec", "f1", "kappa"]


@register("confusion_matrix")
def q_confusion_matrix(spark, sf):
    return confusion_matrix(_predictions(spark, sf))


@register("classification_metrics")
def q_classification_metrics(spark, sf):
    m = classification_metrics(confusion_matrix(_predictions(spark, sf)))
    return _round_cols(m, ["accuracy", "recall", "prec", "f1", "kappa"])


@register("auc_ovr")
def q_auc_ovr(spark, sf):
    return _round_cols(auc_ovr(B.probabilities_long(_predictions(spark, sf))), ["auc"])


@register("auc_ovr_ranges")
def q_auc_ovr_ranges(spark, sf):
    """The same by ranges of scores, as for groups too large for one task."""
    return _round_cols(auc_ovr(B.probabilities_long(_predictions(spark, sf)), buckets=16, single_task_rows=None), ["auc"])


@register("leaderboard")
def q_leaderboard(spark, sf):
    return _round_cols(leaderboard_from(_metrics_table(spark, sf), "f1", 5), METRIC_NAMES)


@register("select_model")
def q_select_model(spark, sf):
    board = leaderboard_from(_metrics_table(spark, sf), "f1", 5)
    return _round_cols(select_model(board, min_f1=0.75, min_auc=0.95), METRIC_NAMES)


@register("prediction_join")
def q_prediction_join(spark, sf):
    pred = _predictions(spark, sf).select("model", "event_id", "prediction")
    actual = B.table(spark, sf, "events").select("event_id", three_band("value").alias("label"))
    return prediction_join(pred, actual, "event_id")


@register("run_log_metrics")
def q_run_log_metrics(spark, sf):
    board = leaderboard_from(_metrics_table(spark, sf), "f1", 5)
    best = board.filter(F.col("rank") == 1)
    runs = run_rows_from_metrics(best, "compare_models", "best_", METRIC_NAMES, {"sort_metric": "f1"})
    path = scratch_path(spark, "runs")
    log_runs(runs, path)
    return metrics_long(spark.read.parquet(path)).withColumn("value", F.round("value", 6))


@register("latest_artifact")
def q_latest_artifact(spark, sf):
    ev = B.table(spark, sf, "events")
    registry = ev.select(
        F.concat(F.lit("air_quality_"), F.col("event_type")).alias("name"),
        F.concat(F.lit("models/"), F.col("event_type"), F.lit("/v"), F.col("event_id").cast("string")).alias("path"),
        F.col("ts").alias("saved_at"),
    )
    return latest_artifact(registry)


# ---------------------------------------------------------------- K: Spark ML (rows-only checks)
def _training_table(spark, sf):
    return B.labeled_measurements(spark, sf)


def _split(spark, sf):
    data = isolated_table(split_flag(prepare(_training_table(spark, sf)), ["version"]))
    return data.filter("is_train").drop("is_train"), data.filter("NOT is_train").drop("is_train")


def _dt_candidate():
    return [c for c in default_candidates() if c.family == "dt"][0]


def _fit_dt(spark, sf):
    train, test = _split(spark, sf)
    c = _dt_candidate()
    labels = class_labels(train)
    pipe = Pipeline(stages=feature_stages(FEATURES, "air_quality_label", c.scaled) + [c.build(len(FEATURES), len(labels), 42)])
    return pipe.fit(train), train, test, labels


@register("train_test_split")
def q_train_test_split(spark, sf):
    data = split_flag(prepare(_training_table(spark, sf)), ["version"])
    return data.groupBy("is_train", "air_quality_label").agg(F.count(F.lit(1)).alias("n"))


@register("compare_models")
def q_compare_models(spark, sf):
    train, test = _split(spark, sf)
    board, _ = compare_models(train, test)
    return board


@register("tune_model")
def q_tune_model(spark, sf):
    train, test = _split(spark, sf)
    _, trials, _ = tune_model(train, test, _dt_candidate())
    return trials


@register("train_run")
def q_train_run(spark, sf):
    res = run_training(spark, _training_table(spark, sf), ["version"], save_path=scratch_path(spark, "model"))
    log_runs(res.runs, scratch_path(spark, "runs"))
    tuned = res.tuned_metrics.select(*[F.col(c).alias(f"tuned_{c}") for c in res.tuned_metrics.columns if c != "model"])
    return tuned.select(
        F.lit(res.model_name).alias("model_name"),
        F.lit(res.model_path).alias("model_path"),
        F.lit(float(res.metrics["f1"])).alias("selected_f1"),
        "*",
    )


@register("model_roundtrip")
def q_model_roundtrip(spark, sf):
    model, _, _, labels = _fit_dt(spark, sf)
    path = save_model(model, scratch_path(spark, "model"))
    loaded = load_model(path)
    rows = B.measurements_table(spark, sf)
    before = score(model, rows, keep=["version"], labels=labels).select("version", F.col("prediction").alias("before"))
    after = score(loaded, rows, keep=["version"], labels=labels)
    return after.join(before, "version").withColumn("same", F.col("prediction") == F.col("before"))


@register("tune_trials")
def q_tune_trials(spark, sf):
    """How many trials a tuning makes, how many of them differ, and that each has a score."""
    train, test = _split(spark, sf)
    _, trials, _ = tune_model(train, test, _dt_candidate())
    scored = F.count_if(F.col("validation_metric").between(0.0, 1.0))
    return trials.agg(F.count("*").alias("n_trials"), F.count_distinct("params").alias("n_points"), scored.alias("n_scored"))


@register("score_checks")
def q_score_checks(spark, sf):
    """Scores of the whole table: a row each, a known class, probabilities that sum to 1."""
    model, _, _, labels = _fit_dt(spark, sf)
    out = score(model, B.measurements_table(spark, sf).drop("sulphur_dioxide", "ozone"), keep=["version"], labels=labels)
    return _score_checks(out, labels)


def _score_checks(out, labels):
    total = F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda a, x: a + x)
    best = F.array_max(F.map_values("probabilities"))
    return out.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("version").alias("n_versions"),
        F.count_if(F.col("prediction").isin(labels)).alias("n_known"),
        F.count_if(F.abs(total - 1) < 1e-9).alias("n_sum_one"),
        F.count_if(F.col("confidence") == best).alias("n_confident"),
    )


@register("score_batch")
def q_score_batch(spark, sf):
    model, _, _, labels = _fit_dt(spark, sf)
    # scoring requests lack two gases: they score as 0, nulls are imputed
    req = B.measurements_table(spark, sf).drop("sulphur_dioxide", "ozone")
    return score(model, req, keep=["version"], labels=labels)


@register("model_stages")
def q_model_stages(spark, sf):
    model, _, _, _ = _fit_dt(spark, sf)
    return model_stages(load_model(save_model(model, scratch_path(spark, "model"))))


@register("model_roundtrip_same")
def q_model_roundtrip_same(spark, sf):
    return q_model_roundtrip(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("same").alias("n_same"))


@register("training_size")
def q_training_size(spark, sf):
    return training_size(prepare(_training_table(spark, sf)))


@register("score_margins")
def q_score_margins(spark, sf):
    """Scores of the whole table by a one-vs-rest model, whose margins are calibrated."""
    train, _ = _split(spark, sf)
    labels = class_labels(train)
    candidate = next(c for c in default_candidates() if c.family == "svc_ovr")
    folds = fold_vectors(train, FEATURES, "air_quality_label", labels, 2, 42)

    def build():
        return estimator(candidate, FEATURES, labels, 42)

    models = fitted_parts(folds, build)
    model = fitted_pipeline(folds, models, out_of_fold(folds, models)[1])
    return _score_checks(score(model, B.measurements_table(spark, sf), keep=["version"], labels=labels), labels)


@register("model_info")
def q_model_info(spark, sf):
    model, _, _, labels = _fit_dt(spark, sf)
    path = save_model(model, scratch_path(spark, "model"))
    reg = scratch_path(spark, "registry")
    row = _training_table(spark, sf).agg(F.max("timestamp").alias("saved_at")).select(
        F.lit("air_quality_decision_tree_classifier_tuned").alias("name"),
        F.lit(path).alias("path"),
        "saved_at",
        F.lit(type(model.stages[-1]).__name__).alias("model_type"),
        F.array(*[F.lit(c) for c in FEATURES]).alias("features"),
        F.array(*[F.lit(c) for c in labels]).alias("classes"),
    )
    row.write.mode("append").parquet(reg)
    return model_info(latest_artifact(spark.read.parquet(reg)))


@register("snapshot_manifest")
def q_snapshot_manifest(spark, sf):
    raw_path = landed_raw_path(spark, sf)
    out = scratch_path(spark, "curated")
    run_curated(spark, raw_path, out, multi_line=False)
    _, dataset = snapshot_manifest(read_curated(spark, out))
    return dataset


@register("snapshot_manifest_rows")
def q_snapshot_manifest_rows(spark, sf):
    """What a manifest tells of the raw and of the curated side: rows, and that two scans agree."""
    raw_path, out = landed_raw_path(spark, sf), scratch_path(spark, "curated")
    run_curated(spark, raw_path, out, multi_line=False)
    sides = {"raw": lambda: read_raw_json(spark, raw_path, multi_line=False).drop("source_file"), "curated": lambda: read_curated(spark, out)}
    parts = []
    for side, scan in sides.items():
        a, b = (snapshot_manifest(scan())[1] for _ in range(2))
        again = b.select(F.col("content_hash").alias("again"))
        parts.append(a.crossJoin(F.broadcast(again)).select(F.lit(side).alias("side"), "rows", (F.col("content_hash") == F.col("again")).alias("same")))
    return parts[0].unionByName(parts[1])



@register("snapshot_diff")
def q_snapshot_diff(spark, sf):
    """Files of two manifests by city and status; the second manifest reads only what was written since the first."""
    out = scratch_path(spark, "curated")
    cur = curated_table(spark, sf)
    write_curated(cur, out)
    before = materialize(manifest_by_difference(spark, out))
    write_curated(cur.filter((F.col("city") == "view") & (F.col("pm2_5") > 100.0)), out)
    write_curated(cur.filter(F.col("city") == "click").withColumn("city", F.lit("new")), out)
    diff = manifest_diff(before, manifest_by_difference(spark, out, before))
    city = F.regexp_extract("file_path", "city=([^/]*)", 1).alias("city")
    return diff.groupBy(city, "status").agg(F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after"))


# ---------------------------------------------------------------- I: incremental / streaming
def _land_waves(spark, sf, raw_path, cutoff=B.REFERENCE_CUTOFF):
    """Land docs in two waves; the second repeats the last day of the first."""
    docs = B.nest_hourly_docs(B.measurements_table(spark, sf))
    fetched = parse_time("fetch_timestamp")
    c = F.lit(cutoff).cast("timestamp_ntz")
    wave1 = docs.filter(fetched < c)
    wave2 = docs.filter(fetched >= c - F.expr("INTERVAL 1 DAY"))
    return wave1, wave2


def _run_stream(q):
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


@register("stream_curated")
def q_stream_curated(spark, sf):
    raw, table = scratch_path(spark, "raw"), scratch_path(spark, "curated_stream")
    ck = scratch_path(spark, "ckpt")
    w1, w2 = _land_waves(spark, sf, raw)
    land_raw(w1, raw)
    _run_stream(start_curated_stream(spark, raw, table, ck))
    land_raw(w2, raw)
    _run_stream(start_curated_stream(spark, raw, table, ck))
    return read_upserted(spark, table)


UPSERT_DAY = "2024-01-10"


@register("stream_upsert")
def q_stream_upsert(spark, sf):
    raw, table = scratch_path(spark, "raw"), scratch_path(spark, "curated_stream")
    ck = scratch_path(spark, "ckpt")
    docs = B.nest_hourly_docs(B.measurements_table(spark, sf))
    land_raw(docs, raw)
    _run_stream(start_curated_stream(spark, raw, table, ck))
    # a later fetch of one day with revised values must replace the first one
    day = F.to_date(parse_time("fetch_timestamp")) == F.lit(UPSERT_DAY).cast("date")
    revised = docs.filter(day).select(
        "latitude",
        "longitude",
        "timezone",
        "city_name",
        F.date_format(parse_time("fetch_timestamp") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(
            "fetch_timestamp"
        ),
        "hourly_units",
        F.col("hourly").withField("pm2_5", F.transform("hourly.pm2_5", lambda x: x + F.lit(1000.0))).alias("hourly"),
    )
    land_raw(revised, raw)
    _run_stream(start_curated_stream(spark, raw, table, ck))
    return read_upserted(spark, table)


@register("upsert_snapshot")
def q_upsert_snapshot(spark, sf):
    """Every version of a snapshot table stays readable: the first landing, a revised day, and the compacted table."""
    cur = curated_table(spark, sf).withColumn("pos", F.lit(0))
    path = scratch_path(spark, "snapshots")
    day = F.to_date("timestamp") == F.lit(UPSERT_DAY).cast("date")
    revised = cur.filter(day).withColumns({"pm2_5": F.col("pm2_5") + 1000.0, "fetch_timestamp": F.col("fetch_timestamp") + F.expr("INTERVAL 1 DAY")})
    upsert_latest(spark, cur, path, "landing", 0)
    upsert_latest(spark, revised, path, "revision", 0)
    upsert_latest(spark, cur.filter(day), path, "revision", 0)  # the same batch of the same run: nothing happens
    table = curated_snapshots(spark, path)
    table.append(table.read().filter("city = 'view'").withColumn("city", F.lit("again")))
    table.compact()
    parts = [table.read(v).groupBy("city").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("pm2_5"), 4).alias("sum_pm2_5")).withColumn("version", F.lit(v)) for v in table.versions()[:3]]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


MATERIALIZE_ENDS = ["2024-01-10 00:00:00", "2024-01-20 00:00:00"]


def _materialized_views(spark, sf):
    _, feats = _spine_and_features(spark, sf)
    path, table = scratch_path(spark, "latest"), None
    # the last step ends where the data does
    last = feats.agg(F.max("view_ts").cast("string")).first()[0]
    for end in [*[e for e in MATERIALIZE_ENDS if last and e < last], last]:
        table = materialize_step(spark, feats, "user_id", "view_ts", ["view_ts", "view_id"], end, path)
    return table


@register("materialize_incremental")
def q_materialize_incremental(spark, sf):
    return _materialized_views(spark, sf).read()


@register("drift_stored_days")
def q_drift_stored_days(spark, sf):
    """Drift between two ranges of days from statistics that were stored day by day."""
    stats = DailyStatistics(spark, scratch_path(spark, "statistics"), FEATURES)
    ref, cur = B.reference_current(B.labeled_measurements(spark, sf))
    for wave in (ref.dropna(subset=FEATURES), cur):
        stats.update(wave, "timestamp")
    drift = drift_of_counts(stats.counts(None, "2024-01-15"), stats.counts("2024-01-16"), FEATURES, [])
    return _round_cols(drift, ["statistic", "drift_score"])


STREAM_DRIFT_SPLIT = "2024-01-23 00:00:00"


@register("stream_drift")
def q_stream_drift(spark, sf):
    ref, _ = _ref_cur(spark, sf)
    cur_path, log, ck = scratch_path(spark, "current"), scratch_path(spark, "drift_log"), scratch_path(spark, "ckpt")
    # two landings by time, each drained by a run of its own: the batches are the landings
    lm = B.labeled_measurements(spark, sf)
    ref, cur = materialize(ref), lm.filter(F.col("timestamp") >= F.lit(B.REFERENCE_CUTOFF).cast("timestamp_ntz"))
    early = F.col("timestamp") < F.lit(STREAM_DRIFT_SPLIT).cast("timestamp_ntz")
    for wave in (cur.filter(early), cur.filter(~early)):
        wave = wave.select(*FEATURES, "air_quality_label")
        wave.write.mode("append").parquet(cur_path)
        _run_stream(start_drift_stream(spark, cur_path, wave.schema, ref, log, ck))
    return spark.read.parquet(log).select("batch_id", "feature", "stattest", F.round("drift_score", 6).alias("drift_score"), "drift_detected")


@register("drift_psi")
def q_drift_psi(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    spec = DriftSpec(numeric_test="psi")
    return _round_cols(drift_features(ref, cur, spec), ["statistic", "drift_score"])
