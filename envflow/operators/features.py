"""Feature layer: typed views, services, point-in-time joins, online lookup."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import FeatureService, FeatureView
from ..session import materialize
from .dedup import latest_per_entity
from .enrich import checked_broadcast


@dataclass(frozen=True)
class FeatureSource:
    """A Parquet feature source with its event-time column."""

    path: str
    timestamp_field: str

    def load(self, spark: SparkSession, columns: list[str] | None = None) -> DataFrame:
        df = spark.read.parquet(self.path)
        return df.select(*columns, self.timestamp_field) if columns else df


def cast_to_view(df: DataFrame, view: FeatureView, keep_keys: bool = True) -> DataFrame:
    """Project and cast to the view's declared types."""
    keys = [view.entity, view.timestamp_field] if keep_keys else []
    extra = [c for c in view.tiebreak if c in df.columns and c not in keys]
    return df.select(*keys, *extra, *[F.col(c).cast(t).alias(c) for c, t in view.schema])


def service_frame(df: DataFrame, service: FeatureService, keep_keys: bool = True) -> DataFrame:
    """Named projection of a view (training: everything; inference: features)."""
    v = service.view
    keys = [v.entity, v.timestamp_field] if keep_keys else []
    typed = dict(v.schema)
    return df.select(*keys, *[F.col(c).cast(typed[c]).alias(c) for c in service.selected()])


#: Feature and spine rows of one range.
RANGE_ROWS = 1_000_000


def _within(features: DataFrame, spine: DataFrame, ts: str, fts: str, ttl_seconds: int | None) -> DataFrame:
    """The features that any spine row can match: not after the last one and, with a TTL, not before
    the first one less the TTL. The bounds are literals, so they reach the scan."""
    lo, hi = spine.agg(F.min(ts), F.max(ts)).first()
    if hi is None:
        return features.filter(F.lit(False))
    features = features.filter(F.col(fts) <= F.lit(hi).cast("timestamp_ntz"))
    if ttl_seconds is not None:
        features = features.filter(F.col(fts) >= F.lit(lo - timedelta(seconds=int(ttl_seconds))).cast("timestamp_ntz"))
    return features


def asof_join(
    spine: DataFrame,
    features: DataFrame | FeatureSource,
    key: str | list[str],
    ts: str,
    feature_cols: list[str],
    ttl_seconds: int | None = None,
    feature_ts: str | None = None,
    tiebreak: tuple = (),
    feature_ts_alias: str = "feature_timestamp",
    range_rows: int | None = None,
) -> DataFrame:
    """Point-in-time join: for each spine row the latest feature row of the
    same key with ``feature_ts <= ts`` and, with a TTL, ``>= ts - ttl``.

    Plan (no range join, no all-pairs, no window over a key): feature rows that no spine row can reach are
    filtered at the scan. What is left and the spine are cut into ranges of (key, time, kind, tie-break, row) of
    about ``range_rows`` rows, so a key, or one second of a key, that holds a third of all rows is
    spread over many ranges. Inside (range, key) a running ``last(ignorenulls)`` finds the
    hit. Every range is lent the last feature row of the ranges below it (one row per
    range, found by a running maximum over as many rows as there are ranges); it counts
    where no row of the own range does and its key is the row's.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if isinstance(features, FeatureSource):
        feature_ts = feature_ts or features.timestamp_field
        columns = dict.fromkeys([*keys, *tiebreak, *feature_cols])
        features = features.load(spine.sparkSession, [c for c in columns if c != features.timestamp_field])
    fts = feature_ts or ts
    # spine rows with a null key or time can match nothing
    matchable = F.col(ts).isNotNull()
    for k in keys:
        matchable = matchable & F.col(k).isNotNull()
    unmatched = spine.filter(~matchable).select(
        *spine.columns,
        *[F.lit(None).cast(features.schema[c].dataType).alias(c) for c in feature_cols],
        F.lit(None).cast(features.schema[fts].dataType).alias(feature_ts_alias),
    )
    spine = spine.filter(matchable)
    features = _within(features.dropna(subset=[fts, *keys]), spine, ts, fts, ttl_seconds)

    # both sides as rows of (keys, time, kind, tie-breaks, row number, feature row, spine row)
    key_cols = [f"_k{i}" for i in range(len(keys))]
    ties = [f"_tb{i}" for i in range(len(tiebreak))]
    payload = F.struct(F.col(fts).alias("_ft"), *[F.col(c) for c in feature_cols])
    f = features.select(
        *[F.col(k).alias(c) for k, c in zip(keys, key_cols)], F.col(fts).alias("_t"), F.lit(0).alias("_is_spine"),
        *[F.col(c).alias(t) for c, t in zip(tiebreak, ties)], payload.alias("_p"),
    )
    s = spine.select(
        *[F.col(k).cast(f.schema[c].dataType).alias(c) for k, c in zip(keys, key_cols)], F.col(ts).alias("_t"), F.lit(1).alias("_is_spine"),
        F.struct(*[F.col(c) for c in spine.columns]).alias("_s"),
    )
    both = f.unionByName(s, allowMissingColumns=True).withColumn("_row", F.monotonically_increasing_id())
    order = [*key_cols, "_t", "_is_spine", *ties, "_row"]
    n = features.count() + spine.count()
    ranges = max(1, -(-n // (range_rows or RANGE_ROWS)))
    cut = materialize(both.repartitionByRange(ranges, *order).withColumn("_part", F.spark_partition_id()))

    last_of = F.max_by(F.struct(*key_cols, "_p"), F.struct(*order)).alias("_last")
    lasts = cut.filter("_is_spine = 0").groupBy("_part").agg(last_of)
    below = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    lent = cut.select("_part").distinct().join(lasts, "_part", "left").withColumn("_lent", F.last("_last", ignorenulls=True).over(below))
    lent = lent.filter(F.col("_lent").isNotNull()).select("_part", "_lent")

    inside = Window.partitionBy("_part", *key_cols).orderBy(*order[len(key_cols) :]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = cut.withColumn("_hit", F.last("_p", ignorenulls=True).over(inside)).filter("_is_spine = 1")
    hits = hits.join(checked_broadcast(lent), "_part", "left")
    same_key = reduce(and_, [F.col(c) == F.col(f"_lent.{c}") for c in key_cols])
    p = F.coalesce(F.col("_hit"), F.when(same_key, F.col("_lent._p")))
    if ttl_seconds is not None:
        p = F.when(p["_ft"] >= F.col("_t") - F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS"), p)
    res = hits.withColumn("_m", p)
    out = res.select("_s.*", *[F.col("_m")[c].alias(c) for c in feature_cols], F.col("_m._ft").alias(feature_ts_alias))
    return out.unionByName(unmatched)


def online_lookup(
    keys_df: DataFrame,
    latest: DataFrame,
    key: str,
    ts: str,
    feature_cols: list[str],
    now: str,
    ttl_seconds: int,
    key_col: str | None = None,
) -> DataFrame:
    """Current features for a key list: missing or expired -> null. Expired rows of
    ``latest`` are filtered before the join, so only fresh ones are shuffled."""
    kc = key_col or key
    now_c = F.lit(now).cast("timestamp_ntz")
    fresh = (F.col(ts) <= now_c) & (F.col(ts) >= now_c - F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS"))
    lat = latest.filter(fresh).select(F.col(key).alias("_k"), ts, *feature_cols)
    j = keys_df.join(lat, keys_df[kc] == F.col("_k"), "left")
    return j.select(
        *[keys_df[c] for c in keys_df.columns],
        *[F.col(c) for c in feature_cols],
        F.col(ts).alias("feature_timestamp"),
    )
