import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from envflow.operators.enrich import checked_broadcast, enrich
from envflow.operators.features import FeatureSource, _within, asof_join, online_lookup
from envflow.operators.prefix import exact_quantiles, running_totals
from envflow.session import materialize


def _brute_asof(spine, feats, ttl):
    out = {}
    for sid, k, t in spine:
        cands = [(ft, fid, v) for fk, ft, fid, v in feats if k is not None and t is not None and fk == k and ft <= t]
        best = max(cands) if cands else None
        if best and (t - best[0]).total_seconds() > ttl:
            best = None
        out[sid] = best[2] if best else None
    return out


def _hot_key_case(spark):
    rnd = random.Random(7)
    base = pd.Timestamp("2024-01-01")
    feats, spine = [], []
    for i in range(3000):
        k = 0 if i % 3 == 0 else rnd.randint(1, 20)  # key 0 holds a third of the rows
        feats.append((k, (base + pd.Timedelta(minutes=rnd.randint(0, 60 * 24 * 20))).to_pydatetime(), i, float(i)))
    for i in range(800):
        k = 0 if i % 3 == 0 else rnd.randint(1, 22)
        spine.append((i, k, (base + pd.Timedelta(minutes=rnd.randint(0, 60 * 24 * 20))).to_pydatetime()))
    # an exact tie: feature at the spine time counts, a later one does not
    feats.append((5, spine[1][2], 99999, -1.0))
    spine.append((9999, 5, spine[1][2]))
    # null keys / times match nothing (and null-key features are ignored)
    feats.append((None, spine[2][2], 99998, -2.0))
    spine += [(9000 + i, None, spine[2][2]) for i in range(50)] + [(8999, 3, None)]
    fdf = spark.createDataFrame(feats, "k long, fts timestamp_ntz, fid long, v double")
    sdf = spark.createDataFrame(spine, "sid long, k long, ts timestamp_ntz")
    return feats, spine, fdf, sdf


def test_asof_matches_brute_force_with_hot_key(spark):
    feats, spine, fdf, sdf = _hot_key_case(spark)
    ttl = 6 * 3600
    got = asof_join(sdf, fdf, "k", "ts", ["v"], ttl_seconds=ttl, feature_ts="fts", tiebreak=("fid",))
    res = {r["sid"]: r["v"] for r in got.collect()}
    want = _brute_asof(spine, feats, ttl)
    assert res == want
    # never a future row
    assert got.filter(F.col("feature_timestamp") > F.col("ts")).count() == 0


@pytest.mark.parametrize("range_rows", [60, 700])
def test_asof_ranges_change_nothing(spark, range_rows):
    feats, spine, fdf, sdf = _hot_key_case(spark)
    for ttl in (6 * 3600, 20 * 86400):
        got = asof_join(sdf, fdf, "k", "ts", ["v"], ttl_seconds=ttl, feature_ts="fts", tiebreak=("fid",), range_rows=range_rows)
        assert {r["sid"]: r["v"] for r in got.collect()} == _brute_asof(spine, feats, ttl)


def test_asof_of_one_second_that_holds_a_third_of_the_rows(spark, monkeypatch):
    """The hot second is cut into many ranges, each lent its last feature row."""
    import envflow.operators.features as fmod

    hot = pd.Timestamp("2024-01-01 12:00:00").to_pydatetime()
    feats = [(1, hot, i, float(i)) for i in range(300)] + [(2, hot, 1000, 5.0)]
    spine = [(i, 1, hot) for i in range(500)] + [(1000 + i, i, hot + pd.Timedelta(seconds=1)) for i in range(4)]
    fdf = spark.createDataFrame(feats, "k long, fts timestamp_ntz, fid long, v double")
    sdf = spark.createDataFrame(spine, "sid long, k long, ts timestamp_ntz")
    cuts = []
    monkeypatch.setattr(fmod, "materialize", lambda df: cuts.append(materialize(df)) or cuts[-1])
    got = asof_join(sdf, fdf, "k", "ts", ["v"], ttl_seconds=60, feature_ts="fts", tiebreak=("fid",), range_rows=20)
    assert {r["sid"]: r["v"] for r in got.collect()} == _brute_asof(spine, feats, 60)
    sizes = [r["count"] for r in cuts[0].groupBy("_part").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 100


def test_asof_reads_no_features_out_of_reach_and_has_no_window_over_a_key(spark, tmp_path):
    base = pd.Timestamp("2024-01-01")
    feats = [(i % 5, (base + pd.Timedelta(days=i)).to_pydatetime(), float(i)) for i in range(100)]
    spark.createDataFrame(feats, "k long, fts timestamp_ntz, v double").write.parquet(str(tmp_path / "f"))
    sdf = spark.createDataFrame([(1, (base + pd.Timedelta(days=50, hours=1)).to_pydatetime())], "k long, ts timestamp_ntz")
    source = FeatureSource(str(tmp_path / "f"), "fts")
    within = _within(source.load(spark, ["k", "v"]), sdf, "ts", "fts", 2 * 86400)
    plan = within._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(fts,2024-02-18T01:00" in plan and "LessThanOrEqual(fts,2024-02-20T01:00" in plan
    assert within.count() == 2
    got = asof_join(sdf, source, "k", "ts", ["v"], ttl_seconds=5 * 86400)
    assert [tuple(r)[2:] for r in got.collect()] == [(46.0, feats[46][1])]
    plan = got._jdf.queryExecution().executedPlan().toString()
    specs = [x for x in plan.split("\n") if "Window [" in x]
    assert specs and all("_part" in x for x in specs)
    assert asof_join(sdf.filter("false"), source, "k", "ts", ["v"], ttl_seconds=60).collect() == []


def test_online_lookup_ttl(spark):
    latest = spark.createDataFrame(
        [(1, "2024-01-29 00:00:00", 1.0), (2, "2024-01-01 00:00:00", 2.0), (3, "2024-02-05 00:00:00", 3.0)],
        "k long, ts string, v double",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    keys = spark.createDataFrame([(1,), (2,), (3,), (4,)], "key long")
    got = {r["key"]: r["v"] for r in online_lookup(keys, latest, "k", "ts", ["v"], "2024-01-30 00:00:00", 7 * 86400, key_col="key").collect()}
    assert got == {1: 1.0, 2: None, 3: None, 4: None}


def test_running_totals_equal_single_window(spark):
    rnd = np.random.default_rng(3)
    rows = []
    for g in ("a", "b", "c"):
        vals = np.unique(np.round(rnd.exponential(10, 2000), 2))
        rows += [(g, float(v), int(rnd.integers(0, 5))) for v in vals]
    df = spark.createDataFrame(rows, "g string, v double, c long")
    got = running_totals(df, ["g"], "v", ["c"], buckets=16, with_next=True, single_task_rows=None)
    w = Window.partitionBy("g").orderBy("v")
    want = df.select("g", "v", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_c"), F.lead("v").over(w).alias("next_v"))
    a = sorted(map(tuple, got.select("g", "v", "cum_c", "next_v").collect()))
    b = sorted(map(tuple, want.collect()))
    assert a == b


def test_running_totals_adaptive_buckets(spark, monkeypatch):
    import envflow.operators.prefix as pmod

    rnd = np.random.default_rng(11)
    vals = np.unique(np.round(rnd.normal(0, 50, 5000), 3))
    df = spark.createDataFrame([("h", float(v), 1) for v in vals] + [("s", 1.0, 2)], "g string, v double, c long")
    # a group bigger than the single-task bound and than 40 x BUCKET_ROWS
    monkeypatch.setattr(pmod, "BUCKET_ROWS", 100)
    got = running_totals(df, ["g"], "v", ["c"], buckets=4, with_next=True, single_task_rows=1000)
    w = Window.partitionBy("g").orderBy("v")
    want = df.select("g", "v", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_c"), F.lead("v").over(w).alias("next_v"))
    assert sorted(map(tuple, got.select("g", "v", "cum_c", "next_v").collect())) == sorted(map(tuple, want.collect()))


def test_running_totals_without_broadcast(spark, monkeypatch):
    import envflow.operators.prefix as pmod

    rows = [(g, float(v), v % 3) for g in ("a", "b") for v in range(300)]
    df = spark.createDataFrame(rows, "g string, v double, c long")
    monkeypatch.setattr(pmod, "MAX_BROADCAST_ENTRIES", 1)  # edge/offset tables "too big"
    got = running_totals(df, ["g"], "v", ["c"], buckets=8, with_next=True, single_task_rows=None)
    assert "strategy=broadcast" not in got._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(pmod, "MAX_BROADCAST_ENTRIES", 10**6)
    hinted = running_totals(df, ["g"], "v", ["c"], buckets=8, with_next=True, single_task_rows=None)
    assert "strategy=broadcast" in hinted._jdf.queryExecution().optimizedPlan().toString()
    w = Window.partitionBy("g").orderBy("v")
    want = df.select("g", "v", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_c"), F.lead("v").over(w).alias("next_v"))
    assert sorted(map(tuple, got.select("g", "v", "cum_c", "next_v").collect())) == sorted(map(tuple, want.collect()))


def test_exact_quantiles_match_numpy(spark):
    rnd = np.random.default_rng(5)
    vals = {g: rnd.normal(0, 3, 501 + i).round(3) for i, g in enumerate(["x", "y"])}
    rows = [(g, float(v)) for g, vs in vals.items() for v in vs] + [("x", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["q_0"], r["q_1"]) for r in exact_quantiles(df, ["g"], "v", [0.5, 0.9], buckets=8, single_task_rows=None).collect()}
    for g, vs in vals.items():
        assert abs(got[g][0] - np.quantile(vs, 0.5)) < 1e-9
        assert abs(got[g][1] - np.quantile(vs, 0.9)) < 1e-9


def test_enrich_explicit_wins_and_broadcast_bound(spark):
    dim = spark.createDataFrame([("Lima", -12.0), ("Bogota", 4.7)], "city string, lat double")
    df = spark.createDataFrame([("Lima", None), ("Bogota", 1.0), ("Nowhere", None)], "city string, my_lat double")
    got = {r["city"]: r["lat"] for r in enrich(df, dim, "city", "city", ["lat"], explicit={"lat": "my_lat"}).collect()}
    assert got == {"Lima": -12.0, "Bogota": 1.0, "Nowhere": None}
    # over the bound: no broadcast hint, the plan falls back to a shuffle join
    big = checked_broadcast(dim, max_rows=1)
    assert big is dim
    # over the byte bound too, and within both bounds the hint is added
    assert checked_broadcast(dim, max_bytes=10) is dim
    assert checked_broadcast(dim) is not dim
