import json
import os

import pytest
from pyspark.sql import functions as F

from envflow.operators.dedup import latest_per_entity, latest_per_key
from envflow.operators.flatten import flatten_hourly, split_rejects
from envflow.plans.curated import curate, run_curated
from envflow.sources.raw import read_raw_json


def _doc(city, fetch, time, pm25, **extra):
    hourly = {"time": time, "pm2_5": pm25}
    hourly.update(extra)
    return {"latitude": -34.6, "longitude": -58.4, "timezone": "America/Buenos_Aires", "city_name": city,
            "fetch_timestamp": fetch, "hourly": hourly}


def _write(dirpath, name, doc):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as f:
        json.dump(doc, f, indent=2)  # multi-line, like the landing client


def test_missing_path_raises(spark, tmp_dir):
    with pytest.raises(ValueError):
        read_raw_json(spark, os.path.join(tmp_dir, "nope"))


def test_empty_folder_with_require_rows(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "empty"))
    with pytest.raises(ValueError):
        read_raw_json(spark, os.path.join(tmp_dir, "empty"), require_rows=True)


def test_ragged_null_absent_and_empty_arrays(spark, tmp_dir):
    d = os.path.join(tmp_dir, "raw")
    _write(d, "a.json", _doc("Lima", "2025-01-02T00:00:00", ["2025-01-01T00:00", "2025-01-01T01:00", "2025-01-01T02:00"],
                             [1.0, 2.0], pm10=[5.0, 6.0, 7.0], us_aqi=[42.0, 43, 44.5]))
    _write(d, "b.json", _doc("Lima", "2025-01-02T00:00:00", ["2025-01-01T03:00"], None, pm10=[1.0]))
    _write(d, "c.json", _doc("Lima", "2025-01-02T00:00:00", [], []))
    _write(d, "d.json", _doc("Lima", "2025-01-02T00:00:00", ["not a time"], [3.0]))
    rows = flatten_hourly(read_raw_json(spark, d))
    good, rejects = split_rejects(rows)
    g = {str(r["timestamp"]): r for r in good.collect()}
    assert set(g) == {"2025-01-01 00:00:00", "2025-01-01 01:00:00", "2025-01-01 03:00:00"}
    assert g["2025-01-01 01:00:00"]["pm2_5"] == 2.0 and g["2025-01-01 00:00:00"]["us_aqi"] == 42
    assert g["2025-01-01 03:00:00"]["pm2_5"] is None  # whole array null: doc kept, padded
    assert g["2025-01-01 00:00:00"]["ozone"] is None  # absent array
    reasons = sorted(r["reject_reason"] for r in rejects.collect())
    assert reasons == ["non_integral_aqi", "unparsable_time"]


def test_latest_fetch_wins_and_is_idempotent(spark, tmp_dir):
    d = os.path.join(tmp_dir, "raw2")
    t = ["2025-01-01T00:00", "2025-01-01T01:00"]
    _write(d, "old.json", _doc("Lima", "2025-01-01T05:00:00", t, [1.0, 2.0]))
    _write(d, "new.json", _doc("Lima", "2025-01-01T06:00:00", t[1:], [20.0]))
    cur, _, _ = curate(read_raw_json(spark, d))
    got = {str(r["timestamp"]): r["pm2_5"] for r in cur.collect()}
    assert got == {"2025-01-01 00:00:00": 1.0, "2025-01-01 01:00:00": 20.0}
    again, _, _ = curate(read_raw_json(spark, d))
    assert sorted(map(tuple, again.drop("fetch_timestamp").collect())) == sorted(map(tuple, cur.drop("fetch_timestamp").collect()))


def test_run_curated_counts_and_partitions(spark, tmp_dir):
    d = os.path.join(tmp_dir, "raw3")
    t = ["2025-01-01T00:00", "2025-01-01T00:00", "2025-01-01T01:00"]
    _write(d, "x.json", _doc("Lima", "2025-01-01T05:00:00", t, [1.0, 2.0, 40.0]))
    out = os.path.join(tmp_dir, "cur")
    run = run_curated(spark, d, out)
    assert run.counts == {
        "loaded": 1, "flattened": 3, "rejected": 0, "before_dedup": 3, "after_dedup": 2, "removed": 1, "saved": 2,
    }
    back = spark.read.parquet(out)
    assert back.filter("city = 'Lima'").count() == 2
    assert {r["air_quality_label"] for r in back.collect()} == {"good", "unhealthy"}


def test_dedup_invariant_under_repartition(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").withColumn("hour", F.date_trunc("hour", "ts"))
    base = sorted(map(tuple, latest_per_key(ev, ["user_id", "hour"], ["event_id"]).select("event_id").collect()))
    for n in (1, 7, 64):
        got = sorted(map(tuple, latest_per_key(ev.repartition(n), ["user_id", "hour"], ["event_id"]).select("event_id").collect()))
        assert got == base
    agg = sorted(map(tuple, latest_per_entity(ev, ["user_id", "hour"], ["event_id"]).select("event_id").collect()))
    assert agg == base


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and "air_quality_label" in df.columns


def test_hot_key_third_of_rows(spark):
    """One key holds a third of the rows: dedup, top-k and latest-per-entity stay exact."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"),
        F.col("id").alias("v"),
    )
    top = latest_per_key(df, ["k"], ["v"]).filter("k = 0").first()
    assert top["v"] == max(i for i in range(n) if i % 3 == 0)
    lat = latest_per_entity(df, "k", ["v"]).filter("k = 0").first()
    assert lat["v"] == top["v"]
    from envflow.operators.prep import limit_per_entity

    got = [r["v"] for r in limit_per_entity(df, "k", ["v"], 3).filter("k = 0").orderBy("rank").collect()]
    assert got == [29997, 29994, 29991]
