import os

import pytest
from pyspark.sql import functions as F

from envflow.sources.latest import BUCKET, LatestTable

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


@pytest.fixture()
def source(spark):
    rows = [(k, f"{d} 10:00:00", 100 * i + k) for i, d in enumerate(DAYS) for k in range(60) if i == 0 or k < 3 * i]
    return spark.createDataFrame([*rows, (None, f"{DAYS[0]} 10:00:00", 1)], "k long, t string, v int").withColumn("t", F.col("t").cast("timestamp_ntz"))


def files(path):
    out = {}
    for d, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out[os.path.join(d, n)] = os.stat(os.path.join(d, n)).st_mtime_ns
    return out


def test_steps_rewrite_only_the_buckets_they_touch(spark, source, tmp_path):
    t = LatestTable(spark, str(tmp_path / "t"), "k", "t", ["t"])
    assert t.step(source, f"{DAYS[0]} 23:00:00", buckets=16) == 1
    before = files(tmp_path / "t" / "data")
    old = {r[BUCKET]: r["commit"] for r in t.table.manifest().collect()}
    assert t.step(source, f"{DAYS[1]} 23:00:00") == 2  # keys 0, 1, 2
    now = {r[BUCKET]: r["commit"] for r in t.table.manifest().collect()}
    touched = {r[0] for r in spark.range(3).select(t.bucket(F.col("id"), 16)).collect()}
    assert {b for b in old if now[b] != old[b]} == touched and len(old) > len(touched)
    after = files(tmp_path / "t" / "data")
    assert all(after[f] == at for f, at in before.items())  # also those that the new version no longer names
    assert len({f for f in after if f not in before}) == len(touched)
    assert t.step(source, f"{DAYS[1]} 23:00:00") is None  # run again
    t.step(source, f"{DAYS[2]} 23:00:00")
    want = {k: 200 + k if k < 6 else k for k in range(60)}
    assert {r["k"]: r["v"] for r in t.read().collect()} == want
    assert {r["k"]: r["v"] for r in t.read(1).collect()} == {k: k for k in range(60)}


def test_a_lookup_reads_its_keys_buckets(spark, source, tmp_path):
    t = LatestTable(spark, str(tmp_path / "t"), "k", "t", ["t"])
    t.step(source, f"{DAYS[2]} 23:00:00", buckets=16)
    keys = spark.createDataFrame([(1,), (59,), (777,), (None,)], "key int")
    got = {r["key"]: r["v"] for r in t.lookup(keys, ["v"], f"{DAYS[2]} 12:00:00", 86400, key_col="key").collect()}
    assert got == {1: 201, 59: None, 777: None, None: None}  # 59 has expired
    scan = t.of_keys(keys, "key")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "(bucket#" in plan.split("PartitionFilters:")[1]
    wanted = {r[0] for r in keys.dropna().select(t.bucket(F.col("key").cast("long"), 16)).collect()}
    assert {r[0] for r in scan.select(t.bucket(F.col("k"), 16)).distinct().collect()} <= wanted
