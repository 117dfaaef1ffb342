import os
import threading

import pytest
from pyspark.sql import functions as F

from envflow.sources import curated, snapshots
from envflow.sources.snapshots import Conflict, SnapshotTable


def rows(spark, *values):
    return spark.createDataFrame(list(values), "city string, v int")


def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "t"), ["city"])


def content(df):
    return sorted((r["city"], r["v"]) for r in df.collect())


def test_versions_can_be_read_as_they_were(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.pointer() is None and t.versions() == []
    t.replace(rows(spark, ("1", 1), ("1", 2), ("b", 3)))
    t.replace(rows(spark, ("b", 4)))
    t.append(rows(spark, ("1", 5), ("c", 6)))
    assert content(t.read(1)) == [("1", 1), ("1", 2), ("b", 3)]
    assert content(t.read(2)) == [("1", 1), ("1", 2), ("b", 4)]
    assert content(t.read()) == content(t.read(3)) == [("1", 1), ("1", 2), ("1", 5), ("b", 4), ("c", 6)]
    with pytest.raises(ValueError, match="no version 9"):
        t.read(9)


def test_a_reader_keeps_its_version_while_others_write(spark, tmp_path):
    t = table(spark, tmp_path)
    t.replace(rows(spark, ("a", 1), ("b", 2)))
    held = t.read()
    t.replace(rows(spark, ("a", 9)))
    assert content(held) == [("a", 1), ("b", 2)]


def test_of_two_writers_the_second_starts_from_the_firsts_result(spark, tmp_path):
    t = table(spark, tmp_path)
    t.replace(rows(spark, ("a", 1)))
    calls = []

    def add_one(old):
        calls.append(1)
        if len(calls) == 1:
            t.replace(rows(spark, ("a", 10)))  # someone else comes first
        return old.select("city", (F.col("v") + 1).alias("v")), None

    assert t.change(add_one) == 3
    assert content(t.read()) == [("a", 11)] and len(calls) == 2
    assert len(os.listdir(tmp_path / "t" / "data")) == 3  # the commit that lost is gone


def test_a_version_is_made_once(spark, tmp_path):
    path, made = str(tmp_path / "versions" / "1"), []
    os.makedirs(tmp_path / "versions")

    def put(i):
        try:
            snapshots.put_new(spark, path, str(i))
            made.append(i)
        except Conflict:
            pass

    put(1)
    tries = [threading.Thread(target=put, args=(i,)) for i in (2, 3)]
    for x in tries:
        x.start()
    for x in tries:
        x.join()
    assert made == [1] and open(path).read() == "1"
    assert [n for n in os.listdir(tmp_path / "versions") if not n.endswith(".crc")] == ["1"]


def test_a_null_partition_value_is_an_error(spark, tmp_path):
    t = table(spark, tmp_path)
    with pytest.raises(Exception, match="null value of the partition column city"):
        t.replace(rows(spark, (None, 1)))
    assert t.versions() == []


def test_filters_on_partitions_prune_folders(spark, tmp_path):
    t = table(spark, tmp_path)
    t.replace(rows(spark, ("a", 1), ("b", 2)))
    plan = t.read().where("city = 'a' AND v > 0")._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "PartitionFilters" in x and "PushedFilters: [IsNotNull(v)" in x)
    assert "(city#" in scan and "dynamicpruning" in scan.lower()


def test_fifty_appends_are_compacted_to_few_files(spark, tmp_path):
    t = table(spark, tmp_path)
    for i in range(50):
        t.append(rows(spark, ("a", i), ("b", -i)))
    big = {r["commit"] for r in t.manifest().collect()}
    before = content(t.read())
    assert t.manifest().agg(F.sum("files")).first()[0] >= 100
    version = t.compact()
    files = {r["city"]: r["files"] for r in t.manifest().collect()}
    assert files == {"a": 1, "b": 1} and content(t.read()) == before
    assert len(big) == 50 and content(t.read(version - 1)) == before
    assert t.compact() is None  # nothing left to do


def test_compaction_leaves_large_files_and_lone_small_ones(spark, tmp_path):
    t = table(spark, tmp_path)
    t.append(spark.range(20000).select(F.lit("a").alias("city"), F.hash("id").alias("v")).coalesce(1))
    t.append(rows(spark, ("a", 1)))
    t.append(rows(spark, ("a", 2), ("b", 3)))
    large = t.manifest().orderBy(F.desc("bytes")).first()
    before = content(t.read())
    t.compact(target_bytes=large["bytes"])
    after = {(r["city"], r["commit"]): r["rows"] for r in t.manifest().collect()}
    assert after[("a", large["commit"])] == 20000 and sorted(after.values()) == [1, 2, 20000]
    assert content(t.read()) == before


def test_vacuum_keeps_what_the_last_versions_need(spark, tmp_path):
    t = table(spark, tmp_path)
    for i in range(5):
        t.replace(rows(spark, ("a", i)) if i else rows(spark, ("a", 0), ("b", 7)))
    assert t.vacuum(keep=2) == 0  # all are young
    assert t.vacuum(keep=2, older_than_seconds=-60) == 2
    assert t.versions() == [4, 5]
    assert content(t.read(4)) == [("a", 3), ("b", 7)] and content(t.read()) == [("a", 4), ("b", 7)]


def test_manifests_by_difference_read_only_new_files(spark, tmp_path):
    path = str(tmp_path / "t")
    curated.write_curated(rows(spark, ("a", 1), ("a", 1), ("b", 2)), path)
    first = curated.manifest_by_difference(spark, path)
    kept = spark.createDataFrame(first.collect(), first.schema)
    # what was read must not be read again: spoil it, but for its size and time
    for d, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                f = os.path.join(d, n)
                at = os.stat(f)
                with open(f, "r+b") as out:
                    out.write(b"\0" * at.st_size)
                os.utime(f, ns=(at.st_atime_ns, at.st_mtime_ns))
    os.makedirs(f"{path}/city=c")
    rows(spark, ("c", 5)).select("v").coalesce(1).write.mode("append").parquet(f"{path}/city=c")
    second = curated.manifest_by_difference(spark, path, kept, scan=spark.read.schema("city string, v int").parquet)
    got = spark.createDataFrame(second.collect(), second.schema)
    status = {r["file_path"].split("city=")[1][0]: (r["status"], r["rows_before"], r["rows_after"]) for r in curated.manifest_diff(kept, got).collect()}
    assert status == {"a": ("unchanged", 2, 2), "b": ("unchanged", 1, 1), "c": ("added", None, 1)}
    assert curated.manifest_by_difference(spark, path, got).count() == 3


def test_manifest_diff_tells_every_status(spark):
    cols = "file_path string, file_size long, modified timestamp, rows long, content_hash decimal(38,0)"

    def of(*files):
        return spark.createDataFrame([(p, n, None, n, h) for p, n, h in files], cols)

    from decimal import Decimal as D

    got = curated.manifest_diff(of(("a", 1, D(1)), ("b", 2, D(2)), ("c", 0, None)), of(("b", 2, D(3)), ("c", 0, None), ("d", 4, D(4)))).collect()
    assert {r["file_path"]: r["status"] for r in got} == {"a": "removed", "b": "changed", "c": "unchanged", "d": "added"}
