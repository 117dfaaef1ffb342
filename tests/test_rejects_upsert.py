import pytest
from pyspark.sql import functions as F

from envflow import bindings as B
from envflow.operators.prep import limit_per_entity
from envflow.plans.curated import curate, run_curated
from envflow.session import checkpoint_base, scratch_path
from envflow.sources import snapshots
from envflow.sources.curated import read_curated, snapshot_manifest, write_curated
from envflow.sources.raw import land_raw, read_raw_json
from envflow.streaming import incremental

SF001 = "/root/testdata/sf0.001"
GOOD = '{"city_name": "a", "fetch_timestamp": "2024-01-02T00:00:00", "hourly": {"time": ["2024-01-01T00:00"], "pm2_5": [5.0]}}'
LATE = '{"city_name": "a", "fetch_timestamp": "2024-01-02T00:00:00", "hourly": {"time": ["soon"]}}'
ODD = '{"city_name": "a", "fetch_timestamp": "2024-01-02T00:00:00", "hourly": {"time": ["2024-01-01T01:00"], "us_aqi": [4.5]}}'


def _land_text(path, name, *lines):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")
    return str(path)


def test_corrupt_documents_are_rejects(spark, tmp_path):
    raw = _land_text(tmp_path / "raw", "x.json", GOOD, GOOD[:70], LATE, ODD, "nonsense")
    assert read_raw_json(spark, raw, multi_line=False).count() == 3
    run = run_curated(spark, raw, str(tmp_path / "out"), multi_line=False)
    assert run.counts == {"loaded": 5, "flattened": 5, "rejected": 4, "before_dedup": 1, "after_dedup": 1, "removed": 0, "saved": 1}
    rejects = {r["time_raw"]: r["reject_reason"] for r in spark.read.parquet(run.reject_path).collect()}
    assert rejects == {GOOD[:70]: "corrupt_document", "nonsense": "corrupt_document", "soon": "unparsable_time", "2024-01-01T01:00": "non_integral_aqi"}


def test_an_empty_input_is_an_error(spark, tmp_path):
    raw = _land_text(tmp_path / "raw", "x.json")
    (tmp_path / "raw" / "x.json").write_text("")
    with pytest.raises(ValueError):
        run_curated(spark, raw, str(tmp_path / "out"), multi_line=False)
    with pytest.raises(ValueError):
        run_curated(spark, str(tmp_path / "absent"), str(tmp_path / "out"), multi_line=False)


def test_a_document_without_city_is_not_landed(spark, tmp_path):
    docs = B.nest_hourly_docs(B.measurements_table(spark, SF001)).limit(1).withColumn("city_name", F.lit(" "))
    with pytest.raises(Exception, match="no city name"):
        land_raw(docs, str(tmp_path / "raw"))


def test_stream_rejects_are_kept(spark, tmp_path):
    raw = _land_text(tmp_path / "raw", "x.json", GOOD, GOOD[:70], LATE)
    table = str(tmp_path / "table")
    q = incremental.start_curated_stream(spark, raw, table, str(tmp_path / "ck"))
    q.awaitTermination()
    assert read_raw_json(spark, raw, multi_line=False).count() == 2
    assert incremental.read_upserted(spark, table).count() == 1
    reasons = sorted(r[0] for r in spark.read.parquet(f"{table}_rejects").select("reject_reason").collect())
    assert reasons == ["corrupt_document", "unparsable_time"]


@pytest.fixture()
def upserts(spark, tmp_path):
    docs = B.nest_hourly_docs(B.measurements_table(spark, SF001))
    rows, _, _ = curate(docs)
    batch = rows.withColumn("pos", F.lit(0)).cache()
    yield batch, str(tmp_path / "table")
    batch.unpersist()


def _rows(spark, table):
    return sorted(map(str, incremental.read_upserted(spark, table).collect()))


def test_readers_see_the_old_version_while_a_write_breaks_off(spark, upserts, monkeypatch):
    batch, table = upserts
    assert incremental.upsert_latest(spark, batch, table, "run", 0) == 1
    want = _rows(spark, table)
    day = F.to_date("timestamp") == F.lit("2024-01-10").cast("date")
    again = batch.filter(day).withColumns({"pm2_5": F.lit(1.0), "fetch_timestamp": F.col("fetch_timestamp") + F.expr("INTERVAL 9 DAY")})

    def dies(*_):
        raise RuntimeError("lost")

    put = snapshots.put_new
    monkeypatch.setattr(snapshots, "put_new", dies)  # everything is written but the pointer
    with pytest.raises(RuntimeError):
        incremental.upsert_latest(spark, again, table, "run", 1)
    assert _rows(spark, table) == want
    monkeypatch.setattr(snapshots, "put_new", put)
    assert incremental.upsert_latest(spark, again, table, "run", 1) == 2
    got = incremental.read_upserted(spark, table)
    assert got.count() == len(want) and got.filter(day & (F.col("pm2_5") != 1.0)).count() == 0
    assert incremental.upsert_latest(spark, again, table, "run", 1) is None  # the batch is known
    old = incremental.curated_snapshots(spark, table).read(1)
    assert sorted(map(str, old.select(*got.columns).collect())) == want


def test_another_run_with_the_same_batch_number_loses_nothing(spark, upserts):
    batch, table = upserts
    half = F.col("version") if "version" in batch.columns else F.xxhash64("city", "timestamp")
    one, two = batch.filter(half % 2 == 0), batch.filter(half % 2 != 0)
    assert incremental.upsert_latest(spark, one, table, "first checkpoint", 0) == 1
    assert incremental.upsert_latest(spark, two, table, "second checkpoint", 0) == 2
    assert incremental.read_upserted(spark, table).count() == batch.count()


def test_a_stream_with_a_new_checkpoint_loses_nothing(spark, tmp_path):
    raw, table = tmp_path / "raw", str(tmp_path / "table")
    late = GOOD.replace("T00:00\"]", "T07:00\"]")
    for i, doc in enumerate((GOOD, late)):
        _land_text(raw / str(i), "x.json", doc, "nonsense")
        q = incremental.start_curated_stream(spark, str(raw / str(i)), table, str(tmp_path / f"ck{i}"))
        q.awaitTermination()
    assert incremental.read_upserted(spark, table).count() == 2
    assert spark.read.parquet(f"{table}_rejects").count() == 2


def test_the_merge_reads_only_the_dates_of_the_batch(spark, upserts):
    batch, table = upserts
    incremental.upsert_latest(spark, batch, table, "run", 0)
    some = batch.filter(F.to_date("timestamp") == F.lit("2024-01-10").cast("date")).withColumn("date", F.to_date("timestamp"))
    old = incremental.affected_partitions(some, incremental.curated_snapshots(spark, table).read())
    plan = old._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "PartitionFilters" in x and "date" in x)
    assert "2024-01-10" in scan or "19732" in scan  # the literal bound, as a date or its number
    assert "dynamicpruning" in plan.lower()
    assert old.select("date").distinct().count() == 1


def test_a_rerun_gives_the_same_rejects(spark, tmp_path):
    raw = _land_text(tmp_path / "raw", "x.json", GOOD, GOOD[:70], LATE, ODD, "nonsense")
    other = _land_text(tmp_path / "other", "x.json", GOOD, LATE)
    for path in (raw, other, raw):
        run = run_curated(spark, path, str(tmp_path / "out"), multi_line=False)
    assert spark.read.parquet(run.reject_path).count() == 5


def test_cities_that_look_like_numbers_stay_strings(spark, tmp_path):
    df = spark.createDataFrame([("1", 2.0), ("2", 3.0)], "city string, pm2_5 double")
    write_curated(df, str(tmp_path / "t"))
    assert sorted(r["city"] for r in read_curated(spark, str(tmp_path / "t")).collect()) == ["1", "2"]


def test_the_manifest_sees_repeated_rows(spark, tmp_path):
    def content(values, name):
        spark.createDataFrame([(v,) for v in values], "x int").coalesce(1).write.parquet(str(tmp_path / name))
        return snapshot_manifest(spark.read.parquet(str(tmp_path / name)))[1].first()["content_hash"]

    assert content([1, 1, 2], "a") != content([2], "b")
    assert content([1, 1, 2], "c") == content([2, 1, 1], "d")


def test_large_limits_are_cut_before_the_last_window(spark):
    df = spark.range(20000).select("id", (F.col("id") % 2).alias("k"), F.lit(1).alias("x"))
    top = limit_per_entity(df, "k", ["id"], 1500)
    assert {(r["k"], r["n"], r["lo"]) for r in top.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("lo")).collect()} == {
        (0, 1500, 17000), (1, 1500, 17001)
    }
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        checkpoint_base(Session())
    assert scratch_path(spark, "x").startswith(checkpoint_base(spark))
