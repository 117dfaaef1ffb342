"""End-to-end curated build: raw docs -> flatten -> label -> dedup -> Parquet.

Per-stage row counts come from ``observe`` on the jobs that write; nothing is
counted a second time.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import TARGET
from ..functions.labels import three_band
from ..operators.dedup import latest_per_key
from ..operators.flatten import flatten_hourly, flatten_with_rejects, split_rejects
from ..schemas import CURATED_COLUMNS
from ..session import scratch_path
from ..sources.curated import write_curated
from ..sources.raw import read_raw_json

CURATED_KEYS = ["city", "timestamp"]
# latest fetch wins; inside one payload the later position wins
CURATED_ORDER = ["fetch_timestamp", "pos"]


def add_quality_label(df: DataFrame, value: str = "pm2_5", out: str = TARGET, bands=None) -> DataFrame:
    from ..config import THREE_BAND
    from ..functions.labels import band_label

    return df.withColumn(out, band_label(value, bands or THREE_BAND) if bands else three_band(value))


def deduplicate(df: DataFrame, keys=CURATED_KEYS, order=CURATED_ORDER) -> DataFrame:
    return latest_per_key(df, list(keys), list(order))


def curate(raw: DataFrame, observe: bool = False):
    """Pure chain raw -> curated (lazy). Returns (curated, rejects, observations)."""
    obs = {}
    rows = flatten_hourly(raw)
    if observe:
        obs["flattened"] = Observation("flattened")
        rows = rows.observe(obs["flattened"], F.count(F.lit(1)).alias("rows"))
    good, rejects = split_rejects(rows)
    labeled = add_quality_label(good)
    if observe:
        obs["before_dedup"] = Observation("before_dedup")
        labeled = labeled.observe(obs["before_dedup"], F.count(F.lit(1)).alias("rows"))
    out = deduplicate(labeled).select(*CURATED_COLUMNS, "fetch_timestamp")
    if observe:
        obs["after_dedup"] = Observation("after_dedup")
        out = out.observe(obs["after_dedup"], F.count(F.lit(1)).alias("rows"))
    return out, rejects, obs


def input_key(raw_path: str | list[str]) -> str:
    """A short name of what a run reads, in any order."""
    paths = sorted([raw_path] if isinstance(raw_path, str) else raw_path)
    return hashlib.md5("\n".join(p.rstrip("/") for p in paths).encode()).hexdigest()[:16]


@dataclass
class CuratedRun:
    path: str
    reject_path: str
    counts: dict


def run_curated(
    spark: SparkSession,
    raw_path: str | list[str],
    out_path: str,
    reject_path: str | None = None,
    multi_line: bool = True,
) -> CuratedRun:
    """Load -> flatten -> label -> dedup -> write partitioned by city.

    The JSON is read once: all flattened rows, good or not, go to a scratch Parquet
    table, from which the rejects (``<out_path>_rejects`` unless a path is given) and
    the curated table are written. Rejects lie in a folder per input, so a run of the same input
    replaces its own and leaves those of other inputs. A missing or empty input is an error. Stage counts
    (loaded documents, flattened rows, rejected, before / after dedup, removed, saved)
    are observed on these jobs.
    """
    reject_path = reject_path or f"{out_path.rstrip('/')}_rejects"
    loaded, flat, saved = Observation("loaded"), Observation("flattened"), Observation("saved")
    n = F.count(F.lit(1)).alias("rows")
    raw = read_raw_json(spark, raw_path, multi_line=multi_line, keep_corrupt=True).observe(loaded, n)
    bad = F.count(F.when(F.col("reject_reason").isNotNull(), 1)).alias("rejected")
    rows = flatten_with_rejects(raw).observe(flat, n, bad).withColumn("ok", F.col("reject_reason").isNull())
    stage = scratch_path(spark, "flattened")
    rows.write.partitionBy("ok").parquet(stage)
    if not loaded.get.get("rows"):
        raise ValueError(f"no raw documents under {raw_path}")
    rows = spark.read.schema(rows.schema).parquet(stage)
    rows.filter("NOT ok").drop("ok").write.mode("overwrite").parquet(f"{reject_path.rstrip('/')}/input={input_key(raw_path)}")
    good = rows.filter("ok").drop("ok", "reject_reason", "bad_integral", "time_raw")
    curated = deduplicate(add_quality_label(good)).select(*CURATED_COLUMNS, "fetch_timestamp")
    write_curated(curated.observe(saved, n), out_path)
    rejected = flat.get.get("rejected", 0)
    before, after = flat.get.get("rows", 0) - rejected, saved.get.get("rows", 0)
    counts = {
        "loaded": loaded.get["rows"], "flattened": before + rejected, "rejected": rejected,
        "before_dedup": before, "after_dedup": after, "removed": before - after, "saved": after,
    }
    return CuratedRun(out_path, reject_path, counts)
