"""Raw landing zone: nested hourly JSON docs and the long measurement feed."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import landing_key, parse_time, sanitize_name
from ..schemas import CORRUPT, LONG_FEED, RAW_OR_CORRUPT


def _reader(spark: SparkSession, schema, multi_line: bool):
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)


def read_raw_json(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = True,
    require_rows: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Scan a folder (or folders) of raw hourly docs with the explicit RAW schema.

    A document that is not valid JSON has only its text, in ``_corrupt_record``; such
    rows are left out unless ``keep_corrupt``.

    A missing path raises ``ValueError``; with ``require_rows`` an empty folder
    does too (one cheap ``isEmpty`` probe). ``source_file`` keeps lineage.
    Partition folders (``city=...``) written by :func:`land_raw` come back as
    a column.
    """
    paths = [path] if isinstance(path, str) else list(path)
    try:
        df = _reader(spark, RAW_OR_CORRUPT, multi_line).json(paths)
    except AnalysisException as e:  # PATH_NOT_FOUND and friends
        raise ValueError(f"no raw data at {paths}: {e}") from e
    df = df.withColumn("source_file", F.col("_metadata.file_path"))
    if require_rows and df.isEmpty():
        raise ValueError(f"no raw documents under {paths}")
    return df if keep_corrupt else valid_documents(df)


def valid_documents(raw: DataFrame) -> DataFrame:
    """The valid documents of a scan that kept the corrupt ones."""
    # Spark refuses a scan that needs the corrupt column alone (a count, say), so the
    # condition reads one more column; its second half is always true
    valid = F.col(CORRUPT).isNull() & F.coalesce(F.length("city_name") >= 0, F.lit(True))
    return raw.filter(valid).drop(CORRUPT)


def stamp_fetch(df: DataFrame, city: str | None = None, fetch_ts: str | None = None) -> DataFrame:
    """Add ``city_name`` / ``fetch_timestamp`` metadata. The fetch time is
    passed in (not read from the clock) so reruns are idempotent."""
    if city is not None:
        df = df.withColumn("city_name", F.lit(city))
    if fetch_ts is not None:
        df = df.withColumn("fetch_timestamp", F.lit(fetch_ts))
    return df


def land_raw(docs: DataFrame, base_path: str, mode: str = "append") -> str:
    """Write raw docs as JSON lines under ``{base}/city=<sanitized>/``.

    The fetch time stays a column (``landing_key`` is derived from it), not a
    file name, so landing is one distributed write rather than a file per doc.
    """
    nameless = F.raise_error(F.lit("a raw document has no city name"))
    named = F.when(F.length(F.trim("city_name")) > 0, sanitize_name("city_name")).otherwise(nameless.cast("string"))
    out = docs.withColumn("city", named).withColumn(
        "landing_key", landing_key(parse_time("fetch_timestamp"))
    )
    out.write.mode(mode).partitionBy("city").option("ignoreNullFields", "false").json(base_path)
    return base_path


def read_long_feed(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Long-format feed docs ``{meta, results: [...]}`` -> one row per measurement."""
    paths = [path] if isinstance(path, str) else list(path)
    try:
        docs = _reader(spark, LONG_FEED, multi_line).json(paths)
    except AnalysisException as e:
        raise ValueError(f"no feed data at {paths}: {e}") from e
    return explode_long_feed(docs)


def explode_long_feed(docs: DataFrame) -> DataFrame:
    r = F.col("r")
    return docs.select(F.explode("results").alias("r")).select(
        r["location"].alias("location"),
        r["city"].alias("city"),
        r["country"].alias("country"),
        r["parameter"].alias("parameter"),
        r["value"].alias("value"),
        r["unit"].alias("unit"),
        parse_time(r["date"]["utc"]).alias("ts_utc"),
        parse_time(r["date"]["local"]).alias("ts_local"),
    )


def union_feeds(*dfs: DataFrame) -> DataFrame:
    """Union feeds by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
