"""Nested -> tabular: zip parallel hourly arrays into rows; long <-> wide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FEATURES, INTEGRAL_FEATURES, PARAMETER_CONSTANT
from ..functions.scalars import integral_bigint, non_integral, parse_time
from ..schemas import CORRUPT


def _array_or_empty(c: Column, elem: str, name: str) -> Column:
    # arrays_zip returns null when any whole input array is null; an empty
    # array instead pads that field with nulls and keeps the document.
    return F.coalesce(c, F.array().cast(f"array<{elem}>")).alias(name)


def zip_hourly(raw: DataFrame, features: list[str] = FEATURES, time_field: str = "time") -> DataFrame:
    """One row per array position; short arrays pad with null.

    Output keeps the doc scalars plus ``pos`` (position in the payload) and
    the raw ``time`` string. No shuffle: a narrow generator over each doc.
    """
    arrays = [_array_or_empty(F.col(f"hourly.{time_field}"), "string", "time")] + [
        _array_or_empty(F.col(f"hourly.{f}"), "double", f) for f in features
    ]
    keep = [c for c in ("city_name", "latitude", "longitude", "timezone", "fetch_timestamp", "source_file", "_corrupt") if c in raw.columns]
    return raw.select(*keep, F.posexplode(F.arrays_zip(*arrays)).alias("pos", "h")).select(
        *keep, "pos", *[F.col("h")[n].alias(n) for n in ["time", *features]]
    )


def flatten_hourly(raw: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Raw docs -> measurement rows (city, coords, timestamp, features, ...).

    Time is parsed with ``try_to_timestamp`` (unparsable -> null, job keeps
    running). AQI series are read as double and cast to bigint only when
    integral; ``bad_integral`` marks rows where that check failed.
    """
    z = zip_hourly(raw, features)
    cols = [
        F.col("city_name").alias("city"),
        "latitude",
        "longitude",
        "timezone",
        parse_time("time").alias("timestamp"),
    ]
    bad = F.lit(False)
    for f in features:
        if f in INTEGRAL_FEATURES:
            cols.append(integral_bigint(f).alias(f))
            bad = bad | non_integral(f)
        else:
            cols.append(F.col(f))
    cols += [
        F.lit(PARAMETER_CONSTANT).alias("parameter"),
        parse_time("fetch_timestamp").alias("fetch_timestamp"),
        "pos",
        F.col("time").alias("time_raw"),
        bad.alias("bad_integral"),
        *[c for c in ("_corrupt",) if c in z.columns],
    ]
    return z.select(*cols)


def reject_reason() -> Column:
    """Why a flattened row is rejected; null for a good one."""
    return F.when(F.col("timestamp").isNull(), F.lit("unparsable_time")).when(F.col("bad_integral"), F.lit("non_integral_aqi"))


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): null timestamp or non-integral AQI go to rejects
    instead of collapsing into one arbitrary row in the dedup."""
    told = rows.withColumn("reject_reason", reject_reason())
    good = told.filter(F.col("reject_reason").isNull()).drop("bad_integral", "time_raw", "reject_reason")
    return good, told.filter(F.col("reject_reason").isNotNull())


def flatten_with_rejects(raw: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """All flattened rows of a scan that kept its corrupt documents, in one pass;
    ``reject_reason`` is null for the good ones. A corrupt document is one row, its
    text in ``time_raw``."""
    if CORRUPT not in raw.columns:
        return flatten_hourly(raw, features).withColumn("reject_reason", reject_reason())
    text = F.col(CORRUPT)
    none = {f: F.when(text.isNull(), F.col(f"hourly.{f}")).alias(f) for f in features}
    time = F.when(text.isNull(), F.col("hourly.time")).otherwise(F.array(text)).alias("time")
    docs = raw.withColumns({"hourly": F.struct(time, *none.values()), "_corrupt": text.isNotNull()})
    reason = F.when(F.col("_corrupt"), F.lit("corrupt_document")).otherwise(reject_reason())
    return flatten_hourly(docs, features).withColumn("reject_reason", reason).drop("_corrupt")


def long_to_wide(
    long: DataFrame,
    keys: list[str],
    parameter: str = "parameter",
    value: str = "value",
    values: list[str] | None = None,
    order: str | None = None,
) -> DataFrame:
    """Pivot (keys, parameter, value) to one column per parameter.

    With a fixed ``values`` list this is one conditional aggregation (a single
    shuffle on the keys, partial aggregation map-side); without it Spark's
    ``pivot`` first finds the distinct parameters. With ``order``, the latest
    value by that column wins; else the maximum.
    """
    if values is None:
        g = long.groupBy(*keys).pivot(parameter)
        return g.agg(F.max_by(value, order) if order else F.max(value))
    aggs = []
    for p in values:
        hit = F.col(parameter) == F.lit(p)
        v = F.when(hit, F.col(value))
        aggs.append((F.max_by(v, F.when(hit, F.col(order))) if order else F.max(v)).alias(p))
    return long.groupBy(*keys).agg(*aggs)
