"""Dimension lookups with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# a dimension is broadcast only when it has at most this many rows and
# about this many bytes (measured as the JSON length of its rows)
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def checked_broadcast(dim: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``dim`` only after proving it is small.

    The rows are counted up to ``max_rows + 1`` (a limit over empty rows, which
    stops reading once the bound is passed); only within that bound is their
    approximate size summed, in parallel. Beyond either bound the plain side is returned and Spark shuffles (AQE may
    still switch to a broadcast at run time when the real size allows it).
    """
    size = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in dim.columns])))
    if dim.select(F.lit(1)).limit(max_rows + 1).count() > max_rows:
        return dim
    nbytes = dim.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(dim) if nbytes <= max_bytes else dim


def enrich(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    columns: list[str],
    explicit: dict[str, str] | None = None,
    max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Left-join dimension columns; an explicit value on the row wins.

    ``explicit`` maps a dimension column to the row column that overrides it
    (like explicit coordinates over the city table).
    """
    explicit = explicit or {}
    d = dim.select(F.col(dim_key).alias("_dk"), *[F.col(c).alias(f"_d_{c}") for c in columns])
    j = df.join(checked_broadcast(d, max_rows), df[key] == F.col("_dk"), "left")
    out = []
    for c in columns:
        v = F.col(f"_d_{c}")
        if c in explicit:
            v = F.coalesce(F.col(explicit[c]), v)
        out.append(v.alias(c))
    keep = [F.col(c) for c in df.columns if c not in columns]
    return j.select(*keep, *out)


def unknown_entities(df: DataFrame, dim: DataFrame, key: str, dim_key: str, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Rows whose key is absent from the dimension (left anti join)."""
    d = dim.select(F.col(dim_key).alias("_dk"))
    return df.join(checked_broadcast(d, max_rows), df[key] == F.col("_dk"), "left_anti")
