"""Keep-latest operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(order: list[Column | str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the first by ``order`` (strings mean descending).

    ``row_number() = 1`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle, so a hot key ships at most one row per map task.
    ``order`` must end in a unique tie-break for a deterministic survivor.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_per_entity(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """Latest row per entity as an aggregation: ``max_by(row, order)``.

    Partial aggregation runs map-side, so a hot entity costs one row per map
    task in the shuffle; no sort of the detail rows is needed.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    ordering = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(F.max_by(row, ordering).alias("_r")).select(*keys, "_r.*")
