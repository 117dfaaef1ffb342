"""Column/row preparation for training, reference data and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EXCLUDE_COLUMNS, FEATURES, TARGET, UNKNOWN_LABEL


def drop_if_present(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def prepare_training(
    df: DataFrame,
    target: str = TARGET,
    exclude: list[str] = EXCLUDE_COLUMNS,
    unknown: str = UNKNOWN_LABEL,
) -> DataFrame:
    """Drop non-feature columns, rows with null target and the unknown class."""
    out = drop_if_present(df, list(exclude))
    return out.na.drop(subset=[target]).filter(F.col(target) != F.lit(unknown))


def available(wanted: list[str], df: DataFrame) -> list[str]:
    """Wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def reference_load(df: DataFrame, features: list[str] = FEATURES, target: str = TARGET) -> DataFrame:
    """Reference table: the available feature/target columns, any-null rows dropped."""
    cols = available(list(features) + [target], df)
    if not cols:
        raise ValueError("none of the requested columns is present")
    return df.select(*cols).na.drop("any")


def align_features(df: DataFrame, features: list[str] = FEATURES, keep: list[str] = (), fill: float = 0.0) -> DataFrame:
    """Model-ordered feature columns as double; a missing column becomes ``fill``.
    A present-but-null value stays null (imputed by the model pipeline)."""
    have = set(df.columns)
    cols = [F.col(c).cast("double").alias(c) if c in have else F.lit(fill).cast("double").alias(c) for c in features]
    return df.select(*keep, *cols)


def check_limit(limit: int, maximum: int | None = None) -> int:
    """A positive limit; above a feed's ``maximum`` it is an error, never a silent cut."""
    if not isinstance(limit, int) or limit < 1:
        raise ValueError("limit must be a positive integer")
    if maximum is not None and limit > maximum:
        raise ValueError(f"limit {limit} is above the feed's maximum of {maximum}")
    return limit


#: ``row_number() <= k`` plans a partial ``WindowGroupLimit`` up to this k (Spark's default threshold).
PARTIAL_LIMIT = 1000


def limit_per_entity(df: DataFrame, entity: str, order: list, limit: int, maximum: int | None = None, salts: int = 64) -> DataFrame:
    """Top-``limit`` rows per entity, with their ``rank``.

    Up to ``PARTIAL_LIMIT`` each map task ships at most ``limit`` rows per entity
    (partial ``WindowGroupLimit``). Beyond it the rows of an entity are first ranked
    within ``salts`` groups by the hash of the row, so no task holds a whole hot
    entity; the final rank sees at most ``salts * limit`` rows of it.
    """
    k = check_limit(limit, maximum)
    ordering = [F.col(c).desc() if isinstance(c, str) else c for c in order]
    if k > PARTIAL_LIMIT:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
        within = Window.partitionBy(entity, "_salt").orderBy(*ordering)
        df = salted.withColumn("_rank", F.row_number().over(within)).filter(F.col("_rank") <= k).drop("_salt", "_rank")
    w = Window.partitionBy(entity).orderBy(*ordering)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def preview(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    """First ``n`` rows after a total order (a top-n, planned as
    ``TakeOrderedAndProject``: each task keeps n rows, the driver merges)."""
    return df.orderBy(*order).limit(n)
