"""Band labels generated from a (upper bound, label) spec."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import FIVE_BAND, THREE_BAND, UNKNOWN_LABEL


def band_label(value: Column | str, bands=THREE_BAND, null_label: str = UNKNOWN_LABEL) -> Column:
    """Label by half-open bands: ``value < bound`` picks the first matching band.

    Null and NaN map to ``null_label`` (Spark orders NaN above every number,
    so without the NaN test it would fall in the top band).
    """
    v = F.col(value) if isinstance(value, str) else value
    expr = F.when(v.isNull() | F.isnan(v), F.lit(null_label))
    for bound, label in bands:
        if bound is None:
            return expr.otherwise(F.lit(label))
        expr = expr.when(v < F.lit(float(bound)), F.lit(label))
    return expr


def three_band(value: Column | str) -> Column:
    return band_label(value, THREE_BAND)


def five_band(value: Column | str) -> Column:
    return band_label(value, FIVE_BAND)


def band_sql(value_sql: str, bands=THREE_BAND, null_label: str = UNKNOWN_LABEL) -> str:
    """The same rule as SQL text (used by oracles and SQL users)."""
    parts = [f"CASE WHEN {value_sql} IS NULL OR isnan({value_sql}) THEN '{null_label}'"]
    for bound, label in bands:
        if bound is None:
            parts.append(f"ELSE '{label}' END")
        else:
            parts.append(f"WHEN {value_sql} < {float(bound)} THEN '{label}'")
    return " ".join(parts)
