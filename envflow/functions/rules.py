"""Declarative row rules -> a ``violations`` array column, accept/reject split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AQI_MAX, AQI_MIN, OPTIONAL_AQI, REQUIRED_NON_NEGATIVE


@dataclass(frozen=True)
class Rule:
    """``column`` must satisfy [lo, hi]; ``required`` makes null a violation."""

    column: str
    lo: float | None = None
    hi: float | None = None
    required: bool = False

    @property
    def name(self) -> str:
        parts = [self.column]
        if self.required:
            parts.append("required")
        if self.lo is not None:
            parts.append(f"ge_{self.lo:g}")
        if self.hi is not None:
            parts.append(f"le_{self.hi:g}")
        return ":".join(parts)

    def broken(self, present: bool = True) -> Column:
        if not present:
            return F.lit(self.required)
        v = F.col(self.column)
        bad = F.lit(False)
        if self.lo is not None:
            bad = bad | (v < F.lit(self.lo))
        if self.hi is not None:
            bad = bad | (v > F.lit(self.hi))
        if self.required:
            bad = bad | v.isNull()
        else:
            bad = v.isNotNull() & bad
        # NaN is not a valid measurement for a bounded rule
        if self.lo is not None or self.hi is not None:
            bad = bad | (v.isNotNull() & F.isnan(v.cast("double")))
        return F.coalesce(bad, F.lit(False))


def scoring_input_rules() -> list[Rule]:
    """Six required non-negative pollutants; two optional AQI in [0, 500]."""
    return [Rule(c, lo=0.0, required=True) for c in REQUIRED_NON_NEGATIVE] + [
        Rule(c, lo=float(AQI_MIN), hi=float(AQI_MAX)) for c in OPTIONAL_AQI
    ]


def prediction_rules(confidence: str = "confidence") -> list[Rule]:
    return [Rule(confidence, lo=0.0, hi=1.0)]


def with_violations(df: DataFrame, rules: list[Rule], out: str = "violations") -> DataFrame:
    """Add an array of broken rule names (empty when the row passes)."""
    cols = set(df.columns)
    checks = [F.when(r.broken(r.column in cols), F.lit(r.name)) for r in rules]
    return df.withColumn(out, F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>"))


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected-with-violations). Both come from one lazy plan."""
    checked = with_violations(df, rules)
    ok = checked.filter(F.size("violations") == 0).drop("violations")
    bad = checked.filter(F.size("violations") > 0)
    return ok, bad


def validate_batches(df: DataFrame, batch: str, lo: int = None, hi: int = None) -> DataFrame:
    """Batch-size rule: every batch must hold between ``lo`` and ``hi`` rows."""
    from ..config import BATCH_MAX, BATCH_MIN

    lo = BATCH_MIN if lo is None else lo
    hi = BATCH_MAX if hi is None else hi
    sizes = df.groupBy(F.col(batch).alias("batch_id")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("valid", (F.col("n") >= lo) & (F.col("n") <= hi))
