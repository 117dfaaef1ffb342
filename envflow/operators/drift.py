"""Distribution drift between a reference and a current table.

Everything starts from one pre-aggregation to (feature, value) -> counts per
side, so the detail rows are read once and hot values cost one row each.
Statistics (our choice of contract, the reference delegates it to a library):

* ``ks`` (numeric): two-sample KS, asymptotic p-value, drift if p < 0.05;
* ``wasserstein`` (numeric): Wasserstein-1 / max(population std of reference,
  0.001), drift if >= 0.1;
* ``psi`` (numeric): reference-decile bins, shares floored at 1e-4, drift if >= 0.2;
* ``chisquare`` (categorical): current counts against reference shares, drift
  if p < 0.05;
* ``jensenshannon`` (categorical): distance (base 2), drift if >= 0.1.

The caller names the test (``DriftSpec``), for all columns or for single ones;
the number of rows never picks it. Every requested column has a row: where a
side has no values, ``status`` says so, there is no score, and a column with
values on one side only counts as drifted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DriftSpec
from .counts import paired, value_counts
from .prefix import quantiles_of_counts, running_totals

KS_TERMS = 100
ERF_TERMS = 400
HALF_SQRT_PI = 0.886226925452758
LOG_HALF_SQRT_PI = -0.1207822376352452


def _available(spec_cols, ref: DataFrame, cur: DataFrame) -> list[str]:
    have = set(ref.columns) & set(cur.columns)
    return [c for c in spec_cols if c in have]


def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic Kolmogorov tail Q(lambda), lambda = D sqrt(nm/(n+m)),
    by the alternating series (fixed term count), clamped to [0, 1]."""
    lam = d * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        F.lit(0.0),
        lambda acc, j: acc
        + F.when(j % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * j * j * lam * lam),
    )
    q = F.when(lam < 0.2, F.lit(1.0)).otherwise(series)
    return F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0))


def chi2_sf(stat: Column, dof: Column) -> Column:
    """Chi-square upper tail, by the finite sums for whole degrees of freedom.

    With x = stat / 2: even k = 2m gives sum_{j<m} e^-x x^j / j!; odd k = 2m + 1
    gives erfc(sqrt x) + sum_{j=1..m} e^-x x^(j-1/2) / Gamma(j + 1/2). Terms are
    kept as logarithms, so none overflows; there are k / 2 of them, whatever k.
    """
    x, lx = stat / 2.0, F.log(stat / 2.0)
    m = F.floor(dof / 2).cast("int")
    odd = (dof % 2) == 1
    half = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    # log of the first term: e^-x, or e^-x x^(1/2) / Gamma(3/2)
    first = -x + F.when(odd, lx / 2 - F.lit(LOG_HALF_SQRT_PI)).otherwise(F.lit(0.0))
    tail = F.aggregate(
        F.sequence(F.lit(1), F.greatest(m, F.lit(1))),
        F.struct(first.alias("l"), F.lit(0.0).alias("s")),
        lambda acc, j: F.struct((acc["l"] + lx - F.log(j + half)).alias("l"), (acc["s"] + F.exp(acc["l"])).alias("s")),
        lambda acc: acc["s"],
    )
    # erfc(sqrt x): below 1e-18 beyond x = 40; the series of erf converges long before its last term there
    erf = F.aggregate(
        F.sequence(F.lit(1), F.lit(ERF_TERMS)),
        F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
        lambda acc, n: F.struct((acc["t"] * x * 2 / (2 * n + 1)).alias("t"), (acc["s"] + acc["t"] * x * 2 / (2 * n + 1)).alias("s")),
        lambda acc: acc["s"],
    )
    erfc = F.when(x > 40.0, F.lit(0.0)).otherwise(1.0 - F.exp(-x) * F.sqrt(x) * erf / F.lit(HALF_SQRT_PI))
    p = F.when(m >= 1, tail).otherwise(F.lit(0.0)) + F.when(odd, erfc).otherwise(F.lit(0.0))
    p = F.when(dof < 1, F.lit(1.0)).when(x <= 0, F.lit(1.0)).otherwise(p)
    p = F.when(F.isnan(stat) | (stat == F.lit(float("inf"))), F.lit(0.0)).otherwise(p)
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


def _every_column(per: DataFrame, columns: list[str], kind: str, test: Column, threshold: Column, statistic: Column, score: Column, drifted: Column) -> DataFrame:
    """One row per requested column, with ``status`` and the verdict."""
    asked = per.sparkSession.createDataFrame([(c,) for c in columns], "feature string")  # the column list
    rows = per.join(F.broadcast(asked), "feature", "right").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("n_ref", "n_cur")}
    )
    status = (
        F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0), F.lit("ok"))
        .when(F.col("n_ref") > 0, F.lit("no_current_data"))
        .when(F.col("n_cur") > 0, F.lit("no_reference_data"))
        .otherwise(F.lit("no_data"))
    )
    ok = F.col("status") == "ok"
    return rows.withColumn("status", status).select(
        "feature",
        F.lit(kind).alias("kind"),
        test.alias("stattest"),
        F.when(ok, statistic).alias("statistic"),
        F.when(ok, score).alias("drift_score"),
        threshold.alias("threshold"),
        F.when(ok, drifted).otherwise(F.col("status") != "no_data").alias("drift_detected"),
        "n_ref",
        "n_cur",
        "status",
    )


def _test_of(spec: DriftSpec, columns: list[str], default: str) -> Column:
    """The test that the caller chose for each column."""
    chosen = dict(spec.tests)
    out = F.lit(default)
    for c in columns:
        if chosen.get(c, default) != default:
            out = F.when(F.col("feature") == c, F.lit(chosen[c])).otherwise(out)
    return out


def _sizes(counts: DataFrame) -> DataFrame:
    """Per feature: side sizes and the reference's population std, from the
    (feature, value) counts (two passes over the small table: mean, then
    squared deviations)."""
    base = counts.groupBy("feature").agg(
        F.sum("c_ref").cast("double").alias("n_ref"),
        F.sum("c_cur").cast("double").alias("n_cur"),
        F.sum(F.col("c_ref") * F.col("value")).alias("_sx"),
    )
    mean = base.select("feature", F.try_divide(F.col("_sx"), F.col("n_ref")).alias("_mu"))
    dev = (
        counts.join(F.broadcast(mean), "feature")
        .groupBy("feature")
        .agg(F.sum(F.col("c_ref") * (F.col("value") - F.col("_mu")) * (F.col("value") - F.col("_mu"))).alias("_ss"))
    )
    return base.join(dev, "feature").select(
        "feature", "n_ref", "n_cur", F.sqrt(F.try_divide(F.col("_ss"), F.col("n_ref"))).alias("ref_std")
    )


def _numeric(both: DataFrame, features: list[str]) -> DataFrame:
    """``feature, value, c_ref, c_cur`` of some columns."""
    return both.filter((F.col("kind") == "num") & F.col("num").isNotNull() & F.col("feature").isin(features)).select(
        "feature", F.col("num").alias("value"), "c_ref", "c_cur"
    )


def numeric_drift(both: DataFrame, features: list[str], spec: DriftSpec) -> DataFrame:
    """KS statistic + p-value and normalized Wasserstein per numeric feature, from paired counts."""
    counts = _numeric(both, features)
    sizes = _sizes(counts)
    rt = running_totals(counts, ["feature"], "value", ["c_ref", "c_cur"], buckets=spec.prefix_buckets, with_next=True)
    j = rt.join(F.broadcast(sizes), "feature")
    gap = F.abs(F.try_divide(F.col("cum_c_ref"), F.col("n_ref")) - F.try_divide(F.col("cum_c_cur"), F.col("n_cur")))
    step = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    per = j.groupBy("feature").agg(
        F.max(gap).alias("ks"),
        F.sum(gap * step).alias("w1"),
        F.count(F.lit(1)).alias("n_unique"),
        F.first("n_ref").alias("n_ref"),
        F.first("n_cur").alias("n_cur"),
        F.first("ref_std").alias("ref_std"),
    )
    ks = _test_of(spec, features, spec.numeric_test) == "ks"
    pval = ks_pvalue(F.col("ks"), F.col("n_ref"), F.col("n_cur"))
    wnorm = F.col("w1") / F.greatest(F.col("ref_std"), F.lit(0.001))
    return _every_column(
        per,
        features,
        "num",
        F.when(ks, F.lit("ks")).otherwise(F.lit("wasserstein")),
        F.when(ks, F.lit(spec.ks_pvalue)).otherwise(F.lit(spec.wasserstein_threshold)),
        F.when(ks, F.col("ks")).otherwise(wnorm),
        F.when(ks, pval).otherwise(wnorm),
        F.when(ks, pval < F.lit(spec.ks_pvalue)).otherwise(wnorm >= F.lit(spec.wasserstein_threshold)),
    )


def psi_drift(both: DataFrame, features: list[str], spec: DriftSpec) -> DataFrame:
    """Population stability index per numeric feature, from paired counts."""
    threshold = F.lit(spec.psi_threshold)
    score = F.col("psi")
    return _every_column(psi_of_counts(_numeric(both, features), spec.psi_bins), features, "num", F.lit("psi"), threshold, score, score, score >= threshold)


def category_counts(both: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, c_ref, c_cur, n_ref, n_cur), nulls skipped."""
    counts = both.filter((F.col("kind") == "cat") & F.col("cat").isNotNull() & F.col("feature").isin(columns)).select(
        "feature", F.col("cat").alias("value"), F.col("c_ref").cast("double").alias("c_ref"), F.col("c_cur").cast("double").alias("c_cur")
    )
    sizes = counts.groupBy("feature").agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"))
    return counts.join(F.broadcast(sizes), "feature")


def categorical_drift(both: DataFrame, columns: list[str], spec: DriftSpec) -> DataFrame:
    """Jensen-Shannon distance or chi-square per categorical column, from paired counts."""
    cc = category_counts(both, columns)
    p = F.try_divide(F.col("c_ref"), F.col("n_ref"))
    q = F.try_divide(F.col("c_cur"), F.col("n_cur"))
    mid = (p + q) / 2.0
    js_term = F.when(p > 0, p * F.log2(p / mid)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / mid)).otherwise(0.0)
    exp_cur = F.try_divide(F.col("c_ref") * F.col("n_cur"), F.col("n_ref"))
    chi_term = F.when(exp_cur > 0, (F.col("c_cur") - exp_cur) * (F.col("c_cur") - exp_cur) / exp_cur).otherwise(
        F.when(F.col("c_cur") > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))
    )
    per = cc.groupBy("feature").agg(
        F.sqrt(F.greatest(F.sum(js_term) / 2.0, F.lit(0.0))).alias("js"),
        F.sum(chi_term).alias("chi2"),
        F.count(F.lit(1)).alias("k"),
        F.first("n_ref").alias("n_ref"),
        F.first("n_cur").alias("n_cur"),
    )
    chi = _test_of(spec, columns, spec.categorical_test) == "chisquare"
    pval = chi2_sf(F.col("chi2"), F.col("k") - 1)
    return _every_column(
        per,
        columns,
        "cat",
        F.when(chi, F.lit("chisquare")).otherwise(F.lit("jensenshannon")),
        F.when(chi, F.lit(spec.chi2_pvalue)).otherwise(F.lit(spec.js_threshold)),
        F.when(chi, F.col("chi2")).otherwise(F.col("js")),
        F.when(chi, pval).otherwise(F.col("js")),
        F.when(chi, pval < F.lit(spec.chi2_pvalue)).otherwise(F.col("js") >= F.lit(spec.js_threshold)),
    )


def psi(ref: DataFrame, cur: DataFrame, features: list[str], bins: int = 10, eps: float = 1e-4) -> DataFrame:
    """Population stability index on reference-quantile bins (exact edges); each side is read once."""
    return psi_of_counts(_numeric(paired(value_counts(ref, features), value_counts(cur, features)), features), bins, eps)


def psi_of_counts(values: DataFrame, bins: int = 10, eps: float = 1e-4) -> DataFrame:
    """PSI from ``feature, value, c_ref, c_cur``: counts, not rows, are dealt into the bins."""
    probs = [i / bins for i in range(1, bins)]
    own = values.filter("c_ref > 0").select("feature", "value", F.col("c_ref").alias("_c"))
    edges = quantiles_of_counts(own, ["feature"], "value", probs).select(
        "feature", F.array(*[F.col(f"q_{i}") for i in range(len(probs))]).alias("_e")
    )
    binned = values.join(F.broadcast(edges), "feature", "left").withColumn("bin", F.size(F.filter("_e", lambda e: e < F.col("value"))))
    counts = binned.groupBy("feature", "bin").agg(F.sum("c_ref").alias("c_ref"), F.sum("c_cur").alias("c_cur"))
    tot = counts.groupBy("feature").agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"))
    j = counts.join(F.broadcast(tot), "feature")
    a = F.greatest(F.try_divide("c_ref", "n_ref"), F.lit(eps))
    b = F.greatest(F.try_divide("c_cur", "n_cur"), F.lit(eps))
    return j.groupBy("feature").agg(
        F.sum((b - a) * F.log(b / a)).alias("psi"), F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur")
    )


def drift_columns(spec: DriftSpec, ref: DataFrame, cur: DataFrame) -> tuple[list[str], list[str]]:
    """The requested numeric and categorical columns that both tables have."""
    num, cat = _available(spec.numerical, ref, cur), _available(spec.categorical, ref, cur)
    if not num and not cat:
        raise ValueError("no requested column is present in both tables")
    return num, cat


def drift_features(ref: DataFrame, cur: DataFrame, spec: DriftSpec = DriftSpec()) -> DataFrame:
    """One row per tested column: kind, test, statistic, score, threshold, flag. Each side is read once."""
    num, cat = drift_columns(spec, ref, cur)
    return drift_of_counts(value_counts(ref, num, cat), value_counts(cur, num, cat), num, cat, spec)


def drift_of_counts(ref: DataFrame, cur: DataFrame, num: list[str], cat: list[str], spec: DriftSpec = DriftSpec()) -> DataFrame:
    """:func:`drift_features` from value counts (:mod:`envflow.operators.counts`), stored ones for instance."""
    both = paired(ref, cur)
    chosen = dict(spec.tests)
    by_psi = [c for c in num if chosen.get(c, spec.numeric_test) == "psi"]
    by_rank = [c for c in num if c not in by_psi]
    parts = []
    if by_rank:
        parts.append(numeric_drift(both, by_rank, spec))
    if by_psi:
        parts.append(psi_drift(both, by_psi, spec))
    if cat:
        parts.append(categorical_drift(both, cat, spec))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_dataset(features: DataFrame, share: float = 0.5) -> DataFrame:
    """Dataset verdict: tested/drifted counts, share, flag, sorted drifted list."""
    return features.agg(
        F.count(F.lit(1)).alias("n_features"),
        F.sum(F.col("drift_detected").cast("int")).cast("bigint").alias("n_drifted"),
        F.avg(F.col("drift_detected").cast("double")).alias("drift_score"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))), ",").alias(
            "drifted_features"
        ),
    ).withColumn("drift_detected", F.col("drift_score") >= F.lit(share))


def target_drift(ref: DataFrame, cur: DataFrame, target: str, spec: DriftSpec = DriftSpec()) -> DataFrame:
    """Drift of the label column, tested as categorical."""
    if target not in ref.columns or target not in cur.columns:
        raise ValueError(f"target {target!r} missing")
    both = paired(value_counts(ref, [], [target]), value_counts(cur, [], [target]))
    return categorical_drift(both, [target], spec)
