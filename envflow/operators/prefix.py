"""Exact running totals over an ordered value, without a single-task window.

A window ``partitionBy(feature).orderBy(value)`` puts every value of a
feature in one task. Here the (pre-aggregated, one row per distinct value)
input is partitioned by ranges of (group, value) and written to a scratch
table; running sums are computed inside (group, range) windows and shifted by
the totals of the group's earlier ranges, a table of ranges + groups rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .enrich import checked_broadcast

# a group up to this many distinct values is summed in one window task
SINGLE_TASK_ROWS = 2_000_000
# beyond that, aim for about this many rows per range, however many ranges that takes
BUCKET_ROWS = 1_000_000
# the table of the ranges' totals is broadcast only up to this many rows;
# beyond it, it is joined by a shuffle
MAX_BROADCAST_ENTRIES = 4_000_000


def running_totals(
    df: DataFrame,
    groups: list[str],
    order: str,
    sums: list[str],
    buckets: int = 64,
    with_next: bool = False,
    single_task_rows: int | None = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Add ``cum_<s>`` (sum of ``s`` over rows with order <= this row, per
    group) and, with ``with_next``, ``next_<order>`` (the next distinct value).

    ``df`` must hold one row per (groups, order).

    Size check first: when the largest group has at most ``single_task_rows``
    rows, one window per group is cheaper and still bounded; beyond that the
    rows are cut into at least ``buckets`` ranges of about ``BUCKET_ROWS`` rows.
    Both give the same rows.
    """
    # one small job: the largest group, the number of groups and of rows
    biggest, n_groups, n_rows = (
        df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n"), F.count(F.lit(1)), F.sum("_n")).first()
    )
    if single_task_rows and (biggest or 0) <= single_task_rows:
        w = Window.partitionBy(*groups).orderBy(order)
        cols = [F.sum(s).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(f"cum_{s}") for s in sums]
        if with_next:
            cols.append(F.lead(order).over(w).alias(f"next_{order}"))
        return df.select(*df.columns, *cols)
    ranges = max(buckets, -(-(n_rows or 0) // BUCKET_ROWS))
    # written, so that a row keeps its range whatever is computed again
    x = materialize(df.repartitionByRange(ranges, *groups, order).withColumn("_range", F.spark_partition_id()))

    within = Window.partitionBy(*groups, "_range").orderBy(order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.sum(s).over(upto).alias(f"_l_{s}") for s in sums]
    if with_next:
        cols.append(F.lead(order).over(within).alias("_lnext"))
    local = x.select("*", *cols)

    totals = x.groupBy(*groups, "_range").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums], F.min(order).alias("_least"))
    ahead = Window.partitionBy(*groups).orderBy("_range")
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *groups,
        "_range",
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums],
        F.lead("_least").over(ahead).alias("_following"),
    )
    # a group's ranges are consecutive, so there are fewer than ranges + groups of these rows
    if n_groups + ranges <= MAX_BROADCAST_ENTRIES:
        offsets = F.broadcast(offsets)
    j = local.join(offsets, [*groups, "_range"])
    out = [F.col(c) for c in df.columns] + [(F.col(f"_l_{s}") + F.col(f"_o_{s}")).alias(f"cum_{s}") for s in sums]
    if with_next:
        out.append(F.coalesce(F.col("_lnext"), F.col("_following")).alias(f"next_{order}"))
    return j.select(*out)


def exact_quantiles(
    df: DataFrame, groups: list[str], value: str, probs: list[float], buckets: int = 64, single_task_rows: int | None = SINGLE_TASK_ROWS
) -> DataFrame:
    """Exact interpolated quantiles (like ``percentile``/``median``) per group,
    nulls skipped, computed from distinct-value counts and running totals
    instead of holding all values of a group in one task.

    Output: groups + ``q_<i>`` per probability.
    """
    counts = materialize(
        df.filter(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_c"))
    )
    return quantiles_of_counts(counts, groups, value, probs, buckets, single_task_rows)


def quantiles_of_counts(
    counts: DataFrame, groups: list[str], value: str, probs: list[float], buckets: int = 64, single_task_rows: int | None = SINGLE_TASK_ROWS
) -> DataFrame:
    """:func:`exact_quantiles` from a stored table of distinct values and their counts ``_c``."""
    rt = running_totals(counts, groups, value, ["_c"], buckets=buckets, single_task_rows=single_task_rows)
    n = counts.groupBy(*groups).agg(F.sum("_c").alias("_n"))
    targets = n
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1) * F.lit(float(p))
        targets = targets.withColumn(f"_lo{i}", F.floor(pos)).withColumn(f"_hi{i}", F.ceil(pos)).withColumn(f"_fr{i}", pos - F.floor(pos))
    # one row per group, from the checkpointed counts: size-checked broadcast
    j = rt.join(checked_broadcast(targets), groups)
    start = F.col("cum__c") - F.col("_c")
    aggs = []
    for i, _ in enumerate(probs):
        in_lo = (start <= F.col(f"_lo{i}")) & (F.col(f"_lo{i}") < F.col("cum__c"))
        in_hi = (start <= F.col(f"_hi{i}")) & (F.col(f"_hi{i}") < F.col("cum__c"))
        aggs += [
            F.max(F.when(in_lo, F.col(value))).alias(f"_vlo{i}"),
            F.max(F.when(in_hi, F.col(value))).alias(f"_vhi{i}"),
            F.max(f"_fr{i}").alias(f"_f{i}"),
        ]
    hits = j.groupBy(*groups).agg(*aggs)
    return hits.select(
        *groups,
        *[
            (F.col(f"_vlo{i}") + (F.col(f"_vhi{i}") - F.col(f"_vlo{i}")) * F.col(f"_f{i}")).alias(f"q_{i}")
            for i in range(len(probs))
        ],
    )
