"""Connected components of an edge table, by alternating stars, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from envflow.llm.common import stored

MAX_ROUNDS = 60


def _lowest(edges: DataFrame) -> DataFrame:
    """For every ``u`` the least of itself and its ``v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return least.select(F.col("u"), F.least("u", "m").alias("m"))


def _told(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """``edges`` stored, and their digest, observed on the way."""
    seen = Observation()
    rows = edges.observe(
        seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("h"), F.sum("v").alias("v")
    )
    table = stored(rows, name)
    got = seen.get
    return table, (got["n"], got["h"], got["v"])


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for every node of ``edges`` (``a, b``).

    Large-star, then small-star, until the edges stay the same; the rounds grow with
    the logarithm of the size. Each round's edges are a stored table, so a lost
    executor costs one round at most.
    """
    first = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now, last = _told(first, "cc")
    for _ in range(MAX_ROUNDS):
        if not last[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours of u point at u's least neighbour
        large = both.where("v > u").join(_lowest(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its smaller neighbours point at the least of them
        low = _lowest(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now, new = _told(small, "cc")
        if new == last:
            break
        last = new
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def forest_roots(parents: DataFrame) -> DataFrame:
    """``node, component`` for a forest ``a, b``: every ``a`` stands once and has the lesser parent
    ``b``. Pointers are doubled until they all end at roots."""
    now = stored(parents.select(F.col("a").alias("node"), F.col("b").alias("component")), "roots")
    for _ in range(MAX_ROUNDS):
        above = now.select(F.col("node").alias("component"), F.col("component").alias("next"))
        seen = Observation()
        step = now.join(above, "component", "left").observe(seen, F.count("next").alias("n"))
        now = stored(step.select("node", F.coalesce("next", "component").alias("component")), "roots")
        if not seen.get["n"]:
            break
    else:
        raise RuntimeError(f"roots did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("component").alias("node")).distinct()
    return now.unionByName(roots.select("node", F.col("node").alias("component")))
