"""Fixtures and plain-Python twins that the operators are held against."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

#: ``documents`` with columns whose names the operators use themselves.
MESSY_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("length", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
)
LONG = " ".join(f"word{i % 997}" for i in range(30_000))
_EXTRA = ("x", 1, None, "y", None, "z", "w")


def messy_rows() -> list[tuple]:
    same = "the quick brown fox jumps over the lazy dog and runs far away"
    rows = [
        (1, same, "en", "a", len(same)),
        (1, same, "en", "a", len(same)),  # a repeated row
        (2, same, "en", None, None),
        (3, None, "en", "b", None),
        (4, "", None, None, 0),
        (5, "   \n\t ", "en", "a", 6),
        (6, LONG, "en", "a", len(LONG)),
        (7, "x", None, "a", 1),
        (None, same + " today", None, None, None),
        (None, None, None, None, None),
        (8, "été señor größe 日本語 👍🏽 \x00 end", "fr", "c", 30),
        (9, "12 34 -- !!", "en", "c", 11),
    ]
    return [(*r, *_EXTRA) for r in rows]


def messy(spark):
    return spark.createDataFrame(messy_rows(), MESSY_SCHEMA)


def none_of(df):
    return df.where("false")


def documents(sf: str = SF) -> dict[int, str]:
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM read_parquet('{sf}/documents.parquet')").fetchall()
    return dict(rows)


def components_by_hand(texts: dict, pct: int = 75, size: int = 5) -> dict:
    """Least id reachable over links of shingle sets, all pairs compared."""
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set()
    by_shingle = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            by_shingle[x].add(i)
    root = {i: i for i in texts}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, s in sets.items():
        near = Counter(j for x in s for j in by_shingle[x] if j < i)
        for j, both in near.items():
            if 100 * both >= pct * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in texts}


def crc(i, folds: int) -> int:
    return zlib.crc32(str(i).encode()) % folds


def rows_by(df, key="doc_id") -> dict:
    return {r[key]: r for r in df.collect()}
