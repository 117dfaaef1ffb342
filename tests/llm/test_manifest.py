import hashlib
import zlib

import pytest
from helpers import SF, messy, none_of
from pyspark.sql import functions as F

from envflow.llm import catalog, manifest

LOWER = {i: i + 32 for i in range(65, 91)}


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    out = []
    for v in (r.doc_id, r.source, r.lang, r.n_chars, text):
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return h(*out)


def by_hand(rows) -> list:
    def tree(level):
        out = [level]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
        return out

    def path(t, i):
        for level in t[:-1]:
            first = i // 8 * 8
            yield level[first:i], level[i + 1 : first + 8]
            i //= 8

    by: dict = {}
    for r in rows:
        by.setdefault(r.lang, []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        by[lang].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        trees.append(tree([leaf(r, r.text) for r in by[lang]]))
    top = tree([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for k, lang in enumerate(langs):
        for i, r in enumerate(by[lang]):
            steps = [*path(trees[k], i), *path(top, k)]
            tampered = r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
            d = leaf(r, r.text.translate(LOWER) if tampered else r.text)
            for a, b in steps:
                d = h(*a, d, *b)
            out.append((r.doc_id, trees[k][0][i], trees[k][-1][0], root, h(*[x for a, b in steps for x in a + b]), d, d == root))
    return sorted(out, key=str)


def got(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_op13_agrees_with_a_plain_tree(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = got(catalog.op13_merkle_manifest(spark, SF))
    assert found == by_hand(rows)
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("rows", [1, 7, 64])
def test_ranges_change_nothing(spark, monkeypatch, rows):
    monkeypatch.setattr(manifest, "RANGE_ROWS", rows)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(90)
    assert got(manifest.verification(docs)) == by_hand(docs.collect())


def test_many_languages_and_a_hot_one(spark):
    docs = spark.range(700).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id")).alias("text"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("l"), F.col("id") % 75)).alias("lang"),
        F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("n_chars"),
    )
    assert got(manifest.verification(docs)) == by_hand(docs.collect())


def test_repeated_rows_are_cut_into_ranges(spark, monkeypatch):
    """No range holds all copies of a row that is repeated."""
    monkeypatch.setattr(manifest, "RANGE_ROWS", 10)
    docs = spark.createDataFrame([(1, "Same", "en", "a", 4)] * 90 + [(2, "other", "en", "a", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    assert got(manifest.verification(docs)) == by_hand(docs.collect())


def test_one_row_one_language(spark):
    one = spark.createDataFrame([(5, "Alone", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    row = manifest.verification(one).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == h("")


def test_intervals_nest_and_siblings_fill_the_parent(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    nodes = manifest.manifest(docs).nodes.collect()
    by = {(n.lang, n.level, n.lo): n for n in nodes}
    for n in nodes:
        above = by.get((n.lang, n.level + 1, n.lo // 8 ** (n.level + 1) * 8 ** (n.level + 1)))
        if above:
            assert above.lo <= n.lo and n.hi <= above.hi
            kids = sorted((k for k in nodes if (k.lang, k.level) == (n.lang, n.level) and above.lo <= k.lo < above.hi), key=lambda k: k.lo)
            assert [k.lo for k in kids[1:]] == [k.hi for k in kids[:-1]] and kids[-1].hi == above.hi
            assert above.digest == h(*[k.digest for k in kids])


def test_any_change_is_noticed(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    for c, v in (("text", "'x' || text"), ("source", "source || ' '"), ("n_chars", "n_chars + 1"), ("lang", "lang || 'x'"), ("doc_id", "doc_id + 1000")):
        other = docs.withColumn(c, F.expr(f"CASE WHEN doc_id = 7 THEN {v} ELSE {c} END"))
        roots = {r[0] for d in (docs, other) for r in manifest.manifest(d).proofs.select("root").distinct().collect()}
        assert len(roots) == 2, c


def test_defined_cases(spark):
    assert got(manifest.verification(messy(spark))) == by_hand(messy(spark).collect())
    assert manifest.verification(none_of(messy(spark))).collect() == []
