import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from helpers import SF, messy, none_of

from envflow.llm import catalog, spelling


def by_hand(rows) -> set:
    """``word, form, root, n, n_near, form_n`` by deletion neighbourhoods."""
    counts: Counter = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.encode().lower().decode()
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= 3 and len(w) >= 5}
    near, holes = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            holes[i, rest].add(w)
            if rest in n:
                near[w].add(rest)
                near[rest].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 2 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), c, len(near[w]), n.get(form.get(w))) for w, c in n.items()}


def rows_of(sf):
    return duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{sf}/documents.parquet')").fetchall()


def test_op11_agrees_with_deletion_neighbourhoods(spark):
    assert {tuple(r) for r in catalog.op11_spelling_variants(spark, SF).collect()} == by_hand(rows_of(SF))


@pytest.mark.parametrize("cell, sample", [(60, 100_000), (30, 50), (10, 1)])
def test_cells_units_and_samples_change_nothing(spark, monkeypatch, cell, sample):
    """Small cells, cells of several units (splits from hardly any words), lengths without a sampled word."""
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "SAMPLE", sample)
    monkeypatch.setattr(spelling, "LEAF", 4)
    monkeypatch.setattr(spelling, "PAIRS", 64)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    assert {tuple(r) for r in spelling.variants(docs).collect()} == by_hand(rows_of(SF))


def test_accents_ties_and_chains(spark):
    words = ["élève"] * 3 + ["eleve"] * 7 + ["élèves"] * 3 + ["größe"] * 4 + ["grösse"] * 9 + ["abcde"] * 3 + ["abcdx"] * 6 + ["abcdy"] * 6 + ["abcdxy"] * 12
    words += ["abcdxyz"] * 24 + ["Hello"] * 4 + ["hELLO"] * 4 + ["h×llo"] * 3 + ["Àbcde"] * 3 + ["àbcde"] * 5
    whole = [next(i for i in range(10 * k, 10 * k + 10) if zlib.crc32(f"{i}:{w.encode().lower().decode()}".encode()) % 97) for k, w in enumerate(words)]
    rows = list(zip(whole, words))
    got = {tuple(r) for r in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == by_hand(rows)
    of = {r[0]: r for r in got}
    assert of["abcde"][1:3] == ("abcdx", "abcdxyz")  # a tie, then a chain


def test_anagrams_and_long_runs(spark):
    rows = [(1, " ".join(f"{a}{b}{c}de " * 3 for a in "abc" for b in "abc" for c in "abc")), (2, ("x" * 5000 + " ") * 3 + ("x" * 4999 + " ") * 3), (None, "nobody " * 4)]
    got = {tuple(r) for r in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == by_hand(rows)


def test_every_run_is_thinned_by_its_document_and_letters():
    ids, texts = [3, None, 12345678901], ["Alpha beta Größe alpha", "alpha beta", "ÀÉ beta " + " ".join(f"run{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600))]
    import pyarrow as pa

    got: Counter = Counter()
    for w, n in zip(*spelling.counted(ids, pa.array(texts), {})):
        got[w] += n
    want: Counter = Counter()
    for i, t in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t):
            run = run.encode().lower().decode()
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            run = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run
            if len(run) >= 5:
                want[run] += 1
    assert got == want


def test_range_searches_prune_nothing_near():
    rng = np.random.default_rng(4)
    v = rng.integers(0, 4, (400, spelling.DIMENSIONS)).astype(np.int16)
    v[:, 6:] = 0
    tree = spelling.Tree(v, 5)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(400))
    seen = set()
    for leaf, at in tree.reached(v, 1, 1):
        seen |= {(i, j) for i in at.tolist() for j in tree.leaves[leaf].tolist()}
    up = np.maximum(v[None] - v[:, None], 0).sum(axis=2)
    assert {(i, j) for i, j in zip(*np.nonzero((up <= 1) & (up.T <= 1)))} <= seen
    assert len(seen) < 400 * 400


def test_defined_cases(spark):
    assert {tuple(r) for r in spelling.variants(messy(spark)).collect()} == by_hand([(r.doc_id, r.text) for r in messy(spark).collect()])
    assert spelling.variants(none_of(messy(spark))).collect() == []
