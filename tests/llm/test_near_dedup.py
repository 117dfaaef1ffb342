import math
import random

import numpy as np
import pytest
from helpers import SF, components_by_hand, documents, messy, none_of, rows_by

from envflow.llm import catalog, components, near_dedup


def test_op7_agrees_with_all_pairs(spark):
    docs = documents()
    got = rows_by(catalog.op7_minhash_near_dedup(spark, SF))
    want = components_by_hand(docs)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def family(rng, base, copies, edits):
    out = [" ".join(base)]
    for _ in range(copies):
        w = list(base)
        for k in rng.sample(range(len(w)), edits):
            w[k] = f"new{rng.random()}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def families(spark):
    """Groups around the threshold: some copies are linked to the base, some only to others or to none."""
    rng = random.Random(3)
    texts = []
    for edits in (1, 2, 3, 4, 5):
        texts += family(rng, [f"w{rng.randrange(10_000)}" for _ in range(120)], 40, edits)
    long = [f"v{rng.randrange(100_000)}" for _ in range(5000)]
    texts += family(rng, long, 6, 60) + family(rng, long, 3, 400)
    texts += ["one two", "One  TWO", "one two three four five", ""]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("block", [2048, 8])
def test_groups_around_the_threshold(spark, families, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    docs = spark.createDataFrame(list(families.items()), "doc_id long, text string")
    got = rows_by(near_dedup.near_duplicates(docs))
    want = components_by_hand(families)
    assert {i: r.component_id for i, r in got.items()} == {i: c for i, (_, c) in want.items()}
    assert {i: r.n_shingles for i, r in got.items()} == {i: n for i, (n, _) in want.items()}


def test_posterior_bounds_keep_similar_pairs():
    bounds = near_dedup.posterior_bounds()
    p = (1 + 0.75) / 2
    for k, least in enumerate(bounds, 1):  # the chance of a pair at the threshold to fall below
        n = min(64 * k, near_dedup.PERMUTATIONS)
        spare = 64 * k - n
        miss = sum(math.comb(n, m) * p**m * (1 - p) ** (n - m) for m in range(least - spare))
        assert miss < 1e-4
    assert bounds == sorted(bounds)
    # unrelated pairs (p = 1/2) go at the end
    assert bounds[-1] > 128 + 4 * 8


def test_min_hashes_estimate_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = x[:2500], x[500:]
    v = near_dedup.min_hashes(np.concatenate([a, b]), np.array([0, len(a)]))
    assert abs((v[0] == v[1]).mean() - 2000 / 3000) < 0.12


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2300)]
    root = {}

    def find(v):
        while root.setdefault(v, v) != v:
            v = root[v]
        return v

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[v] == find(v) for e in edges if e[0] != e[1] for v in e)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_messy_rows(spark):
    docs = messy(spark)
    rows = near_dedup.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    of = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert of[1].component_id == of[2].component_id == 1 and of[1].kept and not of[2].kept
    assert of[3].n_shingles == of[4].n_shingles == of[5].n_shingles == 0
    assert all(of[i].kept for i in (3, 4, 5, 6, 7, 8, 9))
    assert near_dedup.near_duplicates(none_of(docs)).count() == 0
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 8, 9]
    assert [r.text for r in kept.where("doc_id is null").collect()] == [None]  # the other one is near to document 1
    assert near_dedup.drop_near_duplicates(none_of(docs)).count() == 0


def test_null_and_shared_ids_are_linked_by_their_own_texts(spark):
    base = [f"w{i}" for i in range(60)]
    near, other = " ".join([*base[:59], "other"]), "something else that is long enough to have some shingles"
    lone = "alone and without any id at all"
    rows = [(1, " ".join(base)), (7, other), (7, near), (None, near + " x"), (None, lone), (None, lone + " ever"), (None, "no near one to this text of mine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()), key=str)
    alone = [(None, None, True)] * 2  # not near each other: 3 shingles and 4
    assert got == sorted([(1, 1, True), (7, 7, True), (7, 1, False), (None, 1, False), *alone, (None, None, True)], key=str)
    kept = {r.text for r in near_dedup.drop_near_duplicates(docs).collect()}
    assert len(kept) == near_dedup.drop_near_duplicates(docs).count()
    assert {rows[0][1], other, rows[6][1]} <= kept and near not in kept and near + " x" not in kept


def test_of_a_group_without_ids_one_row_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(None, text)] * 5 + [(None, text + " more")] + [(None, "")] * 2 + [(4, "")], "doc_id long, text string")
    kept = [r.text for r in near_dedup.drop_near_duplicates(docs).collect()]
    assert sorted(kept)[:3] == ["", "", ""] and len(kept) == 4
