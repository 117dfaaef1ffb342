import random

import numpy as np
import pytest
from helpers import SF, components_by_hand, documents, messy, messy_rows, none_of, rows_by

from envflow.llm import catalog, jaccard_join
from envflow.llm.shingles import WordHashes


def both(got):
    return {i: (r.n_shingles, r.component_id) for i, r in got.items()}


def test_op12_agrees_with_all_pairs(spark):
    assert both(rows_by(catalog.op12_jaccard_join(spark, SF))) == components_by_hand(documents(), 85, 4)


@pytest.fixture(scope="module")
def families():
    """Copies with edits, so that similarities lie around the threshold."""
    rng = random.Random(5)
    texts = ["one two", "One  TWO", "one two three", "a b c d", "a b c d e", ""]
    for size, edits in ((12, 1), (60, 1), (120, 1), (120, 2), (120, 3), (300, 5), (300, 6), (4000, 60), (4000, 90)):
        base = [f"w{rng.randrange(100_000)}" for _ in range(size)]
        texts.append(" ".join(base))
        for _ in range(8 if size > 1000 else 30):
            w = list(base)
            for k in rng.sample(range(size), edits):
                w[k] = f"new{rng.random()}"
            texts.append(" ".join(w[: size - rng.randrange(3)]))
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("block, group", [(2048, 1000), (8, 3)])
def test_groups_around_the_threshold(spark, families, monkeypatch, block, group):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "GROUP", group)
    docs = spark.createDataFrame(list(families.items()), "doc_id long, text string").repartition(6)
    assert both(rows_by(jaccard_join.jaccard_components(docs))) == components_by_hand(families, 85, 4)


def test_chains_over_pairs_that_are_not_linked(spark):
    """Each text is linked with the next one only; one component over all."""
    words = [f"w{i}" for i in range(400)]
    texts = {i: " ".join(words[6 * i : 6 * i + 100]) for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = rows_by(jaccard_join.jaccard_components(docs))
    assert both(got) == components_by_hand(texts, 85, 4)
    assert got[20].component_id == 0


def test_linked_sets_share_a_tile():
    rng = np.random.default_rng(1)
    for pct in (60, 85, 95):
        bands = jaccard_join.Bands(pct)
        for n in [*range(1, 60), 100, 333, 1000]:
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            n = len(a)
            for gone in {0, 1, n * (100 - pct) // pct}:
                for more in {0, 1, n * (100 - pct) // pct}:
                    b = np.unique(np.concatenate((a[gone:], rng.integers(0, 1 << 63, more).astype(np.uint64))))
                    same = len(np.intersect1d(a, b))
                    if len(b) and 100 * same >= pct * (n + len(b) - same):
                        assert np.intersect1d(jaccard_join.tiles(a, bands), jaccard_join.tiles(b, bands)).size, (pct, n, gone, more)


def test_a_set_that_fills_too_few_parts_has_other_tiles(monkeypatch):
    monkeypatch.setattr(jaccard_join.Bands, "parts", lambda self, b: 1)  # no set of six has two parts
    bands = jaccard_join.Bands()
    a = np.arange(1, 8, dtype=np.uint64)
    assert np.intersect1d(jaccard_join.tiles(a, bands), jaccard_join.tiles(a[:6], bands)).size


def test_bounds_are_never_below_the_intersection():
    rng = np.random.default_rng(2)
    for n, m in ((5, 9), (40, 44), (700, 900), (20_000, 21_000)):
        a = np.unique(rng.integers(0, 2 * n, n).astype(np.uint64))
        b = np.unique(rng.integers(0, 2 * n, m).astype(np.uint64))
        x, y = jaccard_join.bitmap(a).tobytes(), jaccard_join.bitmap(b).tobytes()
        w = min(len(x), len(y)) // 8
        most = jaccard_join.most_overlap(jaccard_join.folded([x], w), jaccard_join.folded([y], w), np.array([len(a)]), np.array([len(b)]))
        assert len(np.intersect1d(a, b)) <= most[0] <= min(len(a), len(b))


def test_defined_cases(spark):
    got = jaccard_join.jaccard_components(messy(spark)).collect()
    assert len(got) == len(messy_rows())
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert by[1] == {(10, 1)} and by[2] == {(10, 1)}
    assert by[3] == {(0, 3)} and by[4] == {(0, 4)} and by[5] == {(0, 5)}
    assert by[None] == {(11, 1), (0, None)}  # the null id's text is linked with document 1
    assert by[6] == {(997, 6)}
    assert jaccard_join.jaccard_components(none_of(messy(spark))).collect() == []


def test_null_and_shared_ids_are_linked_by_their_own_texts(spark):
    base = [f"w{i}" for i in range(60)]
    near = " ".join([*base[:59], "other"])
    rows = [(1, " ".join(base)), (7, "something else that is long enough to have some shingles"), (7, near), (None, near + " x"), (None, "alone and without any id at all")]
    got = {(r[0], r[2]) for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (7, 7), (7, 1), (None, 1), (None, None)}


def test_a_text_held_by_a_third_of_the_rows_is_one_node(spark):
    rows = [(i, "the same five words here" if i % 3 == 0 else f"a text of its own {i} {i * i} {i ** 3}") for i in range(300)]
    got = rows_by(jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)))
    assert all(r.component_id == (0 if i % 3 == 0 else i) for i, r in got.items())


def test_other_thresholds_and_string_ids(spark):
    texts = {f"d{i:03}": t for i, t in documents().items()}
    docs = spark.createDataFrame(list(texts.items()), "name string, body string")
    got = jaccard_join.jaccard_components(docs, 60, 2, "name", "body").collect()
    assert {r[0]: (r[1], r[2]) for r in got} == components_by_hand(texts, 60, 2)


def test_sets_are_sorted():
    s = jaccard_join.set_of("b a b a b a c", WordHashes(), 2)
    assert len(s) == 3 and (s[:-1] < s[1:]).all()


