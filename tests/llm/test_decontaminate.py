import re

import duckdb
import numpy as np
import pytest
from helpers import SF, documents, messy, none_of
from hypothesis import given, settings
from hypothesis import strategies as st

from envflow.llm import catalog, decontaminate
from envflow.llm.fm_index import FMIndex

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def by_hand(docs, items, size=10):
    out = []
    for text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, t in items:
            v = words(t)
            m = min(size, len(v))
            for k in range(len(v) - m + 1) if v else ():
                for i in range(len(w) - m + 1):
                    if w[i : i + m] == v[k : k + m]:
                        hit.update(range(i, i + m))
                        found.add(str(item))
        out.append((len(w), len(hit), len(found), decontaminate.items_digest(found), bool(hit)))
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=12), min_size=1, max_size=6), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=4), min_size=1, max_size=6))
def test_index_finds_what_a_plain_search_finds(runs, patterns):
    text = np.array([x for r in runs for x in [*r, 0]], dtype=np.int64)
    index = FMIndex(text)
    rows = np.zeros((len(patterns), 4), dtype=np.int64)
    for i, p in enumerate(patterns):
        rows[i, 4 - len(p) :] = p
    low, high = index.ranges(rows)
    for p, a, b in zip(patterns, low, high):
        want = [i for i in range(len(text) - len(p) + 1) if text[i : i + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_word_rule_is_the_given_pattern():
    text = "Aé_b-C3/ñ日\x7f[x]`{|}~:;0 9\n\x00z"
    assert decontaminate.words_of(text) == words(text)


def test_op4_agrees_with_a_plain_search(spark):
    docs = documents()
    items = duckdb.sql(f"SELECT item_id, text FROM read_parquet('{SF}/benchmark.parquet')").fetchall()
    got = {r.doc_id: tuple(r)[1:] for r in catalog.op4_decontamination(spark, SF).collect()}
    by_window = {}
    for i, t in items:  # the plain search is quadratic: only items that share a word with the text
        for k in words(t):
            by_window.setdefault(k, set()).add((i, t))
    some = {i: t for i, t in docs.items() if i % 4 == 0 or got[i][4]}
    for i, want in zip(some, by_hand(some.values(), items)):
        assert got[i] == want
    assert any(x[4] for x in got.values())


ITEMS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"),
    (2, "short item"),
    (3, None),
    (4, "..."),
    (5, "word5 word6 word7 word8 word9 word10 word11 word12 word13 word14"),
    (5, "word5 word6 word7 word8 word9 word10 word11 word12 word13 word14"),
    (6, "the quick brown fox jumps over the lazy dog and runs"),
]
TEXTS = [
    "ALPHA beta, gamma delta epsilon zeta eta theta iota kappa lambda and a Short ITEM.",
    "x alpha beta gamma delta epsilon zeta eta theta iota kappa",
    "beta gamma delta epsilon zeta eta theta iota kappa lambda mu",
    "alpha beta gamma delta epsilon zeta eta theta iota",
    "short", "item", "short item short item", None, "",
]


@pytest.fixture()
def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("shard,block", [(4_000_000, 8 << 20), (5, 8 << 20), (4_000_000, 60)])
def test_shards_and_blocks_change_nothing(spark, bench, monkeypatch, shard, block):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs = spark.createDataFrame(list(enumerate([*TEXTS, TEXTS[0]])) + [(0, TEXTS[0])], "doc_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.contamination(docs, bench).collect())
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == sorted((i, *x) for (i, _), x in zip(rows, by_hand([t for _, t in rows], ITEMS)))


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_rows_of_null_and_shared_ids_keep_their_own_hits(spark, bench, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    texts = [*TEXTS, *[" ".join(["clean"] * len(decontaminate.words_of(t))) for t in TEXTS if t], None]  # the same numbers of words
    rows = [(i, t) for i in (None, 3) for t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in decontaminate.contamination(docs, bench).collect()), key=str)
    assert got == sorted(((i, *x) for (i, _), x in zip(rows, by_hand([t for _, t in rows], ITEMS))), key=str)
    clean = decontaminate.decontaminate(docs, bench)
    assert clean.count() == len(rows) and clean.where("text is null").count() == 2 * texts.count(None)
    assert decontaminate.contamination(clean, bench).where("contaminated").count() == 0


def test_spans_are_cut_out(spark, bench):
    docs = messy(spark)
    got = decontaminate.decontaminate(docs, bench).collect()
    assert len(got) == docs.count()
    one = [r for r in got if r.doc_id == 1]
    assert [r.text for r in one] == [" far away"] * 2 and one[0].n_chars == 9 and one[0].score == "y"
    long = next(r for r in got if r.doc_id == 6)
    assert "word14" in long.text and "word5 word6" not in long.text  # elsewhere these words stay
    assert next(r for r in got if r.doc_id == 3).text is None
    again = decontaminate.contamination(spark.createDataFrame(got, docs.schema), bench)
    assert again.where("contaminated").count() == 0


def test_empty_tables(spark, bench):
    docs = messy(spark)
    assert decontaminate.contamination(none_of(docs), bench).count() == 0
    clean = decontaminate.contamination(docs, none_of(bench)).collect()
    assert len(clean) == docs.count() and not any(r.contaminated for r in clean)
