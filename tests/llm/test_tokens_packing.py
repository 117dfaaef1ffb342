import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import LONG, documents, messy, none_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from envflow.llm import bpe, catalog, packing, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [
    "", " ", "  a b", "a  b c", "a \n b", "a\n b c", "x <|endoftext|> y z", "x<|endoftext|>", " a", "a ", "a  b c",
    "it's a 'll 12 !! !'s b\x1c c \x85 d e", "don't  stop\r\n now \t x", "é è 日本 語 👍🏽 x", "a\nB c.\nD e", "x " * 50, "a　b c  d",
]


def ids_of(texts):
    return [e.ids for e in LIBRARY.encode_batch(list(texts), add_special_tokens=False)]


def encoded(texts, keep):
    return [v for values in bpe.encode_all(list(texts), PATH, keep) for v in values]


def test_encoder_agrees_with_the_library_on_odd_texts():
    texts = [*ODD, LONG, *list(documents().values())[:80]]
    assert encoded(texts, bpe.as_count) == [len(x) for x in ids_of(texts)]
    assert encoded(texts, bpe.as_bytes) == [np.asarray(x, "<u4").tobytes() for x in ids_of(texts)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\t ab'sZé.,!?19<|endoftext|>日\x1c")), max_size=40), max_size=4))
def test_encoder_agrees_with_the_library_on_any_text(texts):
    assert encoded(texts, bpe.as_count) == [len(x) for x in ids_of(texts)]


def test_long_texts_are_cut_at_safe_places(monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_CHARS", 50)
    texts = [LONG[:5000], "a  b " * 100, "x" * 300]
    assert ["".join(bpe.slices(t)) for t in texts] == texts
    assert encoded(texts, bpe.as_count) == [len(x) for x in ids_of(texts)]


def test_a_full_memo_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 20)
    texts = list(documents().values())[:30]
    enc = bpe.SegmentEncoder(PATH, bpe.as_count, sum)
    assert enc.values(texts) == [len(x) for x in ids_of(texts)]


def test_op1_counts_every_document(spark):
    docs = documents()
    got = {r.doc_id: r for r in catalog.op1_token_counts(spark, "/root/testdata/sf0.001").collect()}
    for i, n in zip(docs, map(len, ids_of(docs.values()))):
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(docs[i].encode()), n, n > 512)
    assert len(got) == len(docs)


def test_counts_of_messy_rows(spark):
    docs = messy(spark)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs).collect())
    texts = [(str(r.doc_id), r.text or "") for r in docs.collect()]
    assert got == sorted((i, len(t.encode()), len(x)) for (i, t), x in zip(texts, ids_of(t for _, t in texts)))
    assert token_counts.token_counts(none_of(docs)).count() == 0


def check_packed(rows, ids: dict, capacity: int):
    seen = {}
    for r in rows:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length <= capacity
        assert zlib.crc32(np.asarray(own, "<u4").tobytes()) == r.ids_crc32
        seen.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for i, x in ids.items():
        pieces = sorted(seen[i])
        assert [p for p, _, _ in pieces] == list(range(len(pieces)))
        assert [s for _, s, _ in pieces] == [sum(n for _, _, n in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, _, n in pieces) == len(x)
        assert len(pieces) == 1 or all(n == capacity for _, _, n in pieces[1:])
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= capacity
    return bins


def test_op2_packs_every_document(spark):
    docs = documents()
    rows = catalog.op2_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    ids = {i: [*x, 0] for i, x in zip(docs, ids_of(docs.values()))}
    bins = check_packed(rows, ids, packing.CAPACITY)
    assert len(bins) <= -(-sum(map(len, ids.values())) // packing.CAPACITY) * 1.02 + 1


def test_messy_rows_are_packed(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 2)  # several salts
    docs = messy(spark)
    rows = packing.pack(docs, capacity=64, with_ids=True).collect()
    total = sum(len(x) + 1 for x in ids_of(r.text or "" for r in docs.collect()))
    assert sum(r.length for r in rows) == total == sum(len(r.ids) // 4 for r in rows)
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    for (s, o, n), (s2, o2, _) in zip(places, places[1:]):
        assert o2 == (o + n if s == s2 else 0)
    assert len([r for r in rows if r.doc_id == 1]) == 2
    assert packing.pack(none_of(docs)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=12))
def test_plan_places_every_piece_once(histogram):
    capacity = 60
    plan = packing.pack_plan(dict(histogram), capacity)
    bins: dict = {}
    ranks: dict = {}
    for n, rank, count, first, per, offset in plan.tolist():
        for i in range(count):
            bins.setdefault(first + i // per, []).append((offset + i % per * n, n))
            ranks.setdefault(n, []).append(rank + i)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in b) <= 2
    # no worse than first-fit decreasing
    gaps: list = []
    for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        k = next((k for k, g in enumerate(gaps) if g >= n), None)
        if k is None:
            gaps.append(capacity - n)
        else:
            gaps[k] -= n
    assert len(bins) <= len(gaps) * 1.1 + 1


@pytest.mark.parametrize("n,want", [(1, [1]), (64, [64]), (65, [1, 64]), (200, [8, 64, 64, 64])])
def test_the_first_piece_takes_the_remainder(n, want):
    assert packing.cut_lengths(n, 64) == want
