import math
from collections import Counter, defaultdict

import pytest
from helpers import SF, crc, documents, messy, none_of

from envflow.llm import catalog, katz


def model(texts: dict):
    """The model by plain counting over (id, text) lists of the documents to learn from."""
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in texts.items()}
    learned = [t for i, t in tokens.items() if crc(i[0], 10) != 0 and i[0] is not None]
    c1 = Counter(w for t in learned for w in t)
    c2 = Counter(p for t in learned for p in zip([0, *t[:-1]], t))
    n, v = sum(c1.values()), len(c1)
    d1, d2 = (katz.discounts(Counter(c.values())) for c in (c1, c2))

    def less(c, d):
        return c - katz.TAIL if c > katz.GT_MOST else d[c]

    p1 = {w: less(c, d1) / n for w, c in c1.items()}
    unknown = 1 - sum(p1.values()) if n else 1.0
    total, own, low = Counter(), defaultdict(float), defaultdict(float)
    for (h, w), c in c2.items():
        total[h] += c
        own[h] += less(c, d2)
        low[h] += p1[w]
    bow = {h: (1 - own[h] / total[h]) / (1 - low[h]) for h in total}

    def p(h, w):
        if (h, w) in c2:
            return less(c2[h, w], d2) / total[h]
        return bow.get(h, 1.0) * p1.get(w, unknown)

    out = {}
    for i, t in tokens.items():
        base = sum(math.log10((c1.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        out[i] = (len(t), sum(w in c1 for w in t), n, base, sum(math.log10(p(h, w)) for h, w in zip([0, *t[:-1]], t)))
    return out, p, c1, bow, unknown


def held_against(rows, texts):
    want = model(texts)[0]
    left = sorted((str(i[0]), *x) for i, x in want.items())
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows)
    assert len(got) == len(left)
    for a, b in zip(got, left):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)


def test_op6_agrees_with_plain_counting(spark):
    docs = documents()
    rows = catalog.op6_katz_scoring(spark, SF).collect()
    held_against(rows, {(i, 0): t for i, t in docs.items()})
    assert all(r.held_out == (crc(r.doc_id, 10) == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_histories_are_normalised():
    docs = {(i, 0): t for i, t in documents().items()}
    _, p, c1, bow, unknown = model(docs)
    for h in [0, *list(c1)[:200:20]]:
        if h is not None:
            assert sum(p(h, w) for w in c1) + bow[h] * unknown == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("chunk,docs_in,buckets", [(4_000_000, 65_535, 8), (50, 3, 5)])
def test_chunks_and_buckets_change_nothing(spark, monkeypatch, chunk, docs_in, buckets):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(katz, "CHUNK_DOCS", docs_in)
    monkeypatch.setattr(katz, "LEAST_BUCKETS", buckets)
    monkeypatch.setattr(katz, "SAMPLE_EVERY", 1 if chunk == 50 else 32)  # with frequent words spread
    texts = {i: t for i, t in list(documents().items())[:60]}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    held_against(katz.score(docs).collect(), {(i, 0): t for i, t in texts.items()})


def test_messy_rows(spark):
    docs = messy(spark)
    rows = [r for r in docs.collect()]
    held_against(katz.score(docs).collect(), {(r.doc_id, k): r.text for k, r in enumerate(rows)})
    assert katz.score(none_of(docs)).count() == 0
    nothing = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    got = katz.score(nothing).collect()
    assert [(r.train_tokens, r.n_known, r.held_out) for r in got] == [(0, 0, False)] * 2
    assert all(abs(r.score) < 1e-9 and abs(r.base_score) < 1e-9 for r in got)


def test_the_table_is_read_without_a_shuffle(spark, tmp_path):
    rows = spark.createDataFrame([(1, True, "a b c")], "_id long, _train boolean, _text string")
    import numpy as np

    katz.write_pairs(rows, "pairs_plan_test", str(tmp_path / "t"), 4, np.array([], dtype=np.uint64))
    t = spark.table("pairs_plan_test").where("bucket >= 0")
    plan = t.groupBy("bucket").applyInArrow(lambda x: x.select(["bucket"]), "bucket int")._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE pairs_plan_test")
    assert "Exchange" not in plan


def test_hot_pairs_are_spread_and_counted_once(spark, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 200)
    monkeypatch.setattr(katz, "CHUNK_DOCS", 7)
    same = "one and the same line of text that a third of all documents have"
    texts = {i: t for i, t in list(documents().items())[:40]} | {10_000 + i: same for i in range(900)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    held_against(katz.score(docs).collect(), {(i, 0): t for i, t in texts.items()})
    # each of the copies' pairs lies in many buckets
    import numpy as np

    rows = docs.selectExpr("doc_id _id", "true _train", "text _text")
    words, pairs = katz.frequent_pairs(rows, 8)
    second, first = katz.pairs_of([np.array([katz.WordHashes()[w] for w in katz.words_of(same)], dtype=np.uint64)])
    hot = np.sort(katz.pair_key(pairs[:, 1], pairs[:, 0]))
    assert katz.within(katz.pair_key(second, first), hot).all() and katz.within(second, words).all()
    got = np.array([katz.bucket_of(second, first, words, 8, hot, chunk) for chunk in range(60)])
    assert all(len(set(b)) == 8 for b in got.T.tolist())


def test_slices_of_a_bucket_change_nothing(spark, monkeypatch):
    """A task sorts a bucket slice by slice, and writes one sum a history and document."""
    texts = {i: t for i, t in list(documents().items())[:60]}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(katz, "SLICE_BYTES", 5_000)
    held_against(katz.score(docs).collect(), {(i, 0): t for i, t in texts.items()})


def test_a_slice_is_a_share_of_its_bucket(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    hashes = [rng.integers(0, 2**64, 40, dtype=np.uint64) for _ in range(50)]
    names = [x.split()[0] for x in katz.CHUNK_COLUMNS.split(", ")]
    rows = [(b, 0, *x) for b, *x in katz.chunk_rows(hashes, 50, katz.NONE, 1)]
    t = pa.table([pa.array(x) for x in zip(*rows)], names=names)
    whole = katz.Bucket(t)
    monkeypatch.setattr(katz, "SLICE_BYTES", t.nbytes // 7)
    parts = list(katz.slices(t))
    assert len(parts) >= 7 and max(len(p.first) for p in parts) < len(whole.first) / 4
    assert np.concatenate([p.words for p in parts]).tolist() == whole.words.tolist()
    assert np.concatenate([p.first for p in parts]).tolist() == whole.first.tolist()
    assert np.concatenate([p.count for p in parts]).tolist() == whole.count.tolist()
    assert sum(len(p.docs[0]) for p in parts) == 50 * 41
