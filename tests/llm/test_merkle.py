import hashlib

import pytest
import twin_merkle as twin
from helpers import documents, messy, none_of
from pyspark.sql import functions as F

from envflow.llm import catalog, merkle


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


@pytest.fixture(scope="module")
def printed(spark):
    return {r.doc_id: r for r in catalog.op3_merkle_fingerprints(spark, "/root/testdata/sf0.001").collect()}


def test_op3_edits_with_the_next_document(printed):
    docs = documents()
    order = sorted(docs, reverse=True)
    assert len(printed) == len(docs)
    for i, j in zip(order, order[1:] + order[:1]):
        want = edited(docs[i], docs[j])
        assert printed[i].n_chars == len(docs[i])
        assert printed[i].edited_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_equal_texts_have_equal_fingerprints_and_others_differ(printed):
    docs = documents()
    by_text = {}
    for i, t in docs.items():
        by_text.setdefault(t, set()).add(printed[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert len({next(iter(x)) for x in by_text.values()}) == len(by_text)


def test_likeness_follows_the_edit(printed):
    long = [r for r in printed.values() if r.n_chars > 600]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in printed.values())
    assert all(0.25 < r.near_edited <= 1 for r in long)
    assert sum(r.near_edited > r.near_next for r in long) >= 0.95 * len(long)
    for r in long:  # the first differing branch stands where the edit begins
        assert r.first_edit is None or abs(r.first_edit - (r.n_chars - r.n_chars // 2)) <= 200


def test_leaves_are_the_whole_text(spark):
    texts = [*documents().values(), "", "a" * 1000, "\n\n..!?", "no end", " . "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", merkle.leaves(F.col("t")).alias("x")).collect():
        assert "".join(r.x) == r.t


@pytest.mark.parametrize("rows", [1, 3, 100])
def test_messy_rows_and_any_number_of_ranges(spark, monkeypatch, rows):
    monkeypatch.setattr(merkle, "RANGE_ROWS", rows)
    docs = messy(spark)
    got = sorted((r.doc_id is None, -(r.doc_id or 0), r.n_chars, r.edited_sha256) for r in merkle.fingerprints(docs).collect())
    # equal ids stand in some fixed order: here they have equal texts, but for the null ones
    plain = [r for r in docs.collect()]
    known = sorted((r for r in plain if r.doc_id is not None), key=lambda r: -r.doc_id)
    want = []
    for a, b in zip(known, known[1:]):
        want.append((False, -a.doc_id, len(a.text or ""), hashlib.sha256(edited(a.text or "", b.text or "").encode()).hexdigest()))
    assert set(want) <= set(got) and len(got) == len(plain)
    assert merkle.fingerprints(none_of(docs)).count() == 0


def test_one_document_is_its_own_next(spark):
    docs = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    r = merkle.fingerprints(docs).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    assert r.near_next == 1.0


def test_op3_agrees_with_a_plain_tree(printed):
    docs = documents()
    order = sorted(docs, reverse=True)
    for i, j in zip(order, order[1:] + order[:1]):
        r, new = printed[i], edited(docs[i], docs[j])
        assert r.fingerprint == twin.fingerprint(docs[i]) and r.edited_fingerprint == twin.fingerprint(new)
        assert r.near_edited == pytest.approx(twin.likeness(docs[i], new)) and r.near_next == pytest.approx(twin.likeness(docs[i], docs[j]))


def test_the_print_is_small(printed):
    assert sum(len(r.fingerprint) for r in printed.values()) < 0.12 * sum(r.n_chars for r in printed.values())


def test_differing_branches_lead_to_the_changed_paragraphs(spark):
    lines = [f"Line {i} has words of its own, {i * i} of them.\n" for i in range(400)]
    other = lines[:250] + ["Something else.\n"] + lines[251:]
    pairs = [("".join(lines), "".join(other)), ("".join(other), "".join(lines)), ("a\nb", "a\nb"), ("", "x"), ("x", ""), ("a\nb\n", "a\nc\n")]
    df = spark.createDataFrame(pairs, "a string, b string")
    of = lambda c: merkle.fingerprint(merkle.sections(merkle.paragraphs(merkle.leaf_hashes(F.col(c)))))
    for r in df.select("a", "b", merkle.changed(of("a"), of("b")).alias("c")).collect():
        assert r.c == twin.changed(r.a, r.b)
        if len(r.a) > 1000:  # one line, or a few where a hash closes a paragraph within it
            assert 1 <= len(r.c) <= 3


@pytest.mark.parametrize("kind", ["outlier", "null", "string", "equal"])
@pytest.mark.parametrize("rows", [1, 10])
def test_ids_of_all_kinds(spark, monkeypatch, kind, rows):
    monkeypatch.setattr(merkle, "RANGE_ROWS", rows)
    n = 120
    of = {"outlier": lambda i: 2**61 if i == 7 else i, "null": lambda i: None if i % 3 == 0 else i, "string": lambda i: f"id {i}", "equal": lambda i: i // 40}[kind]
    data = [(of(i), f"text {i * 7919 % n} here") for i in range(n)]
    docs = spark.createDataFrame(data, f"doc_id {'string' if kind == 'string' else 'long'}, text string").repartition(4)
    hashed = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, hashed[r[1]]), reverse=True)
    got = {r._text: r._next for r in merkle.with_next(docs).collect()}
    assert got == {a[1]: b[1] for a, b in zip(order, order[1:] + order[:1])}


def test_ranges_follow_the_rows(spark):
    docs = spark.range(20_000).selectExpr("CASE WHEN id = 5 THEN 1L << 61 WHEN id % 3 = 0 THEN NULL ELSE id END AS doc_id", "concat('t', id) AS text")
    src = docs.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("_key"))
    ranges = merkle._with_range(src, merkle._range_keys(src, 20_000))
    sizes = [r[1] for r in ranges.groupBy("_range").count().collect()]
    assert len(sizes) > 120 and max(sizes) < 1500


def test_no_python_runs(spark):
    plan = merkle.fingerprints(messy(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow", "CartesianProduct", "NestedLoop"))
