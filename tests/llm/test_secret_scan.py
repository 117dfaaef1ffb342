import hashlib
import re

import pytest
from helpers import SF, documents, messy, none_of

from envflow.llm import catalog, secret_scan

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
KEY = "AKIA" + "A1B2C3D4E5F6G7H8"
HEX = "0123456789abcdef01234567"
BLOB = "wJalrXUtnFEMI/K7MDENGbPxRfiCYEXAMPLEKEY9"


def base_by_hand(t):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[1]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(found)


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


def agrees(row, text):
    base = base_by_hand(text)
    want = [sum(x[1] == k for x in base) for k in range(3)]
    told = [x for x in row.spans.split(",") if x.split(":")[0] in ("assign", "access", "hex")]
    assert [row.n_assign, row.n_access, row.n_hex] == want, text[:200]
    assert row.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
    assert ",".join(told) == joined(base)


def test_op5_agrees_with_a_plain_search(spark):
    docs = documents()
    rows = catalog.op5_secret_scans(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        agrees(r, docs[r.doc_id])


TEXTS = [
    'token:token : abcdefgh password=short1 PassWord = "abc" secret: x',
    "token=secret=abcdef api_key='Zz09+/_.=-' apikey:123456 API_KEY = 1234567",
    f"👍🏽é {KEY} {HEX} {KEY}{HEX} akia {HEX}x{HEX}",
    f"{HEX}{HEX} token={HEX} token={HEX}",
    "password=" * 50 + "abcdef",
    "a" * 5000 + " token=" + "b" * 5000,
    "token = é secret=ééabcdefgh",
    f"user=bob and {BLOB}",
    f"{BLOB} alone, no one near",
    f"user=bob alone {'x ' * 500} user=eve password=hunter22 at postgres://db.example/x",
    "host=db.example.com alone",
    f"10.0.0.1:5432 {KEY}",
]


def test_overlaps_and_odd_texts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in secret_scan.scan_secrets(docs).collect():
        agrees(r, TEXTS[r.doc_id])


def kinds(row):
    return [x.split(":")[0] for x in row.spans.split(",") if x]


def test_weak_parts_need_complementary_ones(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: kinds(r) for r in secret_scan.scan_secrets(docs).collect()}
    assert got[7] == ["id", "blob"]
    assert got[8] == [] and got[10] == []
    assert got[9] == ["id", "assign", "endpoint"]  # the far user is not told
    assert got[11] == ["endpoint", "access"]


@pytest.mark.parametrize("gap,linked", [(395, True), (405, False)])
def test_the_scope_is_the_distance(spark, gap, linked):
    docs = spark.createDataFrame([(1, f"user=bob {' ' * gap}{BLOB}")], "doc_id long, text string")
    assert bool(kinds(secret_scan.scan_secrets(docs).first())) == linked


def test_redaction(spark):
    docs = spark.createDataFrame([(i, t, len(t), "kept") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_chars int, _hash string")
    got = {r.doc_id: r for r in secret_scan.redact_secrets(docs).collect()}
    spans = {r.doc_id: r.spans for r in secret_scan.scan_secrets(docs).collect()}
    for i, t in enumerate(TEXTS):
        want, at = "", 0
        for a, b in sorted((int(a), int(b)) for _, a, b in (x.split(":") for x in spans[i].split(",") if x)):
            want += t[at:a] + secret_scan.MASK if a >= at else ""
            at = max(at, b)
        want += t[at:]
        assert got[i].text == want and got[i].n_chars == len(want) and got[i]["_hash"] == "kept"


def test_messy_rows(spark):
    docs = messy(spark)
    rows = secret_scan.scan_secrets(docs).collect()
    assert len(rows) == docs.count() and all(r.spans == "" for r in rows)
    twice = spark.createDataFrame([(1, f"x {HEX}")] * 2 + [(None, f"y {KEY}"), (None, f"y {KEY}"), (None, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_access, r.n_hex) for r in secret_scan.scan_secrets(twice).collect())
    assert got == [("1", 0, 1), ("1", 0, 1), ("None", 0, 0), ("None", 1, 0), ("None", 1, 0)]
    assert secret_scan.scan_secrets(none_of(docs)).count() == 0
    same = secret_scan.redact_secrets(docs)
    assert same.columns == docs.columns and sorted(map(str, same.collect())) == sorted(map(str, docs.collect()))


def test_no_python_runs(spark):
    docs = messy(spark)
    for df in (secret_scan.scan_secrets(docs), secret_scan.redact_secrets(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|MapInArrow|CartesianProduct|BroadcastNestedLoop", plan)


def test_repeated_rows_go_before_the_exchange(spark):
    copies = spark.range(0, 4000, 1, 8).selectExpr("1L AS doc_id", f"'x {HEX} {KEY}' AS text")
    plan = secret_scan.secret_spans(copies)._jdf.queryExecution().executedPlan().toString()
    told = [line.strip(" +-:") for line in plan.splitlines() if "Exchange" in line or "Aggregate" in line]
    assert told[-1].startswith("SortAggregate") and "partial_first" in told[-1] and "Exchange" in told[-3] + told[-2]
    got = secret_scan.scan_secrets(copies).selectExpr("count(*)", "count(DISTINCT spans)", "min(n_hex)", "max(n_access)").first()
    assert tuple(got) == (4000, 1, 1, 1)
