import hashlib

import pytest
from helpers import SF, none_of, rows_by

from envflow.llm import catalog, warc

BIG = "<html>" + "same payload " * 200 + "</html>"
PAGES = [
    (1, "http://a.example/x", BIG), (2, "http://b.example/y\r\nEvil: 1", BIG), (3, None, BIG), (3, None, BIG), (None, "u", BIG),
    (4, "http://c.example", "small"), (5, "http://d.example", "small"), (6, "", None), (7, "é ü", "日本" * 600), (None, None, None),
]
SCHEMA = "page_id long, url string, html string"


def by_hand(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            first[b] = max(i, first.get(b, i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        of = first.get(b, i)
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), *(("response", None) if of == i else ("revisit", of))))
    return sorted(out, key=str)


def test_op10_round_trip(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in catalog.op10_warc(spark, SF).collect()), key=str) == by_hand(rows)


def test_messy_rows_and_small_archives(spark, monkeypatch):
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumnRenamed("url", "url")
    want = by_hand(PAGES)
    assert sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str) == want
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1)
    assert sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str) == want
    assert warc.round_trip(none_of(pages)).count() == 0


def test_files_are_read_as_any_file(spark, tmp_path):
    for name, content in warc.write_archives(spark.createDataFrame(PAGES, SCHEMA)).collect():
        (tmp_path / name).write_bytes(content)
    got = warc.read_warc(spark, str(tmp_path)).collect()
    assert len(got) == len(PAGES) and not any(r.error for r in got)
    seven = next(r for r in got if r.record_id == "<urn:page:7>")
    assert seven.payload.decode() == "日本" * 600 and seven.target_uri == "éü"
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)


def records(n=40):
    return [warc.make_record(i, f"http://x/{i}", (f"payload {i} " * 50).encode(), None) for i in range(n)]


def test_the_dictionary_is_in_the_leading_frame():
    import zstandard

    content = warc.make_archive(records())
    assert content[:4] == (0x184D2A5D).to_bytes(4, "little")
    size = int.from_bytes(content[4:8], "little")
    assert size > 0
    assert [r for _, r, e in warc.frames(content)] == records()
    # a compressed dictionary, and none
    packed = zstandard.ZstdCompressor().compress(content[8 : 8 + size])
    again = content[:4] + len(packed).to_bytes(4, "little") + packed + content[8 + size :]
    assert [r for _, r, _ in warc.frames(again)] == records()
    plain = b"".join(zstandard.ZstdCompressor().compress(r) for r in records(3))
    assert [r for _, r, _ in warc.frames(plain)] == records(3)


def test_damage_is_told_and_reading_goes_on(spark):
    content = warc.make_archive(records())
    places = [p for p, _, _ in warc.frames(content)]
    bad = bytearray(content)
    bad[places[5] + 12] ^= 0xFF
    bad[places[5] + 13] ^= 0xFF
    df = spark.createDataFrame([("a", bytes(bad)), ("b", content[:-7]), ("c", content[: places[0] - 9]), ("d", b""), ("e", None)], "path string, content binary")
    got = warc.read_records(df).collect()
    of = {p: [r for r in got if r.path == p] for p in "abcde"}
    assert any(r.error for r in of["a"]) and sum(r.error is None for r in of["a"]) >= 38
    assert "cut off" in of["b"][-1].error and sum(r.error is None for r in of["b"]) == 39
    assert "cut off" in of["c"][0].error and not of["d"] and not of["e"]


GOOD = warc.make_record(1, "http://x/", b"hello", None)


@pytest.mark.parametrize(
    "change",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/9"),
        lambda r: r.replace(b"WARC-Date: ", b"X-Date: "),
        lambda r: r.replace(b"hello", b"hellp"),
        lambda r: r.replace(b"hello", b"hello!"),
        lambda r: r[:-2],
        lambda r: r.replace(b"WARC-Type: ", b"WARC-Type "),
        lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: revisit"),
        lambda r: r.replace(b"WARC-Payload-Digest: sha1:", b"WARC-Payload-Digest: sha1:A"),
    ],
)
def test_records_are_validated(change):
    assert warc.parse_record(GOOD)["bytes"] == 5
    with pytest.raises(ValueError):
        warc.parse_record(change(GOOD))
