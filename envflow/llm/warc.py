"""WARC (10): Zstandard-compressed archives, written from pages and read back.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
compression dictionary; then every record is one Zstandard frame of its own. The
reader loads the dictionary, decodes frame by frame, and validates the version
line, the mandatory headers, lengths and digests of every record.

Archives are rows ``path, content``, the form in which ``spark.read.format("binaryFile")``
loads files, so any store that Spark reads will do: ``read_warc(spark, path)``
reads .warc.zst files, and ``read_records`` any such DataFrame.

Defined cases: null html counts as an empty payload; null and repeated ids are written
as records of their own (of equal payloads, all rows with the largest id are responses);
an empty table gives no archives; a damaged record gives a row with ``error`` set, and
reading goes on at the next frame where its start is known.
"""

from __future__ import annotations

import base64
import binascii
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envflow.llm.common import on_workers, stored

DICTIONARY_FRAME = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
#: Payloads shorter than this are never replaced by a revisit.
REVISIT_BYTES = 1000
#: Uncompressed bytes per archive; dictionary size and the bytes it is trained on (the first records).
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
TRAINING_BYTES = 2 << 20
LEVEL = 3
FEED_BYTES = 16 << 10
DATE = "2024-01-01T00:00:00Z"

RECORD_SCHEMA = (
    "path string, position long, record_id string, record_type string, target_uri string, refers_to_id string, "
    "payload_bytes long, payload_digest string, payload binary, error string"
)


def sha1_field(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def make_record(page_id, url: str, payload: bytes, refers_to, date: str = DATE) -> bytes:
    """A response record, or a revisit of the page ``refers_to`` (the HTTP head alone)."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    uri = "".join(c for c in url if c > " ")
    lines = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {page_urn(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: {sha1_field(payload)}",
        f"WARC-Block-Digest: {sha1_field(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines[2:2] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {page_urn(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def make_archive(records: list[bytes], level: int = LEVEL) -> bytes:
    import zstandard

    sample, size = [], 0
    for r in records:
        if size >= TRAINING_BYTES:
            break
        sample.append(r)
        size += len(r)
    try:
        trained = zstandard.train_dictionary(min(DICTIONARY_BYTES, size // 8), sample) if len(sample) > 8 else None
    except zstandard.ZstdError:  # too few or too short samples
        trained = None
    raw = trained.as_bytes() if trained else b""
    pack = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True, write_content_size=True)
    frames = [DICTIONARY_FRAME.to_bytes(4, "little"), len(raw).to_bytes(4, "little"), raw]
    return b"".join([*frames, *map(pack.compress, records)])


def frames(content: bytes):
    """``(position, record bytes or None, error)`` of each frame after the dictionary."""
    import zstandard

    view, at, trained = memoryview(content), 0, None
    if content[:4] == DICTIONARY_FRAME.to_bytes(4, "little"):
        size = int.from_bytes(content[4:8], "little")
        raw = content[8 : 8 + size]
        if len(raw) < size:
            yield 0, None, "the dictionary frame is cut off"
            return
        if raw[:4] == ZSTD_MAGIC:  # the dictionary itself may be compressed
            raw = zstandard.ZstdDecompressor().decompress(raw)
        trained = zstandard.ZstdCompressionDict(raw) if raw else None
        at = 8 + size
    unpack = zstandard.ZstdDecompressor(dict_data=trained)
    while at < len(content):
        if 0x184D2A50 <= int.from_bytes(content[at : at + 4], "little") <= 0x184D2A5F:
            at += 8 + int.from_bytes(content[at + 4 : at + 8], "little")
            continue
        one, out, pos = unpack.decompressobj(), [], at
        try:
            while not one.eof and pos < len(content):
                out.append(one.decompress(view[pos : pos + FEED_BYTES]))
                pos = min(pos + FEED_BYTES, len(content))
        except zstandard.ZstdError as e:
            yield at, None, f"not a valid frame: {e}"
            following = content.find(ZSTD_MAGIC, at + 1)
            if following < 0:
                return
            at = following
            continue
        if not one.eof:
            yield at, None, "the frame is cut off"
            return
        yield at, b"".join(out), None
        at = pos - len(one.unused_data)


def parse_record(record: bytes) -> dict:
    """Fields of a record; raises ValueError for whatever is not valid."""
    head, sep, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC version line or no end of headers")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"not a header: {line[:80]}")
        fields[name.lower()] = value.strip()
    if absent := [x for x in MANDATORY if x not in fields]:
        raise ValueError(f"no {', '.join(absent)}")
    if not fields["content-length"].isdigit():
        raise ValueError("Content-Length is not a number")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {size}, the block has {len(rest) - 4} bytes")
    block = rest[:size]
    if fields.get("warc-block-digest", sha1_field(block)) != sha1_field(block):
        raise ValueError("the block's digest differs")
    out = {"type": fields["warc-type"], "id": fields["warc-record-id"], "uri": fields.get("warc-target-uri"), "refers": fields.get("warc-refers-to")}
    out |= {"payload": None, "bytes": None, "digest": None}
    if out["type"] not in ("response", "revisit"):
        return out
    http, end, payload = block.partition(b"\r\n\r\n")
    length = next((v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.lower() == b"content-length"), b"")
    if not end or not length.isdigit():
        raise ValueError("no HTTP head with a Content-Length")
    stated = fields.get("warc-payload-digest", "")
    if out["type"] == "response":
        if len(payload) != int(length):
            raise ValueError(f"HTTP Content-Length is {int(length)}, the payload has {len(payload)} bytes")
        if stated and stated != sha1_field(payload):
            raise ValueError("the payload's digest differs")
        out["payload"], stated = payload, sha1_field(payload)
    elif not out["refers"] or payload:
        raise ValueError("a revisit needs WARC-Refers-To and no payload")
    if not stated.startswith("sha1:"):
        raise ValueError("no SHA-1 payload digest")
    out["bytes"], out["digest"] = int(length), base64.b32decode(stated[5:]).hex()
    return out


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows ``path, content``: archives of about ARCHIVE_BYTES with a record per page."""
    src = pages.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("_url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("_body"),
    ).withColumn("_sha", F.sha1("_body"))
    # who answers for a payload: ids and digests only
    skinny = src.where(F.octet_length("_body") >= REVISIT_BYTES).select("_id", "_sha").distinct()
    firsts = skinny.groupBy("_sha").agg(F.max("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    copies = skinny.join(firsts, "_sha").where(~F.col("_id").eqNullSafe(F.col("_first")) & F.col("_first").isNotNull())
    copies = copies.select(F.col("_id").alias("_cid"), F.col("_sha").alias("_csha"), F.col("_first").cast("string"))
    same = F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_sha") == F.col("_csha"))
    rows = src.join(copies, same, "left").select(F.col("_id").cast("string"), "_url", "_body", "_first")

    def write(batches):
        records, size = [], 0

        def archive() -> pa.RecordBatch:
            content = make_archive(records)
            name = f"pages-{hashlib.sha1(content).hexdigest()[:16]}.warc.zst"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], names=["path", "content"])

        for b in batches:
            for page, url, body, first in zip(*(b.column(i).to_pylist() for i in range(4))):
                records.append(make_record(page, url, body, first))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    records, size = [], 0
        if records:
            yield archive()

    return on_workers(rows).mapInArrow(write, "path string, content binary")


def read_records(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of ``archives`` (``path, content``); see RECORD_SCHEMA."""

    def read(batches):
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out, held = [], 0
                for at, record, error in frames(content or b""):
                    r = {}
                    if error is None:
                        try:
                            r = parse_record(record)
                        except (ValueError, binascii.Error) as e:
                            error = str(e)
                    body = r.get("payload") if with_payload else None
                    out.append((path, at, r.get("id"), r.get("type"), r.get("uri"), r.get("refers"), r.get("bytes"), r.get("digest"), body, error))
                    held += len(body or b"") + 200
                    if held > ARCHIVE_BYTES:
                        yield _batch(out)
                        out, held = [], 0
                if out:
                    yield _batch(out)

    return on_workers(archives).select("path", "content").mapInArrow(read, RECORD_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of the .warc.zst files under ``path`` (a file, folder or glob of any store)."""
    return read_records(spark.read.format("binaryFile").load(path), with_payload)


def page_of(record_id: str, kind: str):
    """The page id in a record id of ours; null where there is none."""
    digits = F.regexp_extract(record_id, "^<urn:page:(.*)>$", 1)
    return F.when(digits != "", digits).cast(kind)


def round_trip(pages: DataFrame, id_col: str = "page_id", **cols) -> DataFrame:
    """Write archives to a scratch table, read them back: a row per page."""
    kind = pages.schema[id_col].dataType.simpleString()
    back = read_records(stored(write_archives(pages, id_col, **cols), "warc", "none"), with_payload=False)
    failed = F.raise_error(F.concat(F.lit("archive record: "), F.col("path"), F.lit(" "), F.col("error")))
    return back.select(
        page_of("record_id", kind).alias(id_col),
        "payload_bytes",
        "payload_digest",
        F.when(F.col("error").isNotNull(), failed.cast("string")).otherwise(F.col("record_type")).alias("record_type"),
        page_of("refers_to_id", kind).alias("refers_to"),
    )
