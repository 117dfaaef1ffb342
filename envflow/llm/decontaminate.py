"""Benchmark decontamination (4): an FM-index per shard of documents, searched backward.

The test phrases are the distinct windows of ``size`` words of the benchmark items.
They are read in blocks of bounded size; each block is broadcast. Within a task,
documents are gathered into shards; a shard's text is every maximal run of words that
the phrases use, no shorter than the shortest phrase (no occurrence lies anywhere else).
An FM-index is built over it, all phrases are searched at once, occurrences are
located by sampled suffix positions, and their spans are merged per document.
No document is shuffled; several blocks' spans meet by document.

Defined cases: null text has no words; items without words have no phrases; repeated
rows are searched each; null ids are kept; equal item ids are one item; extra columns are
ignored; an empty table gives none, an empty benchmark no hits.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import on_workers, sized, stored, text_of
from envflow.llm.fm_index import FMIndex

WINDOW_WORDS = 10
#: Words of documents per shard, and bytes of benchmark text per broadcast block.
SHARD_WORDS = 1_000_000
BLOCK_BYTES = 8 << 20

#: Words are runs of 0-9, a-z and bytes from 0x80 on, after A-Z in lower case.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class Phrases:
    """The distinct windows of some items as rows of symbols, and which items have them."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        self.symbol: dict[bytes, int] = {}
        self.items: list[str] = []
        windows: dict[tuple, set[int]] = {}
        for item, text in items:
            w = [self.symbol.setdefault(x, len(self.symbol) + 1) for x in words_of(text)]
            if w:
                self.items.append(item)
            for i in range(max(1, len(w) - size + 1) if w else 0):
                windows.setdefault(tuple(w[i : i + size]), set()).add(len(self.items) - 1)
        self.lengths = np.array([len(w) for w in windows], dtype=np.int64)
        self.rows = np.zeros((len(windows), size), dtype=np.int64)
        for i, w in enumerate(windows):
            self.rows[i, size - len(w) :] = w
        self.owners = [np.array(sorted(x)) for x in windows.values()]
        self.least = int(self.lengths.min(initial=size))


def search(phrases: Phrases, docs: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[int]]]:
    """For each document the merged word spans of all occurrences, and the items that occur."""
    out: list = [([], set()) for _ in docs]
    sizes = np.array([len(w) for w in docs], dtype=np.int64)
    total = int(sizes.sum())
    if not total or not len(phrases.lengths):
        return out
    get = phrases.symbol.get
    symbols = np.concatenate([np.fromiter((get(x, 0) for x in w), dtype=np.int64, count=len(w)) for w in docs])
    doc = np.repeat(np.arange(len(docs)), sizes)
    begins = np.cumsum(sizes) - sizes
    # runs: known words of one document
    known = symbols > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([0], known.astype(np.int8), [0]))) != 0)
    first = np.zeros(total + 1, dtype=bool)
    first[begins[sizes > 0]] = True
    starts, stops = edge[0::2], edge[1::2]
    inner = np.flatnonzero(first[:-1] & known & np.concatenate(([False], known[:-1])))  # a document begins within
    starts, stops = np.sort(np.concatenate((starts, inner))), np.sort(np.concatenate((stops, inner)))
    long = stops - starts >= phrases.least
    starts, stops = starts[long], stops[long]
    if not len(starts):
        return out
    n = stops - starts
    offset = np.concatenate(([0], np.cumsum(n + 1)))
    text = np.zeros(offset[-1], dtype=np.int64)
    place = np.full(offset[-1], -1, dtype=np.int64)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    to, frm = np.repeat(offset[:-1], n) + within, np.repeat(starts, n) + within
    text[to], place[to] = symbols[frm], frm

    index = FMIndex(text)
    low, high = index.ranges(phrases.rows)
    hits = high - low
    which = np.repeat(np.arange(len(hits)), hits)
    rows = np.repeat(low, hits) + np.arange(hits.sum()) - np.repeat(np.cumsum(hits) - hits, hits)
    at = place[index.locate(rows)]
    cover = np.zeros(total + 1, dtype=np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + phrases.lengths[which], -1)
    covered = np.cumsum(cover[:-1]) > 0
    # merged spans, cut where documents meet
    same = np.concatenate(([False], covered[:-1])) & ~first[:-1]
    begin = np.flatnonzero(covered & ~same)
    after = np.concatenate((~covered[1:] | first[1:-1], [True]))
    end = np.flatnonzero(covered & after) + 1
    for b, e, d in zip(begin.tolist(), end.tolist(), doc[begin].tolist()):
        out[d][0].append((b - int(begins[d]), e - int(begins[d])))
    for d, w in {*zip(doc[at].tolist(), which.tolist())}:
        out[d][1].update(phrases.owners[w].tolist())
    return out


def _phrase_rows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(item_col).cast("string").alias("i"), text_of(text_col).alias("t")).distinct()


def _block_count(rows: DataFrame) -> int:
    return sized(rows.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0, BLOCK_BYTES)


def _blocks(rows: DataFrame, parts: int):
    """The benchmark's rows in lists of about BLOCK_BYTES of text."""
    for k in range(parts):
        own = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("t"), F.lit(parts)) == k)
        yield [(r.i, r.t) for r in own.orderBy("i", "t").toLocalIterator()]


def occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW_WORDS,
    keep: tuple[str, ...] = (),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    cut: bool = False,
) -> DataFrame:
    """Per row of ``docs``: ``_id, _words``, merged word ``_spans``, ``_items``, and columns ``keep``
    (as ``_k_<name>``). With ``cut``, the spans are cut out of the kept text column."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"), *[F.col(f"`{c}`").alias(f"_k_{c}") for c in keep])
    kept = src.columns[2:]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_text")
    schema = f"{fields}, _words long, _spans array<struct<start:long,end:long>>, _items array<string>"

    def searcher(shared, kept=tuple(kept)):
        def run(batches):
            phrases = shared.value
            for b in batches:
                texts = b.column("_text").to_pylist()
                lo = 0
                while lo < len(texts):
                    hi, words, total = lo, [], 0
                    while hi < len(texts) and total < SHARD_WORDS:
                        words.append(words_of(texts[hi]))
                        total += len(words[-1])
                        hi += 1
                    found = search(phrases, words)
                    part = b.slice(lo, hi - lo)
                    cols = {c: part.column(c) for c in ["_id", *kept]}
                    if cut_here:
                        _cut(cols, f"_k_{text_col}", "_k_n_chars", [x for x, _ in found])
                    arrays = [
                        *cols.values(),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array([[{"start": s, "end": e} for s, e in x] for x, _ in found], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array([[phrases.items[i] for i in sorted(y)] for _, y in found], pa.list_(pa.string())),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=["_id", *kept, "_words", "_spans", "_items"])
                    lo = hi

        return run

    phrases = _phrase_rows(benchmark, item_col, item_text_col)
    parts = _block_count(phrases)
    cut_here = cut and parts == 1  # with more blocks, after their spans have met
    if parts == 1:
        shared = spark.sparkContext.broadcast(Phrases(next(_blocks(phrases, parts)), size))
        return on_workers(src).mapInArrow(searcher(shared), schema)
    # one block is broadcast at a time; rows are known by their number, whatever their ids
    src = stored(src.withColumn("_row", F.monotonically_increasing_id()), "documents")
    results = []
    for k, rows in enumerate(_blocks(phrases, parts)):
        shared = spark.sparkContext.broadcast(Phrases(rows, size))
        own = src.select(F.col("_row").alias("_id"), "_text")
        own = on_workers(own).mapInArrow(searcher(shared, ()), "_id long, _words long, _spans array<struct<start:long,end:long>>, _items array<string>")
        results.append(stored(own if k == 0 else own.where(F.size("_spans") > 0), "occurrences"))
        shared.unpersist()
    every = results[0]
    for r in results[1:]:
        every = every.unionByName(r)
    met = every.groupBy(F.col("_id").alias("_row")).agg(
        F.max("_words").alias("_words"), F.flatten(F.collect_list("_spans")).alias("_spans"), F.array_distinct(F.flatten(F.collect_list("_items"))).alias("_items")
    )
    whole = (src if cut else src.drop("_text")).join(met, "_row").select("_id", *kept, "_words", "_spans", "_items")

    def settle(batches):
        for b in batches:
            cols = dict(zip(b.schema.names, b.columns))
            spans = [_merged([(x["start"], x["end"]) for x in s]) for s in b.column("_spans").to_pylist()]
            if cut:
                _cut(cols, f"_k_{text_col}", "_k_n_chars", spans)
            cols["_spans"] = pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], b.schema.field("_spans").type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return on_workers(whole).mapInArrow(settle, schema)


def _cut(cols: dict, text: str, n_chars: str, spans: list[list[tuple[int, int]]]) -> None:
    """Cut the spans out of the Arrow column ``text`` of ``cols``; ``n_chars`` follows where it is there."""
    if not any(spans):
        return
    clean = [without_words(t, s) if s else t for t, s in zip(cols[text].to_pylist(), spans)]
    cols[text] = pa.array(clean, pa.string())
    if n_chars in cols:
        n = [len(t) if s else n for t, s, n in zip(clean, spans, cols[n_chars].to_pylist())]
        cols[n_chars] = pa.array(n, cols[n_chars].type)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """``id_col, n_words, n_hit, n_items, items_sha256, contaminated`` per row of ``docs``."""
    found = occurrences(docs, benchmark, id_col=id_col, **how)
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    items = F.array_sort(F.array_distinct("_items"))
    return found.select(
        F.col("_id").alias(id_col),
        F.col("_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of ``spans`` (word places, end exclusive) and what stands between them."""
    data = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(data)]
    out, at = [], 0
    for s, e in spans:
        out.append(data[at : places[s][0]])
        at = places[e - 1][1]
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with every span of benchmark words cut out of ``text_col``; ``n_chars`` follows
    where it is there. Rows and other columns stay."""
    found = occurrences(docs, benchmark, keep=tuple(docs.columns), id_col=id_col, text_col=text_col, cut=True, **how)
    return found.select(*[F.col(f"`_k_{c}`").alias(c) for c in docs.columns])


def items_digest(items) -> str:
    """What ``items_sha256`` holds for these item ids."""
    return hashlib.sha256(",".join(sorted({str(x) for x in items})).encode()).hexdigest()
