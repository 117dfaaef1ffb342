"""LM scoring (6): a Katz backoff bigram model, counted, normalised and evaluated in buckets.

P(w | h) is the Good-Turing discounted count of (h, w) over the count of h where the pair
was seen, else bow(h) * P1(w); P1 is the discounted unigram, its left-over mass that of
all unknown words. Counts up to GT_MOST are discounted by Katz's formula, larger
ones by TAIL, so that every history leaves mass. bow(h) is exactly
(1 - sum of P over the words seen after h) / (1 - sum of P1 over them).

1. One scan cuts the documents into chunks, hashes their words (64 bits) and writes each
   chunk's distinct pairs, in order, with the documents they occur in, to a table bucketed
   by the pair's second word. This is the n-gram table; it is read without a shuffle.
   Words that would overfill a bucket are spread over buckets by their history, and pairs that
   would (hot pairs) by chunk, so no task needs all occurrences of a word or of a pair. Both
   are found in a scan of all documents: what holds a share of the corpus holds it in some chunk.
2. First pass over the buckets: counts of counts, N, V, and the totals of spread words and hot pairs.
3. Second pass: within a bucket the counts c(h, w) and c(w) are complete (a pair's second
   words are all tokens), so the parts of every document's score that depend on them
   are summed there; so are each history's sums for bow. A word is a history as often
   as it is a token, so c(h) needs no lookup. Pairs not seen are joined with bow(h). A hot
   pair's part in the sums of its history is added once.

Nothing but counts of counts and lists of frequent words and hot pairs, bounded by the number of
buckets (8 a bucket each), passes through the driver.

Defined cases: null text counts as empty (the end token alone); repeated rows are scored each and,
where they are learned from, counted each; null ids are neither learned from nor held out; extra
columns are ignored; an empty table gives none; with nothing to learn from every token has probability 1.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import on_workers, sized, stored, text_of
from envflow.llm.language_id import fold
from envflow.llm.shingles import WordHashes, words_of
from envflow.session import scratch_path

GT_MOST = 5
TAIL = 0.05
ADDED = 0.1  # of the base score
CHUNK_TOKENS, CHUNK_DOCS = 2_500_000, 65_535
BUCKET_BYTES = 32 << 20
SLICE_BYTES = 8 << 20  # of a bucket's rows that a task sorts at once
OUT_ROWS = 50_000  # that a task hands to its JVM at once
LEAST_BUCKETS = 8
SAMPLE_EVERY = 1  # documents looked at for frequent words and hot pairs (all); decides the layout only
BEGIN = xxhash.xxh3_64_intdigest(b" begin")  # no word holds a space
END = xxhash.xxh3_64_intdigest(b" end")
_U = np.uint64

#: A row per chunk and bucket: how many documents, the first ones, are learned from, then in the order of the second words:
#: the words, their numbers of pairs, the distinct first words, each pair's index into them,
#: its occurrences, and each occurrence's document. The row of bucket -1 has the ids.
CHUNK_COLUMNS = "bucket int, chunk long, learn int, second binary, pairs binary, firsts binary, first binary, times binary, docs binary"
NO_BUCKET = -1
SUMS_SCHEMA = "kind int, chunk long, doc int, first long, x1 double, x2 double, x3 double, sums binary"
DOC_SUMS, HISTORY, UNSEEN = 0, 1, 2


NONE = np.empty(0, dtype=_U)


def within(x: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the sorted array ``listed``."""
    if not len(listed):
        return np.zeros(len(x), dtype=bool)
    return listed[np.minimum(np.searchsorted(listed, x), len(listed) - 1)] == x


def pair_key(second: np.ndarray, first: np.ndarray) -> np.ndarray:
    return second ^ (first * _U(0x9E3779B97F4A7C15))


def bucket_of(second: np.ndarray, first: np.ndarray, frequent: np.ndarray, buckets: int, hot: np.ndarray = NONE, chunk: int = 0) -> np.ndarray:
    """``frequent`` words and ``hot`` pairs' keys are sorted; the words of hot pairs are frequent."""
    key = second.copy()
    spread = np.flatnonzero(within(second, frequent))
    own = pair_key(second[spread], first[spread])
    salt = _U(((chunk + 1) * 0xD6E8FEB86659FD93) % 2**64)
    key[spread] = np.where(within(own, hot), own * _U(0xA0761D6478BD642F) ^ salt, own)
    key = (key ^ (key >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return ((key >> _U(32)) % _U(buckets)).astype(np.int64)


def pairs_of(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Second and first words of the documents' pairs."""
    end, begin = np.array([END], dtype=_U), np.array([BEGIN], dtype=_U)
    return np.concatenate([x for h in hashes for x in (h, end)]), np.concatenate([x for h in hashes for x in (begin, h)])


def chunk_rows(hashes: list[np.ndarray], learn: int, frequent: np.ndarray, buckets: int, hot: np.ndarray = NONE, chunk: int = 0):
    """For every bucket: its number, then the columns of CHUNK_COLUMNS from ``learn`` on."""
    second, first = pairs_of(hashes)
    doc = np.repeat(np.arange(len(hashes), dtype="<u2"), [len(h) + 1 for h in hashes])
    bucket = bucket_of(second, first, frequent, buckets, hot, chunk).astype(np.int32)
    order = np.lexsort((first, second, bucket))  # stable: equal pairs stay by document
    bucket = bucket[order]  # one at a time, so that no more than one is held twice
    second = second[order]
    first = first[order]
    doc = doc[order]
    del order
    edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    for a, b in zip(edges[:-1], edges[1:]):
        s, f, d = second[a:b], first[a:b], doc[a:b]
        new_s = np.concatenate(([True], s[1:] != s[:-1]))
        new_p = new_s | np.concatenate(([True], f[1:] != f[:-1]))
        at_p = np.flatnonzero(new_p)
        known, index = np.unique(f[at_p], return_inverse=True)
        yield (
            int(bucket[a]), learn,
            s[new_s].tobytes(), np.add.reduceat(new_p.astype(np.int64), np.flatnonzero(new_s)).astype("<u4").tobytes(),
            known.tobytes(), index.astype("<u4").tobytes(),
            np.diff(np.append(at_p, b - a)).astype("<u4").tobytes(), d.tobytes(),
        )


def slices(t: pa.Table):
    """A bucket's rows in ranges of second words, of about SLICE_BYTES each, as ``Bucket``; a pair lies in one of them."""
    n = sized(t.nbytes, SLICE_BYTES)
    edges = [(i << 64) // n for i in range(n)] + [2**64 - 1]
    for i in range(n):
        yield Bucket(t, edges[i], edges[i + 1], i == n - 1)


class Bucket:
    """The merged pairs of one bucket, from the rows of all chunks, of second words from ``least`` to ``most`` (the last
    slice includes it)."""

    def __init__(self, t: pa.Table, least: int = 0, most: int = 2**64 - 1, last: bool = True):
        def get(c: str, kind) -> list[np.ndarray]:
            return [np.frombuffer(x.as_buffer(), dtype=kind) for x in t.column(c)]  # no copies

        self.chunks = t.column("chunk").to_pylist()
        seconds, firsts, counts, self.docs = [], [], [], []  # docs of each chunk's occurrences
        columns = (("second", "<u8"), ("pairs", "<u4"), ("firsts", "<u8"), ("first", "<u4"), ("times", "<u4"), ("docs", "<u2"))
        for s, p, known, index, times, docs in zip(*(get(c, kind) for c, kind in columns)):
            lo, hi = np.searchsorted(s, _U(least)), np.searchsorted(s, _U(most), "right" if last else "left")
            a = int(p[:lo].sum(dtype=np.int64))
            b = a + int(p[lo:hi].sum(dtype=np.int64))
            c = int(times[:a].sum(dtype=np.int64))
            d = c + int(times[a:b].sum(dtype=np.int64))
            seconds.append(np.repeat(s[lo:hi], p[lo:hi]))
            firsts.append(known[index[a:b]])
            counts.append(times[a:b])
            self.docs.append(docs[c:d])
        second, first = np.concatenate(seconds), np.concatenate(firsts)
        del seconds, firsts
        # equal pairs of different chunks together
        order = np.lexsort((first, second))
        second = second[order]  # one at a time, so that no more than one is held twice
        word = np.concatenate(([True], second[1:] != second[:-1]))[: len(order)]
        self.words = second[word]
        del second
        first = first[order]
        pair = word | np.concatenate(([True], first[1:] != first[:-1]))[: len(order)]
        self.first = first[pair]
        del first
        number = np.empty(len(order), dtype=np.int32)
        number[order] = np.cumsum(pair, dtype=np.int32) - 1
        del order
        self.pair = np.repeat(number, np.concatenate(counts))  # of each occurrence
        del number
        self.word = (np.cumsum(word, dtype=np.int32) - 1)[pair]  # of each pair
        del word, pair
        learned = np.concatenate([d < n for d, n in zip(self.docs, t.column("learn").to_pylist())])
        self.count = np.bincount(self.pair[learned], minlength=len(self.first))
        self.word_count = np.bincount(self.word, weights=self.count, minlength=len(self.words)).astype(np.int64)


def discounts(of_counts: dict[int, int]) -> np.ndarray:
    """The discounted counts 0..GT_MOST by Katz's formula; where the counts of counts don't
    allow it (too few), a constant amount, n1 / (n1 + 2 n2), is taken off."""
    n = [0, *(of_counts.get(r, 0) for r in range(1, GT_MOST + 2))]
    out = np.zeros(GT_MOST + 1)
    cut = (GT_MOST + 1) * n[GT_MOST + 1] / n[1] if n[1] else 1.0
    take = min(0.95, max(TAIL, n[1] / (n[1] + 2 * n[2]))) if n[1] else TAIL
    for r in range(1, GT_MOST + 1):
        share = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut < 1 else 0.0
        out[r] = share * r if 0 < share < 1 else r - take
    return out


def discounted(count: np.ndarray, table: np.ndarray) -> np.ndarray:
    return np.where(count > GT_MOST, count - TAIL, table[np.minimum(count, GT_MOST)])


@dataclass
class Totals:
    """What the second pass needs of the whole corpus."""

    tokens: int  # N
    words: int  # V
    documents: int
    unigram: np.ndarray  # discounted counts
    bigram: np.ndarray
    unknown: float  # P1 of all unknown words
    frequent: dict[int, int]  # counts of the words that are spread over buckets
    hot: np.ndarray  # sorted keys of the pairs that are spread over buckets by chunk
    hot_counts: np.ndarray

    def p1(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, discounted(count, self.unigram) / max(1, self.tokens), self.unknown)


def write_pairs(rows: DataFrame, name: str, path: str, buckets: int, frequent: np.ndarray, hot: np.ndarray = NONE) -> None:
    """Step 1: the bucketed table of ``_id, _train, _text``."""
    kind = rows.schema["_id"].dataType

    def cut(batches):
        from pyspark import TaskContext

        part, serial, memo = TaskContext.get().partitionId(), 0, WordHashes()
        hashes, ids, train, tokens = [], [], [], 0
        names = [x.split()[0] for x in CHUNK_COLUMNS.split(", ")] + ["ids"]

        def row(id_type, own_ids, bucket, chunk, *blobs):
            kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * (len(blobs) - 1), pa.list_(id_type)]
            arrays = [pa.array([v], k) for v, k in zip((bucket, chunk, *blobs, own_ids), kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def done():
            chunk = (part << 32) | serial
            order = sorted(range(len(ids)), key=lambda i: not train[i])  # those to learn from first
            yield row(id_type, [ids[i] for i in order], NO_BUCKET, chunk, *[None] * (len(names) - 3))
            for bucket, *blobs in chunk_rows([hashes[i] for i in order], sum(train), frequent, buckets, hot, chunk):
                yield row(id_type, None, bucket, chunk, *blobs)

        for b in batches:
            id_type = b.schema.field(0).type
            for i, learn, text in zip(*(b.column(k).to_pylist() for k in range(3))):
                words = words_of(text)
                hashes.append(np.fromiter(map(memo.__getitem__, words), dtype=_U, count=len(words)))
                ids.append(i)
                train.append(learn)
                tokens += len(words) + 1
                if tokens >= CHUNK_TOKENS or len(ids) >= CHUNK_DOCS:
                    yield from done()
                    serial += 1
                    hashes, ids, train, tokens = [], [], [], 0
        if ids:
            yield from done()

    out = on_workers(rows).mapInArrow(cut, f"{CHUNK_COLUMNS}, ids array<{kind.simpleString()}>")
    out.write.bucketBy(buckets, "bucket").option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)


def frequent_pairs(rows: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Words (sorted hashes) and pairs (first and second words, two columns) that may fill a good part of a
    bucket. They decide where pairs are kept, and nothing else. Each chunk tells those with a share of
    1 / (8 * buckets) of it; the rest of the chunks hold less than that share, so whatever has
    1 / (4 * buckets) of all tokens is told often enough to be taken."""

    def count(batches):
        memo, hashes, tokens = WordHashes(), [], 0

        def told():
            second, first = pairs_of(hashes)
            key = pair_key(second, first)
            order = np.argsort(key)
            key = key[order]
            cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            n = np.diff(np.append(cut, len(key)))
            at, n2 = order[cut[n * (8 * buckets) >= len(key)]], n[n * (8 * buckets) >= len(key)]
            w, n1 = np.unique(second, return_counts=True)
            w, n1 = w[n1 * (8 * buckets) >= len(key)], n1[n1 * (8 * buckets) >= len(key)]
            # a word stands with itself as its first; the last row has the tokens
            columns = [
                np.concatenate((np.full(len(n1), 1), np.full(len(n2), 2), [0])),
                np.concatenate((w, first[at], [_U(0)])).view(np.int64),
                np.concatenate((w, second[at], [_U(0)])).view(np.int64),
                np.concatenate((n1, n2, [len(key)])),
            ]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "first", "second", "n"])

        for b in batches:
            for text in b.column("_text").to_pylist():
                words = words_of(text)
                hashes.append(np.fromiter(map(memo.__getitem__, words), dtype=_U, count=len(words)))
                tokens += len(words) + 1
                if tokens >= CHUNK_TOKENS:
                    yield told()
                    hashes, tokens = [], 0
        if hashes:
            yield told()

    looked = rows.where(F.pmod(F.xxhash64("_text"), F.lit(SAMPLE_EVERY)) == 0).select("_text")
    rows = on_workers(looked).mapInArrow(count, "kind long, first long, second long, n long")
    counts = stored(rows.groupBy("kind", "first", "second").agg(F.sum("n").alias("n")), "words")
    total = counts.where("kind = 0").agg(F.sum("n")).first()[0] or 0
    top = counts.where((F.col("kind") > 0) & (F.col("n") * (8 * buckets) >= total)).collect()  # 16 * buckets at most
    words = np.unique(np.array([END, *(r.second & (2**64 - 1) for r in top if r.kind == 1)], dtype=_U))
    pairs = np.array([(r.first & (2**64 - 1), r.second & (2**64 - 1)) for r in top if r.kind == 2], dtype=_U).reshape(-1, 2)
    return words, pairs[within(pairs[:, 1], words)]


def corpus_totals(table: DataFrame, frequent: np.ndarray, hot: np.ndarray = NONE) -> Totals:
    """The first pass."""

    def count(t: pa.Table) -> pa.Table:
        out = []
        for b in slices(t):
            spread = np.isin(b.words, frequent)
            key = pair_key(b.words[b.word], b.first)
            parted = within(key, hot)
            for kind, c in (("1", b.word_count[~spread]), ("2", b.count[~parted])):
                n = np.bincount(np.minimum(c, GT_MOST + 2), minlength=GT_MOST + 3)
                out += [(kind, r, int(n[r])) for r in range(1, GT_MOST + 2)]
                out += [(kind + "n", 0, int(c.sum())), (kind + "v", 0, int((c > 0).sum()))]
            out += [("w", int(h), int(c)) for h, c in zip(b.words[spread].view(np.int64), b.word_count[spread])]
            out += [("p", int(h), int(c)) for h, c in zip(key[parted].view(np.int64), b.count[parted])]
        return pa.table([pa.array(x) for x in zip(*out)], names=["kind", "r", "n"])

    sums = on_workers(table).groupBy("bucket").applyInArrow(count, "kind string, r long, n long")
    rows = sums.groupBy("kind", "r").agg(F.sum("n").alias("n")).collect()
    got = {(r.kind, r.r): int(r.n) for r in rows}
    words = {h & (2**64 - 1): n for (k, h), n in got.items() if k == "w"}
    n1 = {r: got.get(("1", r), 0) + sum(c == r for c in words.values()) for r in range(1, GT_MOST + 2)}
    pairs = {h & (2**64 - 1): n for (k, h), n in got.items() if k == "p"}
    hot_counts = np.array([pairs.get(h, 0) for h in hot.tolist()], dtype=np.int64)
    n2 = {r: got.get(("2", r), 0) + int((hot_counts == r).sum()) for r in range(1, GT_MOST + 2)}
    tokens = got.get(("1n", 0), 0) + sum(words.values())
    v = got.get(("1v", 0), 0) + sum(c > 0 for c in words.values())
    d1 = discounts(n1)
    few = range(1, GT_MOST + 1)
    mass = sum(n1[r] * d1[r] for r in few) + tokens - sum(n1[r] * r for r in few) - TAIL * (v - sum(n1[r] for r in few))
    return Totals(tokens, v, words.get(END, 0), d1, discounts(n2), 1 - mass / tokens if tokens else 1.0, words, hot, hot_counts)


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, rows of values per key) of all parts as one, values of equal keys added up."""
    if len(parts) == 1:
        return parts[0]
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    values = np.concatenate([v for _, v in parts], axis=1)
    return keys, np.array([np.bincount(at, weights=v, minlength=len(keys)) for v in values])


def bucket_sums(table: DataFrame, totals: Totals) -> DataFrame:
    """The second pass: rows of SUMS_SCHEMA."""

    def sums(t: pa.Table) -> pa.Table:
        names, (i64, f64) = [x.split()[0] for x in SUMS_SCHEMA.split(", ")], (pa.int64(), pa.float64())
        kinds = [pa.int32(), i64, pa.int32(), i64, f64, f64, f64, pa.binary()]
        columns: list[list] = [[] for _ in kinds]

        def add(n: int, **cols) -> None:
            for lo in range(0, n, OUT_ROWS):
                m = min(OUT_ROWS, n - lo)
                for own, name, kind in zip(columns, names, kinds):
                    v = cols.get(name)
                    own.append(pa.nulls(m, kind) if v is None else pa.array(np.full(m, v) if isinstance(v, int) else v[lo : lo + m], kind))

        chunks, by_doc, histories = t.column("chunk").to_pylist(), [[] for _ in range(t.num_rows)], []
        for b in slices(t):
            c1 = b.word_count.copy()
            for i, h in enumerate(b.words.tolist()):
                if h in totals.frequent:
                    c1[i] = totals.frequent[h]
            p1 = totals.p1(c1)
            c2 = b.count.copy()
            key = pair_key(b.words[b.word], b.first)
            parted = within(key, totals.hot)
            c2[parted] = totals.hot_counts[np.searchsorted(totals.hot, key[parted])]
            del key
            seen = c2 > 0
            own = discounted(c2, totals.bigram)
            # a token's part: its discounted count or P1, and as the next one's history
            by_word = np.where((c1 > 0) & (b.words != _U(END)), -np.log10(np.maximum(c1, 1)), 0.0)
            by_pair = np.where(seen, np.log10(np.where(seen, own, 1.0)), np.log10(p1)[b.word]) + by_word[b.word]
            base = np.log10(c1 + ADDED)[b.word]
            known = (c1 > 0)[b.word]
            lo = 0
            for k, (chunk, doc) in enumerate(zip(chunks, b.docs)):  # the documents that the chunk has here, and no others
                pair = b.pair[lo : lo + len(doc)]
                lo += len(doc)
                tokens = np.bincount(doc)
                at = np.flatnonzero(tokens)
                parts = [np.bincount(doc, weights=x[pair])[at] for x in (by_pair, base, known)]
                by_doc[k].append((at.astype("<u2"), np.array((parts[0], parts[1], tokens[at], parts[2]))))
                un = np.flatnonzero(~seen[pair])
                add(len(un), kind=UNSEEN, chunk=chunk, doc=doc[un].astype(np.int32), first=b.first[pair[un]].view(np.int64), x1=np.ones(len(un)))
            once = seen & ~parted
            h, at = np.unique(b.first[once], return_inverse=True)
            histories.append((h, np.array([np.bincount(at, weights=x[once], minlength=len(h)) for x in (own, p1[b.word], c2)])))
        blobs = [values.astype("<f8").tobytes() + at.astype("<u2").tobytes() for at, values in map(added, by_doc)]
        add(len(blobs), kind=DOC_SUMS, chunk=chunks, sums=blobs)
        h, by_history = added(histories)
        add(len(h), kind=HISTORY, first=h.view(np.int64), x1=by_history[0], x2=by_history[1], x3=by_history[2])
        return pa.table([pa.chunked_array(c, k) for c, k in zip(columns, kinds)], names=names)

    return on_workers(table).groupBy("bucket").applyInArrow(sums, SUMS_SCHEMA)


def hot_histories(spark, pairs: np.ndarray, totals: Totals) -> DataFrame:
    """The hot pairs' part of the histories' sums, each pair once."""
    c2 = totals.hot_counts
    p1 = totals.p1(np.array([totals.frequent.get(w, 0) for w in pairs[:, 1].tolist()], dtype=np.int64))
    own = discounted(c2, totals.bigram)
    rows = zip(pairs[:, 0].copy().view(np.int64).tolist(), own.tolist(), p1.tolist(), c2.astype(float).tolist())
    return spark.createDataFrame([r for r in rows if r[3] > 0], "first long, x1 double, x2 double, x3 double")


def per_document(table: DataFrame, sums: DataFrame) -> DataFrame:
    """``_id, chunk, doc, part, base, tokens, known``: the buckets' sums added up, chunk by chunk."""
    ids = table.where(F.col("bucket") == NO_BUCKET).select("chunk", F.lit(None).cast("binary").alias("sums"), "ids")
    both = sums.where(F.col("kind") == DOC_SUMS).select("chunk", "sums", F.lit(None).cast(ids.schema["ids"].dataType).alias("ids"))
    kind = ids.schema["ids"].dataType.elementType.simpleString()

    def add(t: pa.Table) -> pa.Table:
        blobs = [x for x in t.column("sums").to_pylist() if x is not None]
        own = next(x for x in t.column("ids").combine_chunks() if x.is_valid).values
        total = np.zeros((4, len(own)))
        for x in blobs:
            n = len(x) // 34  # four sums and the number of each document
            total[:, np.frombuffer(x, "<u2", n, 32 * n)] += np.frombuffer(x, "<f8", 4 * n).reshape(4, n)
        chunk = pa.array(np.full(len(own), t.column("chunk")[0].as_py(), dtype=np.int64))
        arrays = [own, chunk, pa.array(np.arange(len(own), dtype=np.int32)), pa.array(total[0]), pa.array(total[1])]
        arrays += [pa.array(x.astype(np.int64)) for x in total[2:]]
        return pa.table(arrays, names=["_id", "chunk", "doc", "part", "base", "tokens", "known"])

    schema = f"_id {kind}, chunk long, doc int, part double, base double, tokens long, known long"
    return on_workers(both.unionByName(ids)).groupBy("chunk").applyInArrow(add, schema)


def score(docs: DataFrame, folds: int = 10, held: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn outside fold ``held`` and score all: ``id_col, held_out, n_tokens, n_known,
    train_tokens, base_score, score`` (log10)."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(fold(id_col, folds) != held, F.lit(False)).alias("_train"), text_of(text_col).alias("_text")
    )
    size = rows.agg(F.sum(F.octet_length("_text") + 8)).first()[0]
    if not size:
        return _result(docs, id_col)
    buckets = min(sized(size, BUCKET_BYTES, LEAST_BUCKETS), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    frequent, pairs = frequent_pairs(rows, buckets)
    pairs = pairs[np.argsort(pair_key(pairs[:, 1], pairs[:, 0]))]
    hot = pair_key(pairs[:, 1], pairs[:, 0])
    name, path = f"pairs_{uuid.uuid4().hex}", scratch_path(spark, "pairs")
    write_pairs(rows, name, path, buckets, frequent, hot)
    table = spark.table(name)
    kept = table.where(F.col("bucket") >= 0)
    totals = corpus_totals(kept, frequent, hot)
    sums = stored(bucket_sums(kept, totals), "sums")
    by_doc = stored(per_document(table, sums), "documents")
    spark.sql(f"DROP TABLE {name}")  # the entry; its files stay in the scratch folder

    history = sums.where(F.col("kind") == HISTORY).select("first", "x1", "x2", "x3").unionByName(hot_histories(spark, pairs, totals)).groupBy("first").agg(*[F.sum(f"x{i}").alias(f"x{i}") for i in (1, 2, 3)])
    bow = (1 - F.col("x1") / F.col("x3")) / (1 - F.col("x2"))
    history = history.select("first", (F.log10("x3") + F.log10(bow)).alias("back"))
    unseen = sums.where(F.col("kind") == UNSEEN).groupBy("chunk", "doc", "first").agg(F.sum("x1").alias("n"))
    backed = unseen.join(history, "first").groupBy("chunk", "doc").agg(F.sum(F.col("n") * F.col("back")).alias("back"))
    out = by_doc.join(backed, ["chunk", "doc"], "left")
    begin = math.log10(totals.documents) if totals.documents else 0.0
    each = math.log10(totals.tokens + ADDED * (totals.words + 1))
    return out.select(
        F.col("_id").alias(id_col),
        F.coalesce(fold("_id", folds) == held, F.lit(False)).alias("held_out"),
        F.col("tokens").alias("n_tokens"),
        F.col("known").alias("n_known"),
        F.lit(totals.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("tokens") * F.lit(each)).alias("base_score"),
        (F.col("part") + F.coalesce("back", F.lit(0.0)) - F.lit(begin)).alias("score"),
    )


def _result(docs: DataFrame, id_col: str) -> DataFrame:
    """The columns of ``score`` for a table without rows."""
    none = docs.where("false").select(F.col(id_col))
    for c, kind in (("held_out", "boolean"), ("n_tokens", "long"), ("n_known", "long"), ("train_tokens", "long"), ("base_score", "double"), ("score", "double")):
        none = none.withColumn(c, F.lit(None).cast(kind))
    return none
