"""Best-fit packing (2): token sequences into as few rows of bounded length as possible.

1. Every document is encoded (plus an end id) and cut into pieces of at most
   ``capacity`` ids; the first piece takes the remainder. The pieces, without
   texts, go to a scratch table.
2. Lengths are integers up to ``capacity``, so the histogram of lengths is all the
   packer needs: at most ``capacity`` numbers, however many pieces there are.
   ``pack_plan`` packs *runs* of equal pieces into *runs* of equal bins:
   large-item matching first (a piece above a third of the capacity shares its bin
   with one other such piece at most: greedily, largest first, with the largest that fits),
   then the smaller lengths, largest first, each into the tightest gap.
3. Every piece gets its rank among the pieces of its length (a salted window, so no
   length is one group), and rank plus plan give bin and offset by binary search.

Defined cases: null text counts as empty (the end id alone); repeated rows are packed
each; null ids are kept; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envflow.llm.bpe import as_bytes, encode_all
from envflow.llm.common import on_workers, sized, stored, text_of

CAPACITY = 2048
END_ID = 0
#: Pieces of one length in one window task.
RANK_ROWS = 200_000
_RANK_BITS = 48


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: the remainder first, then full ones."""
    k = max(1, -(-n // capacity))
    return [n - (k - 1) * capacity] + [capacity] * (k - 1)


def pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and, if asked, the ids."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    src = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()
    end = np.asarray([end_id], dtype="<u4").tobytes()
    names = ["_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches):
        for b in batches:
            owner, cols, at = [], [[] for _ in names[1:]], 0
            for values in encode_all(b.column("_text").to_pylist(), path, as_bytes):
                for ids in values:
                    ids += end
                    start = 0
                    for k, n in enumerate(cut_lengths(len(ids) // 4, capacity)):
                        own = ids[4 * start : 4 * (start + n)]
                        for c, v in zip(cols, (k, start, n, zlib.crc32(own), own)):
                            c.append(v)
                        owner.append(at)
                        start += n
                    at += 1
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(cols, types)]
            yield pa.RecordBatch.from_arrays([b.column("_id").take(pa.array(owner, pa.int64())), *arrays], names=names)

    schema = f"_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return on_workers(src).mapInArrow(cut, schema).withColumnRenamed("_id", id_col)


class _Bins:
    """Runs of equal bins by remaining gap; the tightest gap that fits comes first."""

    def __init__(self):
        self.by_gap: dict[int, list[tuple[int, int]]] = {}  # gap -> [(first bin, bins)]

    def put(self, gap: int, first: int, bins: int) -> None:
        if bins and gap:
            self.by_gap.setdefault(gap, []).append((first, bins))

    def tightest(self, size: int) -> int | None:
        return min((g for g in self.by_gap if g >= size), default=None)

    def take(self, gap: int) -> tuple[int, int]:
        runs = self.by_gap[gap]
        run = runs.pop()
        if not runs:
            del self.by_gap[gap]
        return run


def pack_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, ranks, first bin, pieces per bin, offset): pieces of
    ``length`` with ranks from ``first rank`` on fill consecutive bins."""
    left = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    rows, bins, next_bin = [], _Bins(), 0

    def place(n: int, ranks: int, first_bin: int, per_bin: int, offset: int) -> None:
        rows.append((n, used[n], ranks, first_bin, per_bin, offset))
        used[n] += ranks
        left[n] -= ranks

    # Large items: a max-heap of lengths above a third; each takes the largest partner that fits.
    large = [-n for n in left if 3 * n > capacity]
    heapq.heapify(large)
    partners = sorted(-n for n in large)
    while large:
        n = -heapq.heappop(large)
        while left[n]:
            fits = [p for p in partners if left[p] and p + n <= capacity]
            p = fits[-1] if fits else None
            count = left[n] if p is None else left[n] // 2 if p == n else min(left[n], left[p])
            if p == n and left[n] == 1:  # its own last one: the next smaller partner, or none
                fits = [x for x in fits if x != n]
                p = fits[-1] if fits else None
                count = 1
            first, next_bin = next_bin, next_bin + count
            if p == n:
                place(n, 2 * count, first, 2, 0)
                bins.put(capacity - 2 * n, first, count)
                continue
            place(n, count, first, 1, 0)
            if p is not None:
                place(p, count, first, 1, n)
            bins.put(capacity - n - (p or 0), first, count)

    # Small items: largest first, each into the tightest gap, else into new bins.
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            gap = bins.tightest(n)
            if gap is None:
                per = capacity // n
                gap, first, count = capacity, next_bin, sized(left[n], per)
                next_bin += count
            else:
                first, count = bins.take(gap)
            per = gap // n
            full = min(count, left[n] // per)
            if full:
                place(n, full * per, first, per, capacity - gap)
                bins.put(gap - per * n, first, full)
            if full < count:
                rest = left[n]  # fewer than fill one bin
                if rest:
                    place(n, rest, first + full, rest, capacity - gap)
                    bins.put(gap - rest * n, first + full, 1)
                    full += 1
                bins.put(gap, first + full, count - full)
    plan = np.array(rows, dtype=np.int64).reshape(-1, 6)
    return plan[np.lexsort((plan[:, 1], plan[:, 0]))]


def ranked(found: DataFrame, counts: dict[int, int], id_col: str) -> DataFrame:
    """``_rank`` from 0 among the pieces of a length; a frequent length is split by a salt."""
    spark = found.sparkSession
    salts = spark.createDataFrame(
        [(n, sized(c, RANK_ROWS)) for n, c in counts.items()], "length long, _salts int"
    )  # a row per length: the capacity bounds it
    keyed = found.join(F.broadcast(salts), "length").withColumn(
        "_salt", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.col("_salts")).cast("int")
    )
    sizes = keyed.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = Window.partitionBy("length", "_salt").orderBy(id_col, "piece", "ids_crc32")
    numbered = keyed.withColumn("_own", F.row_number().over(own) - 1)
    out = numbered.join(starts, ["length", "_salt"])
    return out.withColumn("_rank", (F.col("_own") + F.col("_before")).cast("long")).drop("_own", "_before", "_salts", "_salt")


def pack_pieces(found: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id") -> DataFrame:
    """``found`` (stored pieces) with ``sequence_id`` and ``offset``."""
    counts = {int(r[0]): int(r[1]) for r in found.groupBy("length").count().collect()}  # capacity rows at most
    plan = pack_plan(counts, capacity)
    keys = (plan[:, 0] << _RANK_BITS) | plan[:, 1]

    def seat(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("_rank").to_numpy()
            p = plan[np.searchsorted(keys, (length << _RANK_BITS) | rank, side="right") - 1]
            at = rank - p[:, 1]
            places = [pa.array(p[:, 3] + at // p[:, 4]), pa.array(p[:, 5] + at % p[:, 4] * length)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *places], names=[*b.schema.names[:-1], "sequence_id", "offset"])

    rows = ranked(found, counts, id_col).select(*found.columns, "_rank")
    fields = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in found.schema)
    return on_workers(rows).mapInArrow(seat, f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Pieces of all ``docs`` with their places: ``id_col, piece, start, length, ids_crc32
    (, ids), sequence_id, offset``."""
    found = stored(pieces(docs, capacity=capacity, id_col=id_col, text_col=text_col, **how), "pieces")
    return pack_pieces(found, capacity, id_col)
