"""MinHash near-dedup (7): banded candidates, sequential Bayesian verification, exact check.

1. Every document gets its set of 5-word shingles as hashes: its size, a 128-bit
   fingerprint of the set, 255 MinHash values folded into 51 band hashes of 5, and a
   sketch of one bit per MinHash value. Equal sets collapse to one representative with a
   number of its own; ids are only labels of the rows that have it.
2. Representatives meet in band buckets. A pair at similarity 0.75 misses all 51
   buckets with probability 1e-6.
3. *Star round:* every member is paired with the least id of each of its buckets
   (so a bucket of k costs k pairs) and keeps the partner with the best sketch.
4. *Rest:* in buckets that still hold more than one component, pairs of different
   components are compared in blocks of bounded size: first a spanning
   forest of the likely ones, then every one that is left. No link is lost.
5. Candidates are pruned batch by batch (64 bits each): as soon as the
   posterior probability that the similarity reaches the threshold falls under ``miss``, the
   pair is dropped. Survivors are verified exactly on the texts' full sets.

Defined cases: a text without words, or null, has an empty set and no links; repeated rows and
rows of equal ids are rows of their own, each linked by its own text; null ids take part in links but are
never a component's id (null, where all ids of it are); extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envflow.llm.bpe import balanced
from envflow.llm.common import on_workers, stored, text_of
from envflow.llm.components import connected_components, forest_roots
from envflow.llm.shingles import SHINGLE_WORDS, WordHashes, mixed, shingle_hashes, words_of

SIMILAR_PCT = 75
BANDS, ROWS = 51, 5
PERMUTATIONS = BANDS * ROWS
#: Chance of dropping a pair at the threshold by its sketch.
MISS = 1e-6
BATCH_BITS, BATCHES = 64, 4
#: Members of a bucket compared in one block.
BLOCK = 2048
#: Least hashes of a set that are compared before its text is, and the slack of their estimate.
BOTTOM, SIGMAS = 1024, 5.0
_U32, _U64 = np.uint32, np.uint64


def permutations() -> tuple[np.ndarray, np.ndarray]:
    """Fixed pseudo-random masks and odd factors, one pair per MinHash value."""
    i = np.arange(PERMUTATIONS, dtype=_U64)
    return (mixed(i, 0x5EED1) >> _U64(32)).astype(_U32), (mixed(i, 0x5EED2) >> _U64(32)).astype(_U32) | _U32(1)


def min_hashes(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash values (documents x PERMUTATIONS) of consecutive runs of shingle hashes."""
    x = (hashes >> _U64(32)).astype(_U32) ^ hashes.astype(_U32)
    masks, factors = permutations()
    out = np.empty((PERMUTATIONS, len(starts)), dtype=_U32)
    y, z = np.empty_like(x), np.empty_like(x)
    for i in range(PERMUTATIONS):
        np.bitwise_xor(x, masks[i], out=y)
        np.multiply(y, factors[i], out=y)
        np.right_shift(y, _U32(15), out=z)
        np.bitwise_xor(y, z, out=y)
        np.multiply(y, _U32(0x2C1B3C6D), out=y)
        out[i] = np.minimum.reduceat(y, starts)
    return np.ascontiguousarray(out.T)


def band_hashes(values: np.ndarray) -> np.ndarray:
    v = values.reshape(len(values), BANDS, ROWS).astype(_U64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U64), v.shape[:2]).copy()
    for r in range(ROWS):
        h = mixed(h * _U64(0x9E3779B97F4A7C15) + v[:, :, r])
    return h


def sketches(values: np.ndarray) -> np.ndarray:
    """One bit per MinHash value, as rows of bytes."""
    bits = np.zeros((len(values), BATCH_BITS * BATCHES), dtype=np.uint8)
    bits[:, :PERMUTATIONS] = (values >> _U32(16)) & _U32(1)
    return np.packbits(bits, axis=1)


def posterior_bounds(similar: float = SIMILAR_PCT / 100, miss: float = MISS) -> list[int]:
    """Least number of equal bits after each batch for a pair to stay.

    A bit is equal with probability p = (1 + J) / 2. With a uniform prior on p over
    [1/2, 1], the posterior of p >= (1 + similar) / 2 given the equal bits is a ratio
    of binomial tails.
    """
    at = (1 + similar) / 2

    def tail(m: int, n: int, x: float) -> float:  # P(Beta(m+1, n-m+1) > x)
        return sum(math.comb(n + 1, j) * x**j * (1 - x) ** (n + 1 - j) for j in range(m + 1))

    out = []
    for k in range(1, BATCHES + 1):
        n = min(k * BATCH_BITS, PERMUTATIONS)
        spare = k * BATCH_BITS - n  # padding bits are always equal
        least = next(m for m in range(n + 1) if tail(m, n, at) >= miss * tail(m, n, 0.5))
        out.append(least + spare)
    return out


def surviving(a: np.ndarray, b: np.ndarray, bounds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs of sketch rows (as 64-bit words) that stay, and their equal bits."""
    left = np.arange(len(a))
    equal = np.zeros(len(a), dtype=np.int64)
    for k, least in enumerate(bounds):
        equal = equal + BATCH_BITS - np.bitwise_count(a[left, k] ^ b[left, k])
        stay = equal >= least
        left, equal = left[stay], equal[stay]
    return left, equal


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, h, g, n, fp1, fp2, bands, sketch`` per row of ``docs``, and the columns ``keep``; ``h`` and ``g`` are hashes of
    the text; empty sets have no bands."""

    def sign(batches):
        memo = WordHashes()
        for b in batches:
            texts = b.column(0).to_pylist()
            n, fp1, fp2, bands, sketch = [], [], [], [], []
            for lo, hi in balanced(texts, 1 << 21):
                sets = [np.unique(shingle_hashes(words_of(t), memo)) for t in texts[lo:hi]]
                sizes = np.array([len(s) for s in sets])
                n += sizes.tolist()
                own_b, own_s = [None] * len(sets), [None] * len(sets)
                full = np.flatnonzero(sizes)
                flat = np.concatenate([sets[i] for i in full]) if len(full) else np.empty(0, _U64)
                starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1])) if len(full) else full
                sums = [np.zeros(len(sets), dtype=_U64), np.zeros(len(sets), dtype=_U64)]
                if len(full):
                    for s, salt in zip(sums, (0xF1, 0xF2)):
                        s[full] = np.add.reduceat(mixed(flat, salt), starts)
                    v = min_hashes(flat, starts)
                    bh, sk = band_hashes(v), sketches(v)
                    for j, i in enumerate(full):
                        own_b[i], own_s[i] = bh[j].astype("<u8").tobytes(), sk[j].tobytes()
                fp1 += sums[0].view(np.int64).tolist()
                fp2 += sums[1].view(np.int64).tolist()
                bands += own_b
                sketch += own_s
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array(n, pa.int64()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()),
                 pa.array(bands, pa.binary()), pa.array(sketch, pa.binary())],
                names=[*b.schema.names[1:], "n", "fp1", "fp2", "bands", "sketch"],
            )

    src = docs.select(text_of(text_col).alias("text"), F.col(id_col).alias("id"), *_text_key(text_col), *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[1:])
    return on_workers(src).mapInArrow(sign, f"{fields}, n long, fp1 long, fp2 long, bands binary, sketch binary")


def _text_key(text_col: str) -> list:
    return [F.xxhash64(text_of(text_col)).alias("h"), F.hash(text_of(text_col)).alias("g")]


def _buckets(reps: DataFrame) -> DataFrame:
    """``bucket, id`` of every representative and band, where a bucket holds two or more."""

    def spread(batches):
        for b in batches:
            ids, blobs = b.column(0), b.column(1).to_pylist()
            at = pa.array(np.repeat(np.arange(len(blobs)), BANDS))
            flat = np.frombuffer(b"".join(blobs), dtype="<i8")
            yield pa.RecordBatch.from_arrays([pa.array(flat), ids.take(at)], names=["bucket", "id"])

    kind = reps.schema["id"].dataType.simpleString()
    rows = on_workers(reps).select("id", "bands").mapInArrow(spread, f"bucket long, id {kind}")
    shared = rows.groupBy("bucket").agg(F.count("*").alias("members"), F.min("id").alias("leader")).where("members > 1")
    return rows.join(shared, "bucket")


def _words(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype="<u8").reshape(len(rows), BATCHES)


def bottoms(texts: DataFrame) -> DataFrame:
    """``id, bottom``: the BOTTOM least 32-bit shingle hashes of each text (all, where it has no more)."""
    kind = texts.schema["id"].dataType.simpleString()

    def least(batches):
        memo = WordHashes()
        for b in batches:
            sets = (np.unique(shingle_hashes(words_of(t), memo) >> _U64(32)) for t in b.column(1).to_pylist())
            blobs = [s[:BOTTOM].astype("<u4").tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(blobs, pa.binary())], names=["id", "bottom"])

    return on_workers(texts).select("id", "text").mapInArrow(least, f"id {kind}, bottom binary")


def _star(buckets: DataFrame, sketch: DataFrame, similar_pct: int, bounds: list[int]) -> DataFrame:
    """Each member with the likeliest of its buckets' leaders, if any is likely enough."""
    pairs = buckets.where("id <> leader").select("id", "leader").distinct()
    both = pairs.join(sketch, "id").join(sketch.select(*[F.col(c).alias(f"l_{c}") for c in sketch.columns]), F.col("leader") == F.col("l_id"))
    both = both.where(_sizes_allow("n", "l_n", similar_pct))
    kind = buckets.schema["id"].dataType.simpleString()

    def prune(batches):
        for b in batches:
            kept, equal = surviving(_words(b.column(2).to_pylist()), _words(b.column(3).to_pylist()), bounds)
            at = pa.array(kept)
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(equal)], names=["a", "b", "equal"])

    left = on_workers(both).select("id", "leader", "sketch", "l_sketch").mapInArrow(prune, f"a {kind}, b {kind}, equal long")
    best = left.groupBy("a").agg(F.max(F.struct("equal", "b")).alias("x"))
    return best.select("a", F.col("x.b").alias("b"))


def _sizes_allow(n: str, m: str, similar_pct: int):
    """J >= s needs the smaller set to have at least s times the larger one's size."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * similar_pct


def _mixed(
    buckets: DataFrame, labels: DataFrame, sketch: DataFrame, similar_pct: int, bounds: list[int], forest: bool
) -> DataFrame:
    """Likely pairs of different components within buckets, compared block by block. ``sketch`` has
    the members' bottom hashes too, so a pair is told only if these agree with the threshold."""
    own = buckets.select("bucket", "id").join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")
    mixed_ones = own.groupBy("bucket").agg(F.count("*").alias("k"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
    rows = own.join(mixed_ones.select("bucket", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks")), "bucket").join(sketch, "id")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # a member stands in the block pairs (its block, j)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")})
    rows = rows.select("bucket", "x", "y", "block", "id", "c", "n", "sketch", "bottom")
    rows = rows.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
    kind = buckets.schema["id"].dataType.simpleString()

    def compare(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            key = np.column_stack([t.column(c).to_numpy() for c in ("bucket", "x", "y")])
            last = int(np.flatnonzero((key[1:] != key[:-1]).any(axis=1))[-1]) + 1 if (key[1:] != key[:-1]).any() else 0
            if last:
                yield told(t.slice(0, last), key[:last])
            held = t.slice(last)
        if held is not None and held.num_rows:
            yield told(held, np.column_stack([held.column(c).to_numpy() for c in ("bucket", "x", "y")]))

    def told(t: pa.Table, key: np.ndarray) -> pa.RecordBatch:
        """Pairs of the whole block pairs in ``t``."""
        ids, c, n = t.column("id").to_pylist(), t.column("c").to_numpy(), t.column("n").to_numpy()
        words, block = _words(t.column("sketch").to_pylist()), t.column("block").to_numpy()
        bottom = t.column("bottom").to_pylist()
        edges = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]))
        out = []
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            g = slice(lo, hi)
            across = key[lo, 1] != key[lo, 2]
            found = Block(words[g], n[g], c[g], block[g], across, bottom[g], similar_pct, bounds).pairs()
            if forest:
                found = _forest(found, c[g])
            out += [(ids[lo + i], ids[lo + j]) for i, j, _ in found]
        kind = t.schema.field("id").type
        pairs = [pa.array([f(p) for p in out], kind) for f in (max, min)]
        return pa.RecordBatch.from_arrays(pairs, names=["a", "b"])

    return on_workers(rows).mapInArrow(compare, f"a {kind}, b {kind}").distinct()


class Block:
    """The members of a bucket, or of two of its blocks, and the pairs of them that stay."""

    def __init__(self, words, n, c, block, across: bool, bottom: list[bytes], similar_pct: int, bounds: list[int]):
        self.pct, self.bounds = similar_pct, bounds
        self.words, self.n, self.c, self.block, self.across = words, n, c, block, across
        self.bottom = [np.frombuffer(x, "<u4") for x in bottom]
        self.size = np.array([len(x) for x in self.bottom])
        self.flat = np.concatenate(self.bottom)
        self.begin = np.cumsum(self.size) - self.size
        # up to here a bottom has all of its set
        self.reach = np.array([x[-1] if len(x) >= BOTTOM else 2**32 - 1 for x in self.bottom], dtype=np.int64)

    def pairs(self) -> list[tuple[int, int, float]]:
        out = []
        for i in range(len(self.n)):
            ok = self.c[i + 1 :] != self.c[i]
            if self.across:
                ok &= self.block[i + 1 :] != self.block[i]
            ok &= np.minimum(self.n[i + 1 :], self.n[i]) * 100 >= np.maximum(self.n[i + 1 :], self.n[i]) * self.pct
            later = np.flatnonzero(ok) + i + 1
            if len(later):
                kept, _ = surviving(np.broadcast_to(self.words[i], (len(later), BATCHES)), self.words[later], self.bounds)
                out += self.close(i, later[kept])
        return out

    def close(self, i: int, later: np.ndarray) -> list[tuple[int, int, float]]:
        """Those of ``later`` whose bottom hashes may belong to a set similar to that of ``i``: exact
        but for hash collisions where both bottoms are whole sets, else an estimate
        from the least hashes of the union, with SIGMAS standard errors of slack."""
        if not len(later):
            return []
        own, size = self.bottom[i], self.size[later]
        starts = np.cumsum(size) - size
        at = np.arange(size.sum()) - np.repeat(starts - self.begin[later], size)
        x = self.flat[at]
        place = np.minimum(np.searchsorted(own, x), len(own) - 1)
        reach = np.minimum(self.reach[later], self.reach[i])
        within = x <= np.repeat(reach, size)
        both = np.add.reduceat((own[place] == x) & within, starts, dtype=np.int64)
        union = np.add.reduceat(within, starts, dtype=np.int64) + np.searchsorted(own, reach, side="right") - both
        s = self.pct / 100
        # whole sets: the union by their true sizes, and slack for hashes that met within a set
        whole = reach == 2**32 - 1
        union = np.where(whole, self.n[later] + self.n[i] - both, union)
        met = self.n[later] - size + self.n[i] - len(own)
        slack = np.where(whole, 2 * met, 1 + SIGMAS * np.sqrt(s * (1 - s) * union))
        good = both + slack >= s * union
        return list(zip([i] * int(good.sum()), later[good].tolist(), (both / np.maximum(union, 1))[good].tolist()))


def _forest(found, c):
    """The likeliest pairs that join components not joined yet."""
    root: dict = {}

    def find(v):
        while root.get(v, v) != v:
            v = root[v]
        return v

    out = []
    for i, j, e in sorted(found, key=lambda t: -t[2]):
        p, q = find(c[i]), find(c[j])
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((i, j, e))
    return out


def _verified(pairs: DataFrame, texts: DataFrame, similar_pct: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    rows = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("s")), "a")
    rows = rows.join(texts.select(F.col("id").alias("b"), F.col("text").alias("t")), "b").select("a", "b", "s", "t")
    kind = pairs.schema["a"].dataType.simpleString()

    def check(batches):
        memo = WordHashes()
        for r in batches:
            keep = []
            for i, (s, t) in enumerate(zip(r.column(2).to_pylist(), r.column(3).to_pylist())):
                p, q = np.unique(shingle_hashes(words_of(s), memo)), np.unique(shingle_hashes(words_of(t), memo))
                both = len(np.intersect1d(p, q, assume_unique=True))
                if both and 100 * both >= similar_pct * (len(p) + len(q) - both):
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([r.column(0).take(at), r.column(1).take(at)], names=["a", "b"])

    return on_workers(rows).mapInArrow(check, f"a {kind}, b {kind}")


def _linked(docs: DataFrame, similar_pct: int, miss: float, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, n, rep, component, component_id`` and ``keep`` per row of ``docs``: the representative of its set and of its
    component (numbers; null for empty sets), and the least id of the component's rows."""
    bounds = posterior_bounds(similar_pct / 100, miss)
    signed = stored(signatures(docs, id_col, text_col, keep), "signatures")
    # equal sets are one representative
    sets = signed.where("n > 0").groupBy("n", "fp1", "fp2").agg(
        F.min("id").alias("least"), F.min(F.struct("h", "g")).alias("text_key"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    reps = stored(sets.withColumn("id", F.monotonically_increasing_id()), "sets")
    buckets = stored(_buckets(reps), "buckets")
    sketch = reps.select("id", "n", "sketch")
    busy = reps.select("id", "text_key.h", "text_key.g").join(buckets.select("id").distinct(), "id", "left_semi")
    texts = docs.select(*_text_key(text_col), text_of(text_col).alias("text"))
    texts = texts.join(busy.select("h", "g"), ["h", "g"], "left_semi").dropDuplicates(["h", "g"])
    texts = stored(texts.join(busy, ["h", "g"]).select("id", "text"), "texts")

    # each member has one partner at most, of a lesser id: a forest
    labels = forest_roots(_verified(_star(buckets, sketch, similar_pct, bounds), texts, similar_pct))
    fuller = sketch.join(stored(bottoms(texts), "bottoms"), "id")
    for forest in (True, False):
        labels = stored(labels, "labels")
        told = stored(_mixed(buckets, labels, fuller, similar_pct, bounds, forest), "told")
        more = stored(_verified(told, texts, similar_pct), "links")
        links = more.count()
        if links:
            labels = _merged(labels, more)
        if forest and links == told.count():
            break  # every tree held, so every pair that was left out is joined

    of_set = reps.select("n", "fp1", "fp2", "least", F.col("id").alias("rep")).join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    of_set = stored(of_set.withColumn("component", F.coalesce("component", "rep")), "components")
    least = of_set.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = of_set.join(least, "component").select("n", "fp1", "fp2", "rep", "component", "component_id")
    out = signed.select("id", "n", "fp1", "fp2", *keep).join(of_set, ["n", "fp1", "fp2"], "left")
    return out.select("id", "n", "rep", "component", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"), *keep)


def near_duplicates(
    docs: DataFrame, similar_pct: int = SIMILAR_PCT, miss: float = MISS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` per row of ``docs``."""
    return _linked(docs, similar_pct, miss, id_col, text_col).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("component_id").eqNullSafe(F.col("id")).alias("kept")
    )


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links between nodes (which may have no label yet)."""
    def of(c: str):
        return labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_c"))

    raised = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("a_c", "a").alias("a"), F.coalesce("b_c", "b").alias("b")
    )
    over = connected_components(raised)
    moved = labels.join(over.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    moved = moved.select("node", F.coalesce("to", "component").alias("component"))
    fresh = over.join(labels.select("node"), "node", "left_anti")
    return moved.unionByName(fresh)


def drop_near_duplicates(
    docs: DataFrame, similar_pct: int = SIMILAR_PCT, miss: float = MISS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each group of near duplicates (that of the least id; null ids last), and all rows with empty sets."""
    row = "_near_dedup_row"
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    linked = _linked(numbered, similar_pct, miss, id_col, text_col, keep=(row,)).where("component IS NOT NULL")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", row)).alias("first")
    kept = linked.groupBy("component").agg(first).select(F.col(f"first.{row}").alias(row))
    gone = linked.select(row).join(kept, row, "left_anti")
    return numbered.join(gone, row, "left_anti").drop(row)
