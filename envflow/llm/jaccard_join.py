"""N-gram Jaccard join (12): size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

Two documents link when their sets of 4-word shingles have a Jaccard similarity of 0.85 or more.

1. Equal texts become one node (grouped with map-side aggregation, so a text that a third of all
   rows repeat is collapsed before the shuffle). A node's set is a sorted array of 64-bit hashes.
2. *Tiles.* Sizes are cut into bands; linked sets lie in the same band or in neighbouring ones, and a set
   near its band's end also enters the next one's tiles. Comparing all of a band would be
   quadratic, so a band is cut by content, without loss: its hash space has ``k`` parts. Linked sets
   of sizes a <= b differ in at most ``d = a (1 - s) / s`` shingles, which touch at most ``d`` parts; so of
   the first ``d + 1`` parts that a set fills, one at least is the same in both. Each of
   these is a tile (band, part, hash of its content). A set that fills fewer enters all of them, and the tiles of
   another hash function; after SALTS of them one tile of its band takes it.
3. *Bitmaps.* A set is also a bitmap: every shingle flips the bit it is hashed to. A shingle that only one of two sets
   has changes one bit at most, so the bits in which two bitmaps differ bound the difference of the sets from
   below, and with their sizes the overlap from above. The bound is hardly loosened by the size of the sets, only by their difference.
4. *Star round:* every node of a tile meets the tile's least node, and keeps the leader whose bound is best.
5. *Rest:* tiles that still hold more than one component are compared by bitmaps in blocks of bounded
   size: first a spanning forest of what the bounds allow, then all that is left.
6. What the bounds allow is verified on the sorted arrays. Rows meet there by leader, and the members of a
   leader are dealt over groups of GROUP, so a leader's text is sent once a group and no task has them all.

Defined cases: a text without words, or null, has an empty set and no links; repeated rows and equal ids
are rows of their own, each linked by its own text; null ids take part in links but are never a
component's id (null, where all ids are); extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import on_workers, runs, stored, text_of, whole_runs
from envflow.llm.components import connected_components, forest_roots
from envflow.llm.shingles import WordHashes, mixed, shingle_hashes, words_of

SIMILAR_PCT, SHINGLE = 85, 4
#: Hash functions tried for a set that fills too few parts.
SALTS = 8
#: Widths of bitmaps in bits: the power of two from BITS_PER times the size on, within these bounds.
BITS_PER, LEAST_BITS, MOST_BITS = 3, 64, 1 << 15
#: Nodes of a tile compared in one block; members verified against one copy of their leader's text.
BLOCK, GROUP = 2048, 1000
_U64 = np.uint64


def set_of(text: str, memo: WordHashes, size: int = SHINGLE) -> np.ndarray:
    return np.unique(shingle_hashes(words_of(text), memo, size))


class Bands:
    """Bands of set sizes, a factor of 1.5 (or 1 / similarity) wide, and the parts of each."""

    def __init__(self, pct: int = SIMILAR_PCT):
        self.pct, self.edges = pct, [1]
        wide = max(3 * pct, 200)
        while self.edges[-1] < 1 << 40:
            e = self.edges[-1]
            self.edges.append(max(e + 1, -(-e * wide // (2 * pct))))

    def differing(self, n: int) -> int:
        """Most shingles by which a set of ``n`` and one that it is linked with differ."""
        return n * (100 - self.pct) // self.pct

    def of(self, n: int) -> list[int]:
        """The bands whose tiles a set of ``n`` enters."""
        b = int(np.searchsorted(self.edges, n, side="right")) - 1
        return [b, b + 1] if n * 100 // self.pct >= self.edges[b + 1] else [b]

    def parts(self, b: int) -> int:
        d = self.differing(self.edges[b + 1] - 1)
        return -(-115 * (d + 1) // 100) + 1 if d else 1


def tiles(s: np.ndarray, bands: Bands) -> np.ndarray:
    """The tiles of a set, as 64-bit hashes."""
    out, need = [], bands.differing(len(s)) + 1
    for b in bands.of(len(s)):
        k = bands.parts(b)
        for salt in range(SALTS):
            h = mixed(s, 0x71E5 + 1009 * b + salt)
            part = ((h >> _U64(32)) * _U64(k)) >> _U64(32)
            order = np.argsort(part, kind="stable")
            part = part[order]
            starts = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1))
            content = np.add.reduceat(mixed(h, 0xC0)[order], starts)
            out.append(mixed(content + part[starts] * _U64(0x9E3779B97F4A7C15), 0xA11 + 4096 * b + salt)[:need])
            if len(starts) >= need:
                break
        else:
            out.append(mixed(np.array([b], dtype=_U64), 0xFEE1))
    return np.concatenate(out)


def bitmap(s: np.ndarray) -> np.ndarray:
    """The set as a bitmap, in 64-bit words."""
    width = min(max(LEAST_BITS, 1 << (BITS_PER * len(s) - 1).bit_length()), MOST_BITS)
    flips = np.bincount((mixed(s, 0xB175) & _U64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits(flips & 1, bitorder="little").view("<u8")


def folded(rows: list[bytes], words: int) -> np.ndarray:
    """Bitmaps as a matrix of ``words`` 64-bit words; wider ones are folded by halves."""
    out = np.empty((len(rows), words), dtype=_U64)
    for i, r in enumerate(rows):
        w = np.frombuffer(r, dtype="<u8")
        while len(w) > words:
            w = w[: len(w) // 2] ^ w[len(w) // 2 :]
        out[i] = w
    return out


def most_overlap(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """No pair of sets of sizes ``n`` and ``m`` with these bitmaps has a larger intersection."""
    differ = np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)
    return np.minimum((n + m - differ) // 2, np.minimum(n, m))


def signatures(texts: DataFrame, similar_pct: int = SIMILAR_PCT, size: int = SHINGLE) -> DataFrame:
    """``node, n, bits, tiles`` per row of ``texts`` (``node, text``); empty sets have neither."""

    def sign(batches):
        memo, bands = WordHashes(), Bands(similar_pct)
        for b in batches:
            n, bits, own = [], [], []
            for t in b.column(1):
                s = set_of(t.as_py(), memo, size)
                n.append(len(s))
                bits.append(bitmap(s).tobytes() if len(s) else None)
                own.append(tiles(s, bands).astype("<u8").tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(bits, pa.binary()), pa.array(own, pa.binary())], names=["node", "n", "bits", "tiles"]
            )

    return on_workers(texts).select("node", "text").mapInArrow(sign, "node long, n long, bits binary, tiles binary")


def shared_tiles(signed: DataFrame) -> DataFrame:
    """``tile, leader, node``: the nodes of every tile but its least, which is the leader."""

    def spread(batches):
        for b in batches:
            blobs = b.column(0).to_pylist()
            at = pa.array(np.repeat(np.arange(len(blobs)), [len(x) // 8 for x in blobs]))
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(blobs), dtype="<i8")), b.column(1).take(at)], names=["tile", "node"])

    def meet(batches):
        last = None  # tile and leader of the run that goes on
        for b in batches:
            tile, node = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(tile):
                continue
            new = np.concatenate(([last is None or tile[0] != last[0]], tile[1:] != tile[:-1]))
            first = np.maximum.accumulate(np.where(new, np.arange(len(tile)), -1))
            leader = np.where(first < 0, last[1] if last else 0, node[first])
            other = node != leader
            yield pa.RecordBatch.from_arrays([pa.array(x[other]) for x in (tile, leader, node)], names=["tile", "leader", "node"])
            last = (tile[-1], leader[-1])

    rows = on_workers(signed).where("n > 0").select("tiles", "node").mapInArrow(spread, "tile long, node long")
    return rows.repartition("tile").sortWithinPartitions("tile", "node").mapInArrow(meet, "tile long, leader long, node long")


def _sizes_allow(n: str, m: str, pct: int):
    return F.least(n, m) * 100 >= F.greatest(n, m) * pct


def _stars(shared: DataFrame, signed: DataFrame, pct: int) -> DataFrame:
    """``a, b``: each node with the leader of one of its tiles whose bound is best, if any bound allows a link."""
    pairs = shared.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    own = signed.select("node", "n", "bits")
    both = pairs.join(own.toDF("a", "n", "x"), "a").join(own.toDF("b", "m", "y"), "b").where(_sizes_allow("n", "m", pct))

    def bound(batches):
        for r in batches:
            a, b, n, m = (r.column(i).to_numpy() for i in (0, 1, 2, 3))
            x, y = r.column(4).to_pylist(), r.column(5).to_pylist()
            words = np.fromiter((min(len(p), len(q)) // 8 for p, q in zip(x, y)), dtype=np.int64, count=len(x))
            most = np.zeros(len(a), dtype=np.int64)
            for w in np.unique(words).tolist():
                at = np.flatnonzero(words == w)
                for lo in range(0, len(at), 1 + (1 << 18) // w):
                    i = at[lo : lo + 1 + (1 << 18) // w]
                    most[i] = most_overlap(folded([x[j] for j in i], w), folded([y[j] for j in i], w), n[i], m[i])
            union = n + m - most
            keep = np.flatnonzero(100 * most >= pct * union)
            score = (most * 1_000_000 // np.maximum(union, 1))[keep]
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep]), pa.array(score)], names=["a", "b", "score"])

    found = on_workers(both).select("a", "b", "n", "m", "x", "y").mapInArrow(bound, "a long, b long, score long")
    return found.groupBy("a").agg(F.max(F.struct("score", "b")).alias("s")).select("a", F.col("s.b").alias("b"))


def _verified(pairs: DataFrame, texts: DataFrame, pct: int, size: int) -> DataFrame:
    """The ``pairs`` (``a, b``) whose sets are similar enough, by intersection of their sorted arrays."""
    groups = pairs.groupBy("b").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
    members = pairs.join(groups, "b").select("b", F.pmod(F.xxhash64("a"), F.col("groups")).cast("int").alias("g"), "a")
    members = members.join(texts.select(F.col("node").alias("a"), "text"), "a").select("b", "g", "a", "text")
    leaders = groups.select("b", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"))
    leaders = leaders.join(texts.select(F.col("node").alias("b"), "text"), "b").select("b", "g", F.lit(-1).cast("long").alias("a"), "text")
    rows = leaders.unionByName(members).repartition("b", "g").sortWithinPartitions("b", "g", "a")

    def check(batches):
        memo, leader = WordHashes(), None
        for new, part in runs(batches, 2):
            nodes, texts_ = part.column(2).to_numpy(), part.column(3)
            begin = 0
            if new:
                leader, begin = set_of(texts_[0].as_py(), memo, size), 1
            keep = []
            for i in range(begin, len(nodes)):
                s = set_of(texts_[i].as_py(), memo, size)
                both = len(np.intersect1d(s, leader, assume_unique=True))
                if both and 100 * both >= pct * (len(s) + len(leader) - both):
                    keep.append(i)
            if keep:
                at = pa.array(keep)
                yield pa.RecordBatch.from_arrays([part.column(2).take(at), part.column(0).take(at)], names=["a", "b"])

    return on_workers(rows).mapInArrow(check, "a long, b long")


def _rest(shared: DataFrame, labels: DataFrame, signed: DataFrame, pct: int, forest: bool) -> DataFrame:
    """``a, b``: pairs of different components within a tile that the bounds allow, found block by block;
    with ``forest`` only so many as join what could be joined."""
    of = labels.select("node", "component")
    own = shared.join(of, "node", "left").select("tile", "leader", "node", F.coalesce("component", "node").alias("c"))
    seen = own.groupBy("tile").agg(F.first("leader").alias("leader"), F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("k"))
    seen = seen.join(of.toDF("leader", "component"), "leader", "left").withColumn("lead_c", F.coalesce("component", "leader"))
    seen = seen.where("lo <> hi OR lo <> lead_c").withColumn("blocks", F.ceil((F.col("k") + 1) / BLOCK).cast("int"))
    seen = stored(seen.select("tile", "leader", "lead_c", "blocks"), "mixed")
    rows = own.select("tile", "node", "c").join(seen.select("tile", "blocks"), "tile")
    rows = rows.unionByName(seen.select("tile", F.col("leader").alias("node"), F.col("lead_c").alias("c"), "blocks"))
    rows = rows.join(signed.select("node", "n", "bits"), "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("tile", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "node", "c", "n", "bits")
    rows = rows.repartition("tile", "x", "y").sortWithinPartitions("tile", "x", "y")

    def compare(batches):
        for t in whole_runs(batches, 3):
            block, node, c, n = (t.column(i).to_numpy() for i in (3, 4, 5, 6))
            across = t.column(1)[0].as_py() != t.column(2)[0].as_py()
            blobs = t.column(7).to_pylist()
            bits = folded(blobs, min(map(len, blobs)) // 8)
            a, b, score = [], [], []
            for i in range(len(node) - 1):
                m = n[i + 1 :]
                ok = (c[i + 1 :] != c[i]) & (np.minimum(m, n[i]) * 100 >= np.maximum(m, n[i]) * pct)
                if across:
                    ok &= block[i + 1 :] != block[i]
                j = np.flatnonzero(ok) + i + 1
                if len(j):
                    most = most_overlap(bits[i], bits[j], n[i], n[j])
                    good = 100 * most >= pct * (n[i] + n[j] - most)
                    j, most = j[good], most[good]
                    a += [i] * len(j)
                    b += j.tolist()
                    score += (most / (n[i] + n[j] - most)).tolist()
            if forest:
                kept = spanning(a, b, score, c)
                a, b = [a[i] for i in kept], [b[i] for i in kept]
            p, q = node[np.array(a, dtype=np.int64)], node[np.array(b, dtype=np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(p, q)), pa.array(np.minimum(p, q))], names=["a", "b"])

    return on_workers(rows).mapInArrow(compare, "a long, b long").distinct()


def spanning(a: list[int], b: list[int], score: list[float], c: np.ndarray) -> list[int]:
    """Of the pairs, best first, those that join components of ``c`` not joined yet."""
    root: dict = {}

    def find(v):
        while (up := root.get(v, v)) != v:
            root[v] = root.get(up, up)
            v = up
        return v

    kept = []
    for i in sorted(range(len(a)), key=lambda i: -score[i]):
        p, q = find(int(c[a[i]])), find(int(c[b[i]]))
        if p != q:
            root[max(p, q)] = min(p, q)
            kept.append(i)
    return kept


def _components(signed: DataFrame, texts: DataFrame, pct: int, size: int) -> DataFrame:
    """``node, component`` of the nodes that have a link."""
    shared = stored(shared_tiles(signed), "tiles")
    busy = shared.select("node").unionByName(shared.select(F.col("leader").alias("node"))).distinct()
    texts = stored(texts.join(busy, "node", "left_semi").select("node", "text"), "busy")
    stars = stored(_stars(shared, signed, pct), "stars")
    # a node has one leader at most, of a lesser number: a forest
    labels = stored(forest_roots(_verified(stars, texts, pct, size)), "labels")
    for forest in (True, False):
        told = stored(_rest(shared, labels, signed, pct, forest), "told")
        links = stored(_verified(told, texts, pct, size), "links")
        held, tried = links.count(), told.count()
        if held:
            edges = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)
            labels = stored(connected_components(edges), "labels")
        if held == tried:
            break  # every tree held, so every pair that was left out is joined
    return labels


def jaccard_components(
    docs: DataFrame, similar_pct: int = SIMILAR_PCT, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, n_shingles, component_id`` per row of ``docs``."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.hash(text).alias("g"), text.alias("text"))
    texts = rows.groupBy("h", "g").agg(F.first("text").alias("text"), F.min("id").alias("least"))
    texts = stored(texts.withColumn("node", F.monotonically_increasing_id()), "texts")
    signed = stored(signatures(texts, similar_pct, size), "signed")
    labels = _components(signed, texts, similar_pct, size)
    of_node = texts.select("h", "g", "node", "least").join(signed.select("node", "n"), "node").join(labels, "node", "left")
    of_node = of_node.withColumn("component", F.coalesce("component", "node"))
    least = of_node.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = of_node.join(least, "component").select("h", "g", "n", "component_id")
    out = rows.select("id", "h", "g").join(of_node, ["h", "g"])
    own = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))
