"""Spelling variant grouping (11): k-d trees over letter-count vectors, box-pruned range search.

Two words are near if one code point inserted, deleted or replaced turns one into the other. A
replacement raises one letter count and lowers another, an insertion raises one: near words of equal
length differ by 2 in L1, of neighbouring lengths by 1.

1. *Words.* Runs of letters are counted per document and batch, thinned by the stated rule, and summed
   by Spark with partial aggregation. Words of enough letters and occurrences are the vocabulary.
2. *Cells.* For each length a k-d tree over the count vectors cuts the vocabulary into cells of about CELL
   words. Its splits come from a bounded sample (about SAMPLE words, those of the least hashes); they decide only how
   evenly the cells are filled. A cell that holds more than twice as many is dealt over several units.
3. *Range searches.* For each length pair (L, L) and (L, L + 1) a word visits the units whose box can hold a near word: a
   box that takes more than one count up or more than one down (any down, for L + 1) is pruned. Of two units of one
   length only the lesser visits the greater, so a pair is seen once.
4. *In a unit* a k-d tree over the distinct vectors of its words takes the visitors batch by batch; where
   vectors are close enough the letters' order is verified. Both words of a pair are credited there:
   the number of near words, and the most frequent one. These sums are added by word, so no pair is ever a row.
5. A word's form is its most frequent near word, if that is at least twice as frequent; roots come by pointer doubling.

Defined cases: null and empty texts have no words; a null id counts as the text ``null``; repeated rows
count each; words of any length take part; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import on_workers, runs, stored, text_of
from envflow.llm.components import forest_roots

LEAST_LENGTH, LEAST_COUNT = 5, 3
#: One run in THIN of a document loses a code point.
THIN = 97
#: A form has at least FORM_TIMES the occurrences of its variant.
FORM_TIMES = 2
#: Words of a cell; words that the splits are taken from; distinct vectors of a leaf within a unit.
CELL, SAMPLE, LEAF = 4000, 100_000, 32
#: Text in one Arrow step, and pairs of words verified at once.
STEP_BYTES, PAIRS = 1 << 22, 1 << 20
DIMENSIONS = 26 + 64


# ---------------------------------------------------------------- words
def moved_on(crc: np.ndarray, n: int, tables: dict) -> np.ndarray:
    """What ``n`` more zero bytes make of CRC-32 values, as far as it depends on these (it is linear)."""
    if n not in tables:
        zero, start = bytes(n), zlib.crc32(bytes(n))
        tables[n] = np.array([[zlib.crc32(zero, v << 8 * k) ^ start for v in range(256)] for k in range(4)], dtype=np.uint32)
    t = tables[n]
    return t[0][crc & 255] ^ t[1][(crc >> 8) & 255] ^ t[2][(crc >> 16) & 255] ^ t[3][crc >> 24]


def counted(ids: list, texts: pa.Array, tables: dict) -> tuple[list[str], list[int]]:
    """Words and their occurrences in some documents, thinned."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), "[^a-zÀ-ÿ]+")
    doc = pc.list_parent_indices(parts).to_numpy()
    runs_ = pc.list_flatten(parts).dictionary_encode()
    words = runs_.dictionary.to_pylist()
    key, n = np.unique(doc.astype(np.int64) * len(words) + runs_.indices.to_numpy(), return_counts=True)
    doc, code = key // max(len(words), 1), key % max(len(words), 1)
    own = np.array([zlib.crc32(w.encode()) for w in words], dtype=np.uint32)
    size = np.array([len(w.encode()) for w in words], dtype=np.int64)
    length = np.array([len(w) for w in words], dtype=np.int64)
    start = np.array([zlib.crc32(f"{'null' if i is None else i}:".encode()) for i in ids], dtype=np.uint32)
    h = np.zeros(len(key), dtype=np.uint32)
    order = np.argsort(size[code], kind="stable")
    at, first = np.unique(size[code][order], return_index=True)
    for k, lo, hi in zip(at.tolist(), first.tolist(), [*first.tolist()[1:], len(order)]):
        i = order[lo:hi]
        h[i] = moved_on(start[doc[i]], k, tables) ^ own[code[i]]
    cut = (h % np.uint32(THIN) == 0) & (length[code] > 0)
    total = np.bincount(code[~cut], weights=n[~cut], minlength=len(words)).astype(np.int64)
    keep = np.flatnonzero((length >= LEAST_LENGTH) & (total > 0))
    out, times = [words[i] for i in keep], total[keep].tolist()
    for i in np.flatnonzero(cut).tolist():
        w = words[code[i]]
        k = int(h[i]) % len(w)
        if len(w) > LEAST_LENGTH:
            out.append(w[:k] + w[k + 1 :])
            times.append(int(n[i]))
    return out, times


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: words of at least LEAST_LENGTH code points and LEAST_COUNT occurrences."""

    def count(batches):
        tables: dict = {}
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            size = np.cumsum(pc.binary_length(texts).to_numpy()) // STEP_BYTES
            edges = [0, *(np.flatnonzero(size[1:] != size[:-1]) + 1).tolist(), len(ids)]
            for lo, hi in zip(edges[:-1], edges[1:]):
                words, n = counted(ids[lo:hi], texts.slice(lo, hi - lo), tables)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

    src = docs.select(F.col(id_col).cast("string").alias("id"), text_of(text_col).alias("text"))
    rows = on_workers(src).where("text <> ''").mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# ---------------------------------------------------------------- vectors and trees
def letters(words: list[str], length: int) -> np.ndarray:
    """The words' code points (all below 256), a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), length)


def vectors(chars: np.ndarray) -> np.ndarray:
    """Letter counts: a-z, then U+00C0 to U+00FF."""
    dim = np.where(chars < 128, chars - 97, chars.astype(np.int16) - 192 + 26).astype(np.int64)
    out = np.zeros((len(chars), DIMENSIONS), dtype=np.int16)
    rows = np.arange(len(chars))
    for j in range(chars.shape[1]):
        out[rows, dim[:, j]] += 1
    return out


class Tree:
    """A k-d tree over count vectors. A node is ``(dimension, count, left, right)``, with no more
    than that count to the left; a leaf is a number."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.leaves: list[np.ndarray] = []
        self.root = self._grown(points, np.arange(len(points)), leaf)

    def _grown(self, points: np.ndarray, at: np.ndarray, leaf: int):
        own = points[at]
        if len(at) > leaf:
            dim = int(np.argmax(own.astype(np.float32).var(axis=0)))
            counts = np.sort(own[:, dim])
            if counts[0] != counts[-1]:
                middle = counts[len(counts) // 2]
                split = int(middle if middle < counts[-1] and np.searchsorted(counts, middle, "right") * 2 <= len(counts) * 1.5 else middle - 1)
                split = max(split, int(counts[0]))
                low = own[:, dim] <= split
                return dim, split, self._grown(points, at[low], leaf), self._grown(points, at[~low], leaf)
        self.leaves.append(at)
        return len(self.leaves) - 1

    def reached(self, q: np.ndarray, up: int, down: int):
        """``(leaf, rows of q)`` for the leaves whose box a vector of ``q`` reaches by raising counts by
        ``up`` in all at most, and lowering them by ``down``."""
        zero = np.zeros(len(q), dtype=np.int16)
        stack = [(self.root, np.arange(len(q)), zero, zero, {}, {})]
        while stack:
            node, at, u, d, lo, hi = stack.pop()
            if not len(at):
                continue
            if isinstance(node, int):
                yield node, at
                continue
            dim, split, left, right = node
            x = q[at, dim]
            # the left box ends at split, the right one begins after it; what was paid for this dimension before counts
            more = np.maximum(x - split, 0) - (np.maximum(x - hi[dim], 0) if dim in hi else 0)
            ok = d + more <= down
            stack.append((left, at[ok], u[ok], (d + more)[ok], lo, hi | {dim: split}))
            more = np.maximum(split + 1 - x, 0) - (np.maximum(lo[dim] - x, 0) if dim in lo else 0)
            ok = u + more <= up
            stack.append((right, at[ok], (u + more)[ok], d[ok], lo | {dim: split + 1}, hi))


def own_leaf(tree: Tree, q: np.ndarray) -> np.ndarray:
    out = np.zeros(len(q), dtype=np.int64)
    for leaf, at in tree.reached(q, 0, 0):
        out[at] = leaf
    return out


# ---------------------------------------------------------------- within a unit
class Unit:
    """The words of a unit, and what they are credited with."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.length = len(words[0])
        v = vectors(letters(words, self.length))
        kinds, of = np.unique(v, axis=0, return_inverse=True)
        order = np.argsort(of.ravel(), kind="stable")
        self.words, self.n = [words[i] for i in order], n[order]
        self.chars = letters(self.words, self.length)
        self.lanes = lanes(self.chars)
        self.kinds, self.size = kinds, np.bincount(of.ravel(), minlength=len(kinds))
        self.begin = np.cumsum(self.size) - self.size
        self.tree = Tree(kinds, LEAF)
        self.near = np.zeros(len(words), dtype=np.int64)
        self.best = [(0, "")] * len(words)

    def pairs(self, kinds: np.ndarray, longer: bool):
        """``(rows of kinds, own kinds)`` whose vectors are as far apart as near words' are. ``longer``: the unit's
        words have one letter more."""
        for leaf, at in self.tree.reached(kinds, 1, 0 if longer else 1):
            own = self.tree.leaves[leaf]
            step = max(1, (1 << 22) // (len(own) * DIMENSIONS))
            for lo in range(0, len(at), step):
                rows = at[lo : lo + step]
                apart = np.abs(kinds[rows][:, None, :] - self.kinds[own][None, :, :]).sum(axis=2, dtype=np.int32)
                i, j = np.nonzero(apart == (1 if longer else 2))
                yield rows[i], own[j]

    def meet(self, visitors: "Unit", same: bool) -> None:
        """Credit the near pairs of the visitors' words and the unit's; ``same``: they are the unit's own."""
        longer = self.length > visitors.length
        for a, b in self.pairs(visitors.kinds, longer):
            if same:
                a, b = a[a < b], b[a < b]
            per = visitors.size[a] * self.size[b]
            cuts = np.searchsorted(np.cumsum(per), np.arange(PAIRS, per.sum() + PAIRS, PAIRS), side="left") + 1
            lo = 0
            for hi in [*cuts.tolist(), len(a)]:
                hi = min(hi, len(a))
                if hi > lo:
                    self._verify(visitors, a[lo:hi], b[lo:hi], per[lo:hi], longer)
                    lo = hi

    def _verify(self, visitors: "Unit", a, b, per, longer: bool) -> None:
        which = np.repeat(np.arange(len(a)), per)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(per) - per, per)
        i = visitors.begin[a][which] + inner // self.size[b][which]
        j = self.begin[b][which] + inner % self.size[b][which]
        ok = inserted(visitors.chars, self.chars, i, j) if longer else replaced(visitors.lanes, self.lanes, i, j)
        for x, y in zip(i[ok].tolist(), j[ok].tolist()):
            visitors.credit(x, self, y)
            self.credit(y, visitors, x)

    def credit(self, i: int, other: "Unit", j: int) -> None:
        self.near[i] += 1
        most, word = self.best[i]
        n, w = int(other.n[j]), other.words[j]
        if n > most or n == most and w < word:
            self.best[i] = (n, w)

    def told(self) -> pa.RecordBatch:
        at = np.flatnonzero(self.near).tolist()
        cols = [[self.words[i] for i in at], self.near[at].tolist(), [self.best[i][0] for i in at], [self.best[i][1] for i in at]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["word", "near", "best_n", "best"])


def lanes(chars: np.ndarray) -> np.ndarray:
    """Rows of letters as 64-bit words."""
    wide = -(-chars.shape[1] // 8) * 8
    out = np.zeros((len(chars), wide), dtype=np.uint8)
    out[:, : chars.shape[1]] = chars
    return out.view(np.uint64)


def replaced(p: np.ndarray, q: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the letters of rows ``i`` of ``p`` and ``j`` of ``q`` differ in exactly one place."""
    apart = np.zeros(len(i), dtype=np.uint8)
    for k in range(p.shape[1]):
        x = p[i, k] ^ q[j, k]
        x |= x >> np.uint64(4)
        x |= x >> np.uint64(2)
        x |= x >> np.uint64(1)
        apart = np.minimum(apart + np.bitwise_count(x & np.uint64(0x0101010101010101)), 2)
    return apart == 1


def inserted(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether row ``j`` of ``b`` is row ``i`` of ``a`` with one letter more."""
    x, y = a[i], b[j]
    ahead, behind = x == y[:, :-1], x == y[:, 1:]
    same = np.cumprod(ahead, axis=1, dtype=np.uint8).sum(axis=1)  # letters before the first difference
    after = np.cumprod(behind[:, ::-1], axis=1, dtype=np.uint8).sum(axis=1)
    return same + after >= x.shape[1]


# ---------------------------------------------------------------- distributed search
class Cells:
    """The top trees, one per length, and the units of their cells."""

    def __init__(self, lengths: dict[int, int], sample: list[str]):
        by: dict[int, list[str]] = {n: [] for n in lengths}
        for w in sample:
            by[len(w)].append(w)
        self.trees, self.first, cells = {}, {}, 0
        for n in sorted(lengths):
            share = max(1, CELL * len(by[n]) // max(lengths[n], 1))
            self.trees[n] = Tree(vectors(letters(by[n], n)) if by[n] else np.zeros((0, DIMENSIONS), dtype=np.int16), share)
            self.first[n] = cells
            cells += max(1, len(self.trees[n].leaves))
        self.units = np.ones(cells, dtype=np.int64)
        self.begin = np.arange(cells)

    def deal(self, sizes: dict[int, int]) -> None:
        """Several units for cells of more than two CELLs."""
        for cell, n in sizes.items():
            self.units[cell] = 1 if n <= 2 * CELL else -(-n // CELL)
        self.begin = np.cumsum(self.units) - self.units

    def of(self, words: list[str], v: np.ndarray, length: int) -> np.ndarray:
        return self.first[length] + own_leaf(self.trees[length], v)

    def placed(self, words: list[str]):
        """``(unit, role, row of words)``: role 0 where a word lives, 1 where it visits."""
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by.setdefault(len(w), []).append(i)
        for length, at in by.items():
            own, at = [words[i] for i in at], np.array(at)
            v = vectors(letters(own, length))
            cell = self.of(own, v, length)
            salt = np.fromiter((zlib.crc32(w.encode()) for w in own), dtype=np.int64, count=len(own))
            unit = self.begin[cell] + salt % self.units[cell]
            yield unit, 0, at
            for other, up, down in ((length, 1, 1), (length + 1, 1, 0)):
                if other not in self.trees:
                    continue
                for leaf, rows in self.trees[other].reached(v, up, down):
                    c = self.first[other] + leaf
                    for u in range(self.begin[c], self.begin[c] + self.units[c]):
                        to = rows if other != length else rows[unit[rows] < u]
                        if len(to):
                            yield np.full(len(to), u), 1, at[to]


def cells_of(vocab: DataFrame) -> Cells:
    """Trees from a bounded sample, units from counts of all words."""
    lengths = {r["k"]: r["n"] for r in vocab.groupBy(F.char_length("word").alias("k")).agg(F.count("*").alias("n")).collect()}
    whole, scale = max(1, sum(lengths.values())), 1 << 30
    some = vocab.where(F.pmod(F.xxhash64("word"), F.lit(scale)) <= scale * SAMPLE // whole)  # about SAMPLE words in all
    sample = [r[0] for r in some.select("word").collect()]
    cells = Cells(lengths, sample)

    def assign(batches):
        for b in batches:
            words = b.column(0).to_pylist()
            for length in {len(w) for w in words}:
                own = [w for w in words if len(w) == length]
                cell = cells.of(own, vectors(letters(own, length)), length)
                yield pa.RecordBatch.from_arrays([pa.array(cell)], names=["cell"])

    sizes = on_workers(vocab).select("word").mapInArrow(assign, "cell long").groupBy("cell").agg(F.count("*").alias("n"))
    cells.deal({r["cell"]: r["n"] for r in sizes.collect()})  # a row per cell
    return cells


def near_words(vocab: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of the words (``word, n``) that have near words."""
    cells = cells_of(vocab)

    def place(batches):
        for b in batches:
            words = b.column(0).to_pylist()
            for unit, role, at in cells.placed(words):
                rows = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unit), pa.array(np.full(len(at), role)), b.column(0).take(rows), b.column(1).take(rows)], names=["unit", "role", "word", "n"]
                )

    rows = on_workers(vocab).select("word", "n").mapInArrow(place, "unit long, role long, word string, n long")
    rows = rows.repartition("unit").sortWithinPartitions("unit", "role", F.char_length("word"))

    def search(batches):
        here, home, held = None, None, []

        def settled() -> Unit | None:
            if not held:
                return None
            t = pa.Table.from_batches(held)
            unit = Unit(t.column("word").to_pylist(), t.column("n").to_numpy())
            unit.meet(unit, True)
            return unit

        for _, part in runs(batches, 2):
            unit, role = part.column(0)[0].as_py(), part.column(1)[0].as_py()
            if unit != here:
                home = home or settled()  # of a unit without visitors
                if home:
                    yield home.told()
                here, home, held = unit, None, []
            if role == 0:  # its own words come first
                held.append(part)
                continue
            if held:
                home, held = settled(), []
            if home is None:
                continue
            words, n = part.column(2).to_pylist(), part.column(3).to_numpy()
            for length in sorted({len(w) for w in words}):
                at = [i for i, w in enumerate(words) if len(w) == length]
                visitors = Unit([words[i] for i in at], n[at])
                home.meet(visitors, False)
                yield visitors.told()
        home = home or settled()
        if home:
            yield home.told()

    credits = rows.mapInArrow(search, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w")))
    return credits.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.w").alias("best"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the vocabulary."""
    vocab = stored(vocabulary(docs, id_col, text_col), "words")
    rows = vocab.join(near_words(vocab), "word", "left")
    has = F.col("best_n") >= FORM_TIMES * F.col("n")
    rows = stored(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "forms")
    roots = forest_roots(rows.where("form IS NOT NULL").select(F.col("word").alias("a"), F.col("form").alias("b")))
    rows = rows.join(roots.select(F.col("node").alias("word"), F.col("component").alias("root")), "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
