"""License scans (9): winnowed fingerprints pick candidates, banded alignment decides.

1. A text's letters and digits (ASCII, lower case, nothing between them) are hashed in
   k-grams; of every ``WINDOW`` k-grams in a row the least hash is selected. Whatever shares
   ``K + WINDOW - 1`` such characters with a template shares a selected hash.
2. The templates' selected hashes are an inverted index (a fixed list of templates, so its
   size is fixed). A document's hits on a template, put in order of their diagonals
   (place in the text less place in the template), give candidate regions.
3. Each candidate region is aligned with the template, word by word, in a band around its
   diagonal, a row of the band at a time: matches score, gaps and replacements cost. The matched share of the
   template's words is the coverage, the first and last matched word the span.
   Regions whose words cannot reach the least coverage are not aligned (exact bounds: a
   template's word needs its like within the band).
4. A match must hold its template's deciding words (``license_templates.DECIDING``) in a
   row, so that a relative with a word more or less is not taken for it. Of overlapping
   matches the one with more matched words stays.

Map side only; no shuffle.

Defined cases: null text counts as empty; texts without matches give no rows; repeated rows
and null ids give their rows each; extra columns are ignored; an empty table gives none;
ties go to the higher coverage, then to the lesser template name.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envflow.llm.bpe import balanced
from envflow.llm.common import on_workers, text_of
from envflow.llm.license_templates import DECIDING, TEMPLATES
from envflow.llm.shingles import mixed

K, WINDOW = 8, 6
BAND = 12
#: Least share of the template's words that match, and of the span's words.
COVERAGE, DENSITY = 0.85, 0.8
#: A match's score, and what a gap and a replacement cost (the same: a template's word that has no match).
MATCH, GAP, REPLACE = 5, 2, 2
#: Regions of a text that are aligned with a template at once.
REGIONS = 64
#: Bits of a cell of the alignment below its score, and below its matched words; templates are shorter than 2 ** 20 words.
SCORE_BITS, MATCHED_BITS = 42, 21
SCORE, MATCHED = 1 << SCORE_BITS, 1 << MATCHED_BITS
BATCH_CHARS = 1 << 21

_WORD = re.compile(r"[A-Za-z0-9]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_DROPPED = bytes(b for b in range(256) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_BETWEEN = b"\0" * K
_MOST = np.uint64(2**64 - 1)


def normalized(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER, _DROPPED)


def selected(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed k-grams of texts joined by _BETWEEN: places and hashes."""
    n = len(data) - K + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = np.ndarray(n, dtype="<u8", buffer=data, strides=(1,))
    zero = np.frombuffer(data, np.uint8) == 0
    across = np.cumsum(np.concatenate(([0], zero)))
    h = np.where(across[K:] > across[:n], _MOST, mixed(grams) >> np.uint64(1))
    least = h.copy()  # over the windows that end WINDOW - 1 places later
    for i in range(1, min(WINDOW, n)):
        np.minimum(least[: n - i], h[i:], out=least[: n - i])
    stay = np.zeros(n, dtype=bool)
    for i in range(min(WINDOW, n)):  # a k-gram is selected if it is the least of a window
        stay[i:] |= h[i:] == least[: n - i]
    at = np.flatnonzero(stay & (h != _MOST))
    return at, h[at]


@dataclass
class Index:
    """The templates' words, and their selected hashes in order with owner and word."""

    names: list[str]
    vocab: dict[str, int]
    words: list[np.ndarray]  # numbers in vocab
    sizes: list[np.ndarray]  # characters of a template's least words, cumulated
    deciding: list[list[np.ndarray]]  # runs of words that a match has to hold
    hashes: np.ndarray
    owner: np.ndarray
    word: np.ndarray

    @classmethod
    def of(cls, templates: dict[str, str]) -> Index:
        names = sorted(templates)
        found = [selected(normalized(templates[n])) for n in names]
        h = np.concatenate([x[1] for x in found]) if found else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(names)), [len(x[0]) for x in found])
        place = np.concatenate([x[0] for x in found]) if found else np.empty(0, np.int64)
        texts = [[w.lower() for w in _WORD.findall(templates[n])] for n in names]
        lengths = [np.array([len(w) for w in t], dtype=np.int64) for t in texts]
        at = [np.searchsorted(np.cumsum(n), x[0], side="right") for n, x in zip(lengths, found)]
        word = np.concatenate(at) if found else np.empty(0, np.int64)
        order = np.lexsort((place, owner, h))
        vocab: dict[str, int] = {}
        words = [np.array([vocab.setdefault(w, len(vocab)) for w in t], dtype=np.int32) for t in texts]
        deciding = []
        for n, own in zip(names, words):
            runs = [[vocab.get(w, -1) for w in run.split()] for run in DECIDING.get(n, "").split("|")]
            runs = [np.array(run, dtype=np.int32) for run in runs if run]
            deciding.append([run for run in runs if holds(own, run)])
        return cls(names, vocab, words, [np.cumsum(np.sort(n)) for n in lengths], deciding, h[order], owner[order], word[order])

    def least_chars(self, least: float) -> np.ndarray:
        """Characters that a text must have at least to match each template."""
        need = [max(1, math.ceil(least * len(n))) for n in self.sizes]
        return np.array([n[min(k, len(n)) - 1] if len(n) else 0 for k, n in zip(need, self.sizes)], dtype=np.int64)


def holds(words: np.ndarray, run: np.ndarray) -> bool:
    if len(words) < len(run):
        return False
    starts = np.flatnonzero(words[: len(words) - len(run) + 1] == run[0])
    return any((words[s : s + len(run)] == run).all() for s in starts)


def band_of(template: np.ndarray) -> int:
    """Short templates get narrow bands, so that neighbouring copies stay apart."""
    return min(BAND, max(2, len(template) // 4))


def reach(words: np.ndarray, template: np.ndarray, start: int) -> int:
    """No alignment in the band matches more words: the template's words with their like in it."""
    band = band_of(template)
    lo, hi = start - band, start + len(template) + band
    own = words[max(0, lo) : max(0, hi)]
    near = np.full(hi - lo, -1, dtype=np.int32)
    near[max(0, -lo) : max(0, -lo) + len(own)] = own
    return int((np.lib.stride_tricks.sliding_window_view(near, 2 * band + 1) == template[:, None]).any(axis=1).sum())


def align(words: np.ndarray, template: np.ndarray, starts: list[int]) -> list[tuple[int, int, int] | None]:
    """Banded alignment of the template with ``words`` from about each of ``starts`` on: matched words,
    first and last matched word; None where nothing matches. Row i of a band holds words
    start + i - band .. start + i + band; the rows i of all bands are filled at once.

    A cell is one number: score, matched words and first matched word (plus 1, counted from the band's
    start), most significant first, so that the greatest number is the best cell. A cell without matches has
    lost a gap per template word wherever it stands: text before the first match is free.
    """
    band = band_of(template)
    width, rows = 2 * band + 1, len(template)
    padded = np.full(len(words) + 2 * (rows + width), -1, dtype=np.int32)  # -1 is no template's word
    padded[rows + width : rows + width + len(words)] = words
    low = np.array(starts, dtype=np.int64) - band  # the word at the first place of the first row
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)
    place = np.arange(width, dtype=np.int64)
    slope = place * (GAP * SCORE)
    cell = np.zeros((len(starts), width), dtype=np.int64)
    best = [0] * len(starts)
    found: list = [None] * len(starts)
    at = np.clip(low + rows + width, 0, len(windows) - rows)
    for i, word in enumerate(template):
        same = windows[at + i] == word
        through = cell - REPLACE * SCORE  # a text word and the template's word
        hits = same.any()
        if hits:
            fresh = (cell & (SCORE - 1)) == 0
            through = np.where(same, cell + (MATCH * SCORE + MATCHED) + fresh * (place + (i + 1)), through)
        np.maximum(through[:, :-1], cell[:, 1:] - GAP * SCORE, out=through[:, :-1])  # the template's word alone
        cell = np.maximum.accumulate(through + slope, axis=1) - slope  # text words alone
        np.maximum(cell, -(i + 1) * GAP * SCORE, out=cell)
        if not hits:
            continue
        for r, top in enumerate((cell.max(axis=1) >> SCORE_BITS).tolist()):
            if top > best[r]:  # a cell that is better than all before it ends in a match
                j = int(np.argmax(cell[r] >> SCORE_BITS))
                rest = int(cell[r, j]) & (SCORE - 1)
                best[r] = top
                found[r] = (rest >> MATCHED_BITS, int(low[r]) + (rest & (MATCHED - 1)) - 1, int(low[r]) + i + j)
    return found


def matches(text: str, owner: np.ndarray, at: np.ndarray, word_in: np.ndarray, index: Index, least: float) -> list[tuple[str, int, int, float, int]]:
    """(template, start, end, coverage, matched words) from hits on the normalized text: their
    templates, places in the text and words of the template."""
    spans = [m.span() for m in _WORD.finditer(text)]
    words = np.array([index.vocab.get(text[a:b].lower(), -1) for a, b in spans], dtype=np.int32)
    ends = np.cumsum([b - a for a, b in spans])
    # the word of the text that the template would start with, were nothing changed
    first_word = np.searchsorted(ends, at, side="right") - word_in
    found = []
    for t in np.unique(owner).tolist():
        template, done = index.words[t], None
        band, need = band_of(template), max(1, least * len(template))
        known = np.concatenate(([0], np.cumsum(np.isin(words, template))))
        if known[-1] < need:
            continue
        exact, near = [], []
        for s in np.unique(first_word[owner == t]).tolist():
            if done is not None and s - done <= band // 2:
                continue  # the same region: this diagonal is within its band
            done = s
            lo, hi = max(0, s - band), max(0, min(len(words), s + len(template) + band))
            if hi <= lo or known[hi] - known[lo] < need or reach(words, template, s) < need:
                continue
            if s >= 0 and np.array_equal(words[s : s + len(template)], template):
                exact.append((len(template), s, s + len(template) - 1))
            else:
                near.append(s)
        for begin in range(0, len(near), REGIONS):
            exact += [x for x in align(words, template, near[begin : begin + REGIONS]) if x]
        for m, first, last in exact:
            if m >= max(need, DENSITY * (last - first + 1)) and all(holds(words[first : last + 1], x) for x in index.deciding[t]):
                found.append((m, m / len(template), index.names[t], first, last))
    found.sort(key=lambda x: (-x[0], -x[1], x[2], x[3]))
    kept: list = []
    taken = bytearray(len(words))
    for m, share, name, first, last in found:
        if 1 not in taken[first : last + 1]:
            taken[first : last + 1] = b"\1" * (last + 1 - first)
            kept.append((name, spans[first][0], spans[last][1], share, m))
    return sorted(kept, key=lambda x: (x[1], x[2], x[0]))


def scan_texts(texts: list[str], index: Index, least: float) -> list[list[tuple[str, int, int, float, int]]]:
    streams = [normalized(t) for t in texts]
    sizes = np.array([len(s) + K for s in streams], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    at, h = selected(_BETWEEN.join(streams) + _BETWEEN)
    lo, hi = np.searchsorted(index.hashes, h, "left"), np.searchsorted(index.hashes, h, "right")
    hit = np.flatnonzero(hi > lo)
    lo, n = lo[hit], (hi - lo)[hit]
    entry = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
    at = np.repeat(at[hit], n)
    doc = np.searchsorted(begins, at, "right") - 1
    owner = index.owner[entry]
    able = np.flatnonzero((sizes - K)[doc] >= index.least_chars(least)[owner])
    at = (at - begins[doc])[able]
    doc, owner, word = doc[able], owner[able], index.word[entry[able]]
    out: list = [[] for _ in texts]
    edges = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1], [True]))) if len(doc) else []
    for a, b in zip(edges[:-1], edges[1:]):
        out[doc[a]] = matches(texts[doc[a]], owner[a:b], at[a:b], word[a:b], index, least)
    return out


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    least: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per match: ``id_col, license, start, end`` (code points), ``coverage, matched_words``."""
    index = Index.of(TEMPLATES if templates is None else templates)
    src = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = b.column("_text").to_pylist()
            rows = []
            for lo, hi in balanced(texts, BATCH_CHARS):
                for i, found in enumerate(scan_texts(texts[lo:hi], index, least), lo):
                    rows += [(i, *x) for x in found]
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            arrays = [pa.array(list(c), k) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays(
                [b.column("_id").take(arrays[0]), *arrays[1:]], names=["_id", "license", "start", "end", "coverage", "matched_words"]
            )

    out = on_workers(src).mapInArrow(run, f"_id {kind}, license string, start long, end long, coverage double, matched_words long")
    return out.withColumnRenamed("_id", id_col)
