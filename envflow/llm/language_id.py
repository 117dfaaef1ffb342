"""Language ID (8): sparse multinomial logistic regression on TF-IDF character n-grams.

1. Features: hashed n-grams (2 and 3) of the lower-cased text's letters, all else a space;
   sublinear counts times inverse document frequency, scaled to length 1 over the n-grams
   that the sample has. Document frequencies and languages are counted over every document to learn from, in one pass.
2. Training: follow-the-regularised-leader (FTRL-proximal) with elastic-net penalties on
   at most SAMPLE_PER_LANG labelled documents per language and about SAMPLE in all, taken by hash order
   in one more pass (the bound of this fit; a fifth of them calibrates). Every language is learned; weights
   have at most MODEL_CELLS entries: with more languages n-grams share weights, and more than
   MODEL_CELLS / LEAST_FEATURES languages are an error.
3. Calibration: one temperature that minimises the log loss of the calibration part.
4. Prediction: every whole text, map side, with the model broadcast (its size is
   features x languages, whatever the data).
5. Rejection: by the share of a text's TF-IDF mass on n-grams that the sample of its best
   language has (n-grams that no language has count in full), so that it means the same
   for any number of languages, and by the score's margin over 1 / languages.

Defined cases: a null text or one without letters is ``und`` with score 0; so is everything
when there is nothing to learn from; repeated rows and null ids give a row each (null
ids are not learned from, ``held_out`` false); extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envflow.llm.bpe import balanced
from envflow.llm.common import on_workers, text_of

UNKNOWN = "und"
ORDERS = (2, 3)
FEATURE_BITS = 18
FEATURES = 1 << FEATURE_BITS
SAMPLE_PER_LANG, SAMPLE = 2500, 40_000
MODEL_CELLS, LEAST_FEATURES = 1 << 24, 1 << 12
CALIBRATION_SHARE = 5  # every fifth document of the sample
EPOCHS, ALPHA, BETA, L1, L2 = 3, 2.0, 1.0, 1e-4, 1e-4
_U = np.uint32
_FACTORS = (_U(0x9E3779B1), _U(0x85EBCA77), _U(0xC2B2AE3D), _U(0x27D4EB2F))
#: Rejection: least known share, texts counting as SURE n-grams longer, all known (a word or two tell little);
#: least part of the way from 1 / languages to 1 that the score has to go.
LEAST_KNOWN, SURE, LEAST_MARGIN = 0.7, 8, 0.1
BATCH_CHARS = 1 << 19

_LETTER_BITS: list = []


def _is_letter() -> np.ndarray:
    """Whether a code point is a letter (categories L and M), for all code points."""
    if not _LETTER_BITS:
        import unicodedata

        flags = np.fromiter((unicodedata.category(chr(i))[0] in "LM" for i in range(0x110000)), dtype=bool, count=0x110000)
        _LETTER_BITS.append(flags)
    return _LETTER_BITS[0]


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, feature numbers and counts of the texts' n-grams, sorted; no entry without letters."""
    low = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in low], dtype=np.int64) + 2
    joined = "".join(f" {t} " for t in low)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").copy()
    row = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    letter = _is_letter()[code]
    code[~letter] = 32
    # one space between words
    stay = letter | np.concatenate(([True], letter[:-1])) | np.concatenate(([True], row[1:] != row[:-1]))
    code, row, letter = code[stay], row[stay], letter[stay]
    keys = []
    for n in ORDERS:
        if len(code) < n:
            continue
        m = len(code) - n + 1
        h = np.full(m, n, dtype=_U)
        some = np.zeros(m, dtype=bool)
        for i in range(n):
            h = (h ^ code[i : m + i]) * _FACTORS[i]
            h ^= h >> _U(15)
            some |= letter[i : m + i]
        h = (h * _FACTORS[3]) >> _U(32 - FEATURE_BITS)
        ok = some & (row[:m] == row[n - 1 : n - 1 + m])
        keys.append((row[:m][ok] << FEATURE_BITS) | h[ok])
    key = np.sort(np.concatenate(keys)) if keys else np.empty(0, np.int64)
    if not len(key):
        return key, key, key
    cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.concatenate((cut, [len(key)])))
    key = key[cut]
    return key >> FEATURE_BITS, key & (FEATURES - 1), count


def weighted(row: np.ndarray, feature: np.ndarray, count: np.ndarray, idf: np.ndarray, rows: int) -> np.ndarray:
    """TF-IDF values, every row scaled to length 1."""
    x = (1 + np.log(count)) * idf[feature]
    norm = np.sqrt(np.bincount(row, weights=x * x, minlength=rows))
    return x / np.where(norm[row] > 0, norm[row], 1)


def folded(feature: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features, in order, and the sums of their values."""
    own, at = np.unique(feature, return_inverse=True)
    return own, np.bincount(at, weights=x, minlength=len(own))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray  # FEATURES
    seen: np.ndarray  # languages x FEATURES / 8: bits of the n-grams that a language's sample has
    weights: np.ndarray  # 2^bits + 1 (bias) x languages
    temperature: float
    shift: int  # an n-gram's weights are those of its number without so many bits

    def logits(self, texts: list[str], found: tuple | None = None) -> np.ndarray:
        row, feature, count = found or features(texts)
        x = weighted(row, feature, count, self.idf * self.learned(), len(texts))
        out = np.empty((len(texts), len(self.languages)))
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(row, weights=x * self.weights[feature >> self.shift, k], minlength=len(texts))
        return out + self.weights[-1]

    def learned(self) -> np.ndarray:
        """N-grams of the sample: those that nothing was learned about have no part in a text's length."""
        return np.unpackbits(np.bitwise_or.reduce(self.seen, axis=0)).astype(bool)

    def probabilities(self, texts: list[str], found: tuple | None = None) -> np.ndarray:
        return softmax(self.logits(texts, found) / self.temperature)

    def known(self, texts: list[str], best: np.ndarray, found: tuple | None = None) -> np.ndarray:
        """Of each text the share of TF-IDF mass on n-grams of the language ``best``; see SURE."""
        row, feature, count = found or features(texts)
        mass = ((1 + np.log(count)) * self.idf[feature]) ** 2
        has = (self.seen[best[row], feature >> 3] >> (7 - (feature & 7)).astype(np.uint8)) & 1
        total, n = (np.bincount(row, weights=w, minlength=len(texts)) for w in (mass, None))
        sure = SURE * total / np.maximum(n, 1)
        return (np.bincount(row, weights=mass * has, minlength=len(texts)) + sure) / np.where(n > 0, total + sure, 1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def shift_of(languages: int) -> int:
    """By how many bits n-gram numbers are cut, so that the weights fit."""
    if languages * LEAST_FEATURES > MODEL_CELLS:
        raise ValueError(f"{languages} languages are more than {MODEL_CELLS // LEAST_FEATURES}")
    return max(0, FEATURE_BITS - (MODEL_CELLS // max(languages, 1)).bit_length() + 1)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, size: int = FEATURES) -> np.ndarray:
    """FTRL-proximal over rows of (distinct features, values), EPOCHS times: weights (``size`` + 1) x classes."""
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))

    def solved(at) -> np.ndarray:
        zi = z[at]
        step = (BETA + np.sqrt(n[at])) / ALPHA + L2
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / step)

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for r in order.permutation(len(rows)):
            f, x = rows[r]
            f, x = np.append(f, size), np.append(x, 1.0)
            w = solved(f)
            p = softmax(x @ w)
            p[labels[r]] -= 1
            g = np.outer(x, p)
            sigma = (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / ALPHA
            z[f] += g - sigma * w
            n[f] += g * g
    return solved(slice(None))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm.

    Targets are smoothed as in Platt scaling, (n + 1) / (n + 2) for the label, so that
    separable classes don't drive the temperature to its limit.
    """
    n, classes = logits.shape if len(labels) else (0, 0)
    if not n or classes < 2:
        return 1.0
    target = np.full((n, classes), 1 / (n + 2) / (classes - 1))
    target[np.arange(n), labels] = (n + 1) / (n + 2)

    def loss(t: float) -> float:
        return -(target * np.log(np.maximum(softmax(logits / np.exp(t)), 1e-12))).sum(axis=1).mean()

    lo, hi, g = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def document_statistics(texts: DataFrame) -> tuple[np.ndarray, dict[str, int]]:
    """Documents with each feature, and documents of each language, over all rows of ``texts`` (text, language)."""

    def count(batches):
        df, langs = np.zeros(FEATURES, dtype=np.int64), Counter()
        for b in batches:
            t = b.column(0).to_pylist()
            langs.update(b.column(1).to_pylist())
            for lo, hi in balanced(t, BATCH_CHARS):
                df += np.bincount(features(t[lo:hi])[1], minlength=FEATURES)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*at.tolist(), *[-1] * len(langs)], pa.int64()), pa.array([None] * len(at) + [*langs], pa.string()), pa.array([*df[at].tolist(), *langs.values()], pa.int64())],
            names=["feature", "lang", "n"],
        )

    rows = on_workers(texts).mapInArrow(count, "feature long, lang string, n long").groupBy("feature", "lang").agg(F.sum("n").alias("n"))
    most = MODEL_CELLS // LEAST_FEATURES
    out, counts = np.zeros(FEATURES, dtype=np.int64), {}
    told = rows.limit(FEATURES + most + 1).toArrow()
    feature, n = told.column("feature").to_numpy(), told.column("n").to_numpy()
    out[feature[feature >= 0]] = n[feature >= 0]
    for i in np.flatnonzero(feature < 0).tolist():
        counts[told.column("lang")[i].as_py()] = int(n[i])
    shift_of(len(counts))  # too many languages are an error
    return out, counts


def labelled_sample(docs: DataFrame, counts: dict[str, int], per_lang: int, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, str]]:
    """At most ``per_lang`` labelled texts of each language, by hash order."""
    order = F.pmod(F.xxhash64(id_col), F.lit(1 << 30))
    # a hash threshold leaves about twice the bound, then the least hashes of each language
    least = {lang: int((1 << 30) * min(1.0, 2 * per_lang / n)) for lang, n in counts.items()}
    usual = min(least.values())
    rare = {lang: t for lang, t in least.items() if t > usual}
    threshold = F.lit(usual)
    if rare:
        threshold = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in sorted(rare.items()) for x in p]), F.col(lang_col)), threshold)
    some = docs.withColumn("_order", order).where(F.col("_order") < threshold)
    place = F.row_number().over(Window.partitionBy(lang_col).orderBy("_order", text_col))
    rows = some.withColumn("_place", place).where(F.col("_place") <= per_lang).select(lang_col, "_place", text_col)
    told = sorted(((r[0], r[1], r[2]) for r in rows.toLocalIterator()), key=lambda r: r[:2])  # about SAMPLE rows at most
    return [(text, lang) for lang, _, text in told]


def sample_rows(sample: list[tuple[str, str]], labels: np.ndarray, classes: int, idf: np.ndarray, shift: int) -> tuple[list, np.ndarray]:
    """Distinct features and values of each text of the sample, and ``Model.seen``. ``sample`` is emptied on the way: the driver
    holds either a text or its row, and all rows in two arrays."""
    seen = np.zeros((classes, FEATURES // 8), dtype=np.uint8)
    own, values, ends = array("i"), array("d"), [0]
    sample.reverse()
    for k in labels.tolist():
        _, f, c = features([sample.pop()[0]])
        np.bitwise_or.at(seen[k], f >> 3, (128 >> (f & 7)).astype(np.uint8))
        f, x = folded(f >> shift, weighted(np.zeros(len(f), dtype=np.int64), f, c, idf, 1))
        own.frombytes(f.astype("i").tobytes())
        values.frombytes(x.astype("d").tobytes())
        ends.append(len(own))
    f, x = np.frombuffer(own, dtype="i"), np.frombuffer(values, dtype="d")
    return [(f[a:b], x[a:b]) for a, b in zip(ends[:-1], ends[1:])], seen


def train(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Learn from the rows of ``docs`` that have a text and a language."""
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), F.col(lang_col).cast("string").alias("_lang")
    )
    df, counts = document_statistics(known.select("_text", "_lang"))
    languages = sorted(counts)
    if not languages:
        return None
    total, shift = sum(counts.values()), shift_of(len(languages))
    per_lang = min(per_lang, max(1, SAMPLE // len(languages)))
    sample = labelled_sample(known, counts, per_lang, "_id", "_text", "_lang")
    idf = np.log((1 + total) / (1 + df)) + 1
    index = {x: i for i, x in enumerate(languages)}
    labels = np.array([index[lang] for _, lang in sample])
    rows, seen = sample_rows(sample, labels, len(languages), idf, shift)
    held = np.arange(len(rows)) % CALIBRATION_SHARE == 0
    learn = np.flatnonzero(~held) if len(rows) >= 10 * len(languages) else np.arange(len(rows))
    weights = fit_ftrl([rows[i] for i in learn], labels[learn], len(languages), FEATURES >> shift)
    model = Model(languages, idf, seen, weights.astype(np.float32), 1.0, shift)
    check = np.flatnonzero(held)
    logits = np.array([x @ weights[f] + weights[-1] for f, x in (rows[i] for i in check)])
    model.temperature = fit_temperature(logits, labels[check])
    return model


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", known: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added, and where asked for the ``known`` share; it has no
    columns of these names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    added = ["lang_pred", "score", "known"][: 2 + known]

    def run(batches):
        import regex

        letter, model = regex.compile(r"\p{L}"), shared.value
        for b in batches:
            texts = b.column(at).to_pylist()
            told = [model is not None and t is not None and letter.search(t) is not None for t in texts]
            lang, score, share = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            some = [i for i, k in enumerate(told) if k]
            for lo, hi in balanced([texts[i] for i in some], BATCH_CHARS):
                own = [texts[i] for i in some[lo:hi]]
                found = features(own)
                p = model.probabilities(own, found)
                best = p.argmax(axis=1)
                for i, k, s in zip(some[lo:hi], best.tolist(), p.max(axis=1).tolist()):
                    lang[i], score[i] = model.languages[k], s
                if known:
                    for i, s in zip(some[lo:hi], model.known(own, best, found).tolist()):
                        share[i] = s
            more = [pa.array(lang), pa.array(score), pa.array(share)][: len(added)]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, *added])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return on_workers(docs).mapInArrow(run, f"{fields}, lang_pred string, score double{', known double' if known else ''}")


def identify(docs: DataFrame, folds: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn outside fold ``held`` and predict all: ``id_col, held_out, lang_pred, score``."""
    model = train(docs.where(fold(id_col, folds) != held), id_col=id_col, text_col=text_col, lang_col=lang_col)
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(fold(id_col, folds) == held, F.lit(False)).alias("held_out"),
        F.when(F.col(text_col).isNotNull(), text_of(text_col)).alias("_text"),
    )
    return predict(rows, model, "_text").select(F.col("_id").alias(id_col), "held_out", "lang_pred", "score")


def reject_unknown(docs: DataFrame, least: float, text_col: str = "text", **how) -> DataFrame:
    """``docs`` without those that have no letters, whose best language scores under ``least`` or hardly more than
    any other would (LEAST_MARGIN), or knows too little of the text (LEAST_KNOWN). The model learns from all
    labelled documents."""
    model = train(docs, text_col=text_col, **how)
    each = 1 / len(model.languages) if model else 0.0
    floor = max(least, each + LEAST_MARGIN * (1 - each))
    wide = docs.select(*[F.col(f"`{c}`").alias(f"_k_{c}") for c in docs.columns])
    told = predict(wide, model, f"_k_{text_col}", known=True)
    kept = told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= floor) & (F.col("known") >= LEAST_KNOWN))
    return kept.select(*[F.col(f"`_k_{c}`").alias(c) for c in docs.columns])
