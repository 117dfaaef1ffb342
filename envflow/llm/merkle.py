"""Document fingerprints (3): Merkle trees over paragraphs and sections, in DataFrame functions only.

A tree has four levels. Leaves are the pieces of a text that a line break or sentence end closes, or
the first space after ``PIECE`` characters; together they are the whole text. A line break closes a
paragraph, and so does a leaf whose hash starts with 0 (running text has no line breaks). A paragraph whose
hash starts with 0 closes a section. Borders depend on nothing but what they close, so an edit moves no
later ones. A paragraph hashes its leaves, a section its paragraphs, the root its sections.

A fingerprint is ``root:section=paragraph,paragraph,...;section=...``: the levels above the leaves. Equal
texts have equal roots. Where roots differ, ``changed`` goes down the branches that differ and gives
the paragraphs at their ends, ``likeness`` is the share of leaves that both trees have (Dice), and
``first_edit`` the place where the first differing leaf starts.

The next document's text comes by one shuffle of the texts. Every document whose key (id and text
hash) has a hash divisible by about ``RANGE_ROWS`` is the first of a range, so ranges follow the rows, however ids
are spread; a range is lent the first document of the range after it. About MAX_RANGES keys at most, the ranges'
first ones, reach every task, which finds a document's range among them by bisection.

Defined cases: null text counts as empty, an empty text has no leaves; likeness of
equal roots is 1; repeated rows are documents of their own (equal ids by text hash,
descending); null ids come last; extra columns are ignored; an empty table gives none.
Ids are of any type that Spark sorts. Rows equal in id and text lie in one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envflow.llm.common import stored, text_of

PIECE = 32
RANGE_ROWS = 100
#: Keys of ranges that are sent to every task, about; beyond RANGE_ROWS times as many documents, ranges grow with
#: the table (Spark sorts and reads them from disk where they outgrow a task's memory).
MAX_RANGES = 262_144
#: Halvings that find one of 2 ** BISECTIONS keys, four times MAX_RANGES.
BISECTIONS = 20
HEX, SHOWN_HEX = 16, 8


def leaves(text: Column, size: int = PIECE) -> Column:
    """The text's pieces, in order."""
    piece = rf"(?s)(?=.)[^.!?\n]{{0,{size}}}[^.!?\n ]{{0,{4 * size}}}+[.!?\n ]?"
    return F.regexp_extract_all(text, F.lit(piece), F.lit(0))


def leaf_hashes(text: Column) -> Column:
    """The leaves' hashes, each with ``;`` behind it if a line break ends it, else ``,``."""
    return F.transform(leaves(text), lambda x: F.concat(_hash(x), F.when(x.endswith("\n"), F.lit(";")).otherwise(F.lit(","))))


def _hash(x: Column) -> Column:
    return F.substring(F.md5(x), 1, HEX)


def _grouped(closed: Column) -> Column:
    """Groups of hashes as strings, each group up to a ``;``; linear in the number of hashes."""
    return F.filter(F.split(F.array_join(closed, ""), ";"), lambda s: s != "")


def paragraphs(leaf: Column) -> Column:
    """Hashes of the paragraphs."""
    closed = F.transform(leaf, lambda h: F.when(h.startswith("0"), F.concat(F.substring(h, 1, HEX), F.lit(";"))).otherwise(h))
    return F.transform(_grouped(closed), _hash)


def sections(paragraph: Column) -> Column:
    """Sections as strings of their paragraphs' hashes."""
    return _grouped(F.transform(paragraph, lambda h: F.concat(h, F.when(h.startswith("0"), F.lit(";")).otherwise(F.lit(",")))))


def fingerprint(section: Column) -> Column:
    """Root and branches as one string; of a paragraph's hash the first SHOWN_HEX digits."""
    hashes = F.transform(section, _hash)
    short = rf"([0-9a-f]{{{SHOWN_HEX}}})[0-9a-f]{{{HEX - SHOWN_HEX}}},?"
    shown = F.transform(
        section, lambda s: F.concat(_hash(s), F.lit("="), F.rtrim(F.regexp_replace(s, short, "$1 ")))
    )
    return F.concat(F.md5(F.array_join(hashes, ",")), F.lit(":"), F.translate(F.array_join(shown, ";"), " ", ","))


def changed(a: Column, b: Column) -> Column:
    """Of two fingerprints: the places (from 0) of the paragraphs of ``a`` that its differing branches lead
    to; none where the roots are equal. Sections that both have are not looked into."""
    branches = lambda x: F.filter(F.split(F.substring_index(x, ":", -1), ";"), lambda s: s != "")
    ids = lambda s: F.split(F.substring_index(s, "=", -1), ",")
    known = F.transform(branches(b), lambda s: F.substring_index(s, "=", 1))
    theirs = F.flatten(F.transform(branches(b), ids))
    kept = F.flatten(
        F.transform(
            branches(a),
            lambda s: F.transform(ids(s), lambda p: F.array_contains(known, F.substring_index(s, "=", 1)) | F.array_contains(theirs, p)),
        )
    )
    places = F.filter(F.transform(kept, lambda k, i: F.when(~k, i)), lambda i: i.isNotNull())
    return F.when(root(a) == root(b), F.array().cast("array<int>")).otherwise(places)


def root(print_: Column) -> Column:
    return F.substring_index(print_, ":", 1)


def likeness(a: Column, b: Column, leaves_a: Column, leaves_b: Column) -> Column:
    """Of two fingerprints and their leaf hashes: 0 to 1. The share of distinct leaves in both, or of
    leaves equal place by place where that is more (texts that repeat one line)."""
    distinct = F.size(F.array_distinct(leaves_a)) + F.size(F.array_distinct(leaves_b))
    both = 2.0 * F.size(F.array_intersect(leaves_a, leaves_b)) / distinct
    same = F.size(F.filter(F.zip_with(leaves_a, leaves_b, lambda x, y: x == y), lambda e: F.coalesce(e, F.lit(False))))
    placed = 2.0 * same / (F.size(leaves_a) + F.size(leaves_b))
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(F.coalesce(F.greatest(both, placed), F.lit(0.0)))


def _range_keys(src: DataFrame, n: int) -> DataFrame:
    """One row: the keys that are first in a range, ascending; the greatest key of all is one of them."""
    every = max(RANGE_ROWS, -(-n // MAX_RANGES))
    chosen = F.when(F.pmod(F.xxhash64("_key"), F.lit(every)) == 0, F.col("_key"))
    return src.agg(F.sort_array(F.array_distinct(F.array_append(F.collect_set(chosen), F.max("_key")))).alias("keys"))


def _with_range(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` with ``_range``, the place (from 1) of the least of the ``keys`` that is not below ``_key``, and
    ``_above``, that of the range whose last row it follows: only for rows that are first in theirs.

    The keys stand in the expressions, so that no row carries them. A step a column; a place past the end is null.
    """
    rows = rows.withColumn("_range", F.lit(1))
    for step in reversed(range(BISECTIONS)):
        beyond = F.get(keys.scalar(), F.col("_range") + (2**step - 2)) < F.col("_key")
        rows = rows.withColumn("_range", F.col("_range") + F.when(beyond, F.lit(2**step)).otherwise(F.lit(0)))
    first = F.get(keys.scalar(), F.col("_range") - 1) == F.col("_key")
    return rows.withColumn("_above", F.when(first, F.pmod(F.col("_range"), F.size(keys.scalar())) + 1))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, _text, _next``: the text of the next document by descending id, the first after the last."""
    src = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    # structs compare field by field, null below all else
    src = src.withColumn("_key", F.struct(F.col("_id").alias("id"), F.xxhash64("_text").alias("h")))
    placed = _with_range(src, stored(_range_keys(src, docs.count()), "range_keys"))
    places = F.filter(F.array(F.col("_range"), F.col("_above")), lambda r: r.isNotNull())
    rows = placed.select("_key", "_text", F.posexplode(places).alias("lent", "r"))
    order = Window.partitionBy("r").orderBy("lent", F.col("_key").desc())
    return rows.withColumn("_next", F.lead("_text").over(order)).where("lent = 0").select(F.col("_key.id").alias("_id"), "_text", "_next")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (the last half replaced by the start of
    the next document's), and their likeness; see the module."""
    rows = with_next(docs, id_col, text_col)
    n, half = F.char_length("_text"), F.floor(F.char_length("_text") / 2).cast("int")
    rows = rows.select(
        "_id", "_text", "_next", n.cast("long").alias("n_chars"),
        F.concat(F.substring(F.col("_text"), F.lit(1), n - half), F.substring(F.col("_next"), F.lit(1), half)).alias("_edited"),
    )
    rows = rows.select(
        "_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        leaf_hashes(F.col("_text")).alias("_a"), leaf_hashes(F.col("_edited")).alias("_b"), leaf_hashes(F.col("_next")).alias("_c"),
        F.transform(leaves(F.col("_text")), lambda x: F.char_length(x)).alias("_sizes"),
    )
    rows = rows.select("*", *[sections(paragraphs(F.col(f"_{x}"))).alias(f"_s{x}") for x in "abc"])
    rows = rows.select("*", *[fingerprint(F.col(f"_s{x}")).alias(f"_f{x}") for x in "abc"])
    same = F.zip_with("_a", "_b", lambda p, q: p.eqNullSafe(q))
    differs = F.array_position(same, F.lit(False))
    before = F.aggregate(F.slice("_sizes", F.lit(1), F.greatest(differs.cast("int") - 1, F.lit(0))), F.lit(0), lambda s, x: s + x)
    return rows.select(
        F.col("_id").alias(id_col),
        "n_chars",
        "edited_sha256",
        F.col("_fa").alias("fingerprint"),
        F.col("_fb").alias("edited_fingerprint"),
        likeness(F.col("_fa"), F.col("_fb"), F.col("_a"), F.col("_b")).alias("near_edited"),
        likeness(F.col("_fa"), F.col("_fc"), F.col("_a"), F.col("_c")).alias("near_next"),
        F.when(differs > 0, F.least(before.cast("long"), F.col("n_chars"))).alias("first_edit"),
    )
