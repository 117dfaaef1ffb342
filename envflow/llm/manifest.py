"""Merkle dataset manifest (13): a tree of digests per language, labelled with nested intervals.

1. Every row is a leaf: the sha256 of its fields, each as byte count, ``:`` and value (``-`` if null).
2. Leaves get dense ranks within their language. Rows are cut into ranges of (language, id, leaf, row)
   of about RANGE_ROWS rows; a rank is the place within the range plus the rows of the language in
   the ranges before, so no task holds a language.
3. Level by level, runs of FAN_OUT nodes become their parent. A node is labelled with the interval
   ``[lo, hi)`` of leaf ranks that it covers, and keeps its children's labels and digests. Subroots are
   the leaves of one more such tree, ordered by language (null first, then by UTF-8 bytes).
4. Top down, ancestors are attached by containment joins: within a language and level, a child's
   interval lies in one parent's, and the bucket ``lo div FAN_OUT^level`` makes that an equality
   first. The parent's interval less the child's gives the siblings: those to its left and to its right.
5. A proof is the list of these (left, right) digests up to the root; it is folded over a leaf.

Each level is a stored table, so a lost executor costs one level at most. DataFrame functions only.

Defined cases: null fields count as ``-`` (a null id comes first and is not tampered with); an empty text
is ``0:``; repeated rows are leaves of their own with equal digests; of equal ids the lesser leaf
comes first; a lone leaf is its subroot, a lone subroot the root, a proof without siblings the
digest of nothing; extra columns are ignored; an empty table has no rows and no nodes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envflow.llm.common import sized, stored

FAN_OUT = 8
RANGE_ROWS = 1_000_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    s = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(**instead: Column) -> Column:
    """The digest of a row; ``instead`` replaces fields."""
    return digest(*[field(instead.get(c, F.col(c))) for c in FIELDS])


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, within ``group``, by ``order``, nulls first) and the group's ``size``.
    ``order`` ends with a column that differs in every row, so that any key can be cut."""
    n = rows.count()
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    cut = stored(rows.repartitionByRange(sized(n, RANGE_ROWS), *keys).withColumn("_part", F.spark_partition_id()), "ranges")
    own = cut.withColumn("_in", F.row_number().over(Window.partitionBy("_part", *group).orderBy(*keys[len(group) :])))
    held = cut.groupBy("_part", *group).agg(F.count("*").alias("_n"))
    of_group = Window.partitionBy(*group)
    held = held.select(
        "_part", *group, F.sum("_n").over(of_group).alias("size"),
        (F.sum("_n").over(of_group.orderBy("_part")) - F.col("_n")).alias("_before"),
    )
    return own.join(held, ["_part", *group]).withColumn("rank", F.col("_before") + F.col("_in") - 1).drop("_part", "_in", "_before")


def levels(leaves: DataFrame) -> list[DataFrame]:
    """The nodes of every level, from the leaves (``grp, rank, size, digest``) to the subroots: ``grp, size``
    (nodes of that level in its group), ``lo, hi, digest`` and, above the leaves, ``kids``."""
    now = stored(leaves.select("grp", "size", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest"), "level")
    out, span = [now], 1
    while (now.agg(F.max("size")).first()[0] or 0) > 1:
        span *= FAN_OUT
        runs = now.where("size > 1").groupBy("grp", F.expr(f"lo div {span}").alias("bucket"))
        up = runs.agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"), F.first("size").alias("below"))
        up = up.select(
            "grp", F.ceil(F.col("below") / FAN_OUT).cast("long").alias("size"),
            F.col("kids")[0]["lo"].alias("lo"), F.array_max(F.transform("kids", lambda k: k["hi"])).alias("hi"),
            digest(F.array_join("kids.digest", "")).alias("digest"), "kids",
        )
        now = stored(up, "level")
        out.append(now)
    return out


def subroots(tree: list[DataFrame]) -> DataFrame:
    """``grp, lo, digest``: the one node that is left of each group."""
    tops = [t.where("size = 1").select("grp", "lo", "digest") for t in tree]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def proofs(tree: list[DataFrame], above: DataFrame) -> DataFrame:
    """``grp, lo, digest, path, carried`` per leaf: ``path`` has the digests to the left and right at each level, from the
    leaf up. ``above`` has the path and what is carried down of each group's subroot."""

    def tops(t: DataFrame) -> DataFrame:
        return t.where("size = 1").join(above, "grp")

    def joined(digests: Column) -> Column:
        return F.array_join(F.transform(digests, lambda k: k["digest"]), "")

    now = tops(tree[-1])
    for level in range(len(tree) - 1, 0, -1):
        span = FAN_OUT**level
        parents = now.select(
            "grp", F.expr(f"lo div {span}").alias("bucket"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), "kids", F.col("path").alias("p_path"), "carried"
        )
        below = tree[level - 1].where("size > 1").withColumn("bucket", F.expr(f"lo div {span}"))
        below = below.drop("kids").join(parents, ["grp", "bucket"]).where("p_lo <= lo AND hi <= p_hi")
        step = F.struct(
            joined(F.filter("kids", lambda k: k["hi"] <= F.col("lo"))).alias("left"),
            joined(F.filter("kids", lambda k: k["lo"] >= F.col("hi"))).alias("right"),
        )
        below = below.withColumn("path", F.concat(F.array(step), F.col("p_path"))).select("grp", "size", "lo", "hi", "digest", "path", "carried")
        if level > 1:
            below = below.join(tree[level - 1].select("grp", "lo", "kids"), ["grp", "lo"])
            now = stored(below.unionByName(tops(tree[level - 1]).select(below.columns)), "paths")
        else:
            now = below.unionByName(tops(tree[0]).select(below.columns))
    return now.select("grp", "lo", "digest", "path", "carried")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(path, start, lambda acc, s: digest(s["left"], acc, s["right"]))


def siblings_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


@dataclass
class Manifest:
    """``nodes``: lang, level, lo, hi, digest of every node below the languages' subroots and these.
    ``proofs``: doc_id, lang, leaf, tampered (the leaf after tampering, or null), subroot, root, path."""

    nodes: DataFrame
    proofs: DataFrame


def manifest(docs: DataFrame, tampered_text: Column | None = None, tampered_where: Column | None = None) -> Manifest:
    """The tree over ``docs`` (columns FIELDS) and every row's proof."""
    changed = F.lit(None).cast("string") if tampered_text is None else F.when(tampered_where, leaf(text=tampered_text))
    rows = docs.select(
        F.col("doc_id"), F.col("lang"), leaf().alias("leaf"), changed.alias("tampered"), F.monotonically_increasing_id().alias("_row")
    ).withColumns({"_known": F.col("lang").isNotNull(), "_lang": F.coalesce(F.col("lang").cast("string"), F.lit(""))})
    rows = stored(ranked(stored(rows, "leaves"), ["_known", "_lang"], ["doc_id", "leaf", "_row"]), "ranked")
    # languages in order are the groups, and the leaves of the upper tree
    langs = rows.select("_known", "_lang", "lang", "size").where("rank = 0").select("*", F.lit(0).alias("grp"))
    langs = stored(ranked(langs, ["grp"], ["_known", "_lang"]).select("_known", "_lang", "lang", F.col("rank").alias("no")), "languages")
    numbered = stored(rows.join(langs.drop("lang"), ["_known", "_lang"]).withColumn("grp", F.col("no")), "numbered")
    tree = levels(numbered.withColumn("digest", F.col("leaf")))
    tops = stored(subroots(tree), "subroots")
    upper = levels(tops.select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("rank"), F.lit(tops.count()).alias("size"), "digest"))
    root = subroots(upper).select("grp", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("digest").alias("carried"))
    of_lang = stored(proofs(upper, root), "upper").select(
        F.col("lo").alias("grp"), "path", F.struct(F.col("digest").alias("subroot"), F.col("carried").alias("root")).alias("carried")
    )
    found = proofs(tree, of_lang).select("grp", F.col("lo").alias("rank"), "path", "carried.subroot", "carried.root")
    out = numbered.join(found, ["grp", "rank"]).select("doc_id", "lang", "leaf", "tampered", "subroot", "root", "path")
    names = langs.select(F.col("no").alias("grp"), "lang")
    nodes = None
    for i, t in enumerate(tree):
        own = t.select("grp", F.lit(i).alias("level"), "lo", "hi", "digest")
        nodes = own if nodes is None else nodes.unionByName(own)
    return Manifest(nodes.join(names, "grp").drop("grp"), out)


def verification(docs: DataFrame) -> DataFrame:
    """Proofs of all rows, held against rows of which those with ``crc32(doc_id) mod 3 = 0`` were lower-cased."""
    where = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    found = manifest(docs, lowered(F.col("text")), where).proofs
    folded = found.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", siblings_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
