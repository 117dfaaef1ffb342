"""Secret scans (5): multipart credential linking, in DataFrame functions only.

1. Every pattern is matched over the whole text. ``regexp_extract_all`` gives a
   pattern's matches and ``split`` the gaps between them; a window's running sums
   of both lengths give the spans (code points, end exclusive).
2. The strong kinds (``assign``, ``access``, ``hex``) are reported as they are.
   The weak kinds are candidates: ``id`` (a user or client name), ``blob`` (a long
   mixed-case token) and ``endpoint`` (a URL, connection target or address).
3. Interval join within a document: a candidate's scope is its span widened by
   ``scope`` code points. A part of a role reaches into it if the furthest end among the parts
   before it, or the start of the next part after it, does; running
   maxima and minima over the document's parts find that without making pairs. An ``id``
   needs a secret in its scope, a ``blob`` an identifier, an ``endpoint`` a strong
   part. Candidates that overlap a strong span are that span.

Only rows of matches are shuffled, by document; no text is.

Defined cases: null text counts as empty; repeated rows and null ids give a row each;
extra columns are ignored; an empty table gives none; a text without matches has zero
counts, an empty ``spans`` and the hash of the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envflow.llm.common import text_of

SCOPE = 400

# The base patterns and their least lengths are given.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # runs of [0-9a-f]+ of 24 or more
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
# Weak candidates.
ID = r"""(?i:user(?:name)?|login|client_?id|account|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
BLOB = r"[A-Za-z0-9+/]{32,}+={0,2}"
ENDPOINT = (
    r"""(?:[a-z][a-z0-9+]{1,12}+://[A-Za-z0-9_.:@%/?=&-]+"""
    r"""|(?i:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.:-]{4,}"""
    r"""|[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?::[0-9]{2,5})?)"""
)

#: kind, pattern, role; kinds in the order in which ties are reported.
KINDS = (
    ("assign", ASSIGN, "secret"),
    ("access", ACCESS, "id"),
    ("hex", HEX, "secret"),
    ("id", ID, "id"),
    ("blob", BLOB, "secret"),
    ("endpoint", ENDPOINT, "endpoint"),
)
STRONG = 3  # the first kinds
MASK = "[SECRET]"


def _matches(kind: int, pattern: str) -> Column:
    """All matches of one kind with the gap before each; null where there are none."""
    text, p = F.col("_text"), F.lit(pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    own = F.regexp_extract_all(text, p, F.lit(1)) if kind == 0 else found
    rows = F.transform(
        F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("found"), own.alias("own")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("at"),
            F.char_length(x["gap"]).alias("gap"),
            F.char_length(x["found"]).alias("size"),
            _kept(kind, x["own"]).alias("kept"),
        ),
    )
    # the last gap has no match after it
    return F.when(text.rlike(pattern), F.filter(rows, lambda x: x["size"].isNotNull()))


def _kept(kind: int, own: Column) -> Column:
    if kind == 0:
        return F.char_length(own) >= ASSIGN_LEAST
    if kind == 1:
        return F.char_length(own) >= ACCESS_LEAST
    if KINDS[kind][0] == "blob":
        return own.rlike("[0-9]") & own.rlike("[A-Z]") & own.rlike("[a-z]")
    return F.lit(True)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    src = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    return src.withColumn("_hash", F.xxhash64("_text"))


def secret_spans(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per reported span: ``_id, _hash`` (the text's), ``kind`` (its place in KINDS),
    ``start, end``, and ``behind``: the furthest end of the spans before it."""
    arrays = [F.coalesce(_matches(k, p), F.array()) for k, (_, p, _) in enumerate(KINDS)]
    keyed = _keyed(docs, id_col, text_col)
    key = ["_id", "_hash"]
    # repeated rows of a document give the same matches: once is enough, and the rest go before the exchange
    found = keyed.select(*key, F.concat(*arrays).alias("m")).where(F.size("m") > 0).groupBy(*key).agg(F.first("m").alias("m"))
    rows = found.select(*key, F.explode("m").alias("m")).select(*key, "m.*")
    own = Window.partitionBy(*key, "kind").orderBy("at")
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto)).where("kept")
    parts = parts.select(*key, "kind", (F.col("end") - F.col("size")).alias("start"), "end")

    order = Window.partitionBy(*key).orderBy("start", "kind", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    strong = F.col("kind") < STRONG

    def reaches(which: Column, by: int) -> Column:
        """A part for which ``which`` holds comes within ``by`` of this one."""
        end = F.max(F.when(which, F.col("end"))).over(before)
        start = F.min(F.when(which, F.col("start"))).over(after)
        return F.coalesce(end > F.col("start") - by, F.lit(False)) | F.coalesce(start < F.col("end") + by, F.lit(False))

    def role(name: str) -> Column:
        return F.col("kind").isin([k for k, x in enumerate(KINDS) if x[2] == name])

    near = parts.withColumns(
        {
            "_inside": reaches(strong, 0),
            "_ids": reaches(role("id"), scope),
            "_secrets": reaches(role("secret"), scope),
            "_strong": reaches(strong, scope),
        }
    )
    index = {x[0]: k for k, x in enumerate(KINDS)}
    complete = (
        ((F.col("kind") == index["id"]) & F.col("_secrets"))
        | ((F.col("kind") == index["blob"]) & F.col("_ids"))
        | ((F.col("kind") == index["endpoint"]) & F.col("_strong"))
    )
    told = near.where(strong | (~F.col("_inside") & complete)).select(*key, "kind", "start", "end")
    return told.withColumn("behind", F.coalesce(F.max("end").over(before), F.lit(0)))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(x[0]) for x in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ","
    )


def _per_text(docs: DataFrame, scope: int, id_col: str, text_col: str) -> DataFrame:
    spans = secret_spans(docs, scope, id_col, text_col)
    return spans.groupBy("_id", "_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "behind"))).alias("_spans")
    )


def _with_spans(docs: DataFrame, keyed: DataFrame, scope: int, id_col: str, text_col: str) -> DataFrame:
    found = _per_text(docs, scope, id_col, text_col).withColumnsRenamed({"_id": "_fid", "_hash": "_fhash"})
    same = keyed["_id"].eqNullSafe(found["_fid"]) & (keyed["_hash"] == found["_fhash"])
    return keyed.join(found, same, "left").drop("_fid", "_fhash")


def _number(kind: int) -> Column:
    return F.size(F.filter("_spans", lambda x: x["kind"] == kind)).cast("long")


def scan_secrets(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: counts of the strong kinds, all spans and their digest."""
    keyed = _keyed(docs, id_col, text_col).drop("_text")
    spans = F.coalesce(F.col("_spans"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint,behind:bigint>>"))
    out = _with_spans(docs, keyed, scope, id_col, text_col).withColumn("_spans", spans)
    count = [_number(k).alias(f"n_{KINDS[k][0]}") for k in range(STRONG)]
    base = F.filter("_spans", lambda x: x["kind"] < STRONG)
    return out.select(
        F.col("_id").alias(id_col), *count, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("_spans")).alias("spans")
    )


def redact_secrets(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every reported span of ``text_col`` replaced by MASK (overlapping spans by one);
    ``n_chars`` follows where it is there. Rows and other columns stay."""
    own = {c: F.col(f"`{c}`").alias(f"_k_{c}") for c in docs.columns}
    keyed = docs.select(*own.values(), F.col(id_col).alias("_id"), F.xxhash64(text_of(text_col)).alias("_hash"))
    out = _with_spans(docs, keyed, scope, id_col, text_col)
    text = F.col(f"`_k_{text_col}`")
    kept = F.transform(
        "_spans",
        lambda x: F.when(x["start"] < x["behind"], F.lit("")).otherwise(
            F.concat(F.substring(text, x["behind"] + 1, x["start"] - x["behind"]), F.lit(MASK))
        ),
    )
    tail = F.substring(text, F.array_max(F.transform("_spans", lambda x: x["end"])) + 1, F.char_length(text))
    clean = F.when(F.col("_spans").isNull(), text).otherwise(F.concat(F.array_join(kept, ""), tail))
    out = out.withColumn("_clean", clean)

    def column(c: str) -> Column:
        if c == text_col:
            return F.col("_clean").alias(c)
        if c == "n_chars":
            n = F.when(F.col("_spans").isNotNull(), F.char_length("_clean")).otherwise(F.col("_k_n_chars"))
            return n.cast(docs.schema[c].dataType).alias(c)
        return F.col(f"`_k_{c}`").alias(c)

    return out.select(*[column(c) for c in docs.columns])
