"""DuckDB twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

#: CRC-32 of a list of bytes; the factor is its polynomial.
_CRC = (
    "xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), {0}), lambda c, b: list_reduce(list_prepend(xor(c, b), "
    "CAST(range(8) AS UBIGINT[])), lambda x, y: xor(x >> 1, CAST(3988292384 AS UBIGINT) * (x & 1)))), CAST(4294967295 AS UBIGINT))"
)
#: The UTF-8 bytes of a text whose code points are below U+0080 or from U+00C0 to U+00FF.
_BYTES = (
    "flatten(list_transform(string_split({0}, ''), lambda a: CASE WHEN unicode(a) < 128 THEN [CAST(unicode(a) AS UBIGINT)] "
    "ELSE [CAST(195 AS UBIGINT), CAST(unicode(a) - 64 AS UBIGINT)] END))"
)
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc(text: str) -> str:
    return _CRC.format(_BYTES.format(text))


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


ORACLES: dict[str, str] = {
    "op4_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
spread AS (SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS k FROM spread),
sizes AS (SELECT DISTINCT m FROM win),
places AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m),
hit AS (
  SELECT p.doc_id, p.i, p.m, win.item_id
  FROM (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS k FROM places) p JOIN win USING (m, k)
),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS place FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op10_warc": """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM q
""",
    "op11_spelling_variants": f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-z\u00c0-\u00ff]+')) AS r FROM documents
), held AS (SELECT doc_id, r, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT r, n, {_crc("(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || r)")} AS h FROM held),
thinned AS (
  SELECT n, CASE WHEN h % 97 = 0 THEN substr(r, 1, CAST(h % length(r) AS BIGINT)) || substr(r, CAST(h % length(r) AS BIGINT) + 2) ELSE r END AS word
  FROM hashed
), v AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM thinned WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cuts AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)
), pairs AS (
  SELECT a.word, b.word AS other FROM cuts a JOIN cuts b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT c.word, v.word FROM cuts c JOIN v ON c.rest = v.word
  UNION SELECT v.word, c.word FROM cuts c JOIN v ON c.rest = v.word
), near AS MATERIALIZED (
  SELECT p.word, count(*) AS n_near, min((-o.n, p.other)) AS best FROM pairs p JOIN v o ON o.word = p.other GROUP BY p.word
), formed AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 2 * v.n THEN best[2] END AS form,
    CASE WHEN -best[1] >= 2 * v.n THEN -best[1] END AS form_n
  FROM v LEFT JOIN near USING (word)
), up AS (
  SELECT word, word AS top FROM formed UNION ALL SELECT up.word, f.form FROM up JOIN formed f ON f.word = up.top WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, up.top AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN up ON up.word = f.word JOIN formed g ON g.word = up.top WHERE g.form IS NULL
""",
    "op12_jaccard_join": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^ \t-\r]+') AS w FROM documents
), places AS (
  SELECT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), sets AS MATERIALIZED (SELECT DISTINCT doc_id, s FROM places),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM met JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)
), reach AS (SELECT doc_id, doc_id AS top FROM d UNION SELECT doc_id, b FROM reach JOIN links ON a = top)
SELECT r.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(r.top) AS component_id
FROM reach r LEFT JOIN sizes USING (doc_id) GROUP BY r.doc_id
""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE l AS MATERIALIZED (
  SELECT doc_id, lang, {_leaf("text")} AS leaf,
    CASE WHEN {_crc("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_leaf("t")} END AS tampered
  FROM (SELECT *, {_LOWER.format("text")} AS t FROM documents)
), r AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS size FROM l
), tree AS (
  SELECT lang, 0 AS level, i, size, leaf AS h FROM r
  UNION ALL
  SELECT lang, level + 1, i // 8, CAST(ceil(any_value(size) / 8) AS BIGINT), sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE size > 1 GROUP BY lang, level, i // 8
), subs AS MATERIALIZED (
  SELECT lang, h, row_number() OVER (ORDER BY lang IS NOT NULL, lang) - 1 AS i, count(*) OVER () AS size FROM tree WHERE size = 1
), upper AS (
  SELECT 0 AS level, i, size, h FROM subs
  UNION ALL
  SELECT level + 1, i // 8, CAST(ceil(any_value(size) / 8) AS BIGINT), sha256(string_agg(h, '' ORDER BY i)) FROM upper WHERE size > 1 GROUP BY level, i // 8
), t AS MATERIALIZED (SELECT * FROM tree), u AS MATERIALIZED (SELECT * FROM upper),
steps AS MATERIALIZED (
  SELECT a.lang, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lef, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS rig
  FROM t a JOIN t b ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND a.i // 8 = b.i // 8 WHERE a.size > 1 GROUP BY ALL
), tops AS MATERIALIZED (
  SELECT a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lef, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS rig
  FROM u a JOIN u b ON a.level = b.level AND a.i // 8 = b.i // 8 WHERE a.size > 1 GROUP BY ALL
), climb AS (
  SELECT doc_id, leaf, lang, 0 AS level, i, row_number() OVER () AS row, coalesce(tampered, leaf) AS h, '' AS met FROM r
  UNION ALL
  SELECT c.doc_id, c.leaf, c.lang, c.level + 1, c.i // 8, c.row, sha256(lef || c.h || rig), c.met || lef || rig
  FROM climb c JOIN steps s ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.i = c.i
), below AS MATERIALIZED (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1),
above AS (
  SELECT b.doc_id, b.leaf, s.h AS subroot, 0 AS level, s.i, b.row, b.h, b.met FROM below b JOIN subs s ON s.lang IS NOT DISTINCT FROM b.lang
  UNION ALL
  SELECT a.doc_id, a.leaf, a.subroot, a.level + 1, a.i // 8, a.row, sha256(lef || a.h || rig), a.met || lef || rig
  FROM above a JOIN tops s ON s.level = a.level AND s.i = a.i
), ended AS (SELECT * FROM above QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1)
SELECT doc_id, leaf, subroot, (SELECT h FROM u WHERE size = 1) AS root, sha256(met) AS proof_sha256, h AS folded_root, h = (SELECT h FROM u WHERE size = 1) AS verified
FROM ended
""",
}
