"""SQL counterparts of the corpus queries that SQL can express."""

from __future__ import annotations

# Space and the five control characters that part words, as SQL.
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = r"len(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'))"

LINE_SPREAD = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, text, source FROM documents
), parts AS (
  SELECT r, source, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS number FROM docs
), lines AS (
  SELECT r, source, raw, number, trim(raw, {BLANKS}) AS line FROM parts
), boilerplate AS (
  SELECT line FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 10
), marked AS (
  SELECT l.*, line <> '' AS worded, b.line IS NOT NULL AS hit FROM lines l LEFT JOIN boilerplate b USING (line)
), counted AS (
  SELECT r, count(*) FILTER (worded) AS n_lines, count(*) FILTER (hit) AS n_hits,
    coalesce(string_agg(raw, chr(10) ORDER BY number) FILTER (NOT hit), '') AS cleaned
  FROM marked GROUP BY r
), judged AS (
  SELECT *, n_hits > 0 AND n_hits = n_lines AND count(*) OVER (PARTITION BY text) >= 2 AS is_copy
  FROM docs JOIN counted USING (r)
)
SELECT doc_id, CASE WHEN n_hits = 0 OR is_copy THEN text ELSE cleaned END AS text,
  n_lines, n_hits AS n_boilerplate, CASE WHEN is_copy THEN 0 ELSE n_hits END AS n_removed, is_copy
FROM judged
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""

def share(part: str, whole: str, limit: int) -> str:
    return f"100 * ({part}) > {limit} * ({whole})"


RULE_CASCADE = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    string_split(coalesce(text, ''), chr(10)) AS parts
  FROM documents
), windows AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM docs)
), repeated AS (
  SELECT r, unnest([i, i + 1, i + 2]) AS place
  FROM windows QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1
), covered AS (
  SELECT r, count(DISTINCT place) AS n FROM repeated GROUP BY r
), facts AS (
  SELECT d.*, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(parts, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(c.n, 0) AS n_repeat_words
  FROM docs d LEFT JOIN covered c USING (r)
), based AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM facts
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT (base_failed
    OR {share("n_symbols", "n_words", 10)}
    OR NOT word_chars BETWEEN 2 * n_words AND 12 * n_words
    OR {share("n_dup_lines", "len(lines)", 60)}
    OR length(regexp_replace(text, '[^A-Z]', '', 'g')) > length(regexp_replace(text, '[^a-z]', '', 'g'))
    OR {share("len(list_filter(w, lambda x: suffix(x, '!')))", "n_words", 20)}
    OR coalesce({share("list_max(map_values(list_histogram(w)))", "n_words", 25)}, false)
    OR {share(r"len(list_filter(w, lambda x: NOT regexp_matches(x, '[\pL]')))", "n_words", 30)}) AS kept
FROM based
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle, least(len(w), 5) AS width
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.width = b.width AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common c JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * c.n >= 75 * (a.n + b.n - c.n)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least_id AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least_id LEFT JOIN sizes USING (doc_id)
"""

# CRC-32 (polynomial 0xEDB88320, fixed value) of a decimal number's text.
CRC32 = """xor(4294967295, list_reduce(
  list_transform(range(1, length({0}) + 1), lambda i: CAST(ascii(substr({0}, i, 1)) AS BIGINT)),
  lambda crc, byte: list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
    lambda c, bit: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, byte)), 4294967295))"""


def merkle(levels: int) -> str:
    """The manifest's SQL for trees of at most 16^``levels`` leaves, and as many trees.

    Two towers of levels: ``l`` over the leaves of each source, ``r`` over the
    subroots. A single node passes a level unchanged.
    """
    fields = " || ".join(
        f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"
        for name in ("doc_id", "source", "lang", "n_chars", "{text}"))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""
leaves AS MATERIALIZED (
  SELECT *, CASE WHEN {CRC32.format("CAST(doc_id AS VARCHAR)")} % 5 = 0
    THEN sha256({fields.format(text=lowered)}) ELSE leaf END AS seen
  FROM (SELECT *, sha256({fields.format(text="text")}) AS leaf, coalesce('1' || source, '0') AS tree FROM documents)
), l0 AS MATERIALIZED (
  SELECT doc_id, leaf, tree, seen, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    leaf AS hash FROM leaves
)"""]

    def tower(name: str) -> None:
        for k in range(levels):
            parts.append(f"""
{name}k{k} AS MATERIALIZED (
  SELECT tree, pos // 16 AS run, list(hash ORDER BY pos) AS kids FROM {name}{k} GROUP BY tree, pos // 16
), {name}s{k} AS MATERIALIZED (SELECT tree, count(*) AS size FROM {name}{k} GROUP BY tree
), {name}{k + 1} AS MATERIALIZED (
  SELECT tree, run AS pos, CASE WHEN size > 1 THEN sha256(array_to_string(kids, '')) ELSE kids[1] END AS hash
  FROM {name}k{k} JOIN {name}s{k} USING (tree)
)""")

    def climbed(rows: str, name: str) -> str:
        for k in range(levels):
            parts.append(f"""
{rows}{k + 1} AS MATERIALIZED (
  SELECT c.* EXCLUDE (pos, node, proof), pos // 16 AS pos,
    CASE WHEN size > 1 THEN sha256(array_to_string(kids[:pos % 16], '') || node || array_to_string(kids[pos % 16 + 2:], ''))
      ELSE node END AS node,
    proof || CASE WHEN size > 1 THEN array_to_string(kids[:pos % 16], '') || array_to_string(kids[pos % 16 + 2:], '')
      ELSE '' END AS proof
  FROM {rows}{k} c JOIN {name}k{k} p ON p.tree = c.tree AND p.run = c.pos // 16 JOIN {name}s{k} s ON s.tree = c.tree
)""")
        return f"{rows}{levels}"

    tower("l")
    parts.append(f"""
r0 AS MATERIALIZED (
  SELECT 0 AS tree, tree AS name, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, hash FROM l{levels}
)""")
    tower("r")
    parts.append("a0 AS (SELECT doc_id, leaf, tree, pos, seen AS node, '' AS proof FROM l0)")
    below = climbed("a", "l")
    parts.append(f"""
b0 AS (
  SELECT c.doc_id, c.leaf, s.hash AS subroot, 0 AS tree, s.pos, c.node, c.proof
  FROM {below} c JOIN r0 s ON s.name = c.tree
)""")
    last = climbed("b", "r")
    return f"""
WITH {",".join(parts)}
SELECT doc_id, leaf, subroot, r.hash AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = r.hash AS verified
FROM {last} CROSS JOIN r{levels} r
"""


SQL: dict[str, str] = {
    "op4_line_spread": LINE_SPREAD,
    "op5_top_k": TOP_K,
    "op6_rule_cascade": RULE_CASCADE,
    "op8_near_duplicates": NEAR_DUPLICATES,
    "op11_merkle": merkle(6),
}
