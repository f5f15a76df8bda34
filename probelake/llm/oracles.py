"""SQL (DuckDB) over the given tables that has to give the same rows as the query of that name."""

from __future__ import annotations

from probelake.llm import sharding

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BENCH_WORDS = f"regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
WORDS = f"regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+')"

DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {BENCH_WORDS} AS w FROM documents),
items AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {BENCH_WORDS} AS w FROM benchmark)),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items WHERE n > 0)),
placed AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM items WHERE n > 0))),
found AS (SELECT doc_id, n, i, item_id FROM placed JOIN windows USING (n, x)),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE split AS (SELECT doc_id, {WORDS} AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(
    CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM split),
members AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM members a JOIN members b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT l.b, r.other FROM reached r JOIN both_ways l ON l.a = r.doc_id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""


def crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text of ASCII characters."""
    steps = "list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ord(({text})[i])::UBIGINT)"
    folded = f"list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda c, b: {steps})"
    return f"xor({folded}, 4294967295::UBIGINT)::BIGINT"


TURN = "sha256(octet_length(encode(role))::VARCHAR || ':' || role || text)"

TRIE = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, {TURN}[1:32] AS token, octet_length(encode(text)) AS n_bytes,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {TURN}[1:32]) AS place
  FROM given),
ids AS (SELECT conv_id, {crc32("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM given)),
turns AS (
  SELECT i.conv_id, 0 AS own, place, token, n_bytes
  FROM ids i JOIN own o ON o.conv_id = i.conv_id - i.conv_id % 5 AND place <= h
  UNION ALL
  SELECT conv_id, 1, place, token, n_bytes FROM own JOIN ids USING (conv_id) WHERE place > h),
paths AS (
  SELECT conv_id, row_number() OVER w AS depth, n_bytes, string_agg(token, '') OVER w AS node,
         depth = count(*) OVER (PARTITION BY conv_id) AS ends
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY own, place)
  UNION ALL
  SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM turns) FROM ids),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_bytes) AS n_bytes,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ids
  FROM paths GROUP BY node, depth),
told AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.node[1:32 * n.depth] = n.node) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1:32 * (n.depth - 1)]),
sums AS (
  SELECT p.node, sum((u.n_convs - 1) * u.n_bytes) AS saved, count(*) FILTER (u.n_children = 0) AS leaves
  FROM told u JOIN paths p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.node)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(ids) AS ends_sha256
FROM told JOIN sums USING (node)
"""

_NONE = "{'c': 1000000000, 'a': '', 't': []::VARCHAR[]}"


def _edit(state: str, cost: str, edit: str, line: str | None = None) -> str:
    lines = f"list_append({state}.t, {line})" if line else f"{state}.t"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 't': {lines}}}"


def _least(*found: str) -> str:
    return f"list_sort([{', '.join(found)}])[1]"


def _kept(state: str, initial: str) -> str:
    kept = _edit(state, "unended", "K", "role || ':' || text")
    return f"CASE WHEN NOT gone AND role[1] = '{initial}' THEN {kept} ELSE {_NONE} END"


def _reroled(state: str, role: str) -> str:
    return f"CASE WHEN NOT gone THEN {_edit(state, '2 + unended', 'R', f"'{role}:' || text")} ELSE {_NONE} END"


_ROWS = {
    "s0": _edit("s0", "3", "D"),
    "s1": _least(_edit("s1", "3", "D"), _kept("s0", "s")),
    "s2": _least(
        _edit("s2", "3", "D"), *[f(f"s{k}", x) for k in (0, 1, 3) for f, x in ((_kept, "u"), (_reroled, "user"))]
    ),
    "s3": _least(_edit("s3", "3", "D"), _kept("s2", "a"), _reroled("s2", "assistant")),
}


def _closed(source: str) -> str:
    """States with insertions after them, as a select list over ``source``."""
    users = _least("s2", *[_edit(f"s{k}", "2", "I", "'user:'") for k in (0, 1, 3)])
    return f"""
      SELECT * EXCLUDE (s2, s3), u AS s2, {_least("s3", _edit("u", "2", "I", "'assistant:'"))} AS s3
      FROM (SELECT *, {users} AS u FROM ({source}))"""


_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

REPAIR = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations),
kinds AS (SELECT *, {crc32("k")} % 20 AS kind FROM given),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS copies,
         rtrim(text, {_SPACE}) AS stripped
  FROM hurt),
faults AS (
  SELECT *, stripped = '' AS blank, stripped <> '' AND copies > 1 AS duplicate,
         stripped <> '' AND copies = 1 AND stripped[-1] NOT IN ('.', '!', '?') AS truncated,
         i > 1 AND lag(role[1]) OVER w || role[1] NOT IN ('su', 'ua', 'au') AS illegal
  FROM placed WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
steps AS (SELECT conv_id, i, role, text, blank OR duplicate AS gone, truncated::INT AS unended FROM faults),
ids AS (SELECT DISTINCT conv_id FROM conversations),
reached AS (
  SELECT * FROM ({_closed(f"SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS s0, {_NONE} AS s1, {_NONE} AS s2, {_NONE} AS s3 FROM ids")})
  UNION ALL
  SELECT * FROM ({_closed(
      "SELECT r.conv_id, r.i + 1 AS i, " + ", ".join(f"{v} AS {k}" for k, v in _ROWS.items())
      + " FROM reached r JOIN steps s ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND s.i = r.i + 1"
  )})),
ended AS (
  SELECT conv_id, {_least("s0", "s3")} AS s
  FROM reached QUALIFY i = max(i) OVER (PARTITION BY conv_id)),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM faults GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, s.c::BIGINT AS cost, s.a AS audit,
       sha256(array_to_string(s.t, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""

ORACLES = {
    "op1_sharding": sharding.ORACLE,
    "op7_decontamination": DECONTAMINATION,
    "op10_jaccard_join": JACCARD,
    "op11_prefix_trie": TRIE,
    "op12_conversation_repair": REPAIR,
}
