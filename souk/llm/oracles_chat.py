"""DuckDB SQL of the conversation operators that came later: repair and prefix trie."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned crc32 of an ASCII string expression: eight steps of the polynomial division per character."""
    step = "list_reduce([xor(c, b)] || [0,0,0,0,0,0,0,0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return (
        f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(ch) AS BIGINT) FOR ch IN string_split({text}, '')], "
        f"lambda c, b: {step}), 4294967295)"
    )


#: White space of the contracts and any other character.
_SPACES = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"[^\x20\x09-\x0D]+"

#: A dynamic programme over rows: of each pattern state the cheapest, then least, edits so far.
REPAIR = rf"""
WITH RECURSIVE d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM d, LATERAL (SELECT unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END))) WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    rtrim(text, {_SPACES}) AS t
  FROM damaged
), repeated AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth FROM numbered
), faults AS (
  SELECT *, CASE WHEN t = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS previous
  FROM repeated
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pos > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), kept AS (  -- a row's edits by the state before it: 0 nothing yet, 1 after s, 2 after u, 3 after a
  SELECT conv_id, pos, s.s AS before, e.edit,
    CASE e.edit WHEN 'D' THEN 2 WHEN 'K' THEN 0 ELSE 1 END + CASE WHEN e.edit <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS cost,
    CASE WHEN e.edit = 'D' THEN s.s WHEN e.edit = 'K' AND initial = 's' THEN 1 WHEN s.s = 2 THEN 3 ELSE 2 END AS after,
    CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text] ELSE [CASE WHEN s.s = 2 THEN 'assistant:' ELSE 'user:' END || text] END AS lines
  FROM faults, (VALUES (0), (1), (2), (3)) s(s), (VALUES ('D'), ('K'), ('R')) e(edit)
  WHERE e.edit = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (e.edit = 'R' OR (initial = 's' AND s.s = 0) OR (initial = 'u' AND s.s <> 2) OR (initial = 'a' AND s.s = 2)))
), inserts AS (  -- up to two inserted turns from a state
  SELECT * FROM (VALUES
    (0, '', 0, 0, []), (1, '', 0, 1, []), (2, '', 0, 2, []), (3, '', 0, 3, []),
    (0, 'I', 5, 2, ['user:']), (1, 'I', 5, 2, ['user:']), (2, 'I', 5, 3, ['assistant:']), (3, 'I', 5, 2, ['user:']),
    (0, 'II', 10, 3, ['user:', 'assistant:']), (1, 'II', 10, 3, ['user:', 'assistant:']), (2, 'II', 10, 2, ['assistant:', 'user:']), (3, 'II', 10, 3, ['user:', 'assistant:'])
  ) i(before, edits, cost, after, lines)
), paths AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS state, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM counts
  UNION ALL
  SELECT conv_id, pos, state, cost, audit, lines FROM (
    SELECT p.conv_id, k.pos, k.after AS state, p.cost + i.cost + k.cost AS cost, p.audit || i.edits || k.edit AS audit, p.lines || i.lines || k.lines AS lines,
      row_number() OVER (PARTITION BY p.conv_id, k.pos, k.after ORDER BY p.cost + i.cost + k.cost, p.audit || i.edits || k.edit) AS nth
    FROM paths p JOIN inserts i ON i.before = p.state
    JOIN kept k ON k.conv_id IS NOT DISTINCT FROM p.conv_id AND k.pos = p.pos + 1 AND k.before = i.after
  ) WHERE nth = 1
), whole AS (
  SELECT p.conv_id, p.cost + i.cost AS cost, p.audit || i.edits AS audit, p.lines || i.lines AS lines,
    row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + i.cost, p.audit || i.edits) AS nth
  FROM paths p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.pos JOIN inserts i ON i.before = p.state AND i.after IN (0, 3)
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN whole w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.nth = 1"""

#: Every prefix of every rebuilt conversation as a list of turns; subtrees by the prefixes of each node.
TRIE = rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY pos) AS turns FROM t GROUP BY conv_id),
c AS (SELECT conv_id, turns, conv_id - conv_id % 20 AS base, CAST({crc32("CAST(conv_id AS VARCHAR)")} % 4 AS INTEGER) AS h FROM own),
rebuilt AS (
  SELECT c.conv_id, coalesce(list_slice(b.turns, 1, c.h), []) || list_slice(c.turns, c.h + 1, len(c.turns)) AS turns
  FROM c LEFT JOIN own b ON b.conv_id = c.base
), named AS (  -- a prefix's name: the hash of its turns' hashes
  SELECT conv_id, turns, [sha256(to_json(x)) FOR x IN turns] AS ids FROM rebuilt
), places AS (
  SELECT conv_id, d AS depth, len(turns) = d AS ends, sha256(array_to_string(list_slice(ids, 1, d), ',')) AS node,
    CASE WHEN d > 0 THEN sha256(array_to_string(list_slice(ids, 1, d - 1), ',')) END AS parent,
    CASE WHEN d > 0 THEN len(regexp_extract_all(turns[d].t, '{_WORD}')) ELSE 0 END AS words
  FROM named, LATERAL (SELECT unnest(range(len(turns) + 1)) AS d)
), nodes AS (
  SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM places GROUP BY depth, node
), children AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent, depth),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children k ON k.parent = n.node AND k.depth = n.depth),
above AS (  -- every node below or at another: the prefixes of its smallest member up to its depth
  SELECT p.node AS top, p.depth AS top_depth, f.n_children, f.n_convs, f.words
  FROM full_nodes f JOIN places p ON p.conv_id = f.conv_id AND p.depth <= f.depth
), sums AS (
  SELECT top, top_depth, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens FROM above GROUP BY top, top_depth
)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sums ON top = f.node AND top_depth = f.depth
LEFT JOIN full_nodes p ON p.node = f.parent AND p.depth = f.depth - 1"""
