"""Queries of this subpackage in ANSI SQL for DuckDB, where SQL can say them.

The others rest on fitted models, tokenizers or hash families and are held against brute
force, the libraries or held-out labels by the tests.
"""

from __future__ import annotations


def crc32(spelled: str) -> str:
    """``crcs(s, crc)`` of the ASCII strings that a query gives, bit by bit; the polynomial is a fixed value."""
    return f"""
 spelled AS (SELECT DISTINCT s FROM ({spelled})),
 crc AS (
  SELECT s, 0 AS i, 4294967295::BIGINT AS x FROM spelled
  UNION ALL
  SELECT s, i + 1, CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END
  FROM (SELECT s, i, CASE WHEN i % 8 = 0 THEN xor(x, ascii(substr(s, i // 8 + 1, 1))::BIGINT) ELSE x END AS y
        FROM crc WHERE i < 8 * length(s))),
 crcs AS (SELECT s, xor(x, 4294967295::BIGINT) AS crc FROM crc WHERE i = 8 * length(s))
"""


TRIE = f"""WITH RECURSIVE {crc32("SELECT conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL")},
 taken AS (SELECT s::BIGINT AS conv_id, crc % 9 AS h FROM crcs),
 turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS n
  FROM conversations WHERE conv_id IS NOT NULL),
 mixed AS (
  SELECT c.conv_id, n, role, text FROM taken c JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 5 AND n < h
  UNION ALL SELECT t.conv_id, n, role, text FROM turns t JOIN taken c ON c.conv_id = t.conv_id AND n >= h),
 placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n) AS depth FROM mixed),
 named AS (
  SELECT conv_id, depth, strlen(text) AS bytes,
   string_agg(concat(length(role), ':', role, length(text), ':', text), '' ORDER BY depth)
    OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM placed),
 steps AS (
  SELECT conv_id, 0 AS depth, 0 AS bytes, '' AS node FROM taken
  UNION ALL SELECT conv_id, depth, bytes, md5(path) FROM named),
 path AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
           max(depth) OVER (PARTITION BY conv_id) AS last FROM steps),
 nodes AS (
  SELECT node, depth, any_value(parent) AS parent, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs,
   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last = depth), '')) AS ends_sha256
  FROM path GROUP BY node, depth),
 families AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
 counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN families USING (node)),
 -- A node's smallest conversation leads through all nodes above it.
 above AS (
  SELECT p.node, (c.n_children = 0)::BIGINT AS leaf, (c.n_convs - 1) * c.bytes AS saved
  FROM counted c JOIN path p ON p.conv_id = c.conv_id AND p.depth <= c.depth),
 sums AS (SELECT node, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY node)
 SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
 FROM counted c JOIN sums USING (node) LEFT JOIN nodes p ON p.node = c.parent"""

EXACT = r"""WITH docs AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[ \t-\r]', '', 'g')) AS text_sha256
  FROM documents)
 SELECT doc_id, first_value(doc_id) OVER alike AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = first_value(doc_id) OVER alike AS kept, text_sha256
 FROM docs WINDOW alike AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)"""

#: A mark before a text, one between role and text and one behind have 32 characters; each control string gets one more.
CHAT = r"""WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
 SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(32 + length(role) + length(text) + len(regexp_extract_all(role, '<\\*\|')) + len(regexp_extract_all(text, '<\\*\|')))::BIGINT
   AS formatted_chars
 FROM said GROUP BY conv_id"""

NEAR = r"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') AS t FROM documents),
 shingles AS (
  SELECT DISTINCT doc_id, array_to_string(t[i : i + 3], ' ') AS g
  FROM (SELECT doc_id, t, unnest(range(1, greatest(len(t) - 3, 1) + 1)) AS i FROM words WHERE len(t) > 0)),
 sizes AS (SELECT doc_id, count(g) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
 common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
 links AS (
  SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
 edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
 reached AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reached r JOIN edges e ON e.x = r.y)
 SELECT doc_id, n AS n_shingles, min(y) AS component_id, doc_id = min(y) AS kept
 FROM sizes JOIN reached ON x = doc_id GROUP BY doc_id, n"""


# --- repair: least costs and audits from the last row back -----------------------------
# A value is the cost in eight digits and the audit behind it, so the least string is the
# cheapest edit list, ties ASCII-least.  States 0 to 3: nothing, s, u or a was written last.

NEXT = (2, 2, 3, 2)


def then(edit: str, cost: str, value: str) -> str:
    return f"lpad((substr({value}, 1, 8)::INT + {cost})::VARCHAR, 8, '0') || '{edit}' || substr({value}, 9)"


def _bare(q: int) -> str:
    """The least value before a row in state q, if nothing is inserted before it."""
    kept = {0: "CASE initial WHEN 's' THEN v1 WHEN 'u' THEN v2 END", 1: "CASE initial WHEN 'u' THEN v2 END",
            2: "CASE initial WHEN 'a' THEN v3 END", 3: "CASE initial WHEN 'u' THEN v2 END"}[q]
    options = [
        then("D", "3", f"v{q}"),
        f"CASE WHEN NOT must_go THEN {then('R', '2 + cut', f'v{NEXT[q]}')} END",
        f"CASE WHEN NOT must_go THEN {then('K', 'cut', f'({kept})')} END",
    ]
    return f"least({', '.join(options)})"


def _inserted(q: int) -> str:
    once, twice = NEXT[q], NEXT[NEXT[q]]
    two = then("I", "2", f"b{twice}")
    return f"least(b{q}, {then('I', '2', f'b{once}')}, {then('I', '2', f'({two})')}) AS v{q}"


REPAIR = rf"""WITH RECURSIVE {crc32("SELECT concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS s FROM conversations")},
 drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, crc % 20 AS draw
  FROM conversations JOIN crcs ON s = concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))),
 damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
   CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
   unnest(range(CASE WHEN draw = 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn WHERE draw <> 0),
 placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
   rtrim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS bare FROM damaged),
 seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed),
 faults AS (
  SELECT *, bare = '' AS blank, bare <> '' AND nth > 1 AS duplicate,
   bare <> '' AND nth = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
   left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier FROM seen),
 sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
   count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
   count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faults GROUP BY conv_id),
 least_from AS (
  SELECT conv_id, n AS i, '00000000' AS v0, '00000004II' AS v1, '00000002I' AS v2, '00000000' AS v3 FROM sums
  UNION ALL
  SELECT conv_id, i - 1, {", ".join(_inserted(q) for q in range(4))}
  FROM (SELECT conv_id, i, {", ".join(f"{_bare(q)} AS b{q}" for q in range(4))}
        FROM (SELECT l.*, f.initial, f.blank OR f.duplicate AS must_go, f.truncated::INT AS cut
              FROM least_from l JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i))),
 best AS (SELECT conv_id, substr(v0, 1, 8)::BIGINT AS cost, substr(v0, 9) AS audit FROM least_from WHERE i = 0),
 edits AS (
  SELECT conv_id, j, substr(audit, j, 1) AS edit, length(replace(substr(audit, 1, j), 'I', '')) AS i,
   length(replace(substr(audit, 1, j), 'D', '')) AS place
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM best)),
 applied AS (
  SELECT e.conv_id, j, place, edit, CASE WHEN edit = 'I' THEN '' ELSE f.text END AS text, CASE WHEN edit = 'K' THEN f.role END AS role,
   max((edit = 'K' AND f.initial = 's')::INT) OVER (PARTITION BY e.conv_id) AS led
  FROM edits e LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i WHERE edit <> 'D'),
 spelled_out AS (
  SELECT conv_id, sha256(string_agg(concat(
    coalesce(role, CASE WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END), ':', text), chr(10) ORDER BY j)) AS sha
  FROM applied GROUP BY conv_id)
 SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  coalesce(sha, sha256('')) AS repaired_sha256
 FROM (SELECT DISTINCT conv_id FROM conversations) c
 LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
 LEFT JOIN spelled_out o ON o.conv_id IS NOT DISTINCT FROM c.conv_id"""

ORACLE = {
    "op4_near_dedup": NEAR, "op6_exact_dedup": EXACT, "op7_chat": CHAT, "op11_structure_repair": REPAIR, "op12_prefix_trie": TRIE,
}
