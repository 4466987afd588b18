"""DuckDB SQL for the queries that SQL can say."""

from __future__ import annotations

from sitegrid.llm.secret_ledger import BASE_RULES

_WORD = r"[^\x20\x09-\x0D]+"

SUBSTRING_DEDUP = rf"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), windows AS (
  SELECT doc_id, pos, array_to_string(list_slice(w, pos, pos + 12), ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS pos FROM split WHERE len(w) >= 13)
), least AS (
  SELECT win, min(doc_id) AS first_doc FROM windows GROUP BY win
), hits AS (
  SELECT doc_id, pos FROM windows JOIN least USING (win) WHERE first_doc < doc_id
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos FROM hits
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM split
), kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
  FROM words ANTI JOIN covered ON covered.doc_id = words.doc_id AND covered.pos = words.pos GROUP BY words.doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""


def _spans(at: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Spans of one rule: the pieces between matches give their places."""
    quoted = pattern.replace("((?i)password|passwd|secret|token|api_?key)", "((?i:password|passwd|secret|token|api_?key))").replace("'", "''")
    return f"""
  SELECT doc_id, {at} AS kind_at, '{kind}' AS kind, start, start + len(found) AS stop, len(value) >= {least} AS holds FROM (
    SELECT doc_id, m[i] AS found, v[i] AS value,
      CAST(list_sum(list_transform(s[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS start
    FROM (
      SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT doc_id, regexp_extract_all(text, '{quoted}', 0) AS m, regexp_extract_all(text, '{quoted}', {group}) AS v,
          regexp_split_to_array(text, '{quoted}') AS s
        FROM documents WHERE regexp_matches(text, '{quoted}'))))"""


_KEY_MARK = "PRIVATE KEY(?: BLOCK)?-----"
#: private keys: what follows each BEGIN is looked at by itself, up to the first END line in it. A key
#: without an END line shows its heading only; tests compare those with the pattern in Python.
_PEM_SPANS = rf"""
  SELECT doc_id, 3 AS kind_at, 'pem' AS kind, start, start + 11 + len(coalesce(nullif(whole, ''), head)) AS stop, true AS holds FROM (
    SELECT doc_id, regexp_extract(s[i], '^[A-Z0-9 ]*{_KEY_MARK}') AS head,
      regexp_extract(s[i], '^[A-Z0-9 ]*{_KEY_MARK}(?:[\s\S])*?-----END [A-Z0-9 ]*{_KEY_MARK}') AS whole,
      CAST(list_sum(list_transform(s[1:i - 1], lambda x: len(x))) + 11 * (i - 2) AS BIGINT) AS start
    FROM (
      SELECT *, unnest(range(2, len(s) + 1)) AS i FROM (
        SELECT doc_id, string_split(text, '-----BEGIN ') AS s FROM documents WHERE contains(text, '-----BEGIN '))))
  WHERE head <> ''"""


_KINDS = "".join(f", count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
SECRET_LEDGER = f"""
WITH spans AS (SELECT *, kind || ':' || start || ':' || stop AS span FROM ({" UNION ALL ".join([*(_spans(i, r.kind, r.pattern, r.group, r.least) for i, r in enumerate(BASE_RULES)), _PEM_SPANS])}) WHERE holds),
per_doc AS (
  SELECT doc_id{_KINDS},
    string_agg(span, ',' ORDER BY start, kind_at) FILTER (kind_at < 3) AS base, string_agg(span, ',' ORDER BY start, kind_at) AS spans
  FROM spans GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"CAST(coalesce(n_{r.kind}, 0) AS BIGINT) AS n_{r.kind}" for r in BASE_RULES)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN per_doc USING (doc_id)
"""


def _draw(k: int) -> str:
    """The k-th eight hex digits of a hash as a whole number."""
    return f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split(substr(hash, {8 * k + 1}, 8), ''), lambda x: CAST(position(x IN '0123456789abcdef') - 1 AS BIGINT))), lambda a, b: a * 16 + b)"


FILL_IN_MIDDLE = f"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '(?s)[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash FROM documents
), drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, {", ".join(f"{_draw(k)} AS h{k + 1}" for k in range(4))} FROM units
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS c1, greatest(h1 % (n + 1), h2 % (n + 1)) AS c2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, array_to_string(u[1:c1], '') AS p, array_to_string(u[c1 + 1:c2], '') AS m, array_to_string(u[c2 + 1:], '') AS s FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


#: crc32 of the decimal digits, bit by bit: each byte is followed by seven zeros
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
  lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)), 4294967295)"""

CONVERSATION_TRIE = rf"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), steps AS (
  SELECT conv_id, row_number() OVER w AS depth, len(regexp_extract_all(text, '{_WORD}')) AS words,
    string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS path
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
), members AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0 AS words FROM convs UNION ALL SELECT conv_id, depth, path, words FROM steps
), lengths AS (
  SELECT conv_id, max(depth) AS n FROM members GROUP BY conv_id
), nodes AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = n), '')) AS ends_sha256
  FROM members JOIN lengths USING (conv_id) GROUP BY path
), linked AS (
  SELECT v.*, p.conv_id AS parent_conv_id, coalesce(k.n, 0) AS n_children FROM nodes v
  LEFT JOIN nodes p ON v.depth > 0 AND p.path = left(v.path, 32 * (v.depth - 1))
  LEFT JOIN (SELECT left(path, 32 * (depth - 1)) AS above, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above) k ON k.above = v.path
), sums AS (
  SELECT left(path, 32 * d) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM linked) GROUP BY ALL
)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM linked JOIN sums USING (path)
"""


def _replaced(column: str, pairs) -> str:
    for a, b in pairs:
        column = f"replace({column}, {a}, {b})"
    return column


_ROLE = _replaced("role", [("'\\'", "'\\\\'"), ("'<'", "'\\l'"), ("'>'", "'\\g'"), ("chr(10)", "'\\n'")])
_TEXT = _replaced("text", [("'<turn:'", "'\\<turn:'"), ("'</turn>'", "'\\</turn>'")])
_ODD = r"\### Assistant: </turn> ok"
CHAT_PREFIX_TREE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{_ODD}'), (-7, 1, 'assistant', '{_ODD}')
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<turn:' || {_ROLE} || '>' || chr(10) || {_TEXT} || chr(10) || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""
