"""Checking SQL of the corpus operators that SQL can express, for DuckDB."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE["op10_line_dedup"] = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, {_BLANKS}),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, max(doc_id) AS keeper
    FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT doc_id, line, pos, coalesce(keeper <> doc_id, false) AS gone
    FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
           AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLE["op1_exact_topk"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

ORACLE["op9_embedding_near_dedup"] = """
WITH RECURSIVE usable AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND label IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
    SELECT a.vec_id AS one, b.vec_id AS other
    FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reached(start, spot) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT start, other FROM reached JOIN links ON one = spot
), named AS (
    SELECT start, min(spot) AS component_id FROM reached GROUP BY start
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE one = e.vec_id) AS n_links, component_id,
       e.vec_id = component_id AS kept
FROM embeddings e JOIN named ON start = e.vec_id
"""

ORACLE["op11_chat_formatting"] = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
           (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), placed AS (
    SELECT *, row_number() OVER w AS pos,
           lag(role) OVER w IS DISTINCT FROM role OR row_number() OVER w = 1 AS opens
    FROM rows
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
    -- a backslash more for each one, each control string, each two marks before a third
    SELECT *,
           list_transform([text, role], lambda s: length(s) + length(s) - length(replace(s, '\', ''))
               + len(regexp_extract_all(s, '</turn>|<more>'))
               + coalesce(list_sum(list_transform(regexp_extract_all(s, '###+'),
                                                  lambda m: (length(m) - 1) // 2)), 0)) AS long
    FROM placed
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), ''))
           AS loss_sha256,
       sum(long[1]::BIGINT
           + CASE WHEN opens THEN 14 + long[2]::BIGINT + len(regexp_extract_all(role, ': ')) ELSE 6 END
          )::BIGINT AS formatted_chars,
       sum(opens::INT)::BIGINT AS n_blocks
FROM sized GROUP BY conv_id
"""

ORACLE["op13_conversation_trie"] = r"""
WITH RECURSIVE turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
           substr(sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '')
                         || coalesce(text, '')), 1, 32) AS name
    FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT conv_id, name, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, name) - 1 AS pos
    FROM turns
), convs AS (
    SELECT conv_id AS c, conv_id - conv_id % 20 AS base,
           xor(list_reduce([4294967295::UBIGINT] || list_transform(
                   string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::UBIGINT),
               lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda u, v: xor(u >> 1, (u & 1) * 3988292384))), 4294967295::UBIGINT) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM placed)
), rebuilt AS (
    SELECT c, 0 AS part, pos, name, words FROM convs JOIN placed ON conv_id = base AND pos < h
    UNION ALL
    SELECT c, 1, pos, name, words FROM convs JOIN placed ON conv_id = c AND pos >= h
), numbered AS (
    SELECT c, name, words, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d FROM rebuilt
), paths AS (
    SELECT c, coalesce(string_agg(name, '' ORDER BY d), '') AS path, coalesce(max(d), 0) AS long
    FROM convs LEFT JOIN numbered USING (c) GROUP BY c
), members AS (
    SELECT c, long, unnest(range(long + 1)) AS d, path FROM paths
), starts AS (
    SELECT c, m.d, substr(path, 1, 32 * m.d) AS key, long = m.d AS ends, coalesce(words, 0) AS words
    FROM members m LEFT JOIN numbered USING (c, d)
), nodes AS MATERIALIZED (
    SELECT key, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), ''))
               AS ends_sha256
    FROM starts GROUP BY key
), children AS (
    SELECT substr(key, 1, 32 * (depth - 1)) AS key, count(*) AS n_children
    FROM nodes WHERE depth > 0 GROUP BY 1
), weighed AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (key)
), sums AS (
    SELECT top, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
           sum((n_convs - 1) * words) AS saved_tokens
    FROM (SELECT *, substr(key, 1, 32 * unnest(range(depth + 1))) AS top FROM weighed) GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM weighed n JOIN sums ON top = n.key
LEFT JOIN nodes p ON n.depth > 0 AND p.key = substr(n.key, 1, 32 * (n.depth - 1))
"""
