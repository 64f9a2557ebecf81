"""DuckDB SQL for the corpus queries that SQL can express, written on its own from their contracts."""

from __future__ import annotations

_OP9 = r"""
WITH sized AS (
  SELECT doc_id, source, text,
    len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT AS size
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u,
    greatest(0.1, 1.0 - 3.0 * coalesce((length(text) - length(translate(text, '#*$%&|<>0123456789', '')))
      / greatest(length(text), 1)::DOUBLE, 0.0)) AS quality
  FROM sized),
ordered AS (SELECT doc_id, source, size, -ln(u) / quality AS k FROM keyed),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][1 + ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3] AS w
  FROM sized GROUP BY source),
-- the level at which the sources that do not stop share what is left: the smallest one that deals everything out
levels AS (
  SELECT (1.5 * (SELECT sum(source_size) FROM totals)::DOUBLE
      - coalesce((SELECT sum(2 * b.source_size) FROM totals b WHERE 2.0 * b.source_size / b.w < 2.0 * a.source_size / a.w), 0)::DOUBLE) AS rest,
    (SELECT sum(b.w) FROM totals b WHERE 2.0 * b.source_size / b.w >= 2.0 * a.source_size / a.w)::DOUBLE AS rest_w,
    2.0 * a.source_size / a.w AS fill
  FROM totals a),
level AS (SELECT rest, rest_w FROM levels WHERE rest / rest_w < fill ORDER BY fill LIMIT 1),
targets AS (
  SELECT source, source_size,
    least(2.0 * source_size, coalesce((SELECT rest * w / rest_w FROM level), 2.0 * source_size))::DOUBLE AS target
  FROM totals),
placed AS (
  SELECT o.*, t.source_size, t.target,
    (CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END)::BIGINT AS epochs,
    sum(size) OVER (PARTITION BY o.source ORDER BY k, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM ordered o JOIN targets t ON o.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * epochs + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM placed"""

_OP5 = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[pos : pos + size - 1], ' ') AS win
  FROM (SELECT item_id, words, least(10, len(words)) AS size,
          unnest(range(1, len(words) - least(10, len(words)) + 2)) AS pos
        FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, pos, array_to_string(words[pos : pos + size - 1], ' ') AS win
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
        FROM w, sizes WHERE len(words) >= size)),
occurs AS (SELECT p.doc_id, p.pos, p.size, v.item_id FROM places p JOIN windows v ON p.size = v.size AND p.win = v.win),
hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM (SELECT DISTINCT doc_id, pos, size FROM occurs))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    sha256(array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',')) AS digest
  FROM occurs GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, coalesce(digest, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

_OP12 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces
), grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
    FROM words, range(1, 6) AS sizes(k)
), totals AS (
    SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang
), counts AS (
    SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), larger AS (
    SELECT lang, array_to_string(string_split(phrase, ' ')[:-2], ' ') AS phrase, f FROM counts WHERE k > 2
    UNION ALL SELECT lang, array_to_string(string_split(phrase, ' ')[2:], ' '), f FROM counts WHERE k > 2
), kept AS (
    SELECT lang, k, phrase, f FROM counts AS c WHERE k > 1
        AND NOT EXISTS (SELECT 1 FROM larger AS x WHERE x.lang = c.lang AND x.phrase = c.phrase AND 100 * x.f >= 100 * c.f)
), cuts AS (
    SELECT kept.*, cut, array_to_string(string_split(phrase, ' ')[1:cut], ' ') AS head,
        array_to_string(string_split(phrase, ' ')[cut + 1:], ' ') AS tail
    FROM kept, range(1, 5) AS places(cut) WHERE cut < k
), scored AS (
    SELECT cuts.lang, cuts.phrase, cuts.f AS a, cut, h.f AS l, t.f AS r, n,
        CAST((1000::HUGEINT * cuts.f * n) // (h.f::HUGEINT * t.f) AS BIGINT) AS score
    FROM cuts JOIN totals USING (lang)
        JOIN counts AS h ON h.lang = cuts.lang AND h.phrase = head
        JOIN counts AS t ON t.lang = cuts.lang AND t.phrase = tail
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

# The checksum of a number as text is taken bit by bit, as there is no function for it
_OP13 = r"""
WITH ordered AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), headed AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, turns, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 9 AS h
    FROM ordered
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:h], []), c.turns[h + 1:]) AS turns
    FROM headed AS c LEFT JOIN ordered AS b ON b.conv_id = c.base
), members AS (
    SELECT conv_id, len(turns) AS size, depth, turns[1:depth] AS path
    FROM rebuilt, LATERAL (SELECT unnest(range(0, len(turns) + 1)) AS depth)
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) = depth AS leaf,
        CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * strlen(path[depth].text) END AS saved,
        sha256(coalesce(string_agg(CASE WHEN size = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM members GROUP BY path, depth
), below AS (
    SELECT path[1:d] AS top, sum(leaf::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens,
        count(*) FILTER (WHERE depth = d + 1) AS n_children
    FROM nodes, LATERAL (SELECT unnest(range(0, depth + 1)) AS d) GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes AS n JOIN below ON top = n.path LEFT JOIN nodes AS p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""

SQL = {
    "op5_decontaminate": _OP5,
    "op9_mix": _OP9,
    "op12_collocations": _OP12,
    "op13_conversation_trie": _OP13,
}
