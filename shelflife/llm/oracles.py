"""DuckDB SQL of the operators that SQL can express, for the registered queries."""

from __future__ import annotations

OP3 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY bare) AS group_size,
       row_number() OVER best = 1 AS kept,
       sha256(bare) AS text_sha256
FROM d
WINDOW best AS (PARTITION BY bare ORDER BY chars DESC, doc_id NULLS LAST)
"""

OP7 = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat(coalesce(doc_id::VARCHAR, ''), '|', md5(coalesce(text, '')))) AS tie
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 2 * source_size AS most,
         [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS weight
  FROM s),
o AS (
  SELECT *, row_number() OVER by_room AS place,
         (sum(source_size) OVER () * 150)::DOUBLE / 100.0 AS wanted,
         coalesce(sum(most) OVER (by_room ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
         sum(weight) OVER (by_room ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM w
  WINDOW by_room AS (ORDER BY most::DOUBLE / weight, source IS NULL, source)),
l AS (
  SELECT *, (wanted - given::DOUBLE) / weights::DOUBLE AS level FROM o),
f AS (
  SELECT min_by(level, place) AS level FROM l WHERE most::DOUBLE > level * weight),
t AS (
  SELECT source, source_size,
         CASE WHEN most::DOUBLE <= l.level * weight THEN most::DOUBLE
              ELSE f.level * weight END AS target
  FROM l LEFT JOIN f ON true),
k AS (
  SELECT source, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS weight,
         sum(size)::BIGINT AS class_size
  FROM d GROUP BY ALL),
m AS (
  SELECT k.source, weight, class_size, source_size, target,
         target - (2 * coalesce(sum(class_size) OVER (big ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS rest,
         (sum(class_size * weight) OVER (big ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS weights_left
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
  WINDOW big AS (PARTITION BY k.source ORDER BY weight DESC)),
p AS (
  SELECT source, max_by(rest / weights_left, weight) AS level
  FROM m WHERE weight > 0 AND weights_left * 2.0 > rest * weight::DOUBLE GROUP BY source),
q AS (
  SELECT m.*, CASE WHEN weight = 0 THEN 0.0 WHEN weights_left * 2.0 <= rest * weight::DOUBLE THEN 2.0
                   ELSE level * weight::DOUBLE END AS copies
  FROM m LEFT JOIN p ON m.source IS NOT DISTINCT FROM p.source),
c AS (
  SELECT *, target - (sum(floor(copies)::BIGINT * class_size) OVER (PARTITION BY source))::DOUBLE AS room
  FROM q),
r AS (
  SELECT d.*, source_size, target, room, floor(copies) AS whole, copies - floor(copies) AS p,
         (('0x' || substr(tie, 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source
               AND weight = CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END)
SELECT doc_id, size, source_size, target,
       size * (whole + CASE WHEN p > 0 AND
         coalesce(sum(size) OVER (PARTITION BY source, p > 0 ORDER BY u / (1 - u) * (1 - p) / p, tie
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         + size / 2.0 <= room THEN 1 ELSE 0 END)::BIGINT AS taken
FROM r
"""
OP8 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
m AS (
  SELECT *, length(role) + length(text)
         + len(regexp_extract_all(role, '\\|<turn>|<says>|</turn>|### Assistant:'))
         + len(regexp_extract_all(text, '\\|<turn>|<says>|</turn>|### Assistant:'))
         + length('<turn><says></turn>') + 1 AS chars
  FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
                             ORDER BY turn NULLS FIRST, role, text), '') AS loss,
         sum(chars)::BIGINT AS formatted_chars
  FROM m GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM g
"""

# crc32 of the decimal text of an id, byte by byte through the table of the polynomial
CRC = r"""
crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
           lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab),
crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, length(id) + 1), lambda k: ascii(substr(id, k, 1))::BIGINT)),
           lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))) AS crc
  FROM (SELECT DISTINCT doc_id, coalesce(doc_id::VARCHAR, '') AS id FROM documents), crc_table)
"""

_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_HEAD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
OP11 = rf"""
WITH RECURSIVE {CRC},
d AS (
  SELECT row_number() OVER () AS row, doc_id, source, sha256({_HEAD} || {_FIELD.format("text")}) AS leaf,
         sha256({_HEAD} || {_FIELD.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS lower_leaf
  FROM documents),
l AS (
  SELECT row, d.doc_id, source, leaf, CASE WHEN crc % 5 = 0 THEN lower_leaf ELSE leaf END AS shown,
         row_number() OVER (PARTITION BY source ORDER BY d.doc_id NULLS FIRST, leaf, row) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n
  FROM d JOIN crc ON d.doc_id IS NOT DISTINCT FROM crc.doc_id),
nodes AS (
  SELECT source, 0 AS level, pos, n, leaf AS digest FROM l
  UNION ALL
  SELECT source, level + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY source, level, pos // 16),
sub AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, place AS pos, n, subroot AS digest FROM sub
  UNION ALL
  SELECT level + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY level, pos // 16),
beside AS (
  SELECT source, level, pos, coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WHERE n > 1 WINDOW run AS (PARTITION BY source, level, pos // 16 ORDER BY pos)),
beside_top AS (
  SELECT level, pos, coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM tops WHERE n > 1 WINDOW run AS (PARTITION BY level, pos // 16 ORDER BY pos)),
walk AS (
  SELECT row, source, 0 AS level, pos, shown AS digest, '' AS proof FROM l
  UNION ALL
  SELECT row, w.source, w.level + 1, w.pos // 16, sha256(before || digest || after), proof || before || after
  FROM walk w JOIN beside b ON w.source IS NOT DISTINCT FROM b.source AND w.level = b.level AND w.pos = b.pos),
walk_top AS (
  SELECT row, 0 AS level, place AS pos, max_by(digest, level) AS digest, max_by(proof, level) AS proof
  FROM walk JOIN sub ON walk.source IS NOT DISTINCT FROM sub.source GROUP BY row, place
  UNION ALL
  SELECT row, w.level + 1, w.pos // 16, sha256(before || digest || after), proof || before || after
  FROM walk_top w JOIN beside_top b ON w.level = b.level AND w.pos = b.pos),
f AS (
  SELECT row, max_by(digest, level) AS folded_root, sha256(max_by(proof, level)) AS proof_sha256 FROM walk_top GROUP BY row)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN f USING (row) JOIN sub ON l.source IS NOT DISTINCT FROM sub.source,
     (SELECT digest AS root FROM tops WHERE n = 1)
"""

# A run of n >= max(24, 3q) words holds a stretch of n - q >= 16 words that comes again q
# words later: equal 16-word passages of a document are joined, neighbours put together.
OP12 = rf"""
WITH {CRC},
c AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS raw,
         len(raw) AS n, crc % 10 = 0 AND n > 0 AS echo, crc // 10 AS g, g % greatest(n, 1) AS a, 1 + (n - a) // (3 + g % 8) AS p
  FROM documents JOIN crc USING (doc_id)),
d AS (
  SELECT row, doc_id, n, CASE WHEN echo THEN list_transform(range(n), lambda i: raw[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
                              ELSE raw END AS words
  FROM c),
w AS (
  SELECT row, n, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i FROM d WHERE n >= 24),
gram AS (
  SELECT row, n, i, string_agg(word, ' ') OVER (PARTITION BY row ORDER BY i ROWS BETWEEN CURRENT ROW AND 15 FOLLOWING) AS gram FROM w),
pair AS (
  SELECT x.row, x.i, y.i - x.i AS q
  FROM gram x JOIN gram y ON x.row = y.row AND x.gram = y.gram AND x.i < y.i AND 3 * (y.i - x.i) <= x.n
  WHERE x.i + 16 <= x.n AND y.i + 16 <= x.n),
island AS (
  SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM pair),
stretch AS (
  SELECT row, q, min(i) AS start, max(i) + 16 + q - min(i) AS length FROM island GROUP BY row, q, island),
run AS (
  SELECT row, start, length, min(q) AS period FROM stretch WHERE length >= greatest(24, 3 * q) GROUP BY row, start, length),
best AS (
  SELECT * FROM run a WHERE NOT EXISTS (
    SELECT 1 FROM run b WHERE a.row = b.row AND (b.length * a.period > a.length * b.period OR (
      b.length * a.period = a.length * b.period AND (b.start, b.period) < (a.start, a.period))))),
of_doc AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         list({{'a': start + period, 'b': start + length}}) AS cuts
  FROM run GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(array_to_string(list_filter(words, lambda x, i: NOT coalesce(list_bool_or(list_transform(cuts,
         lambda r: i - 1 >= r.a AND i - 1 < r.b)), false)), ' '), '')) AS collapsed_sha256
FROM d LEFT JOIN of_doc USING (row) LEFT JOIN best USING (row)
"""

OP13 = r"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.row, a.vec_id AS query_id, b.vec_id AS vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.row <> b.row)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM s)
WHERE rank <= 10
"""
