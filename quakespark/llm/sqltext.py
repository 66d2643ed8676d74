"""SQL counterparts of the queries."""

from __future__ import annotations

#: Takes (conv_id, turn) as the name of a message; passages are compared as text where the operator compares their hashes.
OP1 = r"""
WITH RECURSIVE split AS (
  SELECT conv_id, turn, role, text, string_split(coalesce(text, ''), chr(10)) AS lines,
         row_number() OVER (ORDER BY conv_id NULLS FIRST, turn NULLS FIRST, role, text) AS id
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
), parsed AS (
  SELECT *, list_transform(lines, lambda x: len(regexp_replace(regexp_extract(x, '^(?:[ \t]*>)+'), '[^>]', '', 'g'))) AS levels FROM split
), m AS (
  SELECT *, CASE WHEN list_max(levels) > 0 THEN regexp_replace(array_to_string(list_filter(lines, lambda x, i:
      levels[i] = 0 AND NOT (coalesce(levels[i + 1], 0) > 0
        AND regexp_matches(x, '(?i)^[ \t]*(?:on|am|le|el)\b.*\b(?:wrote|schrieb|écrit|a écrit|escribió)\b.*:[ \t\r]*$'))), chr(10)),
      '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g') ELSE coalesce(text, '') END AS own
  FROM parsed
), marked AS (
  SELECT id, unnest(lines) AS line, unnest(levels) AS level, generate_subscripts(lines, 1) AS place
  FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), quoted AS (
  SELECT id, level, place, place - row_number() OVER (PARTITION BY id, level ORDER BY place) AS run, regexp_replace(line, '^(?:[ \t]*>)+', '') AS body
  FROM marked WHERE level > 0
), asked AS (
  SELECT DISTINCT id, level, trim(regexp_replace(lower(passage), '[ \t\n\x0B\f\r\x{A0}]+', ' ', 'g'), ' ') AS passage FROM (
    SELECT id, level, body AS passage FROM quoted
    UNION ALL SELECT id, level, string_agg(body, ' ' ORDER BY place) FROM quoted GROUP BY id, level, run
  )
), said AS (
  SELECT id, conv_id, trim(regexp_replace(lower(passage), '[ \t\n\x0B\f\r\x{A0}]+', ' ', 'g'), ' ') AS passage FROM (
    SELECT id, conv_id, unnest(list_concat(regexp_split_to_array(own, '\n[ \t\r]*\n'), string_split(own, chr(10)))) AS passage
    FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL
  )
), near AS (SELECT passage, conv_id, min(id) AS id FROM said GROUP BY passage, conv_id
), far AS (SELECT passage, min(id) AS id FROM said GROUP BY passage
), found AS (
  SELECT a.id, a.level, CASE WHEN n.turn < me.turn THEN n.id WHEN (f.conv_id, f.turn) < (me.conv_id, me.turn) THEN f.id END AS of_id, len(a.passage) AS size
  FROM asked a JOIN m me ON me.id = a.id
  LEFT JOIN near ON near.passage = a.passage AND near.conv_id = me.conv_id LEFT JOIN m n ON n.id = near.id
  LEFT JOIN far ON far.passage = a.passage LEFT JOIN m f ON f.id = far.id
  WHERE len(a.passage) >= 8
), links AS (SELECT id, level, of_id, sum(size) AS size FROM found WHERE of_id IS NOT NULL GROUP BY id, level, of_id
), counts AS (SELECT id, count(*) AS n_links FROM links GROUP BY id
), parents AS (
  SELECT id, of_id FROM links QUALIFY row_number() OVER (PARTITION BY id ORDER BY level, size DESC, of_id DESC) = 1
), chain(id, top, depth) AS (
  SELECT id, of_id, 1 FROM parents
  UNION ALL
  SELECT c.id, p.of_id, c.depth + 1 FROM chain c JOIN parents p ON p.id = c.top
), roots AS (SELECT id, arg_max(top, depth) AS root, max(depth) AS depth FROM chain GROUP BY id
), placed AS (
  SELECT m.*, coalesce(n_links, 0) AS n_links, reply.conv_id AS reply_conv, reply.turn AS reply_turn,
         CASE WHEN roots.id IS NULL THEN m.conv_id ELSE start.conv_id END AS thread_conv, coalesce(depth, 0) AS depth
  FROM m LEFT JOIN counts USING (id) LEFT JOIN parents USING (id) LEFT JOIN m reply ON reply.id = of_id
  LEFT JOIN roots USING (id) LEFT JOIN m start ON start.id = root
), numbered AS (SELECT *, row_number() OVER (PARTITION BY thread_conv ORDER BY id) - 1 AS position FROM placed)
SELECT c.conv_id, c.turn, c.role, len(list_filter(levels, lambda x: x > 0)) AS n_quoted, CAST(list_max(levels) AS INTEGER) AS max_level,
       n_links, reply_conv, reply_turn, thread_conv, CAST(depth AS INTEGER) AS depth, position, sha256(own) AS text_sha256
FROM conversations c JOIN numbered n ON c.conv_id IS NOT DISTINCT FROM n.conv_id AND c.turn IS NOT DISTINCT FROM n.turn
  AND c.role IS NOT DISTINCT FROM n.role AND c.text IS NOT DISTINCT FROM n.text
"""

OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

OP7 = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT doc_id, line_no, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM split WHERE trim(raw, ' ' || chr(9) || chr(13)) <> ''
), u AS (
  SELECT line, length(line) AS n, min((doc_id, line_no)) AS first FROM lines GROUP BY line
), halves AS (
  SELECT DISTINCT line, n, first, k, left(line, k) AS part, 0 AS side FROM (SELECT *, unnest([n // 2, (n - 1) // 2]) AS k FROM u WHERE n >= 15)
  UNION ALL
  SELECT DISTINCT line, n, first, k, right(line, k) AS part, 1 AS side FROM (SELECT *, unnest([n // 2, (n - 1) // 2]) AS k FROM u WHERE n >= 15)
), pairs AS (
  SELECT DISTINCT a.line AS early, a.n AS m, b.line AS late, b.n
  FROM halves a JOIN halves b ON a.k = b.k AND a.part = b.part AND a.side = b.side
    AND a.first < b.first AND abs(a.n - b.n) <= 1 AND greatest(a.n, b.n) >= 16
), near AS (
  SELECT DISTINCT late AS line FROM pairs
  WHERE CASE WHEN n = m THEN len(list_filter(range(1, n + 1), lambda i: substr(early, i, 1) <> substr(late, i, 1))) = 1
    WHEN n > m THEN len(list_filter(range(1, n + 1), lambda i: left(late, i - 1) || substr(late, i + 1) = early)) > 0
    ELSE len(list_filter(range(1, m + 1), lambda i: left(early, i - 1) || substr(early, i + 1) = late)) > 0 END
), marked AS (
  SELECT l.doc_id, l.line_no, (l.doc_id, l.line_no) = u.first AS head, near.line IS NOT NULL AS is_near
  FROM lines l JOIN u USING (line) LEFT JOIN near USING (line)
), gone AS (
  SELECT doc_id, count(*) FILTER (NOT head) AS n_exact, count(*) FILTER (head) AS n_near,
         string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS removed
  FROM marked WHERE NOT head OR is_near GROUP BY doc_id
), counts AS (SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near,
       coalesce(removed, '') AS removed
FROM documents d LEFT JOIN counts USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

OP9 = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
    (CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
      / 4503599627370496.0::DOUBLE AS u
  FROM documents
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2 * CAST(sum(size) AS BIGINT) AS most,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM sized GROUP BY source
), level(step, n_full, height) AS (
  SELECT 0, CAST(-1 AS BIGINT), 0.0::DOUBLE
  UNION ALL
  SELECT step + 1, f.n, f.height FROM (
    SELECT step, n_full, count(*) FILTER (w * level.height > most) AS n,
      (1.5::DOUBLE * sum(source_size) - coalesce(sum(most) FILTER (w * level.height > most), 0)) / sum(w) FILTER (w * level.height <= most) AS height
    FROM level, src GROUP BY step, n_full
  ) f WHERE f.n <> f.n_full
), wanted AS (
  SELECT source, source_size, least(CAST(most AS DOUBLE), w * (SELECT max(height) FROM level)) AS target FROM src
), p AS (
  SELECT s.doc_id, s.size, s.u, s.source, source_size, target, floor(CASE WHEN source_size > 0 THEN target / CAST(source_size AS DOUBLE) ELSE 0 END) AS whole,
    CASE WHEN source_size > 0 THEN target / CAST(source_size AS DOUBLE) ELSE 0 END AS ratio
  FROM sized s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source
), o AS (
  SELECT *, target - whole * source_size AS rest, CASE WHEN ratio - whole > 0 THEN (u / (1 - u)) / ((ratio - whole) / (1 - (ratio - whole))) END AS odds FROM p
), c AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM o
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST((whole + CASE WHEN odds IS NOT NULL AND upto - size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM c
"""

OP11 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT id, doc_id, list_sort(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS grams FROM d
), c AS (SELECT grams, min(id) AS node, min(doc_id) AS first_id, len(grams) AS n FROM g WHERE len(grams) > 0 GROUP BY grams
), u AS (SELECT node, n, unnest(grams) AS gram FROM c
), met AS (SELECT a.node AS a, b.node AS b, a.n AS na, b.n AS nb, count(*) AS k FROM u a JOIN u b ON a.gram = b.gram AND a.node <> b.node GROUP BY a.node, b.node, a.n, b.n
), e AS (SELECT a, b FROM met WHERE 100 * k >= 85 * (na + nb - k)
), reach AS (
  SELECT node, node AS other FROM c
  UNION
  SELECT reach.node, e.b FROM reach JOIN e ON e.a = reach.other
), names AS (SELECT reach.node, min(first_id) AS component_id FROM reach JOIN c ON c.node = reach.other GROUP BY reach.node
), out AS (
  SELECT doc_id, len(g.grams) AS n_shingles, CASE WHEN len(g.grams) = 0 THEN doc_id ELSE component_id END AS component_id
  FROM g LEFT JOIN c ON c.grams = g.grams LEFT JOIN names ON names.node = c.node
)
SELECT doc_id, n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept FROM out
"""

OP12 = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM words LEFT JOIN marks USING (doc_id)
), kinds AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (bad) AS n_toxic FROM failed GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS f, left(filter_order, step - 1) AS before
  FROM (SELECT DISTINCT part FROM kinds), orders, (SELECT unnest(range(1, 6)) AS step)
), counted AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN translate(fails, before || f, '') = fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') <> fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN n_good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN n_toxic ELSE 0 END) AS toxic_lost
  FROM steps JOIN kinds USING (part) GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""

OP13 = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents
), tok AS (
  SELECT id, lang, source, translate(unnest(regexp_extract_all(t, '[A-Za-z\x{80}-\x{10FFFF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d
), kept AS (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), groups AS (SELECT DISTINCT lang, source FROM d
), c AS (SELECT lang, source, term, count(*) AS n FROM tok SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), cl AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term
), dense AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
  SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM dense JOIN v USING (lang)
), q AS (
  SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q FROM cl JOIN v USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

#: The other queries need a tokenizer's tables, trained numbers or XXH64, or follow links; they are tested against brute force.
ORACLES = {
    "op1_quotation_linking": OP1, "op2_vector_approximation": OP2, "op7_line_dedup": OP7, "op9_pareto_mix": OP9,
    "op11_setsketch": OP11, "op12_filter_audit": OP12, "op13_source_divergence": OP13,
}
