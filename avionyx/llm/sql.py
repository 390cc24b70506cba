"""DuckDB SQL for the dealt operators that SQL can express."""

from __future__ import annotations

OP10_QUALITY_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d
), p AS (
  SELECT rid, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 3)
), twice AS (
  SELECT rid, i FROM p QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1
), rep AS (
  SELECT rid, count(DISTINCT pos) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS pos FROM twice) GROUP BY rid
), lines AS (
  SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d
), l AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), m AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines
  FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN l USING (rid)
), b AS (
  SELECT *, CAST(
      CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 80 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END AS BIGINT) AS fail_bits
  FROM m
)
SELECT *, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept FROM b
"""

# DuckDB has no base32: the digest is spelled from the bits of the SHA-1.
OP1_WARC_NORMALISE = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT h, count(*) AS n, max(page_id) AS newest, (
    SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(('0x' || substr(g, 1, 5))::BIGINT >> (15 - 5 * k) AS INT) % 32, 1), '' ORDER BY i, k)
    FROM (SELECT i, substr(h, 1 + 5 * i, 5) AS g, unnest([0, 1, 2, 3]) AS k FROM (SELECT unnest(generate_series(0, 7)) AS i))
  ) AS payload_digest
  FROM p GROUP BY h
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM p JOIN d USING (h)
"""

# All links by an inverted index of the full sets, then components by repeated
# label spreading to the smallest reachable id.
OP6_MINHASH_NEAR_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS sh
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 1, 1))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * ((SELECT n FROM n WHERE n.doc_id = a.doc_id) + (SELECT n FROM n WHERE n.doc_id = b.doc_id) - count(*))
), reach AS (
  SELECT u AS doc_id, v AS other FROM links
  UNION
  SELECT r.doc_id, l.v FROM reach r JOIN links l ON r.other = l.u
), c AS (
  SELECT d.doc_id, least(d.doc_id, coalesce(min(r.other), d.doc_id)) AS component_id
  FROM documents d LEFT JOIN reach r USING (doc_id) GROUP BY d.doc_id
)
SELECT c.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

# crc32 bit by bit over the digits of the id; nodes are told by their whole list of turns.
OP11_PREFIX_TRIE = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, upper(md5(length(role) || ':' || role || text))) AS turns
  FROM t GROUP BY conv_id
), h AS (
  SELECT conv_id, turns, xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(conv_id::VARCHAR, '')])),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END
  ), 4294967295::BIGINT) % 4 AS h FROM own
), rebuilt AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:h], h.turns[h + 1:]) AS turns
  FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20
), m AS (
  SELECT conv_id, d AS depth, turns[1:d] AS path, len(turns) = d AS ends
  FROM (SELECT conv_id, turns, unnest(generate_series(0, len(turns))) AS d FROM rebuilt)
), node AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
    CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(path[depth].t, '[^\x20\x09-\x0D]+')) END AS own_saved
  FROM m GROUP BY depth, path
), kids AS (
  SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL
), full_node AS (
  SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (depth, path)
), up AS (
  SELECT u.d AS depth, path[1:u.d] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(own_saved) AS saved_tokens
  FROM full_node, LATERAL (SELECT unnest(generate_series(0, depth)) AS d) u GROUP BY ALL
)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(f.n_convs AS BIGINT) AS n_convs,
  CAST(f.n_children AS BIGINT) AS n_children, CAST(up.n_leaves AS BIGINT) AS n_leaves, CAST(up.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_node f JOIN up USING (depth, path) LEFT JOIN node p ON p.depth = f.depth - 1 AND p.path = f.path[1:f.depth - 1]
"""

# Water filling in closed form: with the sources in order of cap to weight, the first j are at their caps.
OP12_WEIGHTED_MIX = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    length(translate(text, E' \t\n\x0b\x0c\r', '')) AS inked,
    length(translate(text, E' \t\n\x0b\x0c\r0123456789#*$%&|<>{}[]=_@/^~+', '')) AS plain
  FROM documents
), k AS (
  SELECT doc_id, source, CAST(size AS BIGINT) AS size, CASE WHEN inked > 0 THEN greatest(0.05::DOUBLE, plain::DOUBLE / inked) ELSE 0.05::DOUBLE END AS quality,
    (CAST('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), coalesce(source, ''), md5(text), '12')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM k GROUP BY source
), c AS (
  SELECT *, 1 + (rank - 1) % 3 AS weight, 3 * source_size AS cap FROM s
), o AS (
  SELECT *, row_number() OVER w AS j, sum(cap) OVER w AS caps, sum(weight) OVER w AS weights, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weights
  FROM c WINDOW w AS (ORDER BY cap::DOUBLE / weight, rank)
), cut AS (
  SELECT coalesce(min(j), 0) AS j FROM (
    SELECT j - 1 AS j FROM o WHERE cap * (all_weights - (weights - weight)) > weight * (total - (caps - cap))
  )
), fill AS (
  SELECT coalesce(max(caps) FILTER (j <= (SELECT j FROM cut)), 0) AS caps, coalesce(max(weights) FILTER (j <= (SELECT j FROM cut)), 0) AS weights FROM o
), tg AS (
  SELECT o.source, source_size,
    CASE WHEN j <= (SELECT j FROM cut) THEN cap::DOUBLE
      ELSE CAST(weight * (total - f.caps) AS DOUBLE) / CAST(all_weights - f.weights AS DOUBLE) END AS target
  FROM o, fill f
), r AS (
  SELECT k.*, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS goal,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY -ln(u) / quality, doc_id NULLS FIRST, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN tg ON k.source IS NOT DISTINCT FROM tg.source
)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0
  ELSE goal // source_size * size + greatest(0, least(size, goal % source_size - before)) END AS BIGINT) AS taken, source, quality
FROM r
"""

OP13_RANKED_SEARCH = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), i AS (
  SELECT row_number() OVER () AS qid, item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM benchmark
), n AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS l FROM d WHERE len(ts) > 0
), q AS (
  SELECT qid, item_id, term, count(*) AS qtf FROM (SELECT qid, item_id, unnest(ts) AS term FROM i) GROUP BY ALL
), p AS (
  SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(ts) AS n, unnest(ts) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
), f AS (
  SELECT term, count(*) AS df FROM p GROUP BY term
), s AS (
  SELECT qid, item_id, rid, doc_id, sum(qtf * CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * p.n * n_docs) // l)))) AS score
  FROM q JOIN p USING (term) JOIN f USING (term), n GROUP BY ALL
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0
) WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op1_warc_normalise": OP1_WARC_NORMALISE,
    "op6_minhash_near_dedup": OP6_MINHASH_NEAR_DEDUP,
    "op10_quality_rules": OP10_QUALITY_RULES,
    "op11_prefix_trie": OP11_PREFIX_TRIE,
    "op12_weighted_mix": OP12_WEIGHTED_MIX,
    "op13_ranked_search": OP13_RANKED_SEARCH,
}
