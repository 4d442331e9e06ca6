"""The SQL that checks the queries it can express, in DuckDB's dialect."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op2_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words
), posts AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS common
  FROM posts a JOIN posts b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (SELECT a, b FROM pairs WHERE 100 * common >= 75 * (na + nb - common)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, CAST(min(other) AS BIGINT) AS component_id
FROM sets JOIN reach USING (doc_id) GROUP BY ALL
"""

ORACLE["op7_warc_index"] = r"""
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), words AS (
  SELECT page_id, payload_bytes, hex, list_transform(range(8), lambda k: ('0x' || substr(hex, 1 + 5 * k, 5))::INTEGER) AS w
  FROM digests
), coded AS (
  SELECT page_id, payload_bytes, hex, array_to_string(list_transform(range(32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((w[1 + k // 4] >> (15 - 5 * (k % 4))) & 31), 1)), '') AS payload_digest
  FROM words
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM coded WINDOW same AS (PARTITION BY hex, payload_bytes)
"""

ORACLE["op6_block_search"] = r"""
WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""

ORACLE["op13_repeated_passages"] = r"""
WITH split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS pos, unnest(list_transform(range(1, len(w) - 18), lambda i: sha256(array_to_string(w[i:i + 19], ' ')))) AS h
  FROM split WHERE len(w) >= 20
), later AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY h ORDER BY doc_id, pos) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM later, (SELECT unnest(range(20)) AS k)
), lists AS (SELECT doc_id, list(pos) AS ats, count(*) AS n FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM split),
left_over AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.pos) AS kept FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.pos = words.pos
  WHERE gone.pos IS NULL GROUP BY words.doc_id
)
SELECT split.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(lists.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN lists USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

ORACLE["op12_prefix_trie"] = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), crcs AS (
  SELECT conv_id, list_reduce(
    list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, x: CASE WHEN xor(a, x) & 1 = 1 THEN xor(xor(a, x) >> 1, 3988292384) ELSE xor(a, x) >> 1 END) AS c
  FROM (SELECT DISTINCT conv_id FROM turns)
), convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, xor(c, 4294967295) % 9 AS h FROM crcs),
parts AS (
  SELECT convs.conv_id, 0 AS part, p, role, text FROM convs JOIN turns ON turns.conv_id = convs.base AND p <= h
  UNION ALL
  SELECT convs.conv_id, 1 AS part, p, role, text FROM convs JOIN turns ON turns.conv_id = convs.conv_id AND p > h
), rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    sha256(octet_length(encode(role)) || ':' || role || text) AS digest, octet_length(encode(text)) AS bytes FROM parts
), prefixes AS (
  SELECT conv_id, i AS depth, n, bytes, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY i) AS prefix FROM rebuilt
  UNION ALL
  SELECT convs.conv_id, 0, coalesce(max(n), 0), 0, '' FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY convs.conv_id
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '') AS ends
  FROM prefixes GROUP BY prefix, depth
), children AS (
  SELECT parent.prefix, count(child.prefix) AS n FROM nodes parent LEFT JOIN nodes child
    ON child.depth = parent.depth + 1 AND left(child.prefix, 64 * parent.depth) = parent.prefix GROUP BY parent.prefix
), counted AS (SELECT nodes.*, children.n AS n_children FROM nodes JOIN children USING (prefix)),
subtrees AS (
  SELECT top.prefix, CAST(sum(CASE WHEN below.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
    CAST(sum((below.n_convs - 1) * below.bytes) AS BIGINT) AS saved_tokens
  FROM counted top JOIN counted below ON below.depth >= top.depth AND left(below.prefix, 64 * top.depth) = top.prefix GROUP BY top.prefix
)
SELECT counted.conv_id, CAST(counted.depth AS BIGINT) AS depth, CAST(parent.conv_id AS BIGINT) AS parent_conv_id,
  CAST(counted.n_convs AS BIGINT) AS n_convs, CAST(counted.n_children AS BIGINT) AS n_children, n_leaves, saved_tokens, sha256(counted.ends) AS ends_sha256
FROM counted JOIN subtrees USING (prefix)
LEFT JOIN nodes parent ON parent.depth = counted.depth - 1 AND parent.prefix = left(counted.prefix, 64 * (counted.depth - 1))
"""
