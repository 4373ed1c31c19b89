"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

CHATS = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS body,
         length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) AS name FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + name + 2 + body + 8) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

DECONTAMINATION = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), patterns AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS pattern
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM item_words WHERE len(w) > 0)
), at_word AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM doc_words),
windows AS MATERIALIZED (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS pattern
  FROM at_word CROSS JOIN (SELECT DISTINCT size FROM patterns) WHERE i + size - 1 <= len(w)
), found AS (SELECT doc_id, i, size, item_id FROM windows JOIN patterns USING (size, pattern)
), hit AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS j FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items,
       sha256(coalesce(m.items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h USING (doc_id) LEFT JOIN named m USING (doc_id)
"""

SHARDS = """
WITH sized AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash FROM documents
), deep AS (
  SELECT doc_id, bytes, hash, unnest(generate_series(0, 40)) AS depth FROM sized
), cut AS (SELECT doc_id, bytes, depth, hash >> (60 - depth) AS prefix FROM deep),
sums AS (SELECT depth, prefix, sum(bytes) AS shard_bytes, count(*) AS shard_rows FROM cut GROUP BY ALL),
best AS (
  SELECT doc_id, min(depth) AS depth FROM cut JOIN sums USING (depth, prefix) WHERE shard_bytes <= {limit} GROUP BY doc_id
)
SELECT doc_id, bytes, CAST(depth AS INTEGER) AS depth, shard_rows, CAST(shard_bytes AS BIGINT) AS shard_bytes,
       CASE WHEN depth = 0 THEN '' ELSE right(repeat('0', 60) || bin(prefix), CAST(depth AS INTEGER)) END AS shard, FALSE AS oversize
FROM best JOIN cut USING (doc_id, depth) JOIN sums USING (depth, prefix)
"""

FIXITY = """
WITH records AS (
  SELECT page_id, page_id // 1000 AS file,
         'WARC/1.0' || chr(10) || 'WARC-Type: response' || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(10)
         || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(10) || chr(10) AS head, coalesce(html, '') AS body
  FROM pages
), whole AS (SELECT page_id, file, head || body || chr(10) || chr(10) AS content FROM records),
placed AS (
  SELECT page_id, file, content, strlen(content) AS length,
         coalesce(sum(strlen(content)) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 8) AS BIGINT) % 97 AS fate FROM whole
)
SELECT 'crawl-' || lpad(CAST(file AS VARCHAR), 8, '0') || '.warc' AS file, CAST(start AS BIGINT) AS "offset",
       CASE fate WHEN 3 THEN 'changed' WHEN 5 THEN 'missing' ELSE 'resized' END AS status,
       CAST(length AS BIGINT) AS expected_length, sha256(content) AS expected_digest,
       CAST(CASE fate WHEN 3 THEN length WHEN 7 THEN strlen(left(content, 20)) ELSE 0 END AS BIGINT) AS found_length,
       CASE fate WHEN 3 THEN sha256('#' || substr(content, 2)) WHEN 7 THEN sha256(left(content, 20)) END AS found_digest
FROM placed WHERE fate IN (3, 5, 7)
"""

REPEATS = r"""
WITH texts AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w FROM documents
), windows AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM texts WHERE len(w) >= 13)
), lows AS (SELECT win, min(doc_id) AS low FROM windows GROUP BY win),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS j FROM windows JOIN lows USING (win) WHERE low < doc_id
), words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS j FROM texts),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
"""

HAMMING = """
WITH codes AS (
  SELECT vec_id, list_transform(range(1, 65), lambda i: coalesce(embedding[i] >= 0, FALSE)) AS bits
  FROM embeddings WHERE embedding IS NOT NULL
), pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id,
         CAST(list_sum(list_transform(list_zip(q.bits, r.bits), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) AS INTEGER) AS distance
  FROM codes q, codes r WHERE q.vec_id % 20 = 0
), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, neighbour_id, distance FROM ranked WHERE rank <= 10
"""

SEARCH = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), totals AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM docs WHERE len(w) > 0),
wanted AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(w) AS term FROM items) GROUP BY ALL),
held AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held CROSS JOIN totals GROUP BY term
), scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term) CROSS JOIN totals GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE = {
    "op1_chat_formatting": CHATS,
    "op2_decontamination": DECONTAMINATION,
    "op3_sharding": SHARDS.format(limit=2**20),
    "op5_warc_fixity": FIXITY,
    "op6_substring_dedup": REPEATS,
    "op10_hamming_search": HAMMING,
    "op11_lexical_search": SEARCH,
}
