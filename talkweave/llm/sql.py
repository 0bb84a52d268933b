"""DuckDB equivalents of the queries that SQL can express."""

CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), measured AS (
  SELECT *,
    length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
      + len(regexp_extract_all(text, '</?s>|\[/?INST\]|<</?SYS>>|\[OUT\]|\[/?ROLE\]|\[TEXT\]'))
      + CASE role WHEN 'system' THEN 8 + 10 WHEN 'user' THEN 10 + 9 WHEN 'assistant' THEN 6 + 6 ELSE
          7 + length(role) + length(regexp_replace(role, '[^\\]', '', 'g'))
          + len(regexp_extract_all(role, '</?s>|\[/?INST\]|<</?SYS>>|\[OUT\]|\[/?ROLE\]|\[TEXT\]')) + 8 + 9 END AS chars,
    lag(role, 1, 'start') OVER o AS before, lead(role) OVER o IS NULL AS is_last
  FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  bool_and((before || '>' || role) IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user')
    AND (NOT is_last OR role = 'assistant')) AS valid
FROM measured GROUP BY conv_id
"""

SUBSTRING_DEDUP = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(words[s:s + 19], ' ') AS said
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM split WHERE len(words) >= 20)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS k
  FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY said ORDER BY doc_id, s) AS nth FROM windows) WHERE nth > 1
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS said, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM split) ANTI JOIN gone USING (doc_id, k)
  GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(said, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""


WARC = r"""
WITH page AS (SELECT page_id, coalesce(html, '') AS html FROM pages
), placed AS (SELECT *, CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM page)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to, true AS valid
FROM placed
"""

#: Runs have five equal consecutive pairs of words at least, so pairs of equal five-word stretches find them all.
PERIODIC_RUNS = r"""
WITH RECURSIVE bits AS (
  SELECT 0 AS k, (range)::UBIGINT AS byte, (range)::UBIGINT AS crc FROM range(256)
  UNION ALL SELECT k + 1, byte, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384::UBIGINT) ELSE crc >> 1 END FROM bits WHERE k < 8
), crc_table AS (SELECT list(crc ORDER BY byte) AS t FROM bits WHERE k = 8
), hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
      lambda crc, c: xor(crc >> 8, t[(xor(crc, c) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS h
  FROM documents, crc_table
), placed AS (
  SELECT doc_id, words, len(words) AS n, h, h // 10 AS g, CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a FROM hashed
), planted AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: words[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1])
    ELSE words END AS words
  FROM placed
), word AS (
  SELECT doc_id, n, unnest(range(n)) AS i, unnest(words) AS w FROM planted
), five AS (
  SELECT doc_id, n, i, hash(w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS said
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i) QUALIFY lead(w, 4) OVER o IS NOT NULL
), pair AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM five x JOIN five y ON x.doc_id = y.doc_id AND x.said = y.said AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), island AS (
  SELECT doc_id, q, min(i) AS s, max(i) + 4 - min(i) + 1 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM pair)
  GROUP BY doc_id, q, part HAVING max(i) + 4 - min(i) + 1 + q >= greatest(6, 4 * q)
), run AS (
  SELECT * FROM island x WHERE NOT EXISTS (
    SELECT 1 FROM island y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.s <= x.s AND y.s + y.length >= x.s + x.length)
), said AS (
  SELECT doc_id, count(*) AS n_runs, arg_max((s, length, q), (length, -s, -q)) AS best,
    sha256(string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256
  FROM run GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + length)) AS i FROM run
), kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS said FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[1]::BIGINT AS "start", best[2]::BIGINT AS length, best[3]::BIGINT AS period,
  (1000 * best[2] // best[3])::BIGINT AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
  sha256(coalesce(kept.said, '')) AS collapsed_sha256
FROM planted LEFT JOIN said USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_substring_dedup": SUBSTRING_DEDUP, "op8_chat_format": CHAT_FORMAT, "op11_warc": WARC, "op13_periodic_runs": PERIODIC_RUNS}
