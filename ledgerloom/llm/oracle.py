"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP4 = """
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), grouped AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
  FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM grouped
"""

OP6 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sources
), ordered AS (
  SELECT *, source_size / weight AS ratio, row_number() OVER (ORDER BY source_size / weight, weight, source NULLS LAST) AS place
  FROM weighed
), shared AS (
  SELECT *,
    (SELECT sum(source_size) FROM ordered) - coalesce(sum(3 * source_size) OVER before, 0) AS left_over,
    (SELECT sum(weight) FROM ordered) - coalesce(sum(weight) OVER before, 0) AS weights
  FROM ordered WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT left_over, weights FROM shared
  WHERE CAST(left_over AS DOUBLE) * weight / CAST(weights AS DOUBLE) <= 3 * source_size ORDER BY place LIMIT 1
), targets AS (
  SELECT source, source_size,
    least(CAST(level.left_over AS DOUBLE) * weight / CAST(level.weights AS DOUBLE), CAST(3 * source_size AS DOUBLE)) AS target
  FROM ordered, level
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.doc_id NULLS FIRST, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS earlier,
    CAST(floor(t.target) AS BIGINT) AS budget
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
    + greatest(0, least(size, budget % source_size - earlier)) END AS taken
FROM placed
"""

# The template: "<turn " role ">" text, "<part/>" text for adjacent turns of the role, "</turn>\n".
OP8 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, coalesce(lag(role) OVER w <> role, true) AS starts,
    length(text) + length(regexp_replace(text, '[^\\<>]', '', 'g')) AS text_chars,
    length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g')) AS role_chars,
    row_number() OVER w AS place
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_chars + CASE WHEN starts THEN 6 + role_chars + 1 + 8 ELSE 7 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

OP10 = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, words[i:i + 7] AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM split WHERE len(words) >= 8)
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(next_i - i, 8))) AS n
  FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next_i FROM repeated) GROUP BY doc_id
), counts AS (
  SELECT s.doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    length(regexp_replace(text, '\P{L}', '', 'g')) AS letters,
    length(regexp_replace(text, '\P{Lu}', '', 'g')) AS capitals,
    length(regexp_replace(text, '[^\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]', '', 'g')) AS unspaced,
    length(text) - length(replace(text, chr(10), '')) AS breaks
  FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 5 * n_symbols > n_words OR (n_dup_lines > 3 AND 2 * n_dup_lines > breaks + 1)
    OR word_chars < 2 * n_words OR (word_chars > 25 * n_words AND 2 * unspaced <= word_chars) OR 2 * letters < word_chars
    OR 2 * capitals > letters) AS kept
FROM judged
"""


# Filters A to E are bits 1 to 16 of a document's mask.
OP11 = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents
), flags AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), masks AS (
  SELECT part,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN t.doc_id > first THEN 16 ELSE 0 END AS mask,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM texts t LEFT JOIN flags f ON t.doc_id = f.doc_id
), counts AS (
  SELECT part, mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM masks GROUP BY part, mask
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(name, bit)
), orders AS (
  SELECT concat(a.name, b.name, c.name, d.name, e.name) AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, i AS step, bits[i] AS bit, coalesce(list_sum(bits[1:i - 1]), 0) AS before
  FROM orders, range(1, 6) AS r(i)
), measured AS (
  SELECT part, filter_order, CAST(step AS INT) AS step, bit,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM (SELECT part, mask, n, good, toxic, filter_order, step, bit, CAST(before AS INT) AS before FROM counts, steps)
  GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM measured
"""

# Exact search; the approximate one finds the same on the small tables.
OP12 = """
WITH usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc": OP4, "op6_mix": OP6, "op8_chat": OP8, "op10_quality": OP10, "op11_audit": OP11, "op12_onebit": OP12,
    }
