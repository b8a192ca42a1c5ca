"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def quality_measures(docs: str) -> str:
    """CTEs `measured` (with r, a row number) over a relation with doc_id and text."""
    return rf"""
    rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body, {_WORDS} AS words,
                    list_filter(string_split(coalesce(text, ''), chr(10)),
                                lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
             FROM {docs}),
    windows AS (SELECT r, i, array_to_string(words[i:i + 4], ' ') AS w
                FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM rows)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
    covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY r),
    measured AS (
      SELECT r, doc_id, len(words) AS n_words,
             length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
             len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(covered.n, 0) AS n_repeat_words,
             length(regexp_replace(body, '[^\p{{L}}]+', '', 'g')) AS n_letters,
             length(regexp_replace(body, '[^\p{{Lu}}]+', '', 'g')) AS n_upper
      FROM rows LEFT JOIN covered USING (r)),
    judged AS (
      SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END)
              + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
              + (CASE WHEN 4 * n_symbols > n_words THEN 4 ELSE 0 END)
              + (CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
              + (CASE WHEN n_letters >= 20 AND 10 * n_upper > 6 * n_letters THEN 16 ELSE 0 END)
              + (CASE WHEN word_chars < 2 * n_words OR word_chars > 30 * n_words THEN 32 ELSE 0 END) AS failed
      FROM measured)"""


QUALITY = f"""
WITH {quality_measures('documents')}
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_lines AS BIGINT) AS n_lines,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       CAST(n_letters AS BIGINT) AS n_letters, CAST(n_upper AS BIGINT) AS n_upper, CAST(failed AS BIGINT) AS failed,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept
FROM judged
"""

WARC = """
WITH rows AS (SELECT page_id, url, sha1(coalesce(html, '')) AS payload_digest,
                     CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
     held AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM rows)
SELECT page_id, payload_bytes, payload_digest, nullif(url, '') AS url,
       CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN holder END AS refers_to
FROM held
"""


def left_lines(docs: str) -> str:
    """CTEs `parts` (line by line, with `goes` and `near`) over a relation with doc_id and text."""
    return rf"""
    split AS (SELECT DISTINCT doc_id, text, unnest(string_split(text, chr(10))) AS raw,
                     generate_subscripts(string_split(text, chr(10)), 1) AS no FROM {docs}),
    trimmed AS (SELECT *, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM split),
    firsts AS (SELECT line, min((doc_id, no)) AS spot FROM trimmed WHERE line <> '' GROUP BY line),
    long AS (SELECT line, spot, length(line) AS n FROM firsts WHERE length(line) >= 16),
    close AS (SELECT DISTINCT a.line FROM long a JOIN
                (SELECT line, spot, n + d AS n FROM long, (VALUES (-1), (0), (1)) t(d)) b ON a.n = b.n AND b.spot < a.spot
              WHERE (substr(a.line, 1, CAST(a.n // 2 - 1 AS INT)) = substr(b.line, 1, CAST(a.n // 2 - 1 AS INT))
                     OR right(a.line, CAST(a.n // 2 - 1 AS INT)) = right(b.line, CAST(a.n // 2 - 1 AS INT)))
                    AND levenshtein(a.line, b.line) <= 1),
    parts AS (SELECT t.*, coalesce(t.line <> '' AND ((t.doc_id, t.no) <> f.spot OR c.line IS NOT NULL), false) AS goes,
                     coalesce((t.doc_id, t.no) = f.spot AND c.line IS NOT NULL, false) AS near
              FROM trimmed t LEFT JOIN firsts f USING (line) LEFT JOIN close c USING (line))"""


LINES = rf"""
WITH {left_lines('documents')},
     texts AS (SELECT doc_id, text, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (goes) AS n_dropped,
                      count(*) FILTER (near) AS n_near,
                      coalesce(string_agg(raw, chr(10) ORDER BY no) FILTER (NOT goes), '') AS left_text
               FROM parts GROUP BY doc_id, text)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, coalesce(n_near, 0) AS n_near,
       length(coalesce(left_text, '')) AS n_chars_left, sha256(coalesce(left_text, '')) AS left_sha256
FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id AND d.text = t.text
"""


# crc32 of the decimal id, bit by bit: a byte is taken in, then eight steps are made
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
      lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, v: CASE WHEN v >= 0 THEN xor(a, v) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""

TRIE = rf"""
WITH own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS k
             FROM conversations WHERE conv_id IS NOT NULL),
     convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
     parts AS (SELECT c.conv_id, 0 AS part, o.k, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.k < c.h
               UNION ALL SELECT c.conv_id, 1, o.k, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.k >= c.h),
     paths AS (SELECT conv_id, row_number() OVER w AS depth, list({{'role': role, 'text': text}}) OVER w AS path, text
               FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY part, k)
               UNION ALL SELECT conv_id, 0, [], '' FROM convs),
     lengths AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
     members AS (SELECT p.conv_id, p.depth, min(p.conv_id) OVER (PARTITION BY p.depth, p.path) AS node, p.depth = l.depth AS ends,
                        len(list_filter(regexp_split_to_array(p.text, '[ 	-]+'), lambda w: w <> '')) AS words
                 FROM paths p JOIN lengths l ON p.conv_id = l.conv_id),
     nodes AS (SELECT node, depth, count(*) AS n_convs, max(words) AS words, bool_and(ends) AS leaf,
                      sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
               FROM members GROUP BY node, depth),
     above AS (SELECT n.node, n.depth, m.node AS parent FROM nodes n JOIN members m ON m.conv_id = n.node AND m.depth = n.depth - 1),
     sums AS (SELECT m.node, m.depth, count(*) FILTER (n.leaf) AS n_leaves, count(*) FILTER (n.depth = m.depth + 1) AS n_children,
                     sum((n.n_convs - 1) * n.words) AS saved_tokens
              FROM nodes n JOIN members m ON m.conv_id = n.node AND m.depth <= n.depth GROUP BY m.node, m.depth)
SELECT n.node AS conv_id, CAST(n.depth AS BIGINT) AS depth, a.parent AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node AND s.depth = n.depth LEFT JOIN above a ON a.node = n.node AND a.depth = n.depth
"""
