"""DuckDB SQL of operators whose results SQL can express; see registry.oracle_sql()."""

OP3_SQL = """
WITH b AS MATERIALIZED (
  SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS x FROM documents
), windows AS (
  SELECT doc_id, p, md5_number(substr(x, 2 * p + 1, 200)) AS h FROM (SELECT doc_id, x, unnest(range(0, n - 99)) AS p FROM b WHERE n >= 100)
), again AS (
  SELECT doc_id, p FROM windows QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, p) > 1
), cuts AS (
  SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS fresh FROM again
), islands AS (
  SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM cuts
), spans AS MATERIALIZED (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS z FROM islands GROUP BY doc_id, k
), before AS (
  SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS last FROM spans
), kept AS (
  SELECT doc_id, sum(z - a) AS removed, count(*) AS spans, max(z) AS tail, string_agg(substr(x, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) AS head
  FROM before JOIN b USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id)
"""

#: Five hex digits of a SHA-1 are four base-32 digits.
_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(x, 5 * k + 1, 5) AS BIGINT) >> {0}) & 31 AS INTEGER), 1)"
_FOUR = " || ".join(_DIGIT.format(shift) for shift in (15, 10, 5, 0))

OP4_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS x, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 8), lambda k: {_FOUR}), '') AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to
FROM p
"""

OP10_SQL = r"""
WITH w AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), grams AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), twice AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY doc_id
), m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    coalesce(l.n, 0) AS n_lines, length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS n_letters
  FROM w LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols > n_words OR (n_lines >= 5 AND n_dup_lines > 0.3e0 * n_lines)
    OR word_chars < 2 * n_words OR word_chars > 25 * n_words OR n_letters < 0.5e0 * word_chars) AS kept
FROM m
"""
