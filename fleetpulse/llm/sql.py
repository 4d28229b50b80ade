"""DuckDB SQL with the same results, for the operators that SQL can express."""

from __future__ import annotations

from .licenses import NOTICES, class_of, window_of


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LINE_QUALITY = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents
), words AS (
  SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM docs
), positions AS (
  SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM words
), windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS n FROM positions
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM windows, (VALUES (0), (1), (2)) AS o(k) WHERE n >= 2 GROUP BY rid
), lines AS (
  SELECT rid, host, unnest(string_split(text, chr(10))) AS line FROM docs
), worded AS (
  SELECT rid, host, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         trim(regexp_replace(translate(lower(line), '0123456789' || chr(9) || chr(11) || chr(12) || chr(13), '0000000000    '), ' +', ' ', 'g')) AS normal
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), repeated AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY rid
), hosts AS (
  SELECT host, count(*) AS n FROM docs GROUP BY host
), frequent AS (
  SELECT host, normal FROM worded JOIN hosts USING (host) GROUP BY host, normal, hosts.n
  HAVING count(DISTINCT rid) > 4 AND 100 * count(DISTINCT rid) > 2 * hosts.n
), removed AS (
  SELECT rid, sum(n) AS n FROM worded SEMI JOIN frequent USING (host, normal) GROUP BY rid
), measured AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(repeated.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         coalesce(removed.n, 0)::BIGINT AS removed_words
  FROM docs JOIN words USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN repeated USING (rid) LEFT JOIN removed USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
            OR n_words - removed_words < 50 OR 100 * removed_words > 50 * n_words) AS kept
FROM measured
"""


def license_scan() -> str:
    rows = [(name, f"{name}/{k}", text) for name, texts in sorted(NOTICES.items()) for k, text in enumerate(texts)]
    notices = ", ".join(f"({_quoted(a)}, {_quoted(b)}, {_quoted(c)})" for a, b, c in rows)
    classes = sorted({class_of(n) for n in range(1, 257)})
    # The smallest class that holds a template, its window and its step.
    sizes = ", ".join(f"({c}, {window_of(c)[0]}, {window_of(c)[1]})" for c in classes)
    return rf"""
WITH notices(license, template, text) AS (VALUES {notices}),
classes(size, length, step) AS (VALUES {sizes}),
notice_words AS (SELECT license, template, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS ws FROM notices),
notice_shingles AS (
  SELECT DISTINCT license, template, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS i FROM notice_words)
), counted AS (
  SELECT template, count(*) AS n FROM notice_shingles GROUP BY template
), wanted AS (
  SELECT template, n, min(size) AS size FROM counted JOIN classes ON size >= n GROUP BY template, n
), doc_words AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS ws FROM documents
), doc_shingles AS (
  SELECT doc_id, rid, i - 1 AS i, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS i FROM doc_words)
), hits AS (
  SELECT doc_id, rid, license, template, s, i, n, length, step,
         unnest(range(greatest(0, (i - length + step) // step), i // step + 1)) * step AS begin
  FROM doc_shingles JOIN notice_shingles USING (s) JOIN wanted USING (template) JOIN classes USING (size)
  WHERE i >= 0
), verified AS (
  SELECT doc_id, rid, license, template, begin, count(DISTINCT s)::DOUBLE / n AS share
  FROM hits GROUP BY doc_id, rid, license, template, begin, n HAVING count(DISTINCT s)::DOUBLE / n >= 0.8
), matched AS (
  SELECT *, max(share) OVER (PARTITION BY rid, i) AS rival FROM (SELECT DISTINCT rid, template, begin, i FROM hits)
  JOIN verified USING (rid, template, begin)
), kept AS (
  SELECT doc_id, license, share, min(i) AS first FROM matched
  GROUP BY doc_id, rid, license, template, begin, share HAVING max(rival) <= share
)
SELECT doc_id, license, max(share) AS containment, min(first)::BIGINT AS first_token FROM kept GROUP BY doc_id, license
"""


SQL = {
    "op8_license_scan": license_scan(),
    "op9_quality_rules": LINE_QUALITY,
}
