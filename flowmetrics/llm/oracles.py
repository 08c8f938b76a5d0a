"""DuckDB SQL of the digest queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

# Fixed values of op3's rules, written out here so that the SQL stands on its own
_GAP = r"\x20\x09-\x0D"
SYMBOLS = "[#*$%&|<>]"
CLUTTER = "[#*$%&|<>!?]{2,}"
END_PATTERN = f"[.!?:;…\"'”’»)\\]][{_GAP}]*$"
BARE_PATTERN = f"(^|[{_GAP}])[|>»·]+($|[{_GAP}])"
MENU_PATTERN = (f"(?i)(^|[{_GAP}])(home|menu|login|log in|sign in|sign up|register|next|previous|about us|contact us|"
                f"site map|search|read more|back to top)([.:!?]?)([{_GAP}]|$)")
BOILERPLATE_PATTERN = ("(?i)(all rights reserved|cookie policy|use of cookies|accept cookies|privacy policy|terms of use|"
                       "terms of service|enable javascript|subscribe to our newsletter|click here to|lorem ipsum|powered by)")

SQL: dict[str, str] = {}

SQL["op8_bloom_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t"""


def _quote(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


SQL["op3_line_quality"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT r, regexp_extract_all(text, '{_WORD}') AS words FROM docs),
starts AS (
  SELECT r, words, unnest(range(1, greatest(len(words) - 3, 1))) AS i FROM split),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(words[i:i + 4], ' ')) AS n FROM starts),
covered AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM windows WHERE n > 1) GROUP BY r),
lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
worded AS (
  SELECT r, line, len(regexp_extract_all(line, '{_WORD}')) AS n FROM lines),
judged AS (
  SELECT r, line, n,
    NOT regexp_matches(line, {_quote(END_PATTERN)})
    OR len(regexp_extract_all(line, {_quote(CLUTTER)})) * 2 >= n
    OR len(regexp_extract_all(regexp_replace(line, '[\\x20\\x09-\\x0D]', '  ', 'g'), {_quote(BARE_PATTERN)})) * 5 >= n
    OR (n <= 4 AND regexp_matches(line, {_quote(MENU_PATTERN)}))
    OR regexp_matches(line, {_quote(BOILERPLATE_PATTERN)}) AS fails
  FROM worded WHERE n > 0),
by_doc AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, sum(CASE WHEN fails THEN n ELSE 0 END) AS n_lost_words
  FROM judged GROUP BY r),
measured AS (
  SELECT d.doc_id, CAST(len(s.words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(d.text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(d.text, {_quote(SYMBOLS)})) AS BIGINT) AS n_symbols,
    CAST(coalesce(b.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(b.n_lost_words, 0) AS BIGINT) AS n_lost_words
  FROM docs d JOIN split s USING (r) LEFT JOIN by_doc b USING (r) LEFT JOIN covered c USING (r)),
based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND 100 * n_lost_words <= 50 * n_words AS kept FROM based"""
