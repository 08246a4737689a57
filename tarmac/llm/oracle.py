"""DuckDB SQL for the queries that SQL can express (written out, sharing nothing with the operators)."""

from __future__ import annotations

OP2 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, coalesce(text, '') AS t
  FROM documents),
keyed AS (
  SELECT *, -ln((('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
    / CASE WHEN length(t) = 0 THEN 0.05::DOUBLE ELSE greatest(0.05::DOUBLE, 1.0::DOUBLE
        - 10.0::DOUBLE * (length(t) - length(translate(t, '#*$%&|<>!', '')))::DOUBLE / length(t)::DOUBLE) END AS okey
  FROM docs),
sources AS (SELECT k, sum(size)::BIGINT AS s, 1.0::DOUBLE + (row_number() OVER (ORDER BY k) - 1) % 3 AS w FROM docs GROUP BY k),
ordered AS (
  SELECT *, 3.0::DOUBLE * s AS cap, 3.0::DOUBLE * s / w AS ratio,
         coalesce(sum(3.0::DOUBLE * s) OVER o, 0) AS caps_before, coalesce(sum(w) OVER o, 0) AS w_before,
         (sum(s) OVER ())::DOUBLE AS total, sum(w) OVER () AS w_all
  FROM sources WINDOW o AS (ORDER BY 3.0::DOUBLE * s / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (total - caps_before) / (w_all - w_before) AS lvl FROM ordered),
plan AS (
  SELECT k, s, round(coalesce(least(cap, w * (SELECT min_by(lvl, ratio) FROM levels WHERE ratio >= lvl)), cap), 6) AS target FROM levels),
budgets AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s)::BIGINT ELSE 0 END AS epochs FROM plan),
summed AS (
  SELECT keyed.*, b.s, b.target, b.epochs, b.target - b.epochs * b.s AS budget,
         coalesce(sum(size) OVER (PARTITION BY keyed.k ORDER BY okey, doc_id NULLS FIRST, size, rid
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sofar
  FROM keyed JOIN budgets b ON keyed.k = b.k)
SELECT doc_id, size, s AS source_size, target,
       (size * (epochs + CASE WHEN size > 0 AND 2 * sofar + size <= 2 * budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""

OP7 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
windows AS (
  SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM docs WHERE len(ws) >= 8)),
repeats AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (
  SELECT rid, sum(least(8, following - i)) AS n
  FROM (SELECT rid, i, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i), i + 8) AS following FROM repeats) GROUP BY rid),
lines AS (
  SELECT rid, host, t, trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT rid, host, t, unnest(ls) AS l FROM docs)),
frequent AS (SELECT host, line FROM lines GROUP BY host, line HAVING count(DISTINCT t) > 10),
gone AS (
  SELECT l.rid, sum(l.n) AS n FROM lines l JOIN frequent f ON l.line = f.line AND l.host IS NOT DISTINCT FROM f.host GROUP BY l.rid),
counted AS (
  SELECT d.doc_id, len(d.ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(d.ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(d.t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(d.ls) - len(list_distinct(d.ls)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(g.n, 0)::BIGINT AS boilerplate_words
  FROM docs d LEFT JOIN covered c ON d.rid = c.rid LEFT JOIN gone g ON d.rid = g.rid),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, boilerplate_words,
       NOT base_failed AND n_words - boilerplate_words >= 20
         AND n_words - boilerplate_words >= 0.3 * n_words AS kept
FROM judged
"""

ORACLE: dict[str, str] = {"op2_source_mix": OP2, "op7_line_rules": OP7}
