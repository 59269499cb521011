"""SQL for the queries of this subpackage that DuckDB can run on whole tables."""

from __future__ import annotations

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS place
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 3 * source_size AS capacity, CAST((n - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM totals)),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - (sum(capacity) OVER filled - capacity) AS DOUBLE)
            / (sum(weight) OVER () - (sum(weight) OVER filled - weight)) AS level
  FROM weighed WINDOW filled AS (ORDER BY capacity / weight, n)),
targets AS (
  SELECT *, least(CAST(capacity AS DOUBLE), max(level) OVER () * weight) AS target FROM levels),
sent AS (
  SELECT s.doc_id, s.size, t.n, t.source_size, t.target,
         CAST(sum(s.size) OVER (PARTITION BY t.n ORDER BY s.place, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sent
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT n, sent, size, CAST(sum(size) OVER (
           ORDER BY (sent + copy * source_size) / target, n, sent, copy ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM sent, (VALUES (0), (1), (2)) AS v(copy) WHERE size > 0 AND target > 0),
taken AS (
  SELECT n, sent, CAST(sum(size) AS BIGINT) AS taken FROM copies
  WHERE upto <= (SELECT sum(source_size) FROM totals) GROUP BY n, sent)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN coalesce(taken, 0) ELSE 0 END AS taken
FROM sent LEFT JOIN taken USING (n, sent)
"""

ASCII_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINES = rf"""
WITH line AS (
  SELECT n AS doc, doc_id, lines, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
  FROM (SELECT doc_id, row_number() OVER () AS n, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
keyed AS (
  SELECT doc, doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {ASCII_LOWER}) AS key FROM line),
shared AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(s.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE s.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN shared s USING (key) GROUP BY doc
"""

SEARCH = rf"""
WITH term AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, {ASCII_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM term GROUP BY ALL),
length AS (SELECT doc_id, count(*) AS n FROM term GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM length),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, {ASCII_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
part AS (
  SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)) AS part
  FROM tf JOIN length USING (doc_id), total),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * part) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN part USING (term) GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

MIDDLE = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
numbers AS (
  SELECT doc_id, t, n,
         CAST('0x' || substr(d, 1, 8) AS BIGINT) % (n + 1) AS one, CAST('0x' || substr(d, 9, 8) AS BIGINT) % (n + 1) AS two,
         CAST('0x' || substr(d, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) % 100 AS h4
  FROM drawn),
cut AS (
  SELECT *, least(one, two) AS a, greatest(one, two) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
              WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
part AS (
  SELECT *, '<P>' || substr(t, 1, a) AS p, '<M>' || substr(t, a + 1, b - a) AS m, '<S>' || substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN p || s || m ELSE s || p || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM part
"""

ORACLES: dict[str, str] = {
    "op4_mix": MIX,
    "op11_line_dedup": LINES,
    "op12_term_search": SEARCH,
    "op13_fill_in_middle": MIDDLE,
}
