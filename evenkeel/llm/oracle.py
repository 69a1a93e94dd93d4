"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_MIX = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS digest
  FROM documents),
numbered AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE place % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight, 2 * source_size AS most
  FROM numbered),
filled AS (
  SELECT *, row_number() OVER fill AS turn,
         3 * (SELECT sum(source_size) FROM weighed) / 2.0
           - coalesce(CAST(sum(most) OVER before AS DOUBLE), 0) AS rest,
         (SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0) AS weights
  FROM weighed
  WINDOW fill AS (ORDER BY most / weight, source IS NULL, source),
         before AS (ORDER BY most / weight, source IS NULL, source
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT turn, CAST(rest AS DOUBLE) AS rest, CAST(weights AS DOUBLE) AS weights FROM filled
  WHERE CAST(rest AS DOUBLE) * weight / CAST(weights AS DOUBLE) < most ORDER BY turn LIMIT 1),
asked AS (
  SELECT source, source_size,
         CASE WHEN f.turn < l.turn OR l.turn IS NULL THEN CAST(most AS DOUBLE)
              ELSE l.rest * weight / l.weights END AS target
  FROM filled f LEFT JOIN level l ON TRUE),
parted AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS passes,
         CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) % source_size ELSE 0 END AS rest
  FROM asked),
running AS (
  SELECT doc_id, size, source_size, target, passes, rest,
         sum(size) OVER (PARTITION BY s.source ORDER BY digest) AS total,
         sum(size) OVER (PARTITION BY s.source, digest) AS own
  FROM sized s JOIN parted p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (passes + CASE WHEN total - rest <= rest - (total - own) THEN 1 ELSE 0 END) AS BIGINT)
         AS taken
FROM running
"""


def _parts(p: str, q: str) -> str:
    """Terms of a Jensen-Shannon divergence, summed over the rows of a group."""
    half = f"(({p} + {q}) / 2)"
    return (f"sum(0.5 * (CASE WHEN {p} > 0 THEN {p} * log2({p} / {half}) ELSE 0 END"
            f" + CASE WHEN {q} > 0 THEN {q} * log2({q} / {half}) ELSE 0 END))")


_QUALITY = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, lang, text IS NULL AS gone, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w
  FROM documents),
base AS MATERIALIZED (
  SELECT rid, doc_id, lang, gone, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) AS total, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS lines,
         len(regexp_extract_all(t, '\p{{L}}')) AS letters,
         len(regexp_extract_all(t, '\p{{Lu}}')) AS capitals,
         len(regexp_extract_all(t, '\p{{Nd}}')) AS digits
  FROM docs),
windows AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) > 2)),
repeats AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS times FROM windows),
    (SELECT unnest([0, 1, 2]) AS k) WHERE times > 1 GROUP BY rid),
classes AS MATERIALIZED (
  SELECT rid, lang, gone, unnest([1, 2, 3, 4, 5, 6]) AS c,
         unnest([letters - capitals, capitals, digits, total - word_chars, n_symbols,
                 total - letters - digits - (total - word_chars) - n_symbols]) AS n
  FROM base),
class_share AS (
  SELECT lang, c, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS share FROM classes
  WHERE lang IS NOT NULL AND NOT gone GROUP BY lang, c),
spoken AS MATERIALIZED (SELECT rid, lang, unnest(w) AS word FROM docs),
totals AS (
  SELECT lang, count(*) AS total FROM spoken WHERE lang IS NOT NULL GROUP BY lang HAVING count(*) >= 2000),
ranked AS (
  SELECT lang, word, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS rank
  FROM spoken WHERE lang IS NOT NULL GROUP BY lang, word),
common AS MATERIALIZED (
  SELECT lang, word, n / total AS share FROM ranked JOIN totals USING (lang) WHERE rank <= 24),
known AS (SELECT DISTINCT lang FROM common JOIN class_share USING (lang)),
pairs AS MATERIALIZED (
  SELECT rid, n_words, known.lang AS ref FROM base, known
  WHERE base.lang = known.lang OR base.lang IS NULL OR base.lang NOT IN (SELECT lang FROM known)),
said AS (
  SELECT rid, word, count(*) AS n FROM spoken WHERE word IN (SELECT word FROM common) GROUP BY rid, word),
word_rows AS (
  SELECT p.rid, ref, coalesce(s.n, 0) / greatest(n_words, 1) AS p, c.share AS q
  FROM pairs p JOIN common c ON c.lang = ref LEFT JOIN said s ON s.rid = p.rid AND s.word = c.word),
word_all AS (
  SELECT * FROM word_rows UNION ALL
  SELECT rid, ref, greatest(0, 1 - sum(p)), greatest(0, 1 - sum(q)) FROM word_rows GROUP BY rid, ref),
without AS (
  SELECT ref, greatest(0, {_parts('p', 'q')}) AS most, count(*) - 1 AS bins FROM (
    SELECT lang AS ref, 0.0::DOUBLE AS p, share AS q FROM common UNION ALL
    SELECT lang, 1.0, greatest(0, 1 - sum(share)) FROM common GROUP BY lang) GROUP BY ref),
word_excess AS (
  SELECT rid, min(d / sqrt(least(0.81 * most, 0.36 * most + bins / (8 * ln(2) * greatest(n_words, 1))))) AS x
  FROM (SELECT rid, ref, sqrt(greatest(0, {_parts('p', 'q')})) AS d FROM word_all GROUP BY rid, ref)
  JOIN without USING (ref) JOIN base USING (rid) GROUP BY rid),
class_distance AS (
  SELECT rid, min(d) AS d FROM (
    SELECT rid, sqrt(greatest(0, {_parts('p', 'q')})) AS d FROM (
      SELECT p.rid, ref, n / greatest(sum(n) OVER (PARTITION BY p.rid, ref), 1) AS p, share AS q
      FROM pairs p JOIN classes k ON k.rid = p.rid
      JOIN class_share s ON s.lang = ref AND s.c = k.c) GROUP BY rid, ref) GROUP BY rid),
judged AS (
  SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words,
         n_words < 50 OR 100 * coalesce(r.n, 0) > 50 * n_words AS base_failed,
         coalesce((word_chars >= 200 AND c.d > 0.27) OR (n_words >= 50 AND x.x > 1), false) AS far
  FROM base LEFT JOIN repeats r USING (rid) LEFT JOIN class_distance c USING (rid)
  LEFT JOIN word_excess x USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND NOT far AS kept
FROM judged
"""

STATEMENTS = {"op4_min_cost_mix": _MIX, "op5_distribution_divergence": _QUALITY}
