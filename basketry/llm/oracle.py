"""SQL that recomputes the corpus queries SQL can express, independently of the Spark code."""

from __future__ import annotations

from basketry.llm import licenses, rules


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (SELECT r, i, w[i] || chr(0) || w[i+1] || chr(0) || w[i+2] AS g
            FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM docs)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
measured AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(p.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({', '.join(map(_text, rules.STOP_WORDS))}))) AS n_stop,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_cut,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_listed
  FROM docs d LEFT JOIN repeated p ON d.r = p.r),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                 greatest(n_words, 1)::DOUBLE AS nw, greatest(n_lines, 1)::DOUBLE AS nl FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / nw BETWEEN 2.0 AND 20.0 AND n_symbols / nw <= 0.1 AND n_stop / nw >= 0.06
       AND n_dup_lines / nl <= 0.5 AND n_cut / nl <= 0.3 AND n_listed / nl <= 0.9 AS kept
FROM based"""


def _canonical(column: str) -> str:
    made = rf"regexp_replace(lower(coalesce({column}, '')), '(?m)^[ \t]*(copyright|\(c\)|©|all rights reserved)[^\n]*$', '', 'g')"
    for a, b in licenses.SPELLINGS:
        made = f"replace({made}, {_text(a)}, {_text(b)})"
    return rf"sha256(trim(regexp_replace({made}, '[^\p{{L}}\p{{N}}]+', ' ', 'g')))"


def _op5() -> str:
    known = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in licenses.known())
    return f"""
WITH known AS (SELECT DISTINCT k AS license_id, {_canonical('t')} AS d FROM (VALUES {known}) v(k, t)),
units AS (
  SELECT doc_id, 0::BIGINT AS line_no, coalesce(text, '') AS unit FROM documents
  UNION ALL
  SELECT doc_id, unnest(range(1, len(l) + 1)) AS line_no, unnest(l) AS unit
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
SELECT doc_id, line_no, {_canonical('unit')} AS digest, license_id
FROM units LEFT JOIN known ON {_canonical('unit')} = d
WHERE line_no = 0 OR (license_id IS NOT NULL AND unit <> '')"""


OP7 = rf"""
WITH sized AS (SELECT row_number() OVER () AS r, doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][(rnk % 3) + 1] AS weight, 2 * source_size AS bound
            FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk FROM sources)),
levels AS (
  SELECT *, (1.5 * sum(source_size) OVER ()
             - coalesce(sum(bound) OVER (ORDER BY bound / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY bound / weight, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
goals AS (SELECT source, source_size, rnk,
                 least(coalesce(max(CASE WHEN level <= bound / weight THEN level END) OVER (), 'inf'::DOUBLE) * weight,
                       bound::DOUBLE) AS target FROM levels),
rws AS (SELECT s.*, g.source_size, g.rnk, g.target FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
queued AS (SELECT *, ('0x' || substr(md5(epoch || ':' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
           FROM (SELECT *, unnest(range(1, ceil(target / source_size)::BIGINT + 1)) AS epoch FROM rws WHERE target > 0)),
timed AS (SELECT *, (sum(size) OVER (PARTITION BY rnk ORDER BY epoch, key, doc_id NULLS FIRST, size, r
                                     ROWS UNBOUNDED PRECEDING))::DOUBLE / target AS time FROM queued),
placed AS (SELECT *, sum(size) OVER (ORDER BY time, rnk, epoch, key, doc_id NULLS FIRST, size, r
                                     ROWS UNBOUNDED PRECEDING) AS so_far FROM timed),
taken AS (SELECT r, sum(size)::BIGINT AS taken FROM placed WHERE so_far <= (SELECT sum(target) FROM goals) GROUP BY r)
SELECT doc_id, source, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM rws LEFT JOIN taken USING (r)"""

OP10 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(text) + CASE WHEN regexp_matches(text, '<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|\[ROLE |\\[elbr]')
                                THEN len(regexp_extract_all(text, '[\\<\[\]]')) ELSE 0 END AS body,
         CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 17 WHEN 'assistant' THEN 0
                   ELSE 8 + length(role) + len(regexp_extract_all(role, '[\\<\[\]]')) END AS frame
  FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(body + frame + 7)::BIGINT AS formatted_chars, true AS round_trip
FROM sized GROUP BY conv_id"""

OP11 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {_WORDS} AS w
              FROM documents),
failing AS (
  SELECT d.r, part, d.doc_id, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
         100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text), regexp_matches(text, '[#$%&*|]'),
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS f FROM docs d),
labelled AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
counted AS (SELECT part, f, count(*) AS n, count(*) FILTER (good = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
            FROM failing LEFT JOIN labelled USING (doc_id) GROUP BY part, f),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || d.c || e.c || f.c AS filter_order FROM letters a, letters b, letters d, letters e, letters f
           WHERE a.c NOT IN (b.c, d.c, e.c, f.c) AND b.c NOT IN (d.c, e.c, f.c) AND d.c NOT IN (e.c, f.c) AND e.c <> f.c),
steps AS (SELECT filter_order, s.step, filter_order[s.step] AS letter,
                 ascii(filter_order[s.step]) - 64 AS here,
                 [ascii(x) - 64 FOR x IN string_split(filter_order[1:s.step - 1], '') IF x <> ''] AS before
          FROM orders, (SELECT unnest(range(1, 6)) AS step) s),
shown AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (NOT f[here] AND NOT gone), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (f[here] AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (f[here] AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (f[here] AND len(list_filter(f, lambda x: x)) = 1), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (f[here] AND NOT gone), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (f[here] AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM (SELECT *, len(list_filter(before, lambda x: f[x])) > 0 AS gone FROM counted, steps) GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM shown"""

_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP12 = f"""
WITH rws AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND {_FINITE}),
pairs AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                 list_dot_product(a.v, b.v)::BIGINT AS score
          FROM rws a JOIN rws b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
found AS (SELECT p.*, n.id AS negative_id, n.score AS negative_score,
                 row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.id) AS rank
          FROM positives p JOIN pairs n USING (anchor_id)
          WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 5"""

SQL = {"op2_quality_rules": OP2, "op5_license_scans": _op5(), "op7_mixing": OP7, "op10_chat_formatting": OP10,
       "op11_filter_audit": OP11,
       "op12_hard_negatives": OP12}
