"""The queries that SQL can express, in DuckDB's SQL over the same tables."""

import re

from playtrail.llm.chat import TEMPLATE
from playtrail.llm.mixing import LONG_TEXT, MAX_ODDS, SEED
from playtrail.llm.quality import STOP_WORDS, _forms

_WORD = r"[^\x20\x09-\x0D]+"
_STOP_LIST = ", ".join(f"'{form}'" for form in _forms(STOP_WORDS))

OP4 = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda line: regexp_matches(line, '{_WORD}')) AS lines,
         row_number() OVER () AS id
  FROM documents),
placed AS (SELECT id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM split),
windows AS (
  SELECT id, place, (lead(place, 4) OVER own) IS NOT NULL AS complete,
         concat_ws(' ', word, lead(word, 1) OVER own, lead(word, 2) OVER own, lead(word, 3) OVER own,
                   lead(word, 4) OVER own) AS words
  FROM placed WINDOW own AS (PARTITION BY id ORDER BY place)),
found AS (SELECT id, place, complete AND count(*) OVER (PARTITION BY id, complete, words) > 1 AS repeated FROM windows),
covered AS (
  SELECT id, place, bool_or(repeated) OVER (PARTITION BY id ORDER BY place ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit
  FROM found),
repeats AS (SELECT id, count(*) FILTER (hit) AS n FROM covered GROUP BY id),
measured AS (
  SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda word: length(word))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations,
         len(list_filter(words, lambda word: word IN ({_STOP_LIST}))) AS n_stop_words,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         len(list_filter(lines, lambda line: regexp_matches(line, '^[\x20\t]*[-*•][\x20\t]'))) AS n_bullet_lines,
         len(list_filter(lines, lambda line: line LIKE '%...' OR line LIKE '%…')) AS n_ellipsis_lines,
         coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN repeats USING (id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 1.5 * n_words AND word_chars <= 25 * n_words
       AND n_symbols <= 0.2 * n_words AND n_exclamations <= 0.5 * n_words AND n_stop_words + 1 >= 0.02 * n_words
       AND n_dup_lines <= 0.5 * n_lines AND n_bullet_lines <= 0.9 * n_lines
       AND n_ellipsis_lines <= 0.3 * n_lines AS kept
FROM judged
"""

OP2 = rf"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words, row_number() OVER () AS id FROM documents),
starts AS (SELECT id, doc_id, unnest(generate_series(1, len(words) - 49)) AS first FROM split WHERE len(words) >= 50),
windows AS (
  SELECT id, s.doc_id, first, md5(array_to_string(words[first : first + 49], ' ')) AS words FROM starts s JOIN split USING (id)),
hits AS (
  SELECT id, doc_id, first, min(doc_id) OVER (PARTITION BY words) AS earliest FROM windows),
covered AS (
  SELECT DISTINCT id, unnest(generate_series(first, first + 49)) AS place FROM hits
  WHERE earliest < coalesce(doc_id, 9223372036854775807)),
places AS (SELECT id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM split),
kept AS (
  SELECT id, string_agg(word, ' ' ORDER BY p.place) AS text, count(*) AS n
  FROM places p ANTI JOIN covered USING (id, place) GROUP BY id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (id)
"""

OP6 = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS words,
         row_number() OVER () AS id
  FROM documents),
starts AS (
  SELECT id, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS first FROM split WHERE len(words) > 0),
grams AS (SELECT DISTINCT id, hash(array_to_string(words[first : first + 4], ' ')) AS gram FROM starts JOIN split USING (id)),
sizes AS (SELECT id, count(*) AS size, list(gram ORDER BY gram) AS grams FROM grams GROUP BY id),
classes AS (SELECT min(id) AS class, size, grams FROM sizes GROUP BY size, grams),
members AS (SELECT id, class FROM sizes JOIN classes USING (size, grams)),
entries AS (SELECT class, size, unnest(grams) AS gram FROM classes),
common AS (SELECT gram FROM entries GROUP BY gram HAVING count(*) > 1),
shared AS (SELECT * FROM entries SEMI JOIN common USING (gram)),
products AS (
  SELECT a.class AS a, b.class AS b, any_value(a.size) AS m, any_value(b.size) AS n, count(*) AS together
  FROM shared a JOIN shared b USING (gram)
  WHERE a.class <> b.class AND 100 * a.size >= 80 * b.size AND 100 * b.size >= 80 * a.size
  GROUP BY a.class, b.class),
links AS (SELECT a, b FROM products WHERE 100 * together >= 80 * (m + n - together)),
reach(a, b) AS (SELECT class, class FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT class, min(doc_id) AS least FROM members JOIN split USING (id) GROUP BY class),
named AS (SELECT a AS class, min(least) AS named FROM reach JOIN least ON reach.b = least.class GROUP BY a)
SELECT doc_id, coalesce(size, 0) AS n_shingles, coalesce(named, doc_id) AS component_id
FROM split LEFT JOIN sizes USING (id) LEFT JOIN members USING (id) LEFT JOIN named USING (class)
"""

OP8 = rf"""
WITH given AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
         coalesce(doc_id::VARCHAR, '') AS id,
         (('0x' || substr(md5('{SEED}/' || coalesce(doc_id::VARCHAR, '-' || md5(coalesce(text, '')))), 1, 13))::BIGINT + 0.5::DOUBLE)
           / (1::BIGINT << 52)::DOUBLE AS uniform
  FROM documents),
liked AS (SELECT *, CASE WHEN size >= {LONG_TEXT} THEN 2 ELSE 1 END AS liked FROM given),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size * liked)::BIGINT AS liked_size FROM liked GROUP BY source),
ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         2 * source_size AS cap FROM sizes),
lefts AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
           - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS lft,
         sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS weights
  FROM ranked),
capped AS (SELECT *, cap * weights <= lft * weight AS capped FROM lefts),
level AS (SELECT lft, weights FROM capped WHERE NOT capped ORDER BY cap::DOUBLE / weight, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, liked_size,
         CASE WHEN capped THEN cap::DOUBLE ELSE (SELECT lft FROM level) * weight / (SELECT weights FROM level) END AS target
  FROM capped),
drawn AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
missing AS (
  SELECT *, target - whole * source_size AS missing,
         CASE WHEN source_size > 0 THEN (target - whole * source_size) / source_size ELSE 0 END AS share FROM drawn),
shares AS (
  SELECT doc_id, id, size, uniform, m.source, source_size, target, whole, missing,
         share * liked * source_size / nullif(liked_size, 0) AS share
  FROM liked l JOIN missing m ON l.source IS NOT DISTINCT FROM m.source),
odds AS (
  SELECT *, CASE WHEN share >= 1 THEN {MAX_ODDS:.0f}::DOUBLE ELSE least(share / (1 - share), {MAX_ODDS:.0f}::DOUBLE) END AS own FROM shares),
pareto AS (SELECT *, CASE WHEN own > 0 THEN (uniform / (1 - uniform)) / own END AS rank FROM odds),
ordered AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM pareto)
SELECT doc_id, size, source_size, target,
       size * (whole::BIGINT + CASE WHEN rank IS NOT NULL AND missing > 0 AND earlier + size / 2 <= missing THEN 1 ELSE 0 END) AS taken
FROM ordered
"""

OP9 = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, row_number() OVER () AS row,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM plain WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST, row)
"""


OP11 = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, row_number() OVER () AS row
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row AS other, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM given a JOIN given b ON a.row <> b.row
  WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id NULLS LAST) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other_id NULLS LAST))::INT AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n USING (anchor)
WHERE NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other_id NULLS LAST) <= 3
"""


def _op12() -> str:
    def shown(text: str) -> str:
        firsts = "|".join(re.escape(mark[0]) for mark in dict.fromkeys(m[0] for m in TEMPLATE.control))
        rests = "|".join(re.escape(mark) for mark in TEMPLATE.control)
        # RE2 can't look ahead; the template's marks don't overlap, so each is taken whole and its first character split off.
        return rf"regexp_replace(regexp_replace(replace({text}, '\', '\\'), '({rests})', chr(1) || '\1', 'g'), chr(1) || '({firsts})', '\1\\', 'g')"

    marks = " ".join(f"WHEN '{role}' THEN {len(own.before) + len(own.after)}" for role, own in TEMPLATE.roles.items())
    return rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length({shown('text')}) + CASE role {marks} ELSE {sum(map(len, TEMPLATE.other))} + length({shown('role')}) END AS size
  FROM given)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


OP13 = r"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS row,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
asked AS (
  SELECT item_id, row_number() OVER () AS item,
         list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
  FROM benchmark),
wanted AS (SELECT item_id, item, unnest(terms) AS term FROM asked),
sizes AS (SELECT doc_id, row, len(terms)::BIGINT AS n FROM split WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS all_terms FROM sizes),
posts AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM split) GROUP BY row, term),
useful AS (SELECT * FROM posts SEMI JOIN wanted USING (term)),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM useful, totals GROUP BY term, docs),
gains AS (
  SELECT u.row, u.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // all_terms))) AS gain
  FROM useful u JOIN weights USING (term) JOIN sizes USING (row), totals),
scores AS (SELECT item, item_id, row, sum(gain)::BIGINT AS score FROM wanted JOIN gains USING (term) GROUP BY item, item_id, row),
ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score
  FROM scores JOIN sizes USING (row) WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op2_substring_dedup": OP2,
        "op6_ngram_join": OP6,
        "op4_quality_rules": OP4,
        "op8_mixing": OP8,
        "op9_exact_dedup": OP9,
        "op11_hard_negatives": OP11,
        "op12_chat_formatting": _op12(),
        "op13_ranked_search": OP13,
    }
