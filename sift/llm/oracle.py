"""DuckDB SQL for the queries whose results SQL can express."""

from __future__ import annotations

from sift.llm import licenses
from sift.llm.chat_format import Template

_BLANK = r"[\x20\x09-\x0D]"

OP1 = rf"""
WITH lines AS (
  SELECT doc_id, rid, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM (SELECT doc_id, row_number() OVER () AS rid, text FROM documents)
), line_words AS (
  SELECT *, [w FOR w IN string_split_regex(line, '{_BLANK}+') IF w <> ''] AS words FROM lines
), judged AS (
  SELECT *, len(words) AS n,
    (len(words) >= 3
     AND NOT regexp_matches(line, '[.!?:;…。！？][\x22\x27”’»)\]*_]*{_BLANK}*$')
     AND len(regexp_extract_all(line, '[.!?…。！？][ \t\x0b\x0c\r]')) * 60 < len(words))
    OR len([w FOR w IN words IF w IN ('|', '»', '›', '•', '·', '/', '>')]) >= 3
    OR length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) >= 0.2 * length(line)
    OR regexp_matches(lower(line), 'all rights reserved|cookie policy|enable javascript|javascript is disabled|lorem ipsum|privacy policy|terms of use|terms of service|sign up for our newsletter|click here to|skip to content|share on facebook')
    AS fails
  FROM line_words WHERE len(words) > 0
), by_line AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines,
         sum(CASE WHEN fails THEN 1 ELSE 0 END) AS n_lines_failed,
         sum(CASE WHEN fails THEN n ELSE 0 END) AS n_words_lost
  FROM judged GROUP BY rid
), texts AS (
  SELECT row_number() OVER () AS rid, doc_id, text,
         [w FOR w IN string_split_regex(coalesce(text, ''), '{_BLANK}+') IF w <> ''] AS words
  FROM documents
), windows AS (
  SELECT rid, i, words[i:i+2] AS win FROM (
    SELECT rid, words, unnest(generate_series(1, len(words) - 2)) AS i FROM texts)
), repeated AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, win) > 1
), repeats AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY rid
), counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(n_lines_failed, 0) AS BIGINT) AS n_lines_failed,
    CAST(coalesce(n_words_lost, 0) AS BIGINT) AS n_words_lost
  FROM texts LEFT JOIN by_line USING (rid) LEFT JOIN repeats USING (rid)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND n_words_lost <= 0.5 * n_words AS kept
FROM counted
"""

OP9 = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id,
         [w FOR w IN string_split_regex(coalesce(text, ''), '{_BLANK}+') IF w <> ''] AS words FROM documents
), windows AS (
  SELECT rid, doc_id, i, md5(array_to_string(words[i:i+49], ' ')) AS win FROM (
    SELECT rid, doc_id, words, unnest(generate_series(1, len(words) - 49)) AS i FROM texts)
), repeated AS (
  SELECT rid, i FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY win)
), gone AS (
  SELECT DISTINCT rid, p FROM (SELECT rid, unnest(generate_series(i, i + 49)) AS p FROM repeated)
), placed AS (
  SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM texts
), kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM placed ANTI JOIN gone USING (rid, p) GROUP BY rid
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (rid)
"""

_NORMAL_WORDS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                 r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP10 = rf"""
WITH items AS (
  SELECT item_id, words, least(len(words), 10) AS n
  FROM (SELECT item_id, {_NORMAL_WORDS} AS words FROM benchmark WHERE text IS NOT NULL)
  WHERE len(words) > 0
), item_windows AS (
  SELECT DISTINCT item_id, n, words[i:i+n-1] AS win FROM (
    SELECT item_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i FROM items)
), texts AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE {_NORMAL_WORDS} END AS words FROM documents
), doc_windows AS (
  SELECT doc_id, n, i, words[i:i+n-1] AS win FROM (
    SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i
    FROM texts, (SELECT DISTINCT n FROM items))
), hits AS (
  SELECT doc_id, item_id, w.n, i FROM doc_windows w JOIN item_windows x ON w.n = x.n AND w.win = x.win
), words_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p
        FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id
), items_hit AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""



def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _chat_sql(template: Template) -> str:
    """Lengths of the frame from the template; texts are measured escaped."""
    def escaped(column: str) -> str:
        sql = f"replace({column}, chr(92), chr(92) || 'b')"
        for c in template.control:
            sql = f"replace({sql}, {_text(c)}, {_text(c[0])} || chr(92) || {_text('e' + c[1:])})"
        return sql

    frame = len(template.begin) + len(template.end)
    per_turn = len(template.open) + len(template.after_role) + len(template.close)
    moves = ", ".join(f"({_text(a)}, {_text(r)}, {_text(b)})" for (a, r), b in template.moves.items())
    final = ", ".join(map(_text, template.final))
    return f"""
WITH RECURSIVE rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM rows
), moves(state, role, next_state) AS (VALUES {moves}),
walk AS (
  SELECT conv_id, 0 AS n, 'start' AS state FROM (SELECT DISTINCT conv_id FROM numbered)
  UNION ALL
  SELECT w.conv_id, x.n, coalesce(m.next_state, '') FROM walk w
  JOIN numbered x ON x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.n = w.n + 1
  LEFT JOIN moves m ON m.state = w.state AND m.role = x.role
), ended AS (
  SELECT conv_id, state FROM walk QUALIFY n = max(n) OVER (PARTITION BY conv_id)
)
SELECT r.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST({frame} + sum({per_turn} + length({escaped("role")}) + length({escaped("text")})) AS BIGINT)
    AS formatted_chars,
  any_value(e.state) IN ({final}) AS valid
FROM numbered r JOIN ended e ON e.conv_id IS NOT DISTINCT FROM r.conv_id GROUP BY r.conv_id
"""


def _licence_sql() -> str:
    known = ", ".join(f"({_text(s)}, {_text(i)})" for s, i in licenses.known_sentences().items())
    rules = ", ".join(f"({k}, {_text(licence)}, {_text(''.join(f'<{i}>' for i in seq))})"
                      for k, (licence, seq) in enumerate(licenses.licence_rules(), 1))
    return rf"""
WITH RECURSIVE known(plain, sid) AS (VALUES {known}),
rules(k, licence, pattern) AS (VALUES {rules}),
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
readings AS (
  SELECT rid, 1 AS reading, text FROM docs
  UNION ALL
  SELECT rid, 2, regexp_replace(text, '([^\n])\r?\n([^\r\n])', '\1 \2', 'g') FROM docs
), sentences AS (
  SELECT rid, reading, unnest(parts) AS sentence, generate_subscripts(parts, 1) AS n FROM (
    SELECT rid, reading, flatten(list_transform(
      string_split(regexp_replace(text, '([.!?;])[ \t\r\x0B\f]+', '\1' || chr(10), 'g'), chr(10)),
      lambda s: CASE WHEN contains(s, 'SPDX-License-Identifier') THEN string_split(regexp_replace(s,
        '\s(OR|AND|WITH)\s', chr(10) || 'SPDX-License-Identifier: ', 'g'), chr(10)) ELSE [s] END)) AS parts
    FROM readings)
), identified AS (
  SELECT rid, reading, list(sid ORDER BY n) AS ids FROM sentences
  JOIN known ON plain = trim(regexp_replace(lower(sentence), '[^a-z0-9]+', ' ', 'g'))
  GROUP BY rid, reading
), chosen AS (
  SELECT rid, ids FROM identified QUALIFY row_number() OVER (PARTITION BY rid ORDER BY len(ids) DESC, reading) = 1
), applied AS (
  SELECT rid, 0 AS k, '<' || array_to_string(ids, '><') || '>' AS rest, CAST(NULL AS VARCHAR) AS licence FROM chosen
  UNION ALL
  SELECT rid, r.k, replace(rest, pattern, '<>'), CASE WHEN contains(rest, pattern) THEN r.licence END
  FROM applied a JOIN rules r ON r.k = a.k + 1
), found AS (
  SELECT rid, string_agg(licence, ',' ORDER BY k) AS licences
  FROM (SELECT rid, licence, min(k) AS k FROM applied WHERE licence IS NOT NULL GROUP BY rid, licence) GROUP BY rid
)
SELECT doc_id, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_sentences,
       coalesce(array_to_string(ids, ','), '') AS sentence_ids, coalesce(licences, '') AS licences
FROM docs LEFT JOIN chosen USING (rid) LEFT JOIN found USING (rid)
"""


OP12 = rf"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY place) AS turns FROM turns GROUP BY conv_id
), hashed AS (
  SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 4 AS h
  FROM own
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
), members AS (
  SELECT conv_id, turns, unnest(generate_series(0, len(turns))) AS depth FROM rebuilt
), nodes AS (
  SELECT depth, turns[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(turns) = depth), '') AS ends
  FROM members GROUP BY ALL
), children AS (
  SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1)
           * len([w FOR w IN string_split_regex(n.prefix[n.depth].text, '{_BLANK}+') IF w <> '']) END AS saved
  FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.prefix = n.prefix
), above AS (
  SELECT prefix, saved, n_children, unnest(generate_series(0, depth)) AS depth FROM counted
), sums AS (
  SELECT depth, prefix[1:depth] AS prefix, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM above GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM counted n JOIN sums s ON s.depth = n.depth AND s.prefix = n.prefix
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1] AND n.depth > 0
"""


OP13 = rf"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS rid, doc_id,
         [w FOR w IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_BLANK}+') IF w <> ''] AS words
  FROM documents
), sets AS (
  SELECT rid, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [md5(array_to_string(words, ' '))]
    ELSE list_distinct([md5(array_to_string(words[i:i + 3], ' ')) FOR i IN generate_series(1, len(words) - 3)]) END AS grams
  FROM texts
), distinct_sets AS (
  SELECT grams, min(rid) AS node, len(grams) AS n FROM (SELECT rid, list_sort(grams) AS grams FROM sets) WHERE len(grams) > 0 GROUP BY grams
), items AS (
  SELECT node, n, unnest(grams) AS gram FROM distinct_sets
), near AS (
  SELECT a.node AS a, b.node AS b FROM items a JOIN items b ON a.gram = b.gram AND a.node <> b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
  SELECT node AS a, node AS b FROM distinct_sets
  UNION
  SELECT r.a, n.b FROM reached r JOIN near n ON n.a = r.b
), least AS (
  SELECT d.node, min(s.doc_id) AS doc_id FROM distinct_sets d JOIN sets s ON list_sort(s.grams) = d.grams GROUP BY d.node
), classes AS (
  SELECT r.a AS node, min(l.doc_id) AS component_id FROM reached r JOIN least l ON l.node = r.b GROUP BY r.a
)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles,
       CASE WHEN len(s.grams) = 0 THEN s.doc_id ELSE c.component_id END AS component_id
FROM sets s LEFT JOIN distinct_sets d ON d.grams = list_sort(s.grams) LEFT JOIN classes c ON c.node = d.node
"""


ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op6_chat_format": _chat_sql(Template()),
    "op7_licenses": _licence_sql(),
    "op9_substring_dedup": OP9,
    "op10_decontaminate": OP10,
    "op12_prefix_trie": OP12,
    "op13_ngram_join": OP13,
}
