"""DuckDB SQL for each contract query, over the generated tables.

Written independently of the Spark code: the same binding (see
``sources.tables``) and the same semantics, in plain SQL. Links, page
addresses and comment marks are put into the texts by a rule on the id
(``tables.marked_texts``); the SQL states what must remain of them by the same
rule, without searching for them. Other whitespace than ASCII and nested links
do not occur in the generated texts and are covered by ``tests/``.
"""

from __future__ import annotations

import string

from ..functions.flags import NEGATIVE_THRESHOLD, POSITIVE_THRESHOLD
from ..functions.paging import SITE_PREFIX
from ..operators import term_fit
from ..sources.tables import STATES
from . import queries as Q

_STATE_LIST = "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in STATES) + "]"


# Fixed value: the punctuation that cleaning keeps.
_KEPT = "!?.-,';:"
_KEPT_CLASS = _KEPT.replace("-", "\\-").replace("'", "''")  # in a character class of a SQL text
_DELETED = "".join(c for c in string.punctuation if c not in _KEPT)


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- common table expressions -------------------------------------------------

ARTIST = """artist AS (
  SELECT min(doc_id) AS artist_id, source AS artist_name
  FROM documents GROUP BY source)"""

SONG = """song AS (
  SELECT d.doc_id AS song_id, a.artist_id,
         d.source || '-' || CAST(d.doc_id AS VARCHAR) AS song_name,
         '/' || d.lang || '/' || CAST(d.doc_id AS VARCHAR) AS page_link
  FROM documents d JOIN artist a ON a.artist_name = d.source)"""


def words_cte(name: str, source: str, id_col: str, text_col: str) -> str:
    """Cleaned unigram arrays of ``source``: lower-case, drop disallowed
    characters, split on whitespace, cut each word's trailing punctuation,
    drop empty words."""
    return f"""{name} AS (
  SELECT {id_col} AS id, list_filter(list_transform(
           string_split_regex(
             regexp_replace(lower({text_col}), '[^\\sA-Za-z0-9{_KEPT_CLASS}]', '', 'g'),
             '\\s+'),
           lambda x: regexp_replace(x, '[{_KEPT_CLASS}]+$', '')),
         lambda x: x <> '') AS words
  FROM {source})"""


def grams(w: str, n: int) -> str:
    if n == 1:
        return w
    parts = " || '_' || ".join(f"{w}[i + {k}]" for k in range(n))
    return f"list_transform(range(1, len({w}) - {n - 2}), lambda i: {parts})"


INDEX = ",\n".join([
    ARTIST, SONG,
    words_cte("words", "documents", "doc_id", "text"),
    """tok AS (
  SELECT id AS song_id, token, count(*) AS count
  FROM (SELECT id, unnest(words) AS token FROM words) GROUP BY id, token)""",
    """dfreq AS (SELECT token, count(song_id) AS df FROM tok GROUP BY token)""",
    """scores AS (
  SELECT t.song_id, t.token,
         t.count * log10(CAST((SELECT count(song_id) FROM song) AS DOUBLE) / f.df) AS score
  FROM tok t JOIN dfreq f ON f.token = t.token)""",
    """totals AS (SELECT song_id, sum(score) AS total FROM scores GROUP BY song_id)""",
])


def search_ctes(queries_sql: str) -> str:
    return ",\n".join([
        INDEX,
        f"queries AS ({queries_sql})",
        """qtok AS (
  SELECT query_id, mode, list_filter(list_transform(
           string_split_regex(text, '[ \\n\\r]+'),
           lambda t: regexp_replace(t, '^[[:punct:]]+|[[:punct:]]+$', '', 'g')),
         lambda t: t <> '') AS toks
  FROM queries)""",
        """terms AS (
  SELECT query_id,
         CASE WHEN mode = 'and' THEN len(list_distinct(toks)) ELSE 1 END AS need,
         unnest(list_distinct(toks)) AS token
  FROM qtok)""",
        """matched AS (
  SELECT q.query_id, s.song_id
  FROM scores s JOIN terms q ON q.token = s.token
  GROUP BY q.query_id, s.song_id, q.need
  HAVING count(*) >= q.need)""",
        """results AS (
  SELECT m.query_id, m.song_id, sg.song_name AS song, a.artist_name, sg.page_link,
         round(t.total, 6) AS score
  FROM matched m JOIN totals t ON t.song_id = m.song_id
  JOIN song sg ON sg.song_id = m.song_id
  JOIN artist a ON a.artist_id = sg.artist_id)""",
        """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, song_id) AS rank
  FROM results)""",
    ])


BATCH_QUERIES = """SELECT b.item_id * 2 + v.m AS query_id, lower(b.text) AS text,
         CASE v.m WHEN 0 THEN 'or' ELSE 'and' END AS mode
  FROM benchmark b, (VALUES (0), (1)) v(m)"""

BATCH = search_ctes(BATCH_QUERIES)


def single(query: str, mode: str) -> str:
    return search_ctes(f"SELECT 0 AS query_id, {_sql_str(query)} AS text, {_sql_str(mode)} AS mode")


COMMENTS = f"""comments AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id, d.text AS body, d.source AS author,
         {_STATE_LIST}[(d.doc_id % {len(STATES)}) + 1] AS author_flair_text,
         epoch_us(e.ts) // 1000000 AS created_utc,
         't3_' || CAST(d.doc_id % (SELECT count(DISTINCT conv_id) FROM conversations) AS VARCHAR)
           AS link_id,
         CAST(floor(e.value) AS BIGINT) AS score
  FROM documents d
  JOIN events e ON e.event_id = (d.doc_id * 7919) % (SELECT count(*) FROM events))"""

# What ``marked_texts`` puts around a text, and what stripping links or
# addresses must leave of it.
MARKED = """marked AS (
  SELECT d.doc_id, d.text AS plain, d.source, d.doc_id % 4 AS rule,
         CASE d.doc_id % 4 WHEN 0 THEN '[' || d.source || '](' || p.url || ') ' || d.text
              WHEN 1 THEN d.text || ' ' || p.url WHEN 2 THEN d.text || ' /s'
              ELSE '&gt; ' || d.text END AS text
  FROM documents d JOIN pages p ON p.page_id = d.doc_id % (SELECT count(*) FROM pages)),
left_over AS (
  SELECT doc_id, CASE rule WHEN 0 THEN source || ' ' || plain ELSE text END AS no_links,
         CASE rule WHEN 0 THEN source || ' ' || plain WHEN 1 THEN plain ELSE text END AS no_urls
  FROM marked)"""

SUBMISSIONS = """submissions AS (
  SELECT CAST(conv_id AS VARCHAR) AS id, max(CASE WHEN turn = 0 THEN text END) AS title,
         count(*) AS score
  FROM conversations GROUP BY conv_id)"""

LABELED = """labeled_data AS (
  SELECT CAST(doc_id AS VARCHAR) AS "Input_id",
         CASE WHEN toxic = 1 THEN '-1' WHEN quality = 1 THEN '1' ELSE '0' END AS labeldjt
  FROM labels)"""

CWT = """cwt AS (
  SELECT c.id, c.author_flair_text AS flair, c.created_utc, c.body, c.score AS cscore,
         substr(c.link_id, 4) AS sid, s.title, s.score AS sscore
  FROM comments c JOIN submissions s ON s.id = substr(c.link_id, 4))"""

SCORED = """scored AS (
  SELECT cwt.*, l.quality AS pos, l.toxic AS neg
  FROM cwt JOIN labels l ON CAST(l.doc_id AS VARCHAR) = cwt.id)"""

SENT = ",\n".join([COMMENTS, SUBMISSIONS, LABELED, CWT, SCORED])


def share_sql(key_expr: str, key: str, where: str = "TRUE") -> str:
    return f"""SELECT {key_expr} AS {key}, count(*) AS count,
       CAST(sum(pos) AS BIGINT) AS pos_count, CAST(sum(neg) AS BIGINT) AS neg_count,
       CAST(sum(pos) AS DOUBLE) / count(*) AS pos_share,
       CAST(sum(neg) AS DOUBLE) / count(*) AS neg_share
FROM scored WHERE ({where}) AND {key_expr} IS NOT NULL
GROUP BY {key_expr} HAVING sum(pos) > 0 AND sum(neg) > 0"""


DAY_EXPR = "DATE '1970-01-01' + CAST(floor(created_utc / 86400) AS INTEGER)"
STATE_WHERE = f"flair IN ({', '.join(_sql_str(s) for s in STATES)})"


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _top(share: str) -> str:
    return with_(SENT + f",\nst AS ({share_sql('sid', 'sid')})",
                 f"SELECT * FROM st WHERE {share} > 0.9 ORDER BY {share} DESC, sid LIMIT 10")


def _shade(v: str, lo: float, hi: float) -> str:
    return f"1.0 - sqrt(({v} - CAST({lo!r} AS DOUBLE)) / (CAST({hi!r} AS DOUBLE) - CAST({lo!r} AS DOUBLE)))"


_MAPPED = [s for s in STATES if s != "District of Columbia"]

PAGE_LIST = """array_to_string(list_transform(
    range(greatest(1, page - 5), least(num_pages, page + 10, greatest(1, page - 5) + 10) + 1),
    lambda x: CAST(x AS VARCHAR) || ':' || CAST(x - page AS VARCHAR)), ',')"""


def _vocab() -> str:
    w = "words"
    feats = f"list_distinct(list_concat({w}, {grams(w, 2)}, {grams(w, 3)}))"
    ctes = SENT + ",\n" + """lab AS (SELECT c.id, c.body FROM labeled_data l JOIN comments c ON c.id = l."Input_id")""" \
        + ",\n" + words_cte("lw", "lab", "id", "body")
    return with_(ctes, f"""SELECT term, count(*) AS df
FROM (SELECT unnest({feats}) AS term FROM lw)
GROUP BY term HAVING count(*) >= 10""")


def _usable() -> str:
    """Distinct features of every labelled comment, and the vocabulary."""
    w = "words"
    feats = f"list_distinct(list_concat({w}, {grams(w, 2)}, {grams(w, 3)}))"
    return SENT + """,
lab AS (SELECT c.id, c.body, CAST(l.labeldjt AS INTEGER) AS label
        FROM labeled_data l JOIN comments c ON c.id = l."Input_id"),
""" + words_cte("lw", "lab", "id", "body") + f""",
feats AS (SELECT id, unnest({feats}) AS term FROM lw),
vocab AS (SELECT term FROM feats GROUP BY term HAVING count(*) >= 10)"""


def _ml_features() -> str:
    return with_(_usable(), """SELECT lab.id AS "Input_id", CAST(lab.label = 1 AS INTEGER) AS positive,
       CAST(lab.label = -1 AS INTEGER) AS negative, CAST(coalesce(n, 0) AS INTEGER) AS n_active
FROM lab LEFT JOIN (SELECT id, count(*) AS n FROM feats JOIN vocab USING (term) GROUP BY id) f
  ON f.id = lab.id""")


def _ml_train() -> str:
    return with_(_usable(), """SELECT model, (SELECT CAST(count(*) AS INTEGER) FROM vocab) AS num_features,
       CAST(1.0 AS DOUBLE) AS reg_param, CAST(10 AS INTEGER) AS max_iter
FROM (VALUES ('pos'), ('neg')) m(model)""")


def _term_fit(body: str) -> str:
    """The fixed gradient steps of ``term_fit``, unrolled."""
    rate, reg = term_fit.RATE, term_fit.REG
    ctes = [_usable(), """ids AS MATERIALIZED (SELECT row_number() OVER (ORDER BY count(*) DESC, term) - 1 AS term_id,
  term, count(*) AS df FROM feats GROUP BY term HAVING count(*) >= 10)""",
            "enc AS MATERIALIZED (SELECT f.id, i.term_id FROM feats f JOIN ids i ON i.term = f.term)",
            "n AS (SELECT count(*) AS n FROM lab)",
            "w0 AS MATERIALIZED (SELECT term_id, CAST(0 AS DOUBLE) AS pos, CAST(0 AS DOUBLE) AS neg FROM ids)",
            "b0 AS MATERIALIZED (SELECT CAST(0 AS DOUBLE) AS pos, CAST(0 AS DOUBLE) AS neg)"]
    for k in range(term_fit.STEPS + 1):
        ctes.append(f"""p{k} AS MATERIALIZED (SELECT l.id, 1 / (1 + exp(-(coalesce(m.pos, 0) + b.pos))) AS pos,
  1 / (1 + exp(-(coalesce(m.neg, 0) + b.neg))) AS neg FROM lab l CROSS JOIN b{k} b
  LEFT JOIN (SELECT id, sum(pos) AS pos, sum(neg) AS neg FROM enc JOIN w{k} USING (term_id) GROUP BY id) m ON m.id = l.id)""")
        if k == term_fit.STEPS:
            break
        ctes += [f"""r{k} AS MATERIALIZED (SELECT l.id, p.pos - CAST(l.label = 1 AS INTEGER) AS pos,
  p.neg - CAST(l.label = -1 AS INTEGER) AS neg FROM lab l JOIN p{k} p ON p.id = l.id)""",
                 f"""w{k + 1} AS MATERIALIZED (SELECT w.term_id, w.pos - {rate} * (coalesce(g.pos, 0) + {reg} * w.pos) AS pos,
  w.neg - {rate} * (coalesce(g.neg, 0) + {reg} * w.neg) AS neg FROM w{k} w LEFT JOIN
  (SELECT term_id, sum(r.pos) / any_value(n) AS pos, sum(r.neg) / any_value(n) AS neg
   FROM enc JOIN r{k} r ON r.id = enc.id CROSS JOIN n GROUP BY term_id) g ON g.term_id = w.term_id)""",
                 f"""b{k + 1} AS MATERIALIZED (SELECT b.pos - {rate} * g.pos AS pos, b.neg - {rate} * g.neg AS neg FROM b{k} b
  CROSS JOIN (SELECT sum(pos) / any_value(n) AS pos, sum(neg) / any_value(n) AS neg FROM r{k} CROSS JOIN n) g)"""]
    return with_(",\n".join(ctes), body)


def _preview() -> str:
    w = "words"
    feats = f"list_concat({w}, {grams(w, 2)}, {grams(w, 3)})"
    ctes = COMMENTS + """,
first AS (SELECT * FROM comments ORDER BY CAST(id AS BIGINT) LIMIT 99)""" + ",\n" \
        + words_cte("fw", "first", "id", "body")
    return with_(ctes, f"""SELECT f.id, f.author, CAST(length(f.body) AS INTEGER) AS body_length,
       array_to_string({feats}, ' ') AS ngrams
FROM first f JOIN fw ON fw.id = f.id""")


def _term_counts(n: int) -> str:
    return with_(words_cte("words", "documents", "doc_id", "text"),
                 f"SELECT term, count(*) AS n FROM (SELECT unnest({grams('words', n)}) AS term FROM words) GROUP BY term")


def oracle_sql() -> dict[str, str]:
    rank_cols = "query_id, rank, song_id, song, artist_name, page_link, score"
    single_cols = "rank, song_id, song, artist_name, page_link, score"
    sql = {
        "doc_frequency": with_(INDEX, "SELECT token, count(song_id) AS df FROM tok GROUP BY token"),
        "tfidf_scores": with_(INDEX, "SELECT song_id, token, round(score, 6) AS score FROM scores"),
        "search_or": with_(single(Q.OR_QUERY, "or"), f"SELECT {single_cols} FROM ranked"),
        "search_and": with_(single(Q.AND_QUERY, "and"), f"SELECT {single_cols} FROM ranked"),
        "search_batch": with_(BATCH, f"SELECT {rank_cols} FROM ranked"),
        "search_result_count": with_(BATCH, """SELECT q.query_id, coalesce(c.n, 0) AS num_results
FROM queries q LEFT JOIN (SELECT query_id, count(song) AS n FROM ranked GROUP BY query_id) c
  ON c.query_id = q.query_id"""),
        "search_matched_page": with_(BATCH + """,
own AS (
  SELECT q.query_id, s.song_id, round(sum(s.score), 6) AS score
  FROM scores s JOIN terms q ON q.token = s.token
  GROUP BY q.query_id, s.song_id, q.need HAVING count(*) >= q.need),
own_ranked AS (
  SELECT o.*, sg.song_name AS song, a.artist_name, sg.page_link,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, o.song_id) AS rank
  FROM own o JOIN song sg ON sg.song_id = o.song_id JOIN artist a ON a.artist_id = sg.artist_id)""",
                                     f"SELECT {rank_cols} FROM own_ranked WHERE rank <= 20"),
        "tfidf_segments": with_(INDEX, "SELECT song_id, token, round(score, 6) AS score FROM scores"),
        "ranked_postings": with_(INDEX, """SELECT t.token, count(*) AS n_songs
FROM tok t JOIN song s ON s.song_id = t.song_id JOIN artist a ON a.artist_id = s.artist_id GROUP BY t.token"""),
        "search_page": with_(BATCH, f"""SELECT {rank_cols} FROM ranked
WHERE rank > ({Q.PAGE_NUMBER} - 1) * 20 AND rank <= {Q.PAGE_NUMBER} * 20"""),
        "search_first_page": with_(BATCH, f"SELECT {rank_cols} FROM ranked WHERE rank <= 20"),
        "search_snapshot_page": with_(BATCH, f"""SELECT {rank_cols} FROM ranked
WHERE rank > ({Q.PAGE_NUMBER} - 1) * 20 AND rank <= {Q.PAGE_NUMBER} * 20"""),
        "search_or_first_page": with_(single(Q.OR_QUERY, "or"), f"""SELECT song_id, song, artist_name,
       {_sql_str(SITE_PREFIX)} || page_link AS url, score
FROM results ORDER BY score DESC, song_id LIMIT 20"""),
        "search_page_info": with_(BATCH + """,
counts AS (SELECT query_id, count(song) AS num_results FROM ranked GROUP BY query_id),
perq AS (SELECT q.query_id, coalesce(c.num_results, 0) AS n
         FROM queries q LEFT JOIN counts c ON c.query_id = q.query_id),
req AS (SELECT query_id, n AS num_results,
               unnest(range(1, CAST(ceil(n / 20) AS BIGINT) + 2)) AS page FROM perq),
info AS (SELECT query_id, page, num_results,
                CAST(ceil(num_results / 20) AS BIGINT) AS num_pages FROM req)""",
            f"""SELECT query_id, page, num_results, num_pages, page > 1 AS prev_valid,
       num_pages > page AS next_valid, (page - 1) * 20 + 1 AS first_result,
       least((page - 1) * 20 + 20, num_results) AS last_result,
       {PAGE_LIST} AS page_list
FROM info"""),
        "search_or_page": with_(single(Q.OR_QUERY, "or"), f"""SELECT song_id, song, artist_name,
       {_sql_str(SITE_PREFIX)} || page_link AS url, score
FROM results ORDER BY score DESC, song_id LIMIT 20 OFFSET ({Q.PAGE_NUMBER} - 1) * 20"""),
        "query_tokens": with_(BATCH, """SELECT query_id, CAST(unnest(range(0, len(toks))) AS INTEGER) AS position,
       unnest(toks) AS token FROM qtok"""),
        "clean_tokens": with_(words_cte("words", "documents", "doc_id", "text"),
                              """SELECT id AS doc_id, CAST(len(words) AS INTEGER) AS n_words,
       array_to_string(words, ' ') AS words FROM words"""),
        "unigram_counts": _term_counts(1),
        "bigram_counts": _term_counts(2),
        "trigram_counts": _term_counts(3),
        "ngram_features": with_(words_cte("words", "documents", "doc_id", "text"),
                                f"""SELECT id AS doc_id,
       CAST(len(words) + len({grams('words', 2)}) + len({grams('words', 3)}) AS INTEGER) AS n_features,
       md5(array_to_string(list_concat(words, {grams('words', 2)}, {grams('words', 3)}), ' '))
         AS features_md5
FROM words"""),
        "ngram_vocabulary": _vocab(),
        "strip_links": with_(MARKED, "SELECT doc_id, no_links AS text FROM left_over"),
        "clean_marked_tokens": with_(MARKED + ",\n" + words_cte("words", "left_over", "doc_id", "no_urls"),
                                     "SELECT id AS doc_id, array_to_string(words, ' ') AS words FROM words"),
        "clean_text": with_(f"""tokens AS (
  SELECT doc_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS n FROM (
    SELECT doc_id, string_split_regex(translate(regexp_replace(lower(text),
             '[^a-z0-9\\s[:punct:]]', '', 'g'), {_sql_str(_DELETED)}, ''), '\\s+') AS toks
    FROM documents)),
halves AS (SELECT doc_id, n, tok, rtrim(tok, {_sql_str(_KEPT)}) AS body FROM tokens)""",
                            """SELECT d.doc_id, coalesce(string_agg(
         CASE WHEN body = '' OR body = tok THEN tok
              ELSE body || ' ' || substr(tok, length(body) + 1) END, ' ' ORDER BY n)
         FILTER (tok <> ''), '') AS parsed
FROM documents d LEFT JOIN halves h ON h.doc_id = d.doc_id GROUP BY d.doc_id"""),
        "filter_sarcasm_quote": with_(MARKED, "SELECT doc_id, text FROM marked WHERE rule IN (0, 1)"),
        "label_flags": with_(LABELED, """SELECT "Input_id", labeldjt,
       CASE WHEN TRY_CAST(labeldjt AS INTEGER) = 1 THEN 1 ELSE 0 END AS positive,
       CASE WHEN TRY_CAST(labeldjt AS INTEGER) = -1 THEN 1 ELSE 0 END AS negative
FROM labeled_data WHERE TRY_CAST(labeldjt AS INTEGER) IS NOT NULL"""),
        "labeled_comments": with_(SENT, """SELECT l."Input_id", l.labeldjt, c.id, c.author, c.author_flair_text,
       c.created_utc, c.link_id, c.score, c.body
FROM labeled_data l JOIN comments c ON c.id = l."Input_id\""""),
        "comments_with_title": with_(SENT, "SELECT id, sid, title, flair, created_utc, body, cscore, sscore FROM cwt"),
        "story_scores": with_(SENT, "SELECT id, pos, neg, cscore, sscore, sid FROM scored"),
        "sample_comments": with_(COMMENTS, """SELECT id, created_utc, link_id FROM comments
WHERE CAST('0x' || substr(md5(id), 1, 8) AS UBIGINT) < 0.02 * 4294967296"""),
        "share_overall": with_(SENT, """SELECT count(*) AS count, CAST(sum(pos) AS BIGINT) AS pos_count,
       CAST(sum(neg) AS BIGINT) AS neg_count,
       CAST(sum(pos) AS DOUBLE) / count(*) AS pos_share,
       CAST(sum(neg) AS DOUBLE) / count(*) AS neg_share
FROM scored"""),
        "share_all": with_(SENT, "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS dimension, CAST({key} AS VARCHAR) AS key, count(*) AS count,
       CAST(sum(pos) AS BIGINT) AS pos_count, CAST(sum(neg) AS BIGINT) AS neg_count,
       CAST(sum(pos) AS DOUBLE) / count(*) AS pos_share, CAST(sum(neg) AS DOUBLE) / count(*) AS neg_share
FROM scored WHERE {where} GROUP BY {group}""" for name, key, where, group in (
                ("overall", "NULL", "TRUE", "()"), ("day", DAY_EXPR, "created_utc IS NOT NULL", DAY_EXPR),
                ("state", "flair", STATE_WHERE, "flair"), ("comment_score", "cscore", "cscore IS NOT NULL", "cscore"),
                ("submission_score", "sscore", "sscore IS NOT NULL", "sscore"), ("story", "sid", "sid IS NOT NULL", "sid")))),
        "roc_area": with_(SENT + """,
sides AS (SELECT 'pos' AS side, cscore AS score, pos AS label FROM scored
          UNION ALL SELECT 'neg', cscore, neg FROM scored),
mid AS (SELECT side, label, rank() OVER (PARTITION BY side ORDER BY score)
               + (count(*) OVER (PARTITION BY side, score) - 1) / 2.0 AS mid FROM sides),
sums AS (SELECT side, sum(mid * label) AS ranks, CAST(sum(label) AS DOUBLE) AS ones, count(*) AS n FROM mid GROUP BY side)""",
                          """SELECT side, round((ranks - ones * (ones + 1) / 2) / (ones * (n - ones)), 9) AS auc FROM sums"""),
        "share_by_day": with_(SENT, share_sql(DAY_EXPR, "date")),
        "share_by_state": with_(SENT, share_sql("flair", "flair", STATE_WHERE)),
        "share_by_comment_score": with_(SENT, share_sql("cscore", "cscore")),
        "share_by_submission_score": with_(SENT, share_sql("sscore", "sscore")),
        "share_by_story": with_(SENT, share_sql("sid", "sid")),
        "top_stories_pos": _top("pos_share"),
        "top_stories_neg": _top("neg_share"),
        "report_days": with_(SENT + f""",
moved AS (SELECT DATE '{Q.REPORT_START}' + CAST(date - (SELECT min({DAY_EXPR}) FROM scored) AS INTEGER) AS date,
                 pos_share, neg_share FROM ({share_sql(DAY_EXPR, 'date')})),
d AS (SELECT CAST(date AS DATE) AS date, pos_share, neg_share FROM moved)""",
                             """SELECT date, pos_share AS "Positive", neg_share AS "Negative"
FROM d WHERE date <> DATE '2018-12-31'"""),
        "report_states": with_(
            SENT + f",\nst AS ({share_sql('flair', 'flair', STATE_WHERE)}),\n"
            + "regions AS (SELECT unnest([" + ", ".join(_sql_str(s) for s in _MAPPED) + "]) AS state)",
            f"""SELECT r.state, st.pos_share AS "Positive", st.neg_share AS "Negative",
       st.neg_share - st.pos_share AS diff,
       {_shade('st.pos_share', 0.3, 0.7)} AS pos_shade,
       {_shade('st.neg_share', 0.7, 1.0)} AS neg_shade,
       {_shade('(st.neg_share - st.pos_share)', 0.0, 0.7)} AS diff_shade
FROM regions r LEFT JOIN st ON st.flair = r.state"""),
        "report_scores": with_(
            SENT + f",\nss AS ({share_sql('sscore', 'sscore')}),\ncs AS ({share_sql('cscore', 'cscore')})",
            """SELECT 'submission' AS kind, sscore AS score, pos_share AS "Positive", neg_share AS "Negative" FROM ss
UNION ALL
SELECT 'comment' AS kind, cscore AS score, pos_share AS "Positive", neg_share AS "Negative" FROM cs"""),
        "dq_duplicate_keys": with_(INDEX, " UNION ALL ".join(
            f"""SELECT '{name}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows,
       count(*) AS n_keys, count(CASE WHEN n > 1 THEN 1 END) AS duplicate_keys,
       CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT {keys}, count(*) AS n FROM {table} GROUP BY {keys})"""
            for name, table, keys in [("artist", "artist", "artist_id"), ("song", "song", "song_id"),
                                      ("token", "tok", "song_id, token"),
                                      ("tfidf", "scores", "song_id, token")])),
        "dq_orphans": with_(INDEX + ",\n" + SENT, """SELECT 'song.artist_id -> artist' AS check_name, count(*) AS orphans
FROM song s WHERE s.artist_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM artist a WHERE a.artist_id = s.artist_id)
UNION ALL
SELECT 'token.song_id -> song', count(*) FROM tok t
WHERE NOT EXISTS (SELECT 1 FROM song s WHERE s.song_id = t.song_id)
UNION ALL
SELECT 'labeled_data.Input_id -> comments', count(*) FROM labeled_data l
WHERE l."Input_id" IS NOT NULL AND NOT EXISTS (SELECT 1 FROM comments c WHERE c.id = l."Input_id")"""),
        "dq_lengths": with_(INDEX, " UNION ALL ".join(
            f"""SELECT '{t}' AS table_name, '{c}' AS column_name, {n} AS max_length,
       count(CASE WHEN length({c}) > {n} THEN 1 END) AS violations,
       CAST(max(length({c})) AS BIGINT) AS longest FROM {src}"""
            for t, c, n, src in [("artist", "artist_name", 255, "artist"), ("song", "song_name", 255, "song"),
                                 ("song", "page_link", 1000, "song"), ("token", "token", 255, "tok")])),
        "load_rejects": with_(INDEX, """SELECT 'song' AS table_name,
       CASE song_id % 50 WHEN 1 THEN 'x' || CAST(song_id AS VARCHAR) ELSE CAST(song_id AS VARCHAR) END AS key,
       CASE song_id % 50 WHEN 1 THEN 'bad value' WHEN 2 THEN 'too long' WHEN 3 THEN 'duplicate key' ELSE 'orphan' END AS reason,
       1 AS copies
FROM song WHERE song_id % 50 IN (1, 2, 3, 4)"""),
        "load_accepted": with_(INDEX, """SELECT song_id, artist_id, song_name, page_link
FROM song WHERE song_id % 50 NOT IN (1, 2, 4)"""),
        "src_csv_catalog": with_(INDEX, "SELECT song_id, token, count FROM tok"),
        "src_csv_artist": with_(ARTIST, "SELECT artist_id, artist_name FROM artist"),
        "src_csv_song": with_(ARTIST + ",\n" + SONG,
                              "SELECT song_id, artist_id, song_name, page_link FROM song"),
        "tfidf_from_token_csv": with_(INDEX, "SELECT song_id, token, round(score, 6) AS score FROM scores"),
        "src_csv_labels": with_(LABELED, 'SELECT "Input_id", labeldjt FROM labeled_data'),
        "src_json_comments": with_(COMMENTS, """SELECT id, author, author_flair_text, created_utc, link_id, score,
       body FROM comments"""),
        "src_json_submissions": with_(SUBMISSIONS, "SELECT id, title, score FROM submissions"),
        "sink_csv_report": with_(SENT, share_sql(DAY_EXPR, "date")),
        "sink_csv_overall": with_(SENT, """SELECT count(*) AS count, CAST(sum(pos) AS BIGINT) AS pos_count,
       CAST(sum(neg) AS BIGINT) AS neg_count,
       CAST(sum(pos) AS DOUBLE) / count(*) AS pos_share,
       CAST(sum(neg) AS DOUBLE) / count(*) AS neg_share
FROM scored"""),
        "sink_csv_states": with_(SENT, share_sql("flair", "flair", STATE_WHERE)),
        "sink_csv_submission_scores": with_(SENT, share_sql("sscore", "sscore")),
        "sink_csv_comment_scores": with_(SENT, share_sql("cscore", "cscore")),
        "split_train_test": with_(SENT, """SELECT l."Input_id",
       CASE WHEN CAST('0x' || substr(md5('42:' || l."Input_id"), 1, 8) AS UBIGINT) % 2 = 0
            THEN 'train' ELSE 'test' END AS split
FROM labeled_data l JOIN comments c ON c.id = l."Input_id\""""),
        "ml_dictionary": _term_fit("SELECT term_id, term, df FROM ids"),
        "ml_term_ids": _term_fit("SELECT id, term_id FROM enc"),
        "ml_term_weights": _term_fit(f"""SELECT i.term, round(w.pos, 9) AS pos, round(w.neg, 9) AS neg
FROM w{term_fit.STEPS} w JOIN ids i ON i.term_id = w.term_id"""),
        "ml_term_flags": _term_fit(f"""SELECT id, round(pos, 8) AS p_pos, round(neg, 8) AS p_neg,
       CAST(pos > {POSITIVE_THRESHOLD} AS INTEGER) AS pos, CAST(neg > {NEGATIVE_THRESHOLD} AS INTEGER) AS neg
FROM p{term_fit.STEPS}"""),
        "ml_features": _ml_features(),
        "ml_train": _ml_train(),
        "materialize_stage": with_(SENT, """SELECT l."Input_id", l.labeldjt, c.id, c.author, c.author_flair_text,
       c.created_utc, c.link_id, c.score, c.body
FROM labeled_data l JOIN comments c ON c.id = l."Input_id\""""),
        "preview_ngrams": _preview(),
        "stream_share_by_day": with_(SENT, share_sql(DAY_EXPR, "date")),
    }
    return sql
