"""DuckDB SQL equivalents of ``testdata.QUERIES`` (same column names, same values).

Tables ``documents labels conversations events orders customer nation region part``
are views over the same Parquet files.  Built from the same fixed values as the Spark
side (token rule, stop words, label dictionaries) so the two cannot drift apart.
"""

from __future__ import annotations

from verbatim.functions.text import ORACLE_TOKEN_PATTERN
from verbatim.functions.words import ORACLE_WORD_PATTERN
from verbatim.plans.panels import PROVIDER_RULES
from verbatim.plans.testdata import (FLAG_NUMBERS, PARTIAL_LABELS, QUESTION_PATTERN,
                                     SV_LABELS, SV_LANGUAGE, SV_QUESTIONS)
from verbatim.sources.stopwords import ENGLISH_STOP_WORDS


def _lit(s) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def _case(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {_lit(k) if isinstance(k, str) else k} THEN {_lit(v)}"
                     for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def _zip(expr: str) -> str:
    s = f"CAST({expr} AS VARCHAR)"
    return (f"CASE length({s}) WHEN 5 THEN {s} WHEN 4 THEN '0' || {s} "
            f"WHEN 3 THEN '00' || {s} END")


_STOP = ", ".join(f"({_lit(w)})" for w in sorted(set(ENGLISH_STOP_WORDS)))

def _bigrams(source: str = "documents") -> str:
    return f"""
sw(word) AS (VALUES {_STOP}),
tok AS (
  SELECT doc_id, source AS question, regexp_extract_all(lower(text), {_lit(ORACLE_TOKEN_PATTERN)}) AS t
  FROM {source} WHERE text <> ''),
bg AS (
  SELECT doc_id, question, t[i] AS word1, t[i + 1] AS word2
  FROM (SELECT doc_id, question, t, unnest(range(1, len(t))) AS i FROM tok)),
clean AS (
  SELECT * FROM bg
  WHERE word1 NOT IN (SELECT word FROM sw) AND word2 NOT IN (SELECT word FROM sw)),
counts AS (
  SELECT question, word1, word2, count(*) AS n FROM clean GROUP BY question, word1, word2),
cuts AS (
  SELECT question,
         CASE WHEN contains(question, '1') THEN quantile_cont(n, 0.99)
              ELSE quantile_cont(n, 0.95) END AS cut
  FROM counts GROUP BY question),
edges AS (
  SELECT c.question, c.word1, c.word2, c.n FROM counts c JOIN cuts USING (question)
  WHERE c.n >= cuts.cut)
"""


_BIGRAMS = _bigrams()
_CONSENTED = ("(SELECT d.* FROM documents d LEFT JOIN labels l USING (doc_id) "
              "WHERE CASE WHEN l.toxic = 1 THEN 0 ELSE 1 END = 1) AS consented")

_SV = f"""
sv AS (
  SELECT d.doc_id % 100 AS respondent_id, d.doc_id // 100 AS wave, d.doc_id,
         d.source AS question, d.text AS response,
         {_case('d.lang', SV_LANGUAGE)} AS language,
         {_case('l.quality', SV_LABELS['quality'])} AS quality,
         {_case('l.toxic', SV_LABELS['toxic'])} AS toxic,
         CASE WHEN l.toxic = 1 THEN 0 ELSE 1 END AS consent
  FROM documents d LEFT JOIN labels l USING (doc_id))
"""

_FILL_SV = """
SELECT respondent_id, wave, doc_id, question, response,
       last_value(language IGNORE NULLS) OVER w AS language,
       last_value(quality IGNORE NULLS) OVER w AS quality,
       last_value(toxic IGNORE NULLS) OVER w AS toxic
FROM sv WHERE consent = 1
WINDOW w AS (PARTITION BY respondent_id ORDER BY wave ASC NULLS LAST, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

_YEARLY = """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice,
       CASE WHEN year(o_orderdate) % 2 = 1 THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN year(o_orderdate) % 2 = 0 THEN o_orderpriority END AS o_orderpriority
FROM orders
"""


def _flag_sql() -> str:
    flags = {k: f"CASE WHEN p_size <= {k} THEN NULL ELSE CAST((p_partkey + {k}) % 3 = 0 AS INTEGER) END"
             for k in FLAG_NUMBERS}
    whens = " ".join(
        "WHEN " + " OR ".join(f"({flags[k]}) = 1" for k in ks) + f" THEN {_lit(label)}"
        for label, ks in PROVIDER_RULES)
    count = "CASE WHEN p_size > 45 THEN NULL ELSE p_size - 25 END"
    return (f"SELECT p_partkey, CASE {whens} END AS provider_type, "
            f"CASE WHEN ({count}) >= 1 THEN 'Yes' WHEN ({count}) IS NOT NULL THEN 'No' END AS child_0_3 "
            f"FROM part")


_DOC_Q = """
dq AS (
  SELECT 'docs' AS panel, CAST(row_number() OVER (ORDER BY code) AS INTEGER) AS num, code
  FROM (SELECT DISTINCT source AS code FROM documents))
"""

_AUDIT = f"""
WITH {_DOC_Q},
views(view) AS (VALUES ('bigram'), ('responses')),
expected AS (SELECT panel, num, code, view FROM dq, views),
menu AS (
  SELECT panel, view AS section_view,
         CASE WHEN num = 5 THEN code || '.1' ELSE code END AS code,
         CASE WHEN num = 9 AND view = 'responses' THEN 'bigram' ELSE view END AS href_view,
         CASE WHEN num = 7 AND view = 'bigram' THEN num + 1
              WHEN num = 1 AND view = 'responses' THEN 0
              WHEN num = 13 AND view = 'responses' THEN NULL ELSE num END AS page_num,
         CASE WHEN num = 11 AND view = 'bigram' THEN 'other'
              WHEN num = 12 AND view = 'bigram' THEN NULL ELSE panel END AS href_panel
  FROM expected WHERE num <> 3),
sizes AS (SELECT panel, count(*) AS n_questions FROM dq GROUP BY panel),
j AS (
  SELECT coalesce(m.panel, e.panel) AS panel, coalesce(m.section_view, e.view) AS view,
         coalesce(m.code, e.code) AS code, e.num, m.page_num, m.href_view, m.href_panel,
         m.panel IS NOT NULL AS in_menu, e.panel IS NOT NULL AS known
  FROM menu m FULL JOIN expected e
    ON m.panel = e.panel AND m.code = e.code AND m.section_view = e.view)
SELECT j.panel, view, code, num, page_num,
       CASE WHEN NOT in_menu THEN 'missing_in_menu'
            WHEN NOT known THEN 'unknown_code'
            WHEN href_panel IS DISTINCT FROM j.panel THEN 'wrong_panel'
            WHEN page_num IS NULL OR page_num < 1 OR page_num > n_questions THEN 'page_out_of_range'
            WHEN href_view IS DISTINCT FROM view THEN 'wrong_view'
            WHEN page_num IS DISTINCT FROM num THEN 'wrong_page'
            ELSE 'ok' END AS status
FROM j LEFT JOIN sizes USING (panel)
"""

# a link that doesn't parse names no panel, view or page
_NO_LINK = "(num = 12 AND view = 'bigram') OR (num = 13 AND view = 'responses')"
_NESTED_AUDIT = (_AUDIT.replace("num = 13 AND view = 'responses' THEN NULL", f"{_NO_LINK} THEN NULL")
                 .replace("num = 12 AND view = 'bigram' THEN NULL", f"{_NO_LINK} THEN NULL"))

_UNPIVOT_SV = " UNION ALL ".join(
    f"SELECT respondent_id, wave, language, quality, toxic, {_lit(q)} AS question, response "
    f"FROM filled WHERE question = {_lit(q)} AND response <> ''"
    for q in SV_QUESTIONS)

ORACLE_SQL = {
    "bigram_network_edges": f"WITH {_BIGRAMS} SELECT * FROM edges",
    "unicode_word_counts": f"""SELECT question, word, count(*) AS n FROM (
        SELECT source AS question, unnest(regexp_extract_all(lower(text), {_lit(ORACLE_WORD_PATTERN)})) AS word FROM documents) GROUP BY question, word""",
    "bigram_edges_by_wave": f"WITH {_BIGRAMS} SELECT * FROM edges",
    "bigram_network_vertices": f"""WITH {_BIGRAMS}
        SELECT question, word1 AS name FROM edges UNION SELECT question, word2 AS name FROM edges""",
    "bigram_counts": f"WITH {_BIGRAMS} SELECT * FROM counts",
    "panel_bigram_edges": f"WITH {_bigrams(_CONSENTED)} SELECT * FROM edges",
    "bigram_thresholds": f"WITH {_BIGRAMS} SELECT * FROM cuts",
    "bigram_tokens": f"WITH {_BIGRAMS} SELECT doc_id, question, word1, word2 FROM clean",
    "bigram_counts_stop_table": f"WITH {_BIGRAMS} SELECT * FROM counts",
    "panel_language_filter": f"""
        WITH sv AS (
          SELECT d.doc_id % 100 AS respondent_id, d.doc_id // 100 AS wave, d.doc_id,
                 d.source AS question,
                 {_case('l.quality', SV_LABELS['quality'])} AS quality,
                 {_case('l.toxic', SV_LABELS['toxic'])} AS toxic,
                 CASE WHEN l.toxic = 1 THEN 0 ELSE 1 END AS consent
          FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.lang IN ('en'))
        SELECT respondent_id, wave, doc_id, question,
               last_value(quality IGNORE NULLS) OVER w AS quality,
               last_value(toxic IGNORE NULLS) OVER w AS toxic
        FROM sv WHERE consent = 1
        WINDOW w AS (PARTITION BY respondent_id ORDER BY wave ASC NULLS LAST, doc_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "responses_by_question": f"""
        WITH q(code, question_num) AS (VALUES {", ".join(f"({_lit(c)}, {i + 1})" for i, c in enumerate(SV_QUESTIONS))})
        SELECT d.doc_id, d.source AS question, CASE WHEN q.code IS NOT NULL THEN 'docs' END AS panel,
               CAST(q.question_num AS INTEGER) AS question_num,
               CASE WHEN q.code IS NOT NULL THEN 'Answers since ' || t.first_id END AS question_text,
               'Question ' || q.question_num AS title
        FROM documents d LEFT JOIN q ON d.source = q.code
        LEFT JOIN (SELECT source, min(doc_id) AS first_id FROM documents GROUP BY source) t ON t.source = d.source""",
    "question_code_numbers": r"""
        SELECT question, TRY_CAST(regexp_extract(question, '(\d+)', 1) AS INTEGER) AS code_num
        FROM (SELECT DISTINCT source AS question FROM documents)""",
    "panel_fill_forward": f"WITH {_SV} {_FILL_SV}",
    "panel_response_table": f"WITH {_SV}, filled AS ({_FILL_SV}) {_UNPIVOT_SV}",
    "event_fill_forward": """
        SELECT event_id, user_id, event_type,
               last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS last_purchase,
               last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER w AS last_signup_event
        FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts ASC NULLS LAST, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "event_fill_forward_skewed": """
        WITH e AS (SELECT event_id, CASE WHEN event_type = 'view' THEN -1 ELSE user_id END AS user_id,
                          ts, event_type, value FROM events)
        SELECT event_id, user_id, event_type,
               last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS last_purchase,
               last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER w AS last_signup_event
        FROM e
        WINDOW w AS (PARTITION BY user_id ORDER BY ts ASC NULLS LAST, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "unpivot_codes": """
        SELECT doc_id, 'quality' AS question, CAST(quality AS VARCHAR) AS response FROM labels
        WHERE quality IS NOT NULL
        UNION ALL
        SELECT doc_id, 'toxic' AS question, CAST(toxic AS VARCHAR) AS response FROM labels
        WHERE toxic IS NOT NULL""",
    "unpivot_text": """
        SELECT conv_id, turn, role AS question, text AS response FROM conversations
        WHERE role IS NOT NULL AND text <> ''""",
    "wave_full_join": """
        WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate,
                          o_totalprice, o_orderstatus, o_orderpriority FROM orders),
        a AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderstatus FROM o
              WHERE o_orderdate < DATE '1998-01-01'),
        b AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderpriority FROM o
              WHERE o_orderdate >= DATE '1997-01-01')
        SELECT * FROM a NATURAL FULL JOIN b""",
    "wave_fold": _YEARLY,
    "wave_stack": _YEARLY,
    "wave_files": _YEARLY,
    # a customer met in several periods is one row; counts of periods without it are NULL
    "wave_mixed_types": """
        SELECT CAST(o_custkey AS VARCHAR) AS customer, CAST(starts_with(o_orderpriority, '1') AS DOUBLE) AS urgent, o_orderpriority AS priority,
          nullif(count(*) FILTER (o_orderdate IS NULL OR year(o_orderdate) < 1995), 0) AS n_early,
          nullif(count(*) FILTER (year(o_orderdate) BETWEEN 1995 AND 1997), 0) AS n_middle,
          nullif(count(*) FILTER (year(o_orderdate) >= 1998), 0) AS n_late
        FROM orders GROUP BY o_custkey, o_orderpriority""",
    "zip_normalise": f"""
        SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS zip_raw, {_zip('c_custkey')} AS zip
        FROM customer""",
    "zip_lookup": f"""
        WITH g AS (SELECT {_zip('o_custkey')} AS zip, o_orderpriority AS State FROM orders),
        s AS (SELECT zip, min(State) AS State FROM g WHERE zip IS NOT NULL GROUP BY zip),
        c AS (SELECT c_custkey, {_zip('c_custkey')} AS zip FROM customer)
        SELECT c.c_custkey, c.zip, s.State FROM c LEFT JOIN s ON c.zip = s.zip""",
    "zip_lookup_parity": f"""
        WITH s AS (SELECT {_zip('o_custkey')} AS zip, o_orderpriority AS State FROM orders),
        c AS (SELECT c_custkey, {_zip('c_custkey')} AS zip FROM customer)
        SELECT c.c_custkey, c.zip, s.State FROM c LEFT JOIN s ON c.zip = s.zip""",
    "lookup_left": """
        SELECT c.c_custkey, c.c_nationkey, s.s_name FROM customer c
        LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey""",
    "flag_priority": _flag_sql(),
    "label_decode": f"""
        SELECT doc_id, {_case('quality', PARTIAL_LABELS['quality'])} AS quality,
               {_case('toxic', PARTIAL_LABELS['toxic'])} AS toxic FROM labels""",
    "label_decode_schema": f"""
        SELECT {_case('toxic', PARTIAL_LABELS['toxic'])} AS harmful, doc_id,
               {_case('quality', PARTIAL_LABELS['quality'])} AS rating FROM labels WHERE doc_id IS NOT NULL""",
    "question_texts_schema": f"""
        SELECT question, CAST(question_num AS INTEGER) AS question_num, 'What about ' || question || '?' AS question_text, n FROM (
          SELECT source AS question, count(*) AS n FROM documents WHERE text <> '' GROUP BY source)
        JOIN (VALUES {", ".join(f"({_lit(q)}, {i + 1})" for i, q in enumerate(SV_QUESTIONS))}) AS q(question, question_num) USING (question)""",
    "gazetteer_quarantine": """
        SELECT 'good' AS kind, CAST(c_custkey AS VARCHAR) AS zip, c_name AS PlaceName, c_mktsegment AS State, c_acctbal AS longitude,
               CAST(c_nationkey AS INTEGER) AS accuracy, 1::BIGINT AS n FROM customer WHERE c_custkey % 10 NOT IN (3, 5, 7)
        UNION ALL SELECT CASE c_custkey % 10 WHEN 3 THEN 'too_few_fields' WHEN 5 THEN 'too_many_fields' ELSE 'bad_value' END,
               NULL, NULL, NULL, NULL, NULL, count(*) FROM customer WHERE c_custkey % 10 IN (3, 5, 7) GROUP BY 1""",
    "prefix_projection": """
        SELECT c_custkey, c_name AS customer_name, c_nationkey, c_mktsegment FROM customer""",
    "restricted_enrich": """
        SELECT d.doc_id, d.source, l.quality, l.toxic
        FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "question_regex": f"""
        SELECT doc_id, source AS question FROM documents
        WHERE regexp_matches(source, {_lit(QUESTION_PATTERN)})""",
    "response_view": """
        SELECT doc_id, lang, n_chars, text AS response FROM documents
        WHERE source = 'src3' AND lang IN ('en', 'es') AND n_chars >= 100
          AND contains(lower(concat_ws(' ', doc_id, lang, n_chars, text)), 'the')
        ORDER BY n_chars DESC, doc_id ASC LIMIT 10 OFFSET 10""",
    "question_index": f"""
        WITH {_DOC_Q}
        SELECT panel, num, code, CAST(num AS VARCHAR) || ': ' || code AS index_line,
               'Question ' || CAST(num AS VARCHAR) AS title,
               panel || '_bigram_' || CAST(num AS VARCHAR) AS bigram_page,
               panel || '_responses_' || CAST(num AS VARCHAR) AS responses_page
        FROM dq""",
    "catalog_audit": _AUDIT,
    "nested_menu_audit": _NESTED_AUDIT,
    "published_page": f"""WITH {_BIGRAMS}
        SELECT 'Question {SV_QUESTIONS.index("src3") + 1}' AS title, word1, word2, n, NULL::BIGINT AS doc_id FROM edges WHERE question = 'src3'
        UNION ALL SELECT 'Question {SV_QUESTIONS.index("src3") + 1}', NULL, NULL, NULL, doc_id FROM documents WHERE source = 'src3'""",
    "bigram_sorted_counts": f"""WITH {_BIGRAMS} SELECT *, row_number() OVER (
        PARTITION BY question ORDER BY n DESC, word1, word2) AS place FROM counts""",
    "label_decode_double": f"""
        SELECT doc_id, {_case('quality + toxic / 2.0', SV_LABELS['quality'])} AS quality,
               {_case('toxic', SV_LABELS['toxic'])} AS toxic FROM labels""",
    "response_view_contains": """
        SELECT doc_id, lang, text AS response FROM documents
        WHERE source = 'src3' AND contains(lower(text), 'ing') AND lang IN ('en', 'de')""",
    "response_search_indexed": "SELECT doc_id, source AS question, text AS response FROM documents WHERE contains(lower(text), 'password')",
    "wave_full_join_keys": """
        WITH side AS (SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS segment, c_nationkey,
                             CAST(floor(c_custkey / 50.0) AS BIGINT) AS block FROM customer),
        a AS (SELECT segment, c_nationkey, count(*) AS left_rows, max(block) AS left_block
              FROM side WHERE c_nationkey < 15 GROUP BY segment, c_nationkey),
        b AS (SELECT segment, c_nationkey, block AS right_block FROM side WHERE c_nationkey >= 5)
        SELECT coalesce(a.segment, b.segment) AS segment, coalesce(a.c_nationkey, b.c_nationkey) AS c_nationkey,
               left_rows, left_block, right_block
        FROM a FULL JOIN b ON a.segment IS NOT DISTINCT FROM b.segment AND a.c_nationkey = b.c_nationkey""",
}
