"""The same queries as SQL over the driver's tables."""

from __future__ import annotations

from .catalog import AS_OF, CLIENTS, FILES, PRICES, QUERY_VECTOR
from .fixtures import with_views
from ..operators.generators import CITIES, INSURERS, NETWORK, PLANS, REASONS
from ..operators.scoring import PRODUCT_LABELS, UNSAFE_TERMS

SQL: dict[str, str] = {}


def add(name: str, sql: str, *views: str) -> None:
    SQL[name] = with_views(sql, *views)


def listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def tokens(column: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(lower({column}), '[^\\p{{L}}\\p{{N}}]+'), "
        "lambda x: x <> '')"
    )


def n_words(column: str) -> str:
    return f"len(list_filter(regexp_split_to_array({column}, '\\s+'), lambda x: x <> ''))"


SECONDS = "'%Y-%m-%d %H:%M:%S'"

# Sources and sinks

add("read_text_files", """
SELECT lang, source, count(*) AS n_documents, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM documents GROUP BY 1, 2""")

add("path_fields", """
SELECT path, regexp_extract(path, '([^/]+)[.]txt$', 1) AS file_id,
       CASE WHEN path LIKE 'kb/%' THEN split_part(path, '/', 2) END AS path_type,
       CASE WHEN path LIKE 'kb/%' THEN split_part(path, '/', 3) END AS path_category,
       CASE WHEN path LIKE 'tickets/%' THEN CAST(split_part(path, '/', 2) AS INT) END AS path_year,
       CASE WHEN path LIKE 'tickets/%' THEN CAST(split_part(path, '/', 3) AS INT) END AS path_month
FROM (SELECT path FROM article_files UNION ALL SELECT path FROM ticket_files)""",
    "article_files", "ticket_files")

add("parse_article", """
SELECT a.path, concat('KB-', d.doc_id) AS id,
       CASE d.doc_id % 4 WHEN 0 THEN 'FAQ' WHEN 1 THEN 'Policy' WHEN 2 THEN 'Guide'
            ELSE 'Procedure' END AS type,
       CASE d.doc_id % 3 WHEN 0 THEN 'Billing' WHEN 1 THEN 'Technical' ELSE 'Account' END
            AS category,
       concat('from ', d.source) AS subcategory,
       concat('About ', d.source, ': part ', d.doc_id) AS title,
       concat(d.lang, '|', d.source, '|help') AS tags,
       strftime(DATE '2021-05-01' + CAST(d.doc_id % 28 AS INT), '%Y-%m-%d 07:08:09')
            AS last_updated,
       '2022-02-03 04:05:06' AS generated, trim(d.text, ' ' || chr(10)) AS body
FROM article_files a JOIN documents d ON a.doc_id = d.doc_id""", "article_files")

add("parse_ticket", """
SELECT t.path, concat('TICK-', o.o_orderkey) AS ticket_id,
       concat('CUS-', o.o_custkey) AS customer_id,
       concat('SUB-', o.o_custkey + 1000) AS subscription_id, 'Billing' AS category,
       o.o_orderpriority AS priority,
       CASE o.o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Closed' ELSE 'Resolved' END
            AS status,
       strftime(o.o_orderdate, '%Y-%m-%d 20:47:57') AS created,
       concat('TEC-', o.o_orderkey % 97) AS agent_id,
       CASE WHEN o.o_orderstatus <> 'O'
            THEN strftime(o.o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d 20:47:57') END AS resolved,
       concat('Order ', o.o_orderkey, ' fails: ERR-', o.o_orderkey % 11) AS description,
       concat('Ticket TICK-', o.o_orderkey, ' was answered by TEC-', o.o_orderkey % 97)
            AS resolution
FROM ticket_files t JOIN orders o ON t.o_orderkey = o.o_orderkey""", "ticket_files")

add("read_csv", """
SELECT template AS description, target, CAST(example_id AS VARCHAR) AS example_id
FROM examples""", "examples")

BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|"
    "form|h1|h2|h3|h4|h5|h6|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|th|"
    "thead|tr|ul"
)
add("html_to_text", f"""
WITH shown AS (SELECT page_id, regexp_replace(regexp_replace(html,
       '(?is)<!--.*?-->|<head[ >].*?</head>|<script[ >].*?</script>|<style[ >].*?</style>',
       '', 'g'), '<[A-Za-z/!][^<>]*$', '') AS x FROM pages),
broken AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(x,
       '[ \\t\\n\\r\\f]+', ' ', 'g'), '(?i)</?({BLOCKS})( [^<>]*)?/?>', chr(10), 'g'),
       '<[^<>]*>', '', 'g') AS x FROM shown),
lines AS (SELECT page_id, trim(regexp_replace(regexp_replace(x, ' +', ' ', 'g'),
       ' *\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10)) AS x FROM broken)
SELECT page_id, regexp_replace(replace(replace(replace(x, '&middot;', '·'), '&copy;', '©'),
       '&quot;', '"'), '&amp;?', '&', 'g') AS text
FROM lines""")

add("write_table", """
SELECT city, status, count(*) AS n_visits, max(visit_id) AS last_visit
FROM visits WHERE status <> 'O' GROUP BY 1, 2""", "visits")

add("table_ddl", """
SELECT network_status, count(*) AS n_practices FROM practices GROUP BY 1""", "practices")

TRACES = """
SELECT trace_id, count(*) AS n_spans, count(*) FILTER (span_type = 'RETRIEVER') AS n_retriever,
       min(start_ns) AS start_ns, max(end_ns) AS end_ns,
       min(start_ns) FILTER (span_type = 'CHAT_MODEL') AS chat_start_ns,
       arg_min(end_ns, start_ns) FILTER (span_type = 'CHAT_MODEL') AS chat_end_ns
FROM spans GROUP BY 1"""
add("trace_source", TRACES, "spans")

add("stringify_complex", """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
       CASE WHEN event_type <> 'view' THEN
            concat('{"event_type":"', event_type, '","user_id":', user_id, '}') END AS tags,
       CASE WHEN event_type <> 'view' THEN concat('[', event_id, ',', user_id, ']') END AS spans
FROM events""")

add("to_json_text", """
SELECT o_orderkey, concat('{"o_orderkey":', o_orderkey, ',"o_orderstatus":"', o_orderstatus,
       '","o_orderpriority":"', o_orderpriority, '"}') AS as_json,
       CAST(o_orderkey AS VARCHAR) AS as_text
FROM orders""")

add("preview", "SELECT visit_id, patient, city FROM visits ORDER BY visit_id LIMIT 10", "visits")

add("table_snapshot_changes", """
SELECT coalesce(o.doc_id, n.doc_id) AS doc_id,
       CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete'
            ELSE 'update' END AS change
FROM snapshot_old o FULL JOIN snapshot_new n ON o.doc_id = n.doc_id
WHERE o.text IS DISTINCT FROM n.text""", "snapshot_old", "snapshot_new")

add("delete_detect", """
SELECT doc_id FROM snapshot_old WHERE doc_id NOT IN (SELECT doc_id FROM snapshot_new)""",
    "snapshot_old", "snapshot_new")

# Projections and filters

add("project_rename_drop", """
SELECT req_no AS request_id, source_id, event_id, answer_rating, position, chunk_rating,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS day
FROM assessment_log""", "assessment_log")

add("filter_not_null", """
SELECT event_id, req_no AS request_id FROM assessment_log WHERE answer_rating IS NOT NULL""",
    "assessment_log")

add("blank_to_null", """
SELECT event_id, CASE WHEN suggested_output = '' THEN NULL ELSE suggested_output END
       AS suggested_output
FROM assessment_log""", "assessment_log")

add("nested_field", """
SELECT event_id, source_id, answer_rating AS answer, position FROM assessment_log""",
    "assessment_log")

# The feedback pipeline, stage by stage.
LATEST_TEXT = """
latest_text AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY req_no, source_id ORDER BY ts DESC, event_id DESC)
           AS rn FROM assessment_log WHERE answer_rating IS NOT NULL) WHERE rn = 1)"""
LATEST_CHUNK = """
latest_chunk AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY req_no, source_id, step_id, position
                                 ORDER BY ts DESC, event_id DESC)
           AS rn FROM assessment_log WHERE position IS NOT NULL) WHERE rn = 1)"""
NESTED = """
nested AS (SELECT req_no, source_id, step_id, max(ts) AS ts,
                  string_agg(chunk_rating, '|' ORDER BY position) AS ratings,
                  string_agg(concat(position, '=', chunk_rating), '|' ORDER BY position)
                      AS chunk_ratings
           FROM latest_chunk GROUP BY 1, 2, 3)"""
MERGED = """
merged AS (SELECT coalesce(a.req_no, b.req_no) AS request_id,
                  coalesce(a.source_id, b.source_id) AS source_id,
                  coalesce(a.step_id, b.step_id) AS step_id, coalesce(a.ts, b.ts) AS ts,
                  a.answer_rating AS is_correct, a.suggested_output, b.ratings, b.chunk_ratings
           FROM latest_text a FULL JOIN nested b
             ON a.req_no = b.req_no AND a.source_id = b.source_id)"""
RATED = """
rated AS (SELECT r.req_no AS request_id, r.request, r.response, m.is_correct,
                 nullif(m.suggested_output, '') AS suggested_output, m.source_id AS source_user,
                 m.ratings
          FROM request_log r LEFT JOIN merged m ON r.req_no = m.request_id),
tagged AS (SELECT *,
           CASE is_correct WHEN 'positive' THEN 'thumbs_up'
                WHEN 'negative' THEN 'thumbs_down_edited' ELSE 'no_feedback_provided' END
                AS source_tag,
           CASE WHEN is_correct = 'positive' THEN coalesce(suggested_output, response)
                WHEN is_correct = 'negative' THEN suggested_output END AS expected_response
           FROM rated)"""
KEPT = """
marks AS (SELECT request_id, source_user, i - 1 AS position,
                 list_extract(string_split(ratings, '|'), i) AS mark
          FROM (SELECT request_id, source_user, ratings,
                       unnest(range(1, len(string_split(ratings, '|')) + 1)) AS i
                FROM rated WHERE ratings IS NOT NULL)),
kept AS (SELECT m.request_id, m.source_user,
                string_agg(concat(c.doc_uri, '=', c.content), chr(10) ORDER BY c.position) AS kept
         FROM marks m JOIN trace_chunks c
           ON c.req_no = m.request_id AND c.position = m.position AND m.mark = 'true'
         GROUP BY 1, 2)"""
FEEDBACK = ",".join([LATEST_TEXT, LATEST_CHUNK, NESTED, MERGED])
LOGS = ("assessment_log",)
ALL_LOGS = ("assessment_log", "request_log", "trace_chunks")

add("attach_ground_truth", f"""WITH {FEEDBACK}, {RATED}
SELECT request_id, request, is_correct, suggested_output, source_user FROM rated""", *ALL_LOGS)
TAGGED = f"""WITH {FEEDBACK}, {RATED}
SELECT request_id, source_user, source_tag, expected_response FROM tagged"""
add("feedback_partition", TAGGED, *ALL_LOGS)
add("union_feedback", TAGGED, *ALL_LOGS)

add("enum_check", """
SELECT doc_id, lang, coalesce(lang IN ('en', 'fr', 'de'), false) AS valid FROM documents""")

PAIRS = ", ".join(f"('{f}', '{c}')" for f, c in zip(FILES, CLIENTS))
add("client_enrich", f"""
SELECT d.doc_id, d.source, p.client
FROM documents d LEFT JOIN (VALUES {PAIRS}) p(file, client) ON d.source = p.file""")

add("city_insurer_filter", """
SELECT visit_id, patient, city, insurer FROM visits
WHERE city = 'CITY_0' AND insurer = 'BUILDING'""", "visits")

add("range_filter", """
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 6500 AND c_acctbal < 9000""")

TOXIC = f"""
train AS (
    SELECT doc_id, toxic FROM labels WHERE ('0x' || left(md5(concat(doc_id, '-1')), 7))::INT % 2 = 0),
seen AS (
    SELECT term, count(*) FILTER (toxic = 1) AS a, count(*) FILTER (toxic = 0) AS b
    FROM (SELECT DISTINCT doc_id, toxic, unnest({tokens('text')}) AS term
          FROM train JOIN documents USING (doc_id))
    GROUP BY term),
cells AS (
    SELECT term, a::DOUBLE AS a, b::DOUBLE AS b, (fl - a)::DOUBLE AS c, (n - fl - b)::DOUBLE AS d, n, fl
    FROM seen, (SELECT count(*) AS n, coalesce(sum(toxic), 0) AS fl
                FROM train JOIN documents USING (doc_id))),
learned AS (
    SELECT term, ln((a + 0.5) / (c + 0.5)) - ln((b + 0.5) / (d + 0.5)) AS odds,
           round(2 * (CASE WHEN a > 0 THEN a * ln(a * n / (fl * (a + b))) ELSE 0 END
                      + CASE WHEN b > 0 THEN b * ln(b * n / ((n - fl) * (a + b))) ELSE 0 END
                      + CASE WHEN c > 0 THEN c * ln(c * n / (fl * (c + d))) ELSE 0 END
                      + CASE WHEN d > 0 THEN d * ln(d * n / ((n - fl) * (c + d))) ELSE 0 END), 6)
               AS evidence
    FROM cells WHERE a * (n - fl) > b * fl
    QUALIFY evidence >= 20 AND row_number() OVER (ORDER BY evidence DESC, term) <= 1000),
rest AS (SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM train))"""
add("note_severity", f"""WITH {TOXIC}
SELECT doc_id, CAST(sum(round(odds * 10)) AS BIGINT) AS severity
FROM (SELECT doc_id, unnest({tokens('text')}) AS term FROM rest) JOIN learned USING (term)
GROUP BY doc_id HAVING sum(round(odds * 10)) > 0
ORDER BY severity DESC, doc_id LIMIT 25""")

add("recency_filter", f"""
SELECT 'last_30_days' AS kind, patient FROM visits
WHERE visit_date > DATE '{AS_OF}' - INTERVAL 30 DAY AND visit_date <= DATE '{AS_OF}'
UNION ALL
SELECT 'next_7_days', patient FROM visits
WHERE visit_date > DATE '{AS_OF}' AND visit_date <= DATE '{AS_OF}' + INTERVAL 7 DAY
UNION ALL
SELECT 'overdue', c_name FROM customer WHERE c_name NOT IN (
    SELECT patient FROM visits WHERE visit_date > DATE '{AS_OF}' - INTERVAL 6 MONTH
                                 AND visit_date <= DATE '{AS_OF}')""", "visits")

# Joins

FLAT = f"""WITH {FEEDBACK}
SELECT request_id, source_id, step_id, CAST(ts AS VARCHAR) AS ts, is_correct, suggested_output,
       chunk_ratings FROM merged"""
add("merge_assessments", FLAT, *LOGS)
add("dedup_assessment_log", FLAT, *LOGS)

add("feature_lookup", """
SELECT o.o_orderkey, CASE WHEN o.o_orderstatus = 'O' THEN 'N' ELSE 'R' END AS flag, f.quantity
FROM orders o LEFT JOIN (
    SELECT l_orderkey, l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem GROUP BY 1, 2) f
  ON o.o_orderkey = f.l_orderkey
 AND f.l_returnflag = CASE WHEN o.o_orderstatus = 'O' THEN 'N' ELSE 'R' END""")

add("label_coverage", """
WITH r AS (SELECT doc_id, concat(lang, '-', length(source)) AS label FROM documents),
train AS (SELECT label FROM r WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))
SELECT doc_id, label, label IN (SELECT label FROM train) AS covered FROM r""")

add("variant_grid", """
SELECT e.example_id, e.target, v.variant
FROM examples e CROSS JOIN (VALUES ('small'), ('tuned'), ('large')) v(variant)""", "examples")

LATEST_QUOTE = """
latest AS (SELECT upper(symbol) AS symbol, round(close, 2) AS price,
                  round(prev, 2) AS previous_close, round(day_high, 2) AS day_high,
                  round(day_low, 2) AS day_low, volume
           FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY day) AS prev,
                        row_number() OVER (PARTITION BY symbol ORDER BY day DESC) AS rn
                 FROM quotes) WHERE rn = 1)"""
add("company_profile", f"""WITH {LATEST_QUOTE},
about AS (SELECT upper(replace(source, 'src', 's')) AS symbol,
                 min(concat('Company ', source)) AS company_name, count(*) AS n_articles
          FROM documents GROUP BY 1),
longest AS (SELECT upper(replace(source, 'src', 's')) AS symbol, doc_id,
                   row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id DESC) AS rn
            FROM documents)
SELECT l.symbol, a.company_name,
       printf('close %.2f, high %.2f, low %.2f, volume %d', l.price, l.day_high, l.day_low,
              l.volume) AS stock_summary,
       printf('%d articles, longest is %d', coalesce(a.n_articles, 0), g.doc_id) AS article_summary
FROM latest l LEFT JOIN about a ON l.symbol = a.symbol
LEFT JOIN longest g ON l.symbol = g.symbol AND g.rn = 1""", "quotes")

add("visit_practice_join", """
SELECT v.visit_id, v.patient, p.practice_name, p.network_status,
       p.city = v.city AS same_city, p.insurer = v.insurer AS same_insurer,
       (SELECT count(*) FROM practices q WHERE q.city = v.city AND q.insurer = v.insurer
                                         AND q.network_status = 'In Network') AS n_in_network
FROM visits v LEFT JOIN practices p ON v.practice_id = p.practice_id""", "visits", "practices")

# Aggregates and windows

add("latest_text_assessment", f"""WITH {LATEST_TEXT}
SELECT req_no AS request_id, source_id, event_id FROM latest_text""", *LOGS)
add("latest_retrieval_assessment", f"""WITH {LATEST_CHUNK}
SELECT req_no AS request_id, source_id, position, event_id FROM latest_chunk""", *LOGS)
add("nest_retrieval", f"""WITH {LATEST_CHUNK}, {NESTED}
SELECT req_no AS request_id, source_id, step_id, CAST(ts AS VARCHAR) AS ts, ratings
FROM nested""", *LOGS)

CORRECT = "CASE WHEN coalesce(verdict = 'YES', target = prediction) THEN 1 ELSE 0 END"
add("mean_score", f"""
SELECT target, round(avg({CORRECT}), 6) AS mean_score FROM examples GROUP BY 1""", "examples")

add("distinct_labels", """
SELECT concat(quality, '-', toxic) AS label, count(*) AS n_rows FROM labels GROUP BY 1""")

add("visits_per_patient", """
SELECT patient, count(*) AS n_visits,
       array_to_string(list_sort(list(DISTINCT reason)), '|') AS reasons
FROM visits GROUP BY 1""", "visits")

add("mode_per_key", """
SELECT patient, city FROM (
    SELECT patient, city, row_number() OVER (PARTITION BY patient ORDER BY count(*) DESC, city)
           AS rn FROM visits GROUP BY 1, 2) WHERE rn = 1""", "visits")

add("missed_more_than", f"""
SELECT patient, count(*) AS n_rows FROM visits
WHERE visit_date > DATE '1997-06-30' AND visit_date <= DATE '{AS_OF}' AND status = 'F'
GROUP BY 1 HAVING count(*) > 2""", "visits")

add("attribute_per_key", """
SELECT patient, min(insurer) AS insurer, count(DISTINCT insurer) > 1 AS many_insurer,
       min(city) AS city, count(DISTINCT city) > 1 AS many_city
FROM visits GROUP BY 1""", "visits")

add("latest_note", """
SELECT patient, reason, CAST(visit_date AS VARCHAR) AS visit_date FROM (
    SELECT *, row_number() OVER (PARTITION BY patient ORDER BY visit_date DESC, visit_id DESC)
           AS rn FROM visits) WHERE rn = 1""", "visits")

add("latest_per_key", f"WITH {LATEST_QUOTE} SELECT * FROM latest", "quotes")

add("latest_version", """
SELECT p_name AS name, greatest(coalesce(max(CASE WHEN p_size % 5 <> 0 THEN p_size END), 1), 1)
       AS latest_version
FROM part GROUP BY 1""")

SAMPLE = """
ranked AS (SELECT doc_id, concat(quality, '-', toxic) AS label,
                  row_number() OVER (PARTITION BY quality, toxic
                      ORDER BY md5(concat(doc_id, '-1')), doc_id) AS sample_rank
           FROM labels)"""
add("stratified_sample", f"""WITH {SAMPLE}
SELECT doc_id, label, sample_rank, count(*) OVER (PARTITION BY label) AS label_rows
FROM ranked WHERE sample_rank <= 20""")
add("train_test_split", f"""WITH {SAMPLE}
SELECT doc_id, label, sample_rank, CASE WHEN sample_rank <= 3 THEN 'train' ELSE 'test' END AS split
FROM ranked WHERE sample_rank <= 13""")

add("full_history", """
SELECT conv_id, last AS turn, coalesce(string_agg(concat_ws(':', turn, role, text), '|' ORDER BY turn)
       FILTER (turn < last), '') AS history
FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations) GROUP BY 1, 2""")

add("rows_to_df", """
SELECT segment, team, count(*) AS n_customers, CAST(sum(round(c_acctbal * 100)) AS BIGINT) AS cents
FROM customer JOIN (VALUES ('AUTOMOBILE', 'north'), ('BUILDING', 'south'), ('MACHINERY', NULL))
     teams(segment, team) ON c_mktsegment = segment
GROUP BY 1, 2""")

add("sql_functions", f"""
SELECT doc_id, CAST({n_words('text')} AS INTEGER) AS n_words,
       concat(left(concat(source, '_', lang), 4), lpad(CAST(length(source) + 1 + length(lang) AS VARCHAR), 3, '0'))
           AS prefix
FROM documents""")

add("pct_drop", """
SELECT symbol, CAST(day AS VARCHAR) AS day, close, previous_close,
       round((close - previous_close) / previous_close * 100, 6) AS change_pct
FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY day) AS previous_close FROM quotes)
WHERE previous_close > 0 AND (close - previous_close) / previous_close * 100 < -5""", "quotes")

add("conversation_history", """
SELECT conv_id, turn, turn // 64 AS page,
       coalesce(string_agg(concat(turn, ':', role, ':', text), '|') OVER (
           PARTITION BY conv_id, turn // 64 ORDER BY turn
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS page_history,
       lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS last_message
FROM conversations""")
add("history_pages", """
SELECT conv_id, turn // 4 AS page,
       string_agg(concat(turn, ':', text), '|' ORDER BY turn) AS turns
FROM conversations GROUP BY 1, 2""")

add("top_k_global", """
SELECT patient, count(*) AS n_visits FROM visits GROUP BY 1
ORDER BY n_visits DESC, patient LIMIT 10""", "visits")

add("rank_variants", """
WITH s AS (
    SELECT 'small' AS variant, CASE WHEN target = prediction THEN 1 ELSE 0 END AS score FROM examples
    UNION ALL
    SELECT 'tuned', CASE WHEN verdict = 'YES' THEN 1 ELSE 0 END FROM examples
    UNION ALL
    SELECT 'large', CASE WHEN tool_rating <> 'Low' THEN 1 ELSE 0 END FROM examples),
m AS (SELECT variant, avg(score) AS m FROM s GROUP BY 1)
SELECT variant, round(m, 6) AS mean_score,
       rank() OVER (ORDER BY round(m, 6) DESC) AS rank,
       round((m - (SELECT m FROM m WHERE variant = 'small')) * 100, 6) AS gain_points
FROM m""", "examples")

# Scalars

add("word_count", f"SELECT doc_id, {n_words('text')} AS n_words FROM documents")

add("render_template", """
SELECT doc_id, concat('Document ', doc_id, ' from ', source, ':', chr(10), text, chr(10),
                      'Which language is it?') AS prompt
FROM documents""")

add("row_to_sentence", """
SELECT p_partkey, concat('If you need a ', p_type, ', for ', p_name, ' you will pay $',
       CAST(floor(p_retailprice) AS BIGINT), ' In Network and ', p_size,
       '% coinsurance Out of Network.') AS sentence
FROM part""")

add("name_parts", """
SELECT doc_id, 'main' AS catalog, lang AS schema, concat('tbl_', source) AS table_name,
       concat('tbl-', source, '-endpoint') AS endpoint,
       concat('main.', lang, '.tbl_', source, '_index') AS index_name
FROM documents""")

add("user_prefix", """
SELECT c_custkey, replace(lower(c_name), '#', '_') AS user_name,
       concat(substr(replace(lower(c_name), '#', '_'), 1, 4),
              lpad(CAST(length(c_name) AS VARCHAR), 3, '0')) AS prefix
FROM customer""")

add("upper_round", """
SELECT p_partkey, upper(p_name) AS name, round(p_retailprice / 7, 2) AS price FROM part""")

add("ns_to_seconds", """
SELECT span_id, round((end_ns - start_ns) / 1e9, 6) AS seconds FROM spans""", "spans")

add("zone_shift", f"""
SELECT event_id, strftime(timezone('US/Eastern', timezone('UTC', ts)), {SECONDS}) AS local_time
FROM events""")

add("transform_ratings", f"""WITH {FEEDBACK}
SELECT request_id, source_id, ratings FROM merged""", *LOGS)

add("zip_filter", f"""WITH {FEEDBACK}, {RATED}, {KEPT}
SELECT r.request_id, r.source_user, k.kept
FROM rated r LEFT JOIN kept k ON r.request_id = k.request_id AND r.source_user = k.source_user""",
    *ALL_LOGS)

add("json_extract_context", """
SELECT r.req_no AS request_id,
       string_agg(concat(c.doc_uri, '=', c.content), chr(10) ORDER BY c.position)
           FILTER (c.doc_uri IS NOT NULL) AS chunks
FROM request_log r LEFT JOIN trace_chunks c ON r.req_no = c.req_no GROUP BY 1""",
    "request_log", "trace_chunks")

add("decode_base64", """
SELECT doc_id, strlen(text) AS n_bytes, text AS decoded FROM documents""")

add("extract_emails", """
SELECT doc_id, split_part(email, '@', 1) AS name, email
FROM (SELECT doc_id, unnest(regexp_extract_all(text,
        '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')) AS email FROM documents)""")

add("extract_codes", """
SELECT code, count(*) AS n_uses
FROM (SELECT unnest(regexp_extract_all(text, '\\b[A-Z]{2,5}-[0-9]+\\b')) AS code
      FROM ticket_files) GROUP BY 1""", "ticket_files")

add("extract_keywords", f"""
WITH t AS (SELECT doc_id, unnest({tokens('text')}) AS term FROM documents),
c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
f AS (SELECT term, count(*) AS df FROM c GROUP BY 1),
w AS (SELECT c.doc_id, c.term, round(c.tf * ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE)
                                              / (f.df + 1.0::DOUBLE)), 6) AS weight
      FROM c JOIN f ON c.term = f.term)
SELECT doc_id, term, weight, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) AS rank FROM w)
WHERE rank <= 5""")

# Chunks, vectors, retrieval

WINDOWS = """
SELECT {key}, CAST(i AS INT) AS chunk_index, substring(text, i * 550 + 1, 600) AS content
FROM (SELECT {key}, text, unnest(range(0, CAST(greatest(ceil((length(text) - 50) / 550.0), 1)
             AS BIGINT))) AS i FROM {table})"""
CHUNKS = WINDOWS.format(key="doc_id", table="documents")
add("window_chunk", CHUNKS)
add("chunk_index", f"SELECT doc_id, chunk_index FROM ({CHUNKS})")
add("chunk_ids", f"""
SELECT doc_id, chunk_index, concat(doc_id, '_Chunk_', chunk_index) AS chunk_id FROM ({CHUNKS})""")
add("union_documents", f"""
SELECT concat('doc_', doc_id) AS document_name, chunk_index, content FROM ({CHUNKS})
UNION ALL
SELECT concat('item_', item_id), chunk_index, content
FROM ({WINDOWS.format(key='item_id', table='benchmark')})""")
# Nodes are texts to split, each at the coarsest separator it has; parts that stay too long are the
# nodes below. Neighbouring short parts make a run, and runs are packed chunk by chunk.
add("recursive_chunk", """
WITH RECURSIVE nodes AS (
    SELECT doc_id, []::BIGINT[] AS path, text, 1 AS sep FROM documents WHERE text <> ''
    UNION ALL
    SELECT doc_id, list_append(path, pos), part, at_sep + 1
    FROM (SELECT doc_id, path, at_sep, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS pos
          FROM (SELECT doc_id, path, at_sep, CASE WHEN split[1] = '' THEN split[2:] ELSE split END AS parts
                FROM (SELECT doc_id, path, at_sep, list_transform(string_split(text, s),
                             lambda x, i: CASE WHEN i = 1 THEN x ELSE s || x END) AS split
                      FROM (SELECT *, CASE WHEN sep <= 1 AND contains(text, chr(10) || chr(10)) THEN 1
                                           WHEN sep <= 2 AND contains(text, chr(10)) THEN 2
                                           WHEN sep <= 3 AND contains(text, ' ') THEN 3 ELSE 4 END AS at_sep,
                                   CASE at_sep WHEN 1 THEN chr(10) || chr(10) WHEN 2 THEN chr(10) ELSE ' ' END AS s
                            FROM nodes) WHERE at_sep < 4)))
    WHERE length(part) >= 600),
split AS (
    SELECT *, CASE WHEN sep <= 1 AND contains(text, chr(10) || chr(10)) THEN 1
                   WHEN sep <= 2 AND contains(text, chr(10)) THEN 2
                   WHEN sep <= 3 AND contains(text, ' ') THEN 3 ELSE 4 END AS at_sep,
           CASE at_sep WHEN 1 THEN chr(10) || chr(10) WHEN 2 THEN chr(10) ELSE ' ' END AS s
    FROM nodes),
cut AS (
    SELECT doc_id, path, at_sep, CASE WHEN at_sep = 4 THEN string_split(text, '')
           ELSE list_filter(list_transform(string_split(text, s),
                    lambda x, i: CASE WHEN i = 1 THEN x ELSE s || x END), lambda x: x <> '') END AS parts
    FROM split),
parts AS (
    SELECT doc_id, path, at_sep, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS pos FROM cut),
marked AS (
    SELECT *, at_sep < 4 AND length(part) >= 600 AS too_long,
           count(*) FILTER (at_sep < 4 AND length(part) >= 600) OVER (PARTITION BY doc_id, path ORDER BY pos) AS run
    FROM parts),
runs AS (
    SELECT doc_id, list_append(path, min(pos)) AS path, list(part ORDER BY pos) AS parts,
           list(upto ORDER BY pos) AS upto
    FROM (SELECT *, CAST(sum(length(part)) OVER (PARTITION BY doc_id, path, run ORDER BY pos) AS BIGINT) AS upto
          FROM marked WHERE NOT too_long)
    GROUP BY doc_id, path, run),
ends AS (
    SELECT doc_id, path, parts, upto, 1::BIGINT AS low,
           coalesce(list_position(list_transform(upto, lambda u: u > 600), true), len(upto) + 1)::BIGINT AS high
    FROM runs),
chunks AS (
    SELECT doc_id, path, parts, upto, low, high FROM ends
    UNION ALL
    SELECT doc_id, path, parts, upto, low, coalesce(list_position(
               list_transform(upto, lambda u, i: i > low AND u - (CASE WHEN low > 1 THEN upto[low - 1] ELSE 0 END) > 600), true),
               len(upto) + 1)::BIGINT
    FROM (SELECT doc_id, path, parts, upto, list_position(list_transform(upto, lambda u, i: i >= c.low AND (i = c.high OR (
                     upto[c.high - 1] - (CASE WHEN i > 1 THEN upto[i - 1] ELSE 0 END) <= 50
                     AND upto[c.high] - (CASE WHEN i > 1 THEN upto[i - 1] ELSE 0 END) <= 600))), true)::BIGINT AS low
          FROM chunks c WHERE high <= len(upto))),
stripped AS (
    SELECT doc_id, list_append(path, low) AS path, regexp_replace(regexp_replace(
        list_aggregate(parts[low:high - 1], 'string_agg', ''), '^[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}]+', ''),
        '[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}]+$', '') AS content
    FROM chunks)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY path) - 1 AS INTEGER) AS chunk_index, content
FROM stripped WHERE content <> ''""")
# Blocks as in html_to_text, the level of a heading behind a mark. Lists are packed one start after the other:
# blocks of 600 characters or more into pieces of 599 (a word that long by its characters), then lines into bodies.
SPACE = "[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}]+"


def packed_text(by: str) -> str:
    """The parts of one pack joined, white space at the ends stripped."""
    joined = f"list_aggregate({by}, 'string_agg', '')"
    return f"regexp_replace(regexp_replace({joined}, '^{SPACE}', ''), '{SPACE}$', '')"


LEVELS = range(1, 7)
PACKED = """
    SELECT {by}, parts, upto, run, 1::BIGINT AS low, list_position(list_transform(upto, lambda u, i:
               i > len(upto) - 1 OR upto[i + 1] > {most} OR run[i + 1] <> run[1]), true)::BIGINT AS high
    FROM {lists}
    UNION ALL
    SELECT {by}, parts, upto, run, c.high + 1, list_position(list_transform(upto, lambda u, i:
               i > c.high AND (i > len(upto) - 1 OR upto[i + 1] - upto[c.high] > {most}
                               OR run[i + 1] <> run[c.high + 1])), true)::BIGINT
    FROM {name} c WHERE c.high < len(upto)"""
add("structural_chunk", f"""WITH RECURSIVE
shown AS (SELECT page_id, regexp_replace(regexp_replace(html,
       '(?is)<!--.*?-->|<head[ >].*?</head>|<script[ >].*?</script>|<style[ >].*?</style>',
       '', 'g'), '<[A-Za-z/!][^<>]*$', '') AS x FROM pages),
broken AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(x,
       '[ \\t\\n\\r\\f]+', ' ', 'g'), '(?i)<h([1-6])( [^<>]*)?/?>', chr(10) || chr(2) || '\\1', 'g'),
       '(?i)</?({BLOCKS})( [^<>]*)?/?>', chr(10), 'g'), '<[^<>]*>', '', 'g') AS x FROM shown),
raw AS (SELECT page_id, unnest(string_split(x, chr(10))) AS line,
               unnest(range(1, len(string_split(x, chr(10))) + 1)) AS pos FROM broken),
blocks AS (
    SELECT page_id, pos, CASE WHEN starts_with(line, chr(2)) THEN CAST(line[2] AS INT) ELSE 0 END AS level,
           trim(regexp_replace(regexp_replace(replace(replace(replace(
               CASE WHEN starts_with(line, chr(2)) THEN line[3:] ELSE line END,
               '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;?', '&', 'g'), ' +', ' ', 'g'), ' ') AS text
    FROM raw),
seen AS (
    SELECT *, count(*) FILTER (level > 0) OVER w AS section,
           {", ".join(f"coalesce(max(pos) FILTER (level = {i}) OVER w, 0) AS p{i}" for i in LEVELS)},
           {", ".join(f"last_value(CASE WHEN level = {i} THEN text END IGNORE NULLS) OVER w AS t{i}" for i in LEVELS)}
    FROM blocks WHERE text <> '' WINDOW w AS (PARTITION BY page_id ORDER BY pos)),
bodies AS (
    SELECT page_id, section, pos, text, concat_ws(chr(10),
           {", ".join(f"CASE WHEN p{i} > greatest(0, {', '.join(f'p{j}' for j in range(1, i)) or 0}) THEN t{i} END" for i in LEVELS)}
           ) AS heading
    FROM seen WHERE level = 0),
word AS (
    SELECT page_id, pos, unnest(words) AS part, unnest(range(1, len(words) + 1)) AS place
    FROM (SELECT page_id, pos, list_transform(string_split(text, ' '),
                 lambda x, i: CASE WHEN i = 1 THEN x ELSE ' ' || x END) AS words
          FROM bodies WHERE length(text) >= 600)),
unit AS (
    SELECT page_id, pos, place, unnest(letters) AS part, unnest(range(1, len(letters) + 1)) AS letter,
           2 * count(*) FILTER (length(part) >= 599) OVER (PARTITION BY page_id, pos ORDER BY place)
               - CASE WHEN length(part) >= 599 THEN 1 ELSE 0 END AS run
    FROM (SELECT *, CASE WHEN length(part) >= 599 THEN string_split(part, '') ELSE [part] END AS letters
          FROM word)),
units AS (
    SELECT page_id, pos, list(part ORDER BY place, letter) AS parts, list(run ORDER BY place, letter) AS run,
           list(CAST(upto AS BIGINT) ORDER BY place, letter) AS upto
    FROM (SELECT *, sum(length(part)) OVER (PARTITION BY page_id, pos ORDER BY place, letter) AS upto FROM unit)
    GROUP BY page_id, pos),
pieces AS ({PACKED.format(by="page_id, pos", most=599, lists="units", name="pieces")}),
line AS (
    SELECT page_id, pos, low, {packed_text("parts[low:high]")} AS line FROM pieces
    UNION ALL SELECT page_id, pos, 1, text FROM bodies WHERE length(text) < 600),
lines AS (
    SELECT page_id, section, heading, list(line || chr(10) ORDER BY pos, low) AS parts,
           list(0::BIGINT) AS run, list(CAST(upto AS BIGINT) ORDER BY pos, low) AS upto
    FROM (SELECT *, sum(length(line) + 1) OVER (PARTITION BY page_id, section ORDER BY pos, low) AS upto
          FROM line JOIN bodies USING (page_id, pos) WHERE line <> '')
    GROUP BY page_id, section, heading),
chunks AS ({PACKED.format(by="page_id, section, heading", most=600, lists="lines", name="chunks")})
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY section, low) - 1 AS INTEGER) AS chunk_index,
       heading, concat_ws(chr(10), nullif(heading, ''),
           {packed_text("parts[low:high]")}) AS content
FROM chunks""")
add("synthetic_questions", f"""
SELECT doc_id, chunk_index, concat('What does this passage say? ', content) AS question
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id
                ORDER BY md5(concat(doc_id, '-', chunk_index, '-1')), chunk_index) AS rn
      FROM ({CHUNKS})) WHERE rn = 1""")

VECTOR = f"list_value({', '.join(map(str, QUERY_VECTOR))})::DOUBLE[]"
SCORED = f"round(list_cosine_similarity(embedding::DOUBLE[], {VECTOR}), 6)"
add("vector_top_k", f"""
SELECT vec_id, label, {SCORED} AS score, row_number() OVER (ORDER BY {SCORED} DESC, vec_id) AS rank
FROM embeddings QUALIFY rank <= 10""")
add("filtered_top_k", f"""
SELECT vec_id, {SCORED} AS score, row_number() OVER (ORDER BY {SCORED} DESC, vec_id) AS rank
FROM embeddings WHERE label = 3 QUALIFY rank <= 3""")
NEAR = """
near AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (
        SELECT a.vec_id AS query_id, b.vec_id AS id,
               round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6)
                   AS score
        FROM embeddings a CROSS JOIN embeddings b)) WHERE rank <= {k})"""
add("knn_join", f"WITH {NEAR.format(k=3)} SELECT query_id, id, score, rank FROM near")
add("top_k_per_query", f"WITH {NEAR.format(k=1)} SELECT query_id, id, score, rank FROM near")
add("retrieve_context", f"""WITH {NEAR.format(k=3)}
SELECT n.query_id, count(*) AS n_passages,
       string_agg(d.text, chr(10) || chr(10) ORDER BY n.rank) AS context
FROM near n JOIN documents d ON d.doc_id = n.id GROUP BY 1""")
add("index_sync", """
SELECT n.doc_id AS id, sha256(n.text) AS text_hash,
       CASE WHEN o.text IS DISTINCT FROM n.text THEN 2 ELSE 1 END AS version
FROM snapshot_new n LEFT JOIN snapshot_old o ON n.doc_id = o.doc_id""",
    "snapshot_old", "snapshot_new")

EMBEDDED = f"""
signed AS (
    SELECT 'd' AS kind, doc_id AS id, md5(unnest({tokens('text')})) AS h FROM documents
    UNION ALL SELECT 'q', item_id, md5(unnest({tokens('text')})) FROM benchmark),
slotted AS (
    SELECT kind, id, CAST(('0x' || left(h, 7))::INT % 256 AS INT) AS slot,
           sum(CASE WHEN substr(h, 8, 1) < '8' THEN 1 ELSE -1 END) AS c
    FROM signed GROUP BY ALL),
idf AS (
    SELECT slot, ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (count(*) + 1.0::DOUBLE)) AS w
    FROM slotted WHERE kind = 'd' GROUP BY slot),
weighed AS (SELECT kind, id, slot, c * w AS x FROM slotted JOIN idf USING (slot)),
unit AS (
    SELECT kind, id, slot, CAST(x / sqrt(n) AS FLOAT) AS x
    FROM weighed JOIN (SELECT kind, id, sum(x * x) AS n FROM weighed GROUP BY ALL) USING (kind, id)
    WHERE n > 0)"""
add("embed_text", f"""WITH {EMBEDDED}
SELECT id AS doc_id, slot, CAST(round(x::DOUBLE * 1000000) AS BIGINT) AS millionths
FROM unit WHERE kind = 'd' AND round(x::DOUBLE * 1000000) <> 0""")
add("lookup_then_retrieve", f"""WITH {EMBEDDED},
lengths AS (SELECT kind, id, sqrt(sum(x::DOUBLE * x::DOUBLE)) AS n FROM unit GROUP BY ALL),
dots AS (
    SELECT q.id AS item_id, d.id AS doc_id, sum(q.x::DOUBLE * d.x::DOUBLE) AS dot
    FROM unit q JOIN unit d ON q.slot = d.slot AND q.kind = 'q' AND d.kind = 'd' GROUP BY ALL),
scored AS (
    SELECT item_id, doc_id, round(dot / a.n / b.n, 6) AS score
    FROM dots JOIN lengths a ON a.kind = 'q' AND a.id = item_id
    JOIN lengths b ON b.kind = 'd' AND b.id = doc_id),
near AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scored QUALIFY rank <= 3),
context AS (
    SELECT item_id, count(*) AS n_passages, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context
    FROM near JOIN documents USING (doc_id) GROUP BY 1),
t AS (SELECT item_id, unnest({tokens('text')}) AS term FROM benchmark),
c AS (SELECT item_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
f AS (SELECT term, count(*) AS df FROM c GROUP BY 1),
w AS (SELECT c.item_id, c.term, round(c.tf * ln(((SELECT count(*) FROM benchmark) + 1.0::DOUBLE)
                                               / (f.df + 1.0::DOUBLE)), 6) AS weight
      FROM c JOIN f ON c.term = f.term),
words AS (
    SELECT item_id, string_agg(term, ' ' ORDER BY rank) AS keywords FROM (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY weight DESC, term) AS rank FROM w)
    WHERE rank <= 5 GROUP BY 1),
found AS (
    SELECT b.item_id, CASE WHEN c_custkey IS NOT NULL
           THEN concat_ws(' is insured by ', c_name, c_mktsegment) END AS answer
    FROM benchmark b LEFT JOIN customer ON c_custkey = b.item_id)
SELECT item_id, answer, keywords, n_passages, context,
       concat_ws(chr(10), answer, 'Keywords: ' || keywords, context) AS report
FROM found LEFT JOIN words USING (item_id) LEFT JOIN context USING (item_id)""")

# Models and scores

add("text_classifier", f"""WITH ranked AS (
    SELECT doc_id, lang AS label, row_number() OVER (
        PARTITION BY lang ORDER BY md5(concat(doc_id, '-1')), doc_id) AS sample_rank FROM documents),
train AS (SELECT doc_id, label FROM ranked WHERE sample_rank <= 40),
shares AS (SELECT label, count(*) AS n FROM train GROUP BY 1),
counted AS (
    SELECT label, term, count(*) AS c
    FROM (SELECT label, unnest({tokens('text')}) AS term FROM train JOIN documents USING (doc_id))
    GROUP BY ALL),
sizes AS (SELECT label, sum(c) AS n FROM counted GROUP BY 1),
vocabulary AS (SELECT DISTINCT term FROM counted),
weights AS (
    SELECT v.term, s.label, CAST(round(ln((coalesce(c.c, 0) + 1)::DOUBLE
           / (coalesce(z.n, 0) + (SELECT count(*) FROM vocabulary))::DOUBLE) * 1000000) AS BIGINT) AS w
    FROM vocabulary v CROSS JOIN shares s LEFT JOIN sizes z ON z.label = s.label
    LEFT JOIN counted c ON c.term = v.term AND c.label = s.label),
rest AS (SELECT doc_id, lang AS label FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM train)),
used AS (
    SELECT doc_id, term, count(*) AS tf
    FROM (SELECT doc_id, unnest({tokens('text')}) AS term FROM rest JOIN documents USING (doc_id))
    GROUP BY ALL),
sums AS (SELECT doc_id, label, sum(tf * w) AS s FROM used JOIN weights USING (term) GROUP BY ALL),
posterior AS (
    SELECT r.doc_id, r.label, s.label AS prediction, coalesce(x.s, 0)
           + round(ln(s.n / (SELECT sum(n) FROM shares)) * 1000000) AS score
    FROM rest r JOIN documents USING (doc_id) CROSS JOIN shares s
    LEFT JOIN sums x ON x.doc_id = r.doc_id AND x.label = s.label)
SELECT doc_id, label, prediction FROM posterior
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, prediction) = 1""")

add("batch_predict", """
SELECT doc_id, concat(length(text), ':', length(text) - length(replace(text, ' ', '')))
       AS prediction
FROM documents""")

add("parse_typed_output", """
SELECT doc_id, raw, doc_id % 5 < 3 AS valid, CASE WHEN doc_id % 5 < 3 THEN lang END AS label,
       CASE WHEN doc_id % 5 < 3 THEN CAST(doc_id % 10 AS INT) END AS score,
       CASE WHEN doc_id % 5 < 3 THEN doc_id % 2 = 0 END AS ok
FROM model_texts JOIN documents USING (doc_id)""", "model_texts")

NAMED = "CASE " + " ".join(
    f"WHEN contains(lower(response), '{n.lower()}') THEN '{n}'" for n in PRODUCT_LABELS
) + " END"
add("score_label_guideline", f"""
SELECT example_id, {NAMED} AS label, CASE WHEN {NAMED} IS NULL THEN 'no' ELSE 'yes' END AS value
FROM answers""", "answers")

add("score_rationale", f"""
WITH p AS (SELECT example_id, list_filter(list_transform(
               regexp_split_to_array(response, '[.!?]+(\\s+|$)'), lambda s: trim(s)),
               lambda s: s <> '') AS parts FROM answers)
SELECT example_id, CASE WHEN len(parts) = 2 AND {n_words('parts[2]')} <= 60 THEN 'yes' ELSE 'no'
       END AS value FROM p""", "answers")

UNSAFE = f"len(list_filter({tokens('text')}, lambda x: x IN ({listed(UNSAFE_TERMS)}))) > 0"
add("score_safety", f"""WITH {TOXIC}
SELECT doc_id, CASE WHEN doc_id IN (
    SELECT doc_id FROM (SELECT doc_id, unnest({tokens('text')}) AS term FROM rest) JOIN learned USING (term))
    THEN 'no' ELSE 'yes' END AS value FROM rest""")

add("score_relevance", f"""
WITH t AS (SELECT req_no, list_distinct({tokens('request')}) AS q, {tokens('response')} AS c
           FROM request_log),
s AS (SELECT req_no, len(q) AS n, len(list_filter(q, lambda x: list_contains(c, x))) AS hits FROM t)
SELECT req_no, CASE WHEN n > 0 THEN round(hits / n, 6) END AS coverage,
       CASE WHEN hits / n >= 0.2 THEN 'yes' ELSE 'no' END AS value
FROM s""", "request_log")

add("score_latency", f"""
WITH t AS ({TRACES}), s AS (SELECT trace_id, (chat_end_ns - chat_start_ns) / 1e9 AS s FROM t)
SELECT trace_id, CASE WHEN s <= 5.0 THEN 'yes' WHEN s > 5.0 THEN 'no' END AS value,
       CASE WHEN s <= 5.0 THEN printf('LLM response time %.2fs is within the 5.0s limit.', s)
            WHEN s > 5.0 THEN printf('LLM response time %.2fs exceeds the 5.0s limit.', s)
       END AS rationale
FROM s""", "spans")

add("score_length", f"SELECT example_id, {n_words('response')} AS value FROM answers", "answers")

add("map_rating_numeric", """
SELECT example_id, CASE rating WHEN 'correct_and_well_reasoned' THEN 1.0::DOUBLE
       WHEN 'correct_but_poorly_reasoned' THEN 0.6::DOUBLE WHEN 'incorrect' THEN 0.3::DOUBLE
       WHEN 'unclear' THEN 0.0::DOUBLE END AS value
FROM answers""", "answers")

GRADE = "CASE {c} WHEN 'High' THEN 100.0::DOUBLE WHEN 'Medium' THEN 50 WHEN 'Low' THEN 0 END"
add("composite_score", f"""
SELECT example_id, round(({GRADE.format(c='tool_rating')} * 0.65::DOUBLE
       + {GRADE.format(c='format_rating')} * 0.35::DOUBLE) / 100, 6) AS value,
       concat('Tool Calling feedback: ', tool_rating, chr(10), 'Formatting feedback: ',
              format_rating) AS feedback
FROM examples""", "examples")

add("score_correctness", f"SELECT example_id, {CORRECT} AS value FROM examples", "examples")

SCORES = f"""
scores AS (
    SELECT example_id, 'safety' AS scorer,
           CASE WHEN {UNSAFE.replace('(text)', '(template)')} THEN 'no' ELSE 'yes' END AS value_str,
           CAST(NULL AS DOUBLE) AS value_num FROM examples
    UNION ALL
    SELECT example_id, 'length', NULL, CAST({n_words('template')} AS DOUBLE) FROM examples
    UNION ALL
    SELECT example_id, 'correctness', NULL, CAST({CORRECT} AS DOUBLE) FROM examples
    UNION ALL
    SELECT example_id, 'tool_grade', NULL, {GRADE.format(c='tool_rating')} FROM examples)"""
add("run_scorers", f"WITH {SCORES} SELECT * FROM scores", "examples")
add("score_summary", f"""WITH {SCORES}
SELECT scorer, count(*) AS n_rows, round(avg(value_num), 6) AS mean,
       round(CASE WHEN count(value_str) > 0
             THEN count(*) FILTER (value_str = 'yes') / count(value_str) END, 6) AS pass_rate,
       count(*) FILTER (value_str IS NULL AND value_num IS NULL) AS n_unscored
FROM scores GROUP BY 1""", "examples")

add("score_language", f"""
WITH d AS (SELECT doc_id, lang, {tokens('text')} AS tk,
                  ('0x' || left(md5(concat(doc_id, '-1')), 7))::INT % 2 AS half FROM documents),
n AS (SELECT lang, count(*) AS n FROM d WHERE half = 0 AND lang IS NOT NULL GROUP BY 1),
c AS (SELECT lang, term, count(*) AS c
      FROM (SELECT lang, unnest(list_distinct(tk)) AS term FROM d WHERE half = 0) GROUP BY ALL),
s AS (SELECT term, lang, c * 1000000 // n AS share FROM c JOIN n USING (lang)),
m AS (SELECT term, lang, share - coalesce(lead(share) OVER w, 0) AS lead, row_number() OVER w AS place
      FROM s WINDOW w AS (PARTITION BY term ORDER BY share DESC)),
k AS (SELECT lang, term FROM m WHERE place = 1 AND lead > 0
      QUALIFY row_number() OVER (PARTITION BY lang ORDER BY lead DESC, term) <= 25),
u AS (SELECT doc_id, k.lang AS language, count(*) AS hits
      FROM (SELECT doc_id, unnest(tk) AS term FROM d WHERE half = 1) JOIN k USING (term) GROUP BY ALL),
t AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, language) = 1)
SELECT doc_id, language, CASE WHEN len(tk) > 0 THEN round(coalesce(hits, 0) / len(tk), 6) END AS share,
       language IS NOT DISTINCT FROM lang AS agrees
FROM d LEFT JOIN t USING (doc_id) WHERE half = 1""")

add("score_out_of_scope", f"""
SELECT example_id, CASE WHEN (coalesce({NAMED}, '') = 'None') = (expected = 'None')
       THEN 'yes' ELSE 'no' END AS value
FROM answers""", "answers")

GRAMS = """
SELECT req_no, 1 AS n, unnest({tk}) AS gram FROM t
UNION ALL
SELECT req_no, 2, unnest(list_transform(range(1, len({tk})),
       lambda i: concat({tk}[i], ' ', {tk}[i + 1]))) FROM t"""
add("score_overlap", f"""
WITH t AS (SELECT req_no, {tokens('response')} AS c, {tokens('request')} AS r FROM request_log),
g AS (SELECT req_no, n, gram, count(*) AS nc, 0 AS nr FROM ({GRAMS.format(tk='c')}) GROUP BY 1, 2, 3
      UNION ALL
      SELECT req_no, n, gram, 0, count(*) FROM ({GRAMS.format(tk='r')}) GROUP BY 1, 2, 3),
s AS (SELECT req_no, n, gram, sum(nc) AS nc, sum(nr) AS nr FROM g GROUP BY 1, 2, 3),
u AS (SELECT req_no, n, sum(least(nc, nr)) AS hits, sum(nc) AS nc, sum(nr) AS nr
      FROM s GROUP BY 1, 2)
SELECT k.req_no, k.n, CASE WHEN nc > 0 THEN round(hits / nc, 6) END AS precision,
       CASE WHEN nr > 0 THEN round(hits / nr, 6) END AS recall
FROM (SELECT req_no, CAST(unnest([1, 2]) AS INT) AS n FROM request_log) k
LEFT JOIN u ON k.req_no = u.req_no AND k.n = u.n""", "request_log")

SMALL, LARGE = PRICES["small"], PRICES["large"]
add("score_cost", f"""
SELECT req_no, round(({n_words('request')} * CASE WHEN req_no % 2 = 0 THEN {SMALL[0]}::DOUBLE
                      ELSE {LARGE[0]}::DOUBLE END
                    + {n_words('response')} * CASE WHEN req_no % 2 = 0 THEN {SMALL[1]}::DOUBLE
                      ELSE {LARGE[1]}::DOUBLE END) / 1000, 6) AS cost
FROM request_log""", "request_log")

add("normalize_synonyms", """
SELECT example_id, CASE lower(trim(split_part(response, '.', 1)))
       WHEN 'home loan' THEN 'Mortgage Loan' WHEN 'mortgage' THEN 'Mortgage Loan'
       WHEN 'car loan' THEN 'Auto Loan' ELSE trim(split_part(response, '.', 1)) END AS label
FROM answers""", "answers")

add("trajectory_tools", """
WITH s AS (SELECT req_no,
           CASE req_no % 3 WHEN 0 THEN 'patient_lookup' WHEN 1 THEN 'web_search'
                ELSE 'insurance_lookup' END AS a,
           CASE req_no % 4 WHEN 0 THEN 'web_search' ELSE 'patient_lookup' END AS b,
           req_no % 2 = 0 AS three FROM request_log)
SELECT req_no, concat(a, ',', b, CASE WHEN three THEN ',finish' ELSE '' END) AS tools,
       CASE WHEN three THEN 3 ELSE 2 END AS n_calls,
       a = 'web_search' OR b = 'web_search' AS has_mandatory
FROM s""", "request_log")

add("next_step_route", """
SELECT event_id, CASE event_type WHEN 'view' THEN 'text_processing_agent'
       WHEN 'click' THEN 'patient_lookup_agent' ELSE 'final_agent' END AS route, true AS valid
FROM events""")

# Evaluation sets

RECORDS = f"""WITH {FEEDBACK}, {RATED}, {KEPT}
SELECT t.request_id, t.request, t.is_correct, t.suggested_output, t.source_user,
       t.expected_response, t.source_tag, t.ratings AS chunk_at_i_relevance,
       k.kept AS expected_retrieved_context
FROM tagged t LEFT JOIN kept k
  ON t.request_id = k.request_id AND t.source_user = k.source_user"""
add("identify_eval_records", RECORDS, *ALL_LOGS)
add("potential_eval_set", RECORDS, *ALL_LOGS)
add("eval_from_traces", """
SELECT r.req_no AS request_id, min(r.request) AS template, min(r.response) AS outputs,
       count(*) AS n_chunks
FROM request_log r JOIN trace_chunks c ON r.req_no = c.req_no GROUP BY 1""",
    "request_log", "trace_chunks")

# Generators and streams


def draw(what: str, key: str, n: int) -> str:
    return f"(('0x' || substr(md5(concat('{what}|', {key}, '|1')), 1, 8))::BIGINT % {n})"


def pick(what: str, key: str, values: list[str]) -> str:
    return f"list_extract([{listed(values)}], {draw(what, key, len(values))} + 1)"


add("gen_visits", f"""
WITH w AS (SELECT o_orderkey AS visit_id, {draw('patient', 'o_orderkey', 15)} AS who FROM orders)
SELECT visit_id, concat('First', who) AS first_name, concat('Last', who) AS last_name,
       {pick('insurer', 'who', INSURERS)} AS insurance_provider_name,
       {pick('plan', 'who', PLANS)} AS insurance_type,
       CASE WHEN {draw('has_policy', 'visit_id', 5)} > 0 THEN md5(concat('policy|', visit_id)) END
           AS insurance_policy_number,
       concat('user', visit_id, '@example.com') AS email,
       {pick('city', 'visit_id', CITIES)} AS city,
       {draw('practice', 'visit_id', 9000)} + 1000 AS practice_visited_practice_id,
       concat('Note ', {draw('note', 'visit_id', 1000000)}) AS doctor_notes,
       {pick('reason', 'visit_id', REASONS)} AS reason_for_visit
FROM w""")

add("gen_practices", f"""
SELECT concat('Medical Center ', s_suppkey + 1) AS practice_name,
       {pick('city', 's_suppkey', CITIES)} AS city,
       concat('(555) 555-12', CASE WHEN s_suppkey < 10 THEN '0' ELSE '' END, s_suppkey) AS contact,
       concat('INS-', {draw('insurance', 's_suppkey', 9000)} + 1000) AS insurance_id,
       {pick('insurer', 's_suppkey', INSURERS)} AS insurance_company,
       {pick('plan', 's_suppkey', PLANS)} AS insurance_plan_type,
       {pick('network', 's_suppkey', NETWORK)} AS network_status
FROM supplier""")

add("stream_index_sync", """
SELECT doc_id AS id, sha256(text) AS text_hash FROM snapshot_new
UNION ALL
SELECT doc_id, sha256(text) FROM snapshot_old
WHERE doc_id NOT IN (SELECT doc_id FROM snapshot_new)""", "snapshot_old", "snapshot_new")

add("stream_quality_monitor", f"""
SELECT strftime(date_trunc('day', ts), {SECONDS}) AS window_start, event_type, count(*) AS n,
       CAST(sum(floor(value * 100)) AS BIGINT) AS value_cents,
       count(*) FILTER (value > 5) AS n_slow, CAST(0 AS BIGINT) AS n_late
FROM events GROUP BY 1, 2""")

# Spark counts ranks, array lengths and hits in 32 bits; the SQL says so for equal types.
INTEGERS = {
    "note_severity": "severity",
    "stratified_sample": "sample_rank",
    "train_test_split": "sample_rank",
    "rank_variants": "rank",
    "word_count": "n_words",
    "decode_base64": "n_bytes",
    "extract_keywords": "rank",
    "vector_top_k": "rank",
    "filtered_top_k": "rank",
    "knn_join": "rank",
    "top_k_per_query": "rank",
    "score_length": "value",
    "eval_from_traces": "n_chunks",
}
for _name, _column in INTEGERS.items():
    SQL[_name] = (
        f"SELECT * REPLACE (CAST({_column} AS INTEGER) AS {_column}) FROM ({SQL[_name]})"
    )
