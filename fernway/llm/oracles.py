"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

# A-Z only; chr(9) to chr(13) and the blank are stripped.
SQL["op1_line_dedup"] = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
keyed AS (
    SELECT doc_id, pos, line,
           trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
    FROM lines),
frequent AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (
    SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
           AS kept_sha256
FROM marked GROUP BY doc_id"""

SQL["op4_url_filter"] = r"""
WITH captures AS (
    SELECT page_id, 19723 + ('0x' || left(md5(CAST(page_id AS VARCHAR)), 7))::INT % 366 AS fetch_day,
           regexp_replace(regexp_extract(lower(coalesce(url, '')),
               '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '\.+$', '') AS host
    FROM pages),
split AS (SELECT DISTINCT host, string_split(host, '.') AS labels FROM captures),
ups AS (
    SELECT host, array_to_string(labels[i:], '.') AS pattern
    FROM split, LATERAL (SELECT unnest(range(1, greatest(len(labels), 2))) AS i)),
hashed AS (
    SELECT pattern, ('0x' || left(md5(pattern), 7))::INT AS v
    FROM (SELECT DISTINCT pattern FROM ups WHERE pattern <> '')),
entries AS (
    SELECT pattern, 19723 + (v // 16) % 300 AS day, 'add' AS action FROM hashed WHERE v % 5 = 0
    UNION ALL
    SELECT pattern, 19723 + (v // 16) % 300 + 20 + v % 50, 'remove' FROM hashed WHERE v % 10 = 0
    UNION ALL
    SELECT pattern, 19723 + (v // 16) % 300 + 100, 'add' FROM hashed WHERE v % 20 = 0),
latest AS (
    SELECT c.page_id, c.host, c.fetch_day, e.pattern, e.day, e.action,
           row_number() OVER (PARTITION BY c.page_id, e.pattern ORDER BY e.day DESC,
                              e.action DESC) AS rn
    FROM captures c JOIN ups u ON u.host = c.host
    JOIN entries e ON e.pattern = u.pattern AND e.day <= c.fetch_day),
best AS (
    SELECT page_id, pattern, day,
           row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC) AS rn
    FROM latest WHERE rn = 1 AND action = 'add')
SELECT c.page_id, c.host, c.fetch_day, b.pattern IS NOT NULL AS listed, b.pattern AS matched,
       b.day AS since
FROM captures c LEFT JOIN best b ON b.page_id = c.page_id AND b.rn = 1"""

SQL["op6_warc"] = """
WITH sized AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
    SELECT *, CASE WHEN payload_bytes >= 100
                   THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id
    FROM sized)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts"""

SQL["op11_chat_format"] = r"""
WITH rows_ AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
    FROM rows_),
marked AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS last_role,
           regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]|TURN\]|SAYS\]|ALSO\]))', '\1\2\\\3', 'g') AS role_,
           regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]|TURN\]|SAYS\]|ALSO\]))', '\1\2\\\3', 'g') AS text_
    FROM numbered),
parts AS (
    SELECT conv_id, i, role, text,
           CASE WHEN role = last_role THEN '[ALSO]'
                ELSE CASE WHEN i = 1 THEN '' ELSE '[/TURN]' END || '[TURN]' || role_ || '[SAYS]' END
           || text_ AS part
    FROM marked),
whole AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS turns,
           coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '') AS learned,
           '<s>' || string_agg(part, '' ORDER BY i) || '[/TURN]</s>' AS formatted
    FROM parts GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars,
       sha256(learned) AS loss_sha256, length(formatted) AS formatted_chars
FROM whole"""

SQL["op13_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
worded AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
    FROM pieces),
numbers AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
placed AS (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM worded, (VALUES (1), (2), (3)) sizes(k)),
counted AS (
    SELECT lang, k, w[i:i + k - 1] AS p, count(*) AS c
    FROM placed GROUP BY ALL HAVING count(*) >= 10),
candidates AS (SELECT * FROM counted WHERE k > 1),
inside AS (
    SELECT t.lang, t.c, u.p FROM candidates t, LATERAL (SELECT unnest([t.p[1:2], t.p[2:3]]) AS p) u
    WHERE t.k = 3),
kept AS (
    SELECT * FROM candidates c WHERE NOT EXISTS (
        SELECT 1 FROM inside x WHERE x.lang = c.lang AND x.p = c.p AND 100 * x.c >= 50 * c.c)),
cuts AS (
    SELECT lang, p, c AS a, p[1:j] AS lp, p[j + 1:k] AS rp, j
    FROM (SELECT *, unnest(range(1, k)) AS j FROM kept)),
scored AS (
    SELECT s.lang, s.p, s.a, x.c AS l, y.c AS r, j,
           CAST((1000000::HUGEINT * s.a * s.a) // (x.c::HUGEINT * y.c) AS BIGINT) AS score
    FROM cuts s JOIN counted x ON x.lang = s.lang AND x.p = s.lp
    JOIN counted y ON y.lang = s.lang AND y.p = s.rp),
weakest AS (
    SELECT *, array_to_string(p, ' ') AS phrase FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM weakest)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN numbers USING (lang) WHERE rank <= 2000"""
