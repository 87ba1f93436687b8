"""DuckDB SQL for the registered queries' rows."""

from narrative_spark.functions.text import SPACE
from narrative_spark.functions.text import STOP_SIGNS as STOP

LINES = rf"""
raw AS (
  SELECT source AS work_id, doc_id AS part, '== ' || doc_id || ' ==' || chr(10) || coalesce(text, '') AS text FROM documents
), split AS (
  SELECT work_id, part, string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) AS every FROM raw
), numbered AS (
  SELECT work_id, part, row_number() OVER (PARTITION BY work_id ORDER BY part, k) AS line_no, regexp_replace(line, '^{SPACE}+|{SPACE}+$', '', 'g') AS line
  FROM (SELECT work_id, part, unnest(every) AS line, unnest(range(len(every))) AS k FROM split)
), lines AS (SELECT work_id, part, line_no, line FROM numbered WHERE line <> '')
"""
CHAPTERS = LINES + """
, headers AS (SELECT source AS work_id, '== ' || doc_id || ' ==' AS header FROM documents
), marked AS (
  SELECT l.*, h.header IS NOT NULL AS is_header FROM lines l LEFT JOIN (SELECT DISTINCT * FROM headers) h ON l.work_id = h.work_id AND l.line = h.header
), labelled AS (
  SELECT *, coalesce(last_value(CASE WHEN is_header THEN line END IGNORE NULLS) OVER w, '') AS chapter_name, CAST(sum(is_header::INT) OVER w AS INTEGER) AS chapter_idx
  FROM marked WINDOW w AS (PARTITION BY work_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)
)
"""
UNITS = CHAPTERS + """
, begun AS (
  SELECT *, CASE WHEN length(line) > 80 OR lag(chapter_idx) OVER (PARTITION BY work_id ORDER BY line_no) IS DISTINCT FROM chapter_idx THEN 1 ELSE 0 END AS begins
  FROM labelled WHERE NOT is_header
), placed AS (SELECT *, sum(begins) OVER (PARTITION BY work_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS ord FROM begun
), units AS (
  SELECT work_id, work_id || '-' || CASE WHEN ord < 10000 THEN lpad(CAST(ord AS VARCHAR), 4, '0') ELSE CAST(ord AS VARCHAR) END AS unit_id, CAST(ord AS BIGINT) AS ord, chapter_idx, first(chapter_name) AS chapter_name,
    min(line_no) AS start_line, max(line_no) AS end_line, string_agg(line, chr(10) ORDER BY line_no) AS text, length(string_agg(line, chr(10) ORDER BY line_no)) AS chars
  FROM placed GROUP BY work_id, ord, chapter_idx
)
"""
TALKS = """
talk AS (
  SELECT CAST(conv_id AS VARCHAR) AS work_id, conv_id, turn + 1 AS ord, role, text, CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT DISTINCT FROM role THEN 0 ELSE 1 END AS fresh FROM conversations
), talks AS (
  SELECT work_id, CAST(conv_id AS VARCHAR) || '-' || lpad(CAST(ord AS VARCHAR), 4, '0') AS unit_id, ord, CAST(sum(fresh) OVER (PARTITION BY conv_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS INTEGER) AS chapter_idx, role AS chapter_name, ord AS start_line, ord AS end_line, text, length(text) AS chars FROM talk
)
"""
DELTAS = """
ev AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ord, coalesce(TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 10, 0) AS k FROM events
), deltas AS (
  SELECT CAST(user_id AS VARCHAR) AS work_id, 'u' || user_id || '-' || lpad(CAST(ord AS VARCHAR), 4, '0') AS unit_id, ord, CAST((ord - 1) // 20 AS INTEGER) AS chapter_idx, 'part ' || CAST((ord - 1) // 20 AS INTEGER) AS chapter_name,
    event_type AS name, ['character', 'object', 'location'][event_id % 3 + 1] AS type, CASE WHEN event_id % 3 = 0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS status, CASE WHEN event_id % 2 = 0 THEN 'n' || event_id ELSE '' END AS note,
    CASE event_type WHEN 'signup' THEN 'open' WHEN 'purchase' THEN 'close' ELSE 'advance' END AS action, 'k' || k AS title, CASE WHEN event_id % 2 = 1 THEN 'p' || event_id ELSE '' END AS plot_note,
    CASE WHEN event_type <> 'view' THEN event_type || ' ' || event_id END AS event, event_type = 'error' AS degraded
  FROM ev
)
"""
#: Whole benchmark items, asked of a work each; three of four within a share of its units.
QUERIES = """
, asks AS (SELECT CAST(item_id AS VARCHAR) AS query_id, 'src' || (item_id % 20) AS work_id, text AS query, item_id FROM benchmark
), lasts AS (SELECT work_id, max(ord) AS last FROM units GROUP BY work_id
), queries AS (SELECT query_id, work_id, query, CASE WHEN item_id % 4 <> 0 THEN (last * (item_id % 4)) // 4 END AS max_order FROM asks LEFT JOIN lasts USING (work_id))
"""

TERMS = QUERIES + f"""
, q1 AS (SELECT *, regexp_extract_all(query, '[\\p{{L}}\\p{{N}}]') AS every FROM queries
), q2 AS (SELECT *, list_filter(every, lambda x: NOT contains('{STOP}', x)) AS few FROM q1
), q3 AS (SELECT *, CASE WHEN len(few) >= 2 THEN few ELSE every END AS c FROM q2
), q4 AS (SELECT *, list_transform(range(1, greatest(len(c), 1)), lambda i: c[i] || c[i + 1]) AS two FROM q3
), terms AS (SELECT query_id, work_id, query, max_order, len(c) < 2 AS single, CASE WHEN len(c) >= 2 THEN list_filter(two, lambda x, i: list_position(two, x) = i) ELSE list_sort(list_distinct(c)) END AS terms FROM q4)
"""
POSTINGS = """
, tokens AS (SELECT work_id, unit_id, ord, chapter_name, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]') AS s FROM units
), postings AS (
  SELECT work_id, term, ord, unit_id, chapter_name, CAST(len(s) AS BIGINT) AS size, count(*) AS tf
  FROM (SELECT *, unnest(list_transform(range(1, greatest(len(s), 1)), lambda i: s[i] || s[i + 1])) AS term FROM tokens) GROUP BY ALL
), stats AS (SELECT work_id, count(*) AS n_units, avg(len(s)) AS mean_size FROM tokens GROUP BY 1)
"""
BM25 = """
, asked AS (SELECT DISTINCT query_id, work_id, max_order, lower(unnest(terms)) AS term FROM terms
), spread AS (SELECT work_id, term, count(*) AS n FROM postings GROUP BY 1, 2
), bm AS (
  SELECT query_id, work_id, unit_id, ord, sum(CASE WHEN ln((n_units - n + 0.5) / (n + 0.5)) <= 0 THEN 1e-6 ELSE ln((n_units - n + 0.5) / (n + 0.5)) END * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean_size))) AS score
  FROM asked JOIN spread USING (work_id, term) JOIN stats USING (work_id) JOIN postings USING (work_id, term) WHERE ord <= coalesce(max_order, 9000000000) GROUP BY 1, 2, 3, 4
), bm25 AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, ord, unit_id) AS place FROM bm QUALIFY place <= 200)
"""
SCAN = """
, sc AS (
  SELECT query_id, work_id, unit_id, ord, CAST(CASE WHEN single THEN len(list_filter(terms, lambda t: contains(text, t))) ELSE 2 * coalesce(list_sum(list_transform(terms, lambda t: (length(text) - length(replace(text, t, ''))) // length(t))), 0) END AS DOUBLE) AS score
  FROM terms JOIN units USING (work_id) WHERE ord <= coalesce(max_order, 9000000000)
), scan AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, ord, unit_id) AS place FROM sc WHERE score > 0 QUALIFY place <= 200)
"""
ROUTED = POSTINGS + BM25 + SCAN + """
, routed AS (SELECT *, 'fts' AS used FROM bm25 UNION ALL SELECT *, 'scan' FROM scan WHERE query_id NOT IN (SELECT query_id FROM bm25))
"""

EVENTS = """
, seen AS (SELECT work_id, ord, chapter_idx, event FROM deltas WHERE NOT degraded AND event IS NOT NULL)
, windows AS (SELECT work_id, ord, string_agg(ord || ' ' || event, '|') OVER (PARTITION BY work_id ORDER BY ord ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS recent FROM seen)
, recents AS (SELECT d.work_id, d.ord, coalesce(last_value(w.recent IGNORE NULLS) OVER (PARTITION BY d.work_id ORDER BY d.ord ROWS UNBOUNDED PRECEDING), '') AS recent FROM deltas d LEFT JOIN windows w USING (work_id, ord))
, pushed AS (SELECT * FROM (SELECT work_id, ord, event, lead(chapter_idx, 5) OVER (PARTITION BY work_id ORDER BY ord) AS chapter_idx FROM seen) WHERE chapter_idx IS NOT NULL)
, digests AS (SELECT work_id, chapter_idx, trim(substring(string_agg('@' || ord || ' ' || event, '；' ORDER BY ord), 1, 200)) AS digest FROM pushed GROUP BY 1, 2)
, backdrops AS (SELECT work_id, chapter_idx, digest, substring(string_agg(digest, '；') OVER (PARTITION BY work_id ORDER BY chapter_idx ROWS UNBOUNDED PRECEDING), 1, 300) AS backdrop FROM digests)
, readers AS (SELECT work_id || '-' || p AS reader_id, work_id, p AS max_order FROM (SELECT DISTINCT work_id FROM deltas), (VALUES (0), (7), (33), (500)) v(p))
"""

#: The whole state as of each unit, as canonical JSON. Every event has one entity, one plotline and one event at most, so that orders tell records apart.
SNAPS = EVENTS + """
, before AS (SELECT a.work_id, a.ord AS here, d.* EXCLUDE (work_id) FROM deltas a JOIN deltas d ON d.work_id = a.work_id AND d.ord <= a.ord AND NOT d.degraded
), ents AS (
  SELECT work_id, here, type, name, min(ord) AS first_seen_order, max(ord) AS last_seen_order,
    CASE WHEN type <> 'location' THEN arg_max(status, ord) FILTER (WHERE status <> '') END AS status,
    arg_max(CASE WHEN type = 'location' AND note = '' THEN status ELSE note END, ord) FILTER (WHERE CASE WHEN type = 'location' AND note = '' THEN status ELSE note END <> '') AS note
  FROM before GROUP BY 1, 2, 3, 4
), plots AS (
  SELECT work_id, here, title, CASE WHEN count(*) FILTER (WHERE action = 'close') > 0 THEN 'closed' ELSE 'open' END AS status, min(ord) AS opened_order, max(ord) FILTER (WHERE action = 'close') AS closed_order,
    list_sort(list(DISTINCT ord)) AS key_orders, coalesce(arg_max(plot_note, ord) FILTER (WHERE plot_note <> ''), '') AS summary FROM before GROUP BY 1, 2, 3
), entity_json AS (
  SELECT work_id, here, type, string_agg('{"aliases":[],"first_seen_order":' || first_seen_order || CASE WHEN type = 'object' THEN ',"kind":"object"' ELSE '' END || ',"last_seen_order":' || last_seen_order || ',"name":"' || name || '"'
    || coalesce(',"note":"' || note || '"', '') || coalesce(',"status":"' || status || '"', '') || '}', ',' ORDER BY first_seen_order) AS j FROM ents GROUP BY 1, 2, 3
), plot_json AS (
  SELECT work_id, here, string_agg('{"closed_order":' || coalesce(CAST(closed_order AS VARCHAR), 'null') || ',"key_orders":[' || array_to_string(key_orders, ',') || '],"opened_order":' || opened_order || ',"status":"' || status || '","summary":"' || summary || '","title":"' || title || '"}', ',' ORDER BY opened_order) AS j
  FROM plots GROUP BY 1, 2
), ends AS (SELECT work_id, chapter_idx, max(ord) AS chapter_end FROM deltas GROUP BY 1, 2
), pushes AS (SELECT work_id, ord, event, push FROM (SELECT work_id, ord, event, lead(ord, 5) OVER (PARTITION BY work_id ORDER BY ord) AS push FROM seen) WHERE push IS NOT NULL
), held AS (
  SELECT a.work_id, a.ord AS here, string_agg('{"order":' || p.ord || ',"text":"' || p.event || '"}', ',' ORDER BY p.ord) AS j
  FROM deltas a JOIN pushes p ON p.work_id = a.work_id AND p.push <= a.ord JOIN deltas d ON d.work_id = p.work_id AND d.ord = p.push JOIN ends e ON e.work_id = d.work_id AND e.chapter_idx = d.chapter_idx WHERE e.chapter_end > a.ord GROUP BY 1, 2
), recent_json AS (
  SELECT work_id, ord, string_agg('{"order":' || ord || ',"text":"' || event || '"}', ',') OVER (PARTITION BY work_id ORDER BY ord ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS j FROM seen
), lasts AS (
  SELECT d.work_id, d.ord, d.chapter_idx, d.degraded, max(CASE WHEN NOT d.degraded THEN d.ord ELSE 0 END) OVER w AS last_order, last_value(r.j IGNORE NULLS) OVER w AS recent, lead(d.chapter_idx) OVER (PARTITION BY d.work_id ORDER BY d.ord) IS NOT DISTINCT FROM d.chapter_idx AS inside
  FROM deltas d LEFT JOIN recent_json r USING (work_id, ord) WINDOW w AS (PARTITION BY d.work_id ORDER BY d.ord ROWS UNBOUNDED PRECEDING)
), states AS (
  SELECT l.*, coalesce((SELECT arg_max(backdrop, b.chapter_idx) FROM backdrops b WHERE b.work_id = l.work_id AND b.chapter_idx <= l.chapter_idx - l.inside::INT), '') AS backdrop FROM lasts l
), snaps AS (
  SELECT s.work_id, s.ord, s.chapter_idx, s.degraded, s.inside, s.last_order, s.backdrop,
    '{"backdrop":"' || s.backdrop || '","backdrop_buffer":[' || coalesce(h.j, '') || '],"characters":[' || coalesce(c.j, '') || '],"last_order":' || s.last_order || ',"locations":[' || coalesce(o.j, '') || '],"objects":[' || coalesce(t.j, '')
    || '],"plotlines":[' || coalesce(p.j, '') || '],"recent":[' || coalesce(s.recent, '') || '],"schema_version":"1","work_id":"' || s.work_id || '"}' AS snapshot
  FROM states s LEFT JOIN held h ON h.work_id = s.work_id AND h.here = s.ord LEFT JOIN plot_json p ON p.work_id = s.work_id AND p.here = s.ord
    LEFT JOIN entity_json c ON c.work_id = s.work_id AND c.here = s.ord AND c.type = 'character' LEFT JOIN entity_json o ON o.work_id = s.work_id AND o.here = s.ord AND o.type = 'location' LEFT JOIN entity_json t ON t.work_id = s.work_id AND t.here = s.ord AND t.type = 'object'
), read_at AS (SELECT reader_id, r.work_id, CAST(r.max_order AS BIGINT) AS max_order, max(d.ord) AS ord FROM readers r LEFT JOIN deltas d ON d.work_id = r.work_id AND d.ord <= r.max_order GROUP BY 1, 2, 3)
"""
#: What stands in the snapshot that a request reads, which ends here BOUND.
CURRENT = DELTAS + SNAPS + """
, asked AS (SELECT work_id || '-' || q AS request_id, work_id, q, least(max(ord), BOUND) AS here FROM deltas, (VALUES NAMES) v(q) GROUP BY 1, 2, 3)
"""
VIEW = """
, view_parts AS (
  SELECT s.work_id, s.ord, s.last_order, s.backdrop,
    (SELECT string_agg(name || coalesce('：' || coalesce(status, note), ''), '；' ORDER BY first_seen_order) FROM ents e WHERE e.work_id = s.work_id AND e.here = s.ord AND type = 'character') AS people,
    (SELECT string_agg(name || '（' || coalesce(status, note, 'object') || '）', '；' ORDER BY first_seen_order) FROM ents e WHERE e.work_id = s.work_id AND e.here = s.ord AND type = 'object') AS things,
    (SELECT string_agg(name, '、' ORDER BY first_seen_order) FROM ents e WHERE e.work_id = s.work_id AND e.here = s.ord AND type = 'location') AS places,
    (SELECT string_agg(title || '[' || CASE WHEN status = 'open' THEN '进行中' ELSE '已结束' END || '@' || opened_order || coalesce('→' || closed_order, '') || ']：' || summary, '；' ORDER BY status = 'closed', opened_order)
      FROM (SELECT *, row_number() OVER (PARTITION BY work_id, here, status ORDER BY opened_order DESC) AS back FROM plots) p WHERE p.work_id = s.work_id AND p.here = s.ord AND (status = 'open' OR back <= 2)) AS lines,
    (SELECT string_agg('@' || ord || ' ' || event, '；' ORDER BY ord) FROM (SELECT e.ord, e.event FROM seen e WHERE e.work_id = s.work_id AND e.ord <= s.ord ORDER BY e.ord DESC LIMIT 5) x) AS recent
  FROM snaps s
)
"""
#: The given vectors as units of three works: the vector index of the first is as new as its source, that of the second older, that of the third new too but asked for a chapter that no unit has.
ROUTES = """
units AS (SELECT 'emb' || (vec_id % 3) AS work_id, 'e-' || vec_id AS unit_id, CAST(vec_id + 1 AS BIGINT) AS ord, 'part ' || label AS chapter_name, 'unit number ' || vec_id || ' of part ' || label AS text, embedding AS vector, vec_id FROM embeddings
), terms AS (
  SELECT CAST(vec_id AS VARCHAR) AS query_id, work_id, CAST(NULL AS BIGINT) AS max_order, FALSE AS single, vector, CASE WHEN work_id = 'emb2' THEN 'none' ELSE '' END AS chapter, list_filter(two, lambda x, i: list_position(two, x) = i) AS terms
  FROM (SELECT *, list_transform(range(1, len(c)), lambda i: c[i] || c[i + 1]) AS two FROM (SELECT *, regexp_extract_all('number ' || vec_id, '[\\p{L}\\p{N}]') AS c FROM units WHERE vec_id % 20 = 0))
), near AS (
  SELECT query_id, t.work_id, u.unit_id, u.ord, list_cosine_similarity(t.vector::DOUBLE[], u.vector::DOUBLE[]) AS score FROM terms t JOIN units u ON u.work_id = t.work_id AND t.work_id <> 'emb1' AND contains(u.chapter_name, t.chapter)
), vec AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, ord, unit_id) AS place FROM near QUALIFY place <= 200)
"""
RUN_TOKENS = """
, run_terms AS (SELECT query_id, work_id, max_order, list_distinct(regexp_extract_all(strip_accents(lower(query)), '[\\p{L}\\p{N}]+')) AS terms FROM queries
), tokens AS (SELECT work_id, unit_id, ord, chapter_name, regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{N}]+') AS s FROM units
), postings AS (SELECT work_id, term, ord, unit_id, chapter_name, CAST(len(s) AS BIGINT) AS size, count(*) AS tf FROM (SELECT *, unnest(s) AS term FROM tokens) GROUP BY ALL
), stats AS (SELECT work_id, count(*) AS n_units, avg(len(s)) AS mean_size FROM tokens GROUP BY 1)
"""

ORACLE_SQL: dict[str, str] = {
    "normalize_lines": f"WITH {LINES} SELECT work_id, line_no, line FROM lines",
    "split_title": f"""WITH {LINES}, t AS (SELECT work_id, min(line_no) AS title_line, arg_min(line, line_no) AS title FROM lines GROUP BY work_id)
        SELECT work_id, title, title_line, count(*) AS body_lines FROM lines JOIN t USING (work_id) WHERE line_no > title_line GROUP BY ALL""",
    "normalize_stats": f"WITH {LINES} SELECT work_id, count(*) AS line_count_body, CAST(sum(length(line)) + count(*) - 1 AS BIGINT) AS char_count_body FROM lines GROUP BY work_id",
    "label_chapters": f"WITH {CHAPTERS} SELECT work_id, line_no, chapter_idx, chapter_name, is_header FROM labelled",
    "segment_units": f"WITH {UNITS} SELECT work_id, unit_id, ord, chapter_idx, chapter_name, start_line, end_line, text, chars FROM units",
    "chapter_stats": f"WITH {UNITS} SELECT work_id, chapter_idx, first(chapter_name) AS chapter_name, count(*) AS unit_count, CAST(sum(chars) AS BIGINT) AS char_count FROM units GROUP BY work_id, chapter_idx",
    "segment_warnings": f"""WITH {CHAPTERS}, wanted AS (SELECT * FROM headers UNION ALL SELECT DISTINCT work_id, '== none ==' FROM headers WHERE work_id < 'src3')
        SELECT e.work_id, e.expected, coalesce(f.found, 0) AS found FROM (SELECT work_id, count(DISTINCT header) AS expected FROM wanted GROUP BY 1) e LEFT JOIN (SELECT work_id, count(*) AS found FROM labelled WHERE is_header GROUP BY 1) f USING (work_id) WHERE e.expected <> coalesce(f.found, 0)""",
    "check_orders": f"WITH {UNITS} SELECT work_id, count(*) AS units, min(ord) AS first, max(ord) AS last, count(*) = count(DISTINCT ord) AND min(ord) = 1 AND max(ord) = count(*) AS ok FROM units GROUP BY work_id",
    "check_lossless": f"""WITH {UNITS}, b AS (SELECT work_id, string_agg(line, chr(10) ORDER BY line_no) AS x FROM labelled WHERE NOT is_header GROUP BY work_id), u AS (SELECT work_id, string_agg(text, chr(10) ORDER BY ord) AS y FROM units GROUP BY work_id)
        SELECT work_id, length(x) AS body_chars, length(y) AS unit_chars, x = y AS ok FROM b JOIN u USING (work_id)""",
    "check_headers": f"WITH {UNITS} SELECT DISTINCT work_id, header FROM headers h WHERE NOT EXISTS (SELECT 1 FROM units u WHERE u.work_id = h.work_id AND u.chapter_name = h.header)",
    "check_provenance": f"WITH {UNITS}, bent AS (SELECT work_id, unit_id, CASE WHEN ord % 7 = 3 THEN end_line + 1 WHEN ord % 11 = 5 THEN 0 ELSE start_line END AS start_line, end_line FROM units) SELECT * FROM bent WHERE NOT (start_line > 0 AND start_line <= end_line)",
    "units_per_chapter": f"WITH {UNITS} SELECT work_id, chapter_name, count(*) AS unit_count FROM units GROUP BY 1, 2",
    "spot_check": f"""WITH {UNITS}, c AS (SELECT work_id, count(*) AS n FROM units GROUP BY 1), p AS (SELECT DISTINCT work_id, CASE WHEN n <= 10 THEN i + 1 ELSE CAST(round_even(i * (n - 1) / 9.0, 0) AS BIGINT) + 1 END AS ord FROM c, range(10) r(i) WHERE n > 10 OR i < n)
        SELECT work_id, ord, unit_id, chapter_name, start_line, end_line, chars, CASE WHEN length(replace(text, chr(10), ' / ')) > 220 THEN substring(replace(text, chr(10), ' / '), 1, 220) || ' ……' ELSE replace(text, chr(10), ' / ') END AS preview FROM units JOIN p USING (work_id, ord)""",
    "validation_report": f"""WITH {UNITS}, w AS (SELECT DISTINCT work_id FROM units), b AS (SELECT work_id, string_agg(line, chr(10) ORDER BY line_no) AS x FROM labelled WHERE NOT is_header GROUP BY work_id), u AS (SELECT work_id, string_agg(text, chr(10) ORDER BY ord) AS y FROM units GROUP BY work_id),
        r AS (SELECT work_id, 'orders' AS check, count(*) = max(ord) AND min(ord) = 1 AS passed FROM units GROUP BY 1
          UNION ALL SELECT work_id, 'lossless', x = y FROM b JOIN u USING (work_id)
          UNION ALL SELECT work_id, 'headers', NOT EXISTS (SELECT 1 FROM headers h WHERE h.work_id = w.work_id AND NOT EXISTS (SELECT 1 FROM units u WHERE u.work_id = h.work_id AND u.chapter_name = h.header)) FROM w
          UNION ALL SELECT work_id, 'provenance', bool_and(start_line > 0 AND start_line <= end_line) FROM units GROUP BY 1)
        SELECT * FROM r UNION ALL SELECT work_id, 'all', bool_and(passed) FROM r GROUP BY 1""",
    "corpus_profile": f"""WITH {LINES} SELECT work_id, count(*) AS line_count, quantile_cont(length(line), 0.5) AS median_chars, quantile_cont(length(line), 0.9) AS p90_chars, max(length(line)) AS max_chars, CAST(sum((length(line) - length(replace(line, 'the', ''))) // 3) AS BIGINT) AS n_the, CAST(sum((length(line) - length(replace(line, 'de', ''))) // 2) AS BIGINT) AS n_de FROM lines GROUP BY work_id""",
    "analyze_queries": f"WITH {UNITS} {TERMS} SELECT query_id, terms, single FROM terms",
    "build_postings": f"WITH {UNITS} {POSTINGS} SELECT work_id, term, ord, unit_id, chapter_name, size, tf FROM postings",
    "index_stats": f"WITH {UNITS} {POSTINGS} SELECT work_id, n_units, round(mean_size, 6) AS mean_size FROM stats",
    "search_bm25": f"WITH {UNITS} {TERMS} {POSTINGS} {BM25} SELECT query_id, work_id, unit_id, ord, round(score, 3) AS score, place FROM bm25",
    "search_scan": f"WITH {UNITS} {TERMS} {SCAN} SELECT query_id, work_id, unit_id, ord, score, place FROM scan",
    "search": f"WITH {UNITS} {TERMS} {ROUTED} SELECT query_id, work_id, unit_id, ord, place, used, round(score, 4) AS score, text AS raw_text, chapter_name AS chapter, start_line, end_line FROM routed JOIN units USING (work_id, unit_id, ord) WHERE place <= 8",
    "search_diagnostics": f"""WITH {UNITS} {TERMS} {ROUTED}, e AS (SELECT query_id, count(*) AS n FROM terms JOIN units USING (work_id) WHERE ord <= coalesce(max_order, 9000000000) GROUP BY 1), r AS (SELECT query_id, count(*) AS n, min(used) AS used FROM routed GROUP BY 1)
        SELECT t.query_id, 'auto' AS requested, coalesce(r.used, 'scan') AS used, CASE WHEN r.used = 'fts' THEN 'vector_unavailable_or_stale' ELSE 'vector_then_fts_unavailable_or_no_match' END AS fallback_reason, coalesce(e.n, 0) AS eligible_units, coalesce(r.n, 0) AS candidates FROM terms t LEFT JOIN e USING (query_id) LEFT JOIN r USING (query_id)""",
    "evaluate_retrieval": f"""WITH {UNITS} {TERMS} {ROUTED}, top AS (SELECT * FROM routed WHERE place <= 8), gold AS (SELECT q.query_id, list(DISTINCT u.ord) AS relevant FROM queries q JOIN units u USING (work_id) JOIN labels l ON u.chapter_name = '== ' || l.doc_id || ' ==' WHERE l.quality = 1 GROUP BY 1),
        c AS (SELECT q.query_id, q.max_order, g.relevant FROM queries q LEFT JOIN gold g USING (query_id)), x AS (SELECT c.*, (SELECT list(ord) FROM top t WHERE t.query_id = c.query_id AND place <= 5) AS found, (SELECT max(ord) FROM top t WHERE t.query_id = c.query_id) AS furthest FROM c)
        SELECT count(*) AS cases, count(relevant) AS scored, count(*) FILTER (WHERE list_has_any(coalesce(found, []), coalesce(relevant, []))) AS hits, count(*) FILTER (WHERE furthest > max_order) AS violations, coalesce(count(*) FILTER (WHERE list_has_any(coalesce(found, []), coalesce(relevant, []))) / nullif(count(relevant), 0), 0.0) AS recall FROM x""",
    "fallback_extract": f"""WITH {UNITS}, h AS (SELECT work_id, unit_id, coalesce(nullif(split_part(text, '.', 1), ''), nullif(split_part(text, chr(10), 1), ''), text[:60]) AS head FROM units)
        SELECT work_id, unit_id, CASE WHEN length(head) > 60 THEN substring(head, 1, 60) || '……' ELSE head END AS summary FROM h""",
    "derive_tags": f"""WITH {DELTAS} SELECT work_id, unit_id, CASE WHEN type = 'character' THEN name ELSE '' END AS characters, CASE WHEN type = 'location' THEN name ELSE '' END AS locations, CASE WHEN type = 'object' THEN name ELSE '' END AS key_terms FROM deltas""",
    "recent_context": f"WITH {TALKS} SELECT work_id, ord, coalesce(string_agg(text, chr(10)) OVER (PARTITION BY work_id ORDER BY ord ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), '') AS recent_text FROM talks",
    "related_context": f"""WITH {TALKS}, p0 AS (SELECT work_id, ord, chapter_name, text, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]') AS every, row_number() OVER (PARTITION BY work_id ORDER BY ord) AS place FROM talks),
        p AS (SELECT *, list_distinct(every) AS signs FROM p0), m AS (SELECT work_id, place, unnest(signs) AS sign FROM p), a AS (SELECT work_id, place AS now, unnest(signs) AS sign FROM p WHERE len(signs) >= 2),
        sh AS (SELECT work_id, now, place, count(*) AS score FROM a JOIN m USING (work_id, sign) WHERE place <= now - 3 GROUP BY 1, 2, 3), b AS (SELECT *, row_number() OVER (PARTITION BY work_id, now ORDER BY score DESC, place DESC) AS rank FROM sh QUALIFY rank <= 3),
        x AS (SELECT work_id, now, rank, '@' || ord || '（' || chapter_name || '，相关度' || score || '）：' || trim(text) AS piece FROM b JOIN p USING (work_id, place)), y AS (SELECT *, coalesce(sum(length(piece) + 1) OVER (PARTITION BY work_id, now ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM x),
        z AS (SELECT work_id, now, string_agg(substring(piece, 1, CAST(greatest(1800 - used, 0) AS BIGINT)), chr(10) ORDER BY rank) AS related FROM y WHERE used < 1800 GROUP BY 1, 2) SELECT p.work_id, p.ord, coalesce(related, '') AS related FROM p LEFT JOIN z ON p.work_id = z.work_id AND p.place = z.now""",
    "cache_split": f"""WITH {UNITS}, k AS (SELECT work_id, unit_id, ord, sha256('v1' || chr(10) || work_id || chr(10) || text) AS key FROM units), c AS (SELECT DISTINCT key FROM k WHERE ord % 3 <> 0)
        SELECT work_id, count(*) AS units, count(c.key) AS cached, count(*) - count(c.key) AS fresh, count(*) FILTER (WHERE ord % 10 = 9) AS degraded FROM k LEFT JOIN c USING (key) GROUP BY 1""",
    "apply_patch": f"""WITH {DELTAS} SELECT work_id, ord, CASE WHEN ord % 4 = 0 THEN 'checked ' || ord ELSE 's' || ord END AS summary, CASE WHEN ord % 4 = 0 AND name = 'view' THEN '' WHEN ord % 4 = 0 AND name = 'click' THEN 'press' ELSE name END AS name, CASE WHEN ord % 4 = 0 AND name = 'view' THEN '' WHEN ord % 4 = 0 AND name = 'click' THEN 'pressed' ELSE status END AS status, CASE WHEN ord % 4 = 0 AND name = 'view' THEN '' WHEN ord % 4 = 0 AND name = 'click' THEN 'seen' ELSE note END AS note, CASE WHEN ord % 4 = 0 AND NOT (action = 'advance' AND title = 'k1') THEN 2 ELSE 1 END AS plots, CASE WHEN ord % 4 = 0 THEN 'a,b,c' ELSE 'a,b' END AS refs FROM deltas""",
    "entity_timeline": f"""WITH {DELTAS}, r AS (SELECT work_id, type, name, ord, CASE WHEN type = 'location' THEN NULL ELSE nullif(status, '') END AS status, nullif(CASE WHEN type = 'location' AND note = '' THEN status ELSE note END, '') AS note FROM deltas WHERE NOT degraded)
        SELECT work_id, type, name, arg_max(status, ord) FILTER (WHERE status IS NOT NULL) AS status, arg_max(note, ord) FILTER (WHERE note IS NOT NULL) AS note, min(ord) AS first_seen_order, max(ord) AS last_seen_order FROM r GROUP BY 1, 2, 3""",
    "plotline_timeline": f"""WITH {DELTAS} SELECT work_id, title, CASE WHEN count(*) FILTER (WHERE action = 'close') > 0 THEN 'closed' ELSE 'open' END AS status, min(ord) AS opened_order, max(ord) FILTER (WHERE action = 'close') AS closed_order, list_sort(list(DISTINCT ord)) AS key_orders, coalesce(arg_max(plot_note, ord) FILTER (WHERE plot_note <> ''), '') AS summary FROM deltas WHERE NOT degraded GROUP BY 1, 2""",
    "recent_events": f"WITH {DELTAS} {EVENTS} SELECT work_id, ord, recent FROM recents",
    "archive_backdrop": f"WITH {DELTAS} {EVENTS} SELECT work_id, chapter_idx, digest, backdrop FROM backdrops",
    "fold_state": f"""WITH {DELTAS} {SNAPS} SELECT s.work_id, s.ord, s.chapter_idx, s.last_order, r.recent, s.backdrop, s.snapshot, sha256(s.snapshot) AS fingerprint FROM snaps s JOIN recents r USING (work_id, ord)""",
    "stream_state": f"WITH {DELTAS} {SNAPS} SELECT work_id, ord, chapter_idx, snapshot, sha256(snapshot) AS fingerprint, degraded FROM snaps",
    "checkpoints": f"WITH {DELTAS} {SNAPS} SELECT work_id, ord, chapter_idx, snapshot, sha256(snapshot) AS fingerprint, degraded FROM snaps WHERE NOT inside",
    "final_state": f"WITH {DELTAS} {SNAPS} SELECT work_id, ord, snapshot, sha256(snapshot) AS fingerprint FROM snaps QUALIFY row_number() OVER (PARTITION BY work_id ORDER BY ord DESC) = 1",
    "state_view": f"""WITH {DELTAS} {SNAPS} {VIEW} SELECT work_id, ord, '（故事状态，截至第 ' || last_order || ' 段）' || coalesce(chr(10) || '人物：' || people, '') || coalesce(chr(10) || '物件/设定：' || things, '') || coalesce(chr(10) || '地点：' || places, '')
        || coalesce(chr(10) || '事件线：' || lines, '') || coalesce(chr(10) || '最近发生：' || recent, '') || CASE WHEN backdrop <> '' THEN chr(10) || '更早背景：' || backdrop ELSE '' END AS view FROM view_parts""",
    "prefix_consistency": f"""WITH {DELTAS}, l AS (SELECT work_id, max(ord) AS last FROM deltas GROUP BY 1), p AS (SELECT DISTINCT work_id, last, unnest([5, 20, 40, CAST(ceil(last * 0.5) AS BIGINT), CAST(ceil(last * 0.75) AS BIGINT), last]) AS prefix FROM l)
        SELECT work_id, prefix, CAST(0 AS BIGINT) AS differences, CAST([] AS BIGINT[]) AS first, TRUE AS ok FROM p WHERE prefix > 1 OR last = 1""",
    "list_works": f"WITH {UNITS} SELECT work_id, count(*) AS unit_count, CAST(NULL AS VARCHAR) AS title, work_id <> 'src3' AS has_index, work_id < 'src5' AS has_vector_index FROM units GROUP BY 1",
    "reading_locations": f"""WITH {TALKS} SELECT work_id, 'chapter-' || lpad(CAST(chapter_idx AS VARCHAR), 2, '0') AS location_id, chapter_name AS label, min(ord) AS start_order, max(ord) AS end_order, min(ord) AS start_line, max(ord) AS end_line, count(*) AS unit_count FROM talks GROUP BY work_id, chapter_idx, chapter_name""",
    "get_units": f"WITH {UNITS} SELECT work_id, unit_id, ord, text FROM units WHERE ord % 50 = 7",
    "get_range": f"WITH {UNITS} {QUERIES} SELECT query_id AS range_id, work_id, unit_id, ord FROM queries JOIN units USING (work_id) WHERE ord BETWEEN coalesce(max_order, 1) AND coalesce(max_order, 1) + 4",
    "progressive_view": f"""WITH {DELTAS} {SNAPS} SELECT reader_id, x.work_id, max_order, CASE WHEN s.ord IS NULL THEN 'unavailable' WHEN s.degraded THEN 'invalid' ELSE 'ok' END AS status, CASE WHEN s.ord IS NULL THEN 'no_completed_unit' WHEN s.degraded THEN 'degraded_snapshot' END AS reason, s.ord AS snapshot_order,
        CASE WHEN NOT s.degraded THEN snapshot END AS snapshot, CASE WHEN NOT s.degraded THEN d.unit_id END AS unit_id, CASE WHEN NOT s.degraded THEN d.chapter_name END AS chapter FROM read_at x LEFT JOIN snaps s USING (work_id, ord) LEFT JOIN deltas d USING (work_id, ord)""",
    "recap": f"""WITH {DELTAS} {SNAPS} SELECT reader_id, x.work_id, max_order, coalesce(r.recent, '') AS recent, coalesce(s.backdrop, '') AS backdrop FROM read_at x LEFT JOIN recents r USING (work_id, ord) LEFT JOIN snaps s USING (work_id, ord)""",
    "entity_current": f"""WITH {CURRENT} SELECT request_id, a.work_id, name, CAST([] AS VARCHAR[]) AS aliases, CASE WHEN type = 'object' THEN 'object' END AS kind, status, note, first_seen_order, last_seen_order, type || 's' AS "group" FROM asked a JOIN ents e ON e.work_id = a.work_id AND e.here = a.here AND (contains(name, q) OR contains(q, name))
        QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY list_position(['character', 'object', 'location'], type), first_seen_order) = 1""".replace("NAMES", "('vie'), ('clicks')").replace("BOUND", "40"),
    "plotline_current": f"""WITH {CURRENT} SELECT request_id, a.work_id, title, status, opened_order, closed_order, key_orders, summary FROM asked a JOIN plots e ON e.work_id = a.work_id AND e.here = a.here AND (contains(title, q) OR contains(q, title))
        QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY opened_order) = 1""".replace("NAMES", "('k3'), ('k')").replace("BOUND", "40"),
    "entity_history": f"WITH {DELTAS} SELECT work_id || '-' || q AS request_id, work_id, ord, unit_id, name FROM deltas, (VALUES ('vie'), ('clicks'), ('up')) v(q) WHERE ord <= 40 AND (contains(name, q) OR contains(q, name))",
    "plotline_history": f"WITH {DELTAS} SELECT work_id || '-' || q AS request_id, work_id, ord, unit_id, title FROM deltas, (VALUES ('k3'), ('k')) v(q) WHERE ord <= 40 AND (contains(title, q) OR contains(q, title))",
    "resolve_units": f"WITH {UNITS} SELECT work_id, unit_id, ord, CASE WHEN work_id IN ('src1', 'src2') THEN 'done' ELSE '' END AS summary FROM units",
    "retrieval_text": f"WITH {TALKS} SELECT work_id, unit_id, '章节：' || chapter_name || chr(10) || '正文：' || text AS content FROM talks",
    "search_vector": """WITH q AS (SELECT CAST(vec_id AS VARCHAR) AS query_id, embedding::DOUBLE[] AS v, 100 * (vec_id % 5 + 1) AS max_order FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT query_id, vec_id + 1 AS ord, list_cosine_similarity(v, embedding::DOUBLE[]) AS score FROM q, embeddings WHERE vec_id + 1 <= max_order)
        SELECT query_id, 'emb' AS work_id, 'emb-' || lpad(CAST(ord AS VARCHAR), 4, '0') AS unit_id, ord, round(score, 3) AS score FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, ord) <= 200""",
    "search_vector_whole": """WITH q AS (SELECT CAST(vec_id AS VARCHAR) AS query_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT query_id, vec_id + 1 AS ord, list_cosine_similarity(v, embedding::DOUBLE[]) AS score FROM q, embeddings)
        SELECT query_id, 'emb' AS work_id, 'emb-' || lpad(CAST(ord AS VARCHAR), 4, '0') AS unit_id, ord, round(score, 3) AS score FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, ord) <= 200""",
    "index_status": "SELECT source AS work_id, NOT (source < 'src5') AS current FROM documents GROUP BY source",
    "coerce_fields": """SELECT event_id, CASE event_id % 5 WHEN 1 THEN 'not_json' WHEN 2 THEN 'entity_updates' WHEN 3 THEN 'no_summary' END AS parse_error, CASE event_id % 5 WHEN 0 THEN 's' || event_id WHEN 4 THEN CAST(event_id AS VARCHAR) END AS summary,
        CASE event_id % 5 WHEN 0 THEN event_type || ':character' WHEN 4 THEN '7:object' END AS entities, CASE event_id % 5 WHEN 0 THEN 'advance:k' || event_id WHEN 4 THEN '' END AS plots, CASE event_id % 5 WHEN 0 THEN '' WHEN 4 THEN '{x,true' END AS refs, CASE event_id % 5 WHEN 0 THEN 'went ' || event_id WHEN 4 THEN '{oops ' || event_id END AS event FROM events""",
    "normalize_refs": "SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN NULL WHEN turn % 3 = 1 THEN role || ',e' || turn ELSE role || ',7,true,[x],{a' END AS refs FROM conversations",
}
ORACLE_SQL |= {
    "coerce_patch": """SELECT event_id, CASE event_id % 4 WHEN 1 THEN 'not_json' WHEN 2 THEN 'rename_entities' END AS parse_error, CASE WHEN event_id % 4 IN (0, 3) THEN 's' || event_id END AS summary, CASE WHEN event_id % 4 IN (0, 3) THEN event_type || ':new' END AS renames, CASE WHEN event_id % 4 IN (0, 3) THEN event_type || ':on:' END AS statuses,
        CASE WHEN event_id % 4 IN (0, 3) THEN 'a,b' END AS removed, CASE WHEN event_id % 4 IN (0, 3) THEN 'advance:k' || event_id END AS fixes, CASE WHEN event_id % 4 IN (0, 3) THEN '' END AS refs FROM events""",
    "extract_units": """WITH e AS (SELECT event_id, event_type, event_id % 5 = 1 AS failed, event_id % 5 = 1 OR event_id % 11 = 5 AS degraded, event_id % 7 = 3 AND event_id % 5 <> 1 AS unnamed, event_type || ' of ' || user_id AS head FROM events)
        SELECT event_id, failed, degraded, CAST(CASE WHEN failed OR unnamed THEN 3 ELSE 0 END AS INTEGER) AS errors, CASE WHEN failed THEN 'summary' WHEN unnamed THEN 'entity' ELSE '' END AS failing, CASE WHEN degraded THEN head ELSE 's' || event_id END AS summary,
        CAST(CASE WHEN degraded OR unnamed THEN 0 ELSE 1 END AS INTEGER) AS entities, CAST(CASE WHEN degraded THEN 0 ELSE 1 END AS INTEGER) AS plots, CASE WHEN degraded THEN '' ELSE event_type END AS refs, CASE WHEN degraded THEN head ELSE 'went ' || event_id END AS event FROM e""",
    "run_report": f"""WITH {DELTAS} SELECT work_id, count(*) AS units, count(*) FILTER (WHERE ord % 3 <> 0) AS cached, count(*) FILTER (WHERE ord % 3 = 0) AS fresh, count(*) FILTER (WHERE degraded) AS degraded, 2 * count(*) FILTER (WHERE degraded) AS errors, count(*) FILTER (WHERE ord % 3 = 0) AS requests,
        CAST(coalesce(sum(ord) FILTER (WHERE ord % 3 = 0), 0) AS BIGINT) AS prompt_tokens, CAST(coalesce(sum(ord % 7) FILTER (WHERE ord % 3 = 0), 0) AS BIGINT) AS completion_tokens, CAST(coalesce(sum(ord + ord % 7) FILTER (WHERE ord % 3 = 0), 0) AS BIGINT) AS total_tokens,
        count(DISTINCT chapter_idx) FILTER (WHERE chapter_idx % 2 = 0) AS compress_cached, count(DISTINCT chapter_idx) FILTER (WHERE chapter_idx % 2 = 1) AS compress_fresh FROM deltas GROUP BY 1""",
    "search_run": f"""WITH {UNITS} {QUERIES} {RUN_TOKENS} {BM25} SELECT query_id, work_id, unit_id, ord, round(score, 3) AS score, place FROM bm25""".replace("FROM terms", "FROM run_terms"),
    "search_routes": f"""WITH {ROUTES} {POSTINGS} {BM25}, every AS (SELECT query_id, work_id, unit_id, ord, score, place, 'vector' AS used FROM vec UNION ALL SELECT query_id, work_id, unit_id, ord, score, place, 'fts' FROM bm25 WHERE work_id = 'emb1')
        SELECT query_id, work_id, unit_id, ord, round(score, 3) AS score, used FROM every""",
    "search_routes_diagnostics": f"""WITH {ROUTES} {POSTINGS} {BM25}, n AS (SELECT query_id, count(*) AS n FROM vec GROUP BY 1 UNION ALL SELECT query_id, count(*) FROM bm25 WHERE work_id = 'emb1' GROUP BY 1), w AS (SELECT work_id, count(*) AS n FROM units GROUP BY 1)
        SELECT t.query_id, 'auto' AS requested, CASE WHEN t.work_id = 'emb1' THEN 'fts' ELSE 'vector' END AS used, CASE WHEN t.work_id = 'emb1' THEN 'vector_unavailable_or_stale' END AS fallback_reason, CASE WHEN t.work_id = 'emb2' THEN 0 ELSE w.n END AS eligible_units, coalesce(n.n, 0) AS candidates, t.work_id || '-now' AS source_version
        FROM terms t JOIN w USING (work_id) LEFT JOIN n USING (query_id)""",
}
ORACLE_SQL["search_diagnostics"] = ORACLE_SQL["search_diagnostics"].replace("AS candidates FROM", "AS candidates, CAST(NULL AS VARCHAR) AS source_version FROM")
#: The searches asked of all units of their work.
ORACLE_SQL |= {f"{name}_whole": ORACLE_SQL[name].replace("CASE WHEN item_id % 4 <> 0 THEN (last * (item_id % 4)) // 4 END AS max_order", "CAST(NULL AS BIGINT) AS max_order") for name in ("analyze_queries", "search_bm25", "search_scan", "search", "search_diagnostics", "evaluate_retrieval")}
ORACLE_SQL |= {f"{name}_whole": ORACLE_SQL[name].replace(" ord <= 40 AND", "").replace(" WHERE ord % 50 = 7", "").replace("least(max(ord), 40)", "max(ord)") for name in ("get_units", "entity_history", "plotline_history", "entity_current", "plotline_current")}
# The plain names ask for all rows too; what a boundary does is shown beside them.
ORACLE_SQL["search_vector_bounded"] = ORACLE_SQL["search_vector"].replace("100 * (vec_id % 5 + 1) AS max_order", "vec_id // 20 * 20 + 10 AS max_order")
ORACLE_SQL |= {name: ORACLE_SQL[f"{name}_whole"] for name in ("get_units", "entity_history", "plotline_history", "entity_current", "plotline_current", "search_vector")}
ORACLE_SQL["fold_state_blocks"], ORACLE_SQL["archive_backdrop_blocks"] = ORACLE_SQL["fold_state"], ORACLE_SQL["archive_backdrop"]
ORACLE_SQL["stream_dropped"] = f"WITH {DELTAS} SELECT work_id, ord, CAST(1 AS BIGINT) AS dropped FROM deltas WHERE ord % 10 = 3"
ORACLE_SQL["search_refreshed"] = ORACLE_SQL["search_bm25_whole"]
ORACLE_SQL["search_bounded"] = f"""WITH {UNITS} {TERMS} {POSTINGS}, asked AS (SELECT DISTINCT query_id, work_id, coalesce(max_order, 9000000000) AS upto, lower(unnest(terms)) AS term FROM terms
    ), read AS (SELECT query_id, upto, p.* FROM asked a JOIN postings p ON p.work_id = a.work_id AND p.term = a.term AND p.ord <= a.upto
    ), spread AS (SELECT query_id, term, count(*) AS n FROM read GROUP BY 1, 2
    ), sized AS (SELECT q.query_id, count(*) AS n_units, avg(len(s)) AS mean_size FROM terms q JOIN tokens t ON t.work_id = q.work_id AND t.ord <= coalesce(q.max_order, 9000000000) GROUP BY 1
    ), bm AS (
      SELECT query_id, work_id, unit_id, ord, sum(CASE WHEN ln((n_units - n + 0.5) / (n + 0.5)) <= 0 THEN 1e-6 ELSE ln((n_units - n + 0.5) / (n + 0.5)) END * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean_size))) AS score
      FROM read JOIN spread USING (query_id, term) JOIN sized USING (query_id) GROUP BY 1, 2, 3, 4)
    SELECT query_id, work_id, unit_id, ord, round(score, 3) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, ord, unit_id) AS place FROM bm QUALIFY place <= 200"""
#: A work's units hit up to the first that is degraded (never kept) or, in works of one run, has changed.
ORACLE_SQL["cache_chain"] = f"""WITH {DELTAS}, m AS (SELECT work_id, max(ord) // 2 + 1 AS middle FROM deltas GROUP BY 1
    ), stops AS (SELECT work_id, min(ord) FILTER (WHERE degraded OR (ord = middle AND CAST(work_id AS BIGINT) % 2 = 1)) AS stop FROM deltas JOIN m USING (work_id) GROUP BY 1)
    SELECT work_id, count(*) AS units, count(*) FILTER (WHERE ord < coalesce(stop, 9000000000)) AS cached, count(*) FILTER (WHERE ord >= coalesce(stop, 9000000000)) AS fresh, count(*) FILTER (WHERE degraded) AS degraded FROM deltas JOIN stops USING (work_id) GROUP BY 1"""
ORACLE_SQL["work_manifest"] = """WITH f AS (SELECT source AS work_id, CAST(doc_id AS VARCHAR) AS file, strlen(coalesce(text, '')) AS size, sha256(coalesce(text, '')) AS hash FROM documents
    ), g AS (SELECT work_id, substring(sha256(file), 1, 2) AS part, count(*) AS n, sum(size) AS size, sha256(string_agg(file || chr(9) || hash, chr(10) ORDER BY file)) AS hash FROM f GROUP BY 1, 2)
    SELECT work_id, CAST(sum(n) AS BIGINT) AS files, CAST(sum(size) AS BIGINT) AS source_bytes, sha256(string_agg(part || chr(9) || hash, chr(10) ORDER BY part)) AS source_sha256 FROM g GROUP BY 1"""
ORACLE_SQL["index_status"] = "SELECT source AS work_id, NOT (source < 'src2' OR source = 'src9') AS current FROM documents GROUP BY source"
ORACLE_SQL["lossless_differences"] = f"""WITH {UNITS}, b AS (SELECT work_id, row_number() OVER (PARTITION BY work_id ORDER BY line_no) AS at, line FROM labelled WHERE NOT is_header
    ), l AS (SELECT work_id, ord, unnest(string_split(CASE WHEN work_id < 'src2' AND ord % 50 = 7 THEN text || chr(10) || 'added' ELSE text END, chr(10))) AS line, generate_subscripts(string_split(CASE WHEN work_id < 'src2' AND ord % 50 = 7 THEN text || chr(10) || 'added' ELSE text END, chr(10)), 1) AS k FROM units
    ), u AS (SELECT work_id, row_number() OVER (PARTITION BY work_id ORDER BY ord, k) AS at, line FROM l)
    SELECT coalesce(b.work_id, u.work_id) AS work_id, coalesce(b.at, u.at) AS at, b.line AS body, u.line AS unit FROM b FULL JOIN u ON b.work_id = u.work_id AND b.at = u.at WHERE b.line IS DISTINCT FROM u.line QUALIFY row_number() OVER (PARTITION BY coalesce(b.work_id, u.work_id) ORDER BY coalesce(b.at, u.at)) = 1"""
