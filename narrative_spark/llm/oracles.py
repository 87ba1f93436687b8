"""DuckDB SQL for the rows of registered queries, where SQL can express them."""

from narrative_spark.llm.rules import STOP_WORDS

OP4 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item, least(13, len(words)) AS size, list_slice(words, k, k + least(13, len(words)) - 1) AS gram
  FROM (SELECT item, words, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS k FROM i WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS k FROM w, sizes WHERE len(words) >= size
), found AS (
  SELECT p.doc_id, p.k, p.size, v.item FROM (SELECT doc_id, k, size, list_slice(words, k, k + size - 1) AS gram FROM places) p JOIN windows v USING (size, gram)
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP8 = r"""
WITH a AS (
  SELECT page_id, sha256(html) AS hash, strlen(html) AS length, coalesce(sum(strlen(html)) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM pages
), b AS (
  SELECT page_id, sha256(CASE WHEN page_id % 97 = 13 THEN '~' || substring(html, 2) ELSE html END) AS hash FROM pages WHERE page_id % 101 <> 50
)
SELECT a.page_id, CASE WHEN b.hash IS NULL THEN 'missing' ELSE 'corrupt' END AS status, CAST(a.place AS BIGINT) AS "offset", a.length AS length, a.hash AS hash_left, b.hash AS hash_right
FROM a LEFT JOIN b USING (page_id) WHERE a.hash IS DISTINCT FROM b.hash
"""

#: The rules' votes, in the order of rules.rules().
_RULES = [
    ("n_words < 20", "n_words >= 50"),
    ("2 * word_chars < 5 * n_words OR word_chars > 12 * n_words", "word_chars >= 3 * n_words AND word_chars <= 9 * n_words"),
    ("5 * n_symbols > n_words", "50 * n_symbols < n_words"),
    ("10 * n_symbols > word_chars", "100 * n_symbols < word_chars"),
    ("10 * n_bare > n_words", "50 * n_bare < n_words"),
    ("2 * n_dup_lines > n_lines", "10 * n_dup_lines < n_lines"),
    ("4 * n_repeat_words > n_words", "20 * n_repeat_words <= n_words"),
    ("4 * n_capitals > word_chars", "20 * n_capitals < word_chars"),
    ("n_stops = 0 AND n_words >= 30", "n_stops >= 2"),
    ("CASE WHEN n_words <= 500 THEN 5 * n_distinct < n_words ELSE n_distinct < 100 END", "CASE WHEN n_words <= 500 THEN 3 * n_distinct > n_words ELSE n_distinct > 150 END"),
]


def _em(voters: int, prior: float, yes: float, no: float, rounds: int, weight: float = 10.0) -> str:
    """Expectation-maximisation over patterns (votes, n), as a recursive table em (step, yes, no, prior)."""
    odds = " + ".join(f"CASE votes[{j}] WHEN 1 THEN ln(yes[{j}] / (1 - no[{j}])) WHEN 0 THEN ln((1 - yes[{j}]) / no[{j}]) ELSE 0.0 END" for j in range(1, voters + 1))
    share = lambda vote, p, begin: ", ".join(f"greatest(0.02, least(0.998, (sum(CASE WHEN votes[{j}] = {vote} THEN n * {p} ELSE 0 END) + {weight * begin}) / (sum(CASE WHEN votes[{j}] IS NULL THEN 0 ELSE n * {p} END) + {weight})))" for j in range(1, voters + 1))
    least = ", ".join(f"greatest(no[{j}], 1.02 - yes[{j}])" for j in range(1, voters + 1))
    return f"""em AS (
  SELECT 0 AS step, list_transform(range({voters}), lambda x: {yes}::DOUBLE) AS yes, list_transform(range({voters}), lambda x: {no}::DOUBLE) AS no, {prior}::DOUBLE AS prior
  UNION ALL
  SELECT step + 1, yes, [{least}], prior FROM (
    SELECT step, [{share(1, "p", yes)}] AS yes, [{share(0, "(1 - p)", no)}] AS no, greatest(0.01, least(0.99, (sum(n * p) + {weight * prior}) / (sum(n) + {weight}))) AS prior
    FROM (SELECT step, votes, n, 1 / (1 + exp(-(ln(prior / (1 - prior)) + {odds}))) AS p FROM em, patterns WHERE step < {rounds}) GROUP BY step)
), posterior AS (
  SELECT votes, 1 / (1 + exp(-(ln(prior / (1 - prior)) + {odds}))) AS good FROM em, patterns WHERE step = {rounds}
)"""


OP6 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents
), grams AS (SELECT r, k, list_slice(words, k, k + 7) AS gram FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS k FROM w WHERE len(words) >= 8)
), twice AS (SELECT r, unnest(list(k)) AS k FROM grams GROUP BY r, gram HAVING count(*) > 1
), covered AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(k, k + 8)) AS place FROM twice) GROUP BY r
), m AS (
  SELECT w.doc_id, w.r, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, len(list_distinct(words)) AS n_distinct, len(list_intersect(list_distinct(words), {STOP_WORDS})) AS n_stops, len(regexp_extract_all(text, '[A-Z]')) AS n_capitals,
    len(list_filter(words, lambda x: regexp_full_match(x, '[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS n_bare FROM w LEFT JOIN covered c USING (r)
), v AS (SELECT *, [{", ".join(f"CASE WHEN n_words = 0 THEN NULL WHEN {bad} THEN 0 WHEN {good} THEN 1 END" for bad, good in _RULES)}] AS votes FROM m
), patterns AS (SELECT votes, count(*)::DOUBLE AS n FROM v GROUP BY votes
), {_em(len(_RULES), 0.9, 0.97, 0.4, 30)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND good >= 0.5 AS kept
FROM v JOIN posterior p ON p.votes IS NOT DISTINCT FROM v.votes
"""

OP12 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), first AS (SELECT text, min(doc_id) AS least FROM w GROUP BY text
), failed AS (
  SELECT part, (CASE WHEN len(words) < 50 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 'C' ELSE '' END) || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > least THEN 'E' ELSE '' END) AS fails,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
  FROM w JOIN first USING (text)
), sets AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM failed GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), grown AS (
  SELECT '' AS filter_order UNION ALL SELECT filter_order || letter FROM grown, letters WHERE NOT contains(filter_order, letter)
), orders AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM grown WHERE length(filter_order) = 5
), judged AS (
  SELECT part, fails, n, n_good, n_toxic, filter_order, step, substring(filter_order, step, 1) AS own, contains(fails, substring(filter_order, step, 1)) AS bad,
    regexp_matches(fails, '[' || substring(filter_order || '-', 1, step - 1) || '-]') AND fails <> '' AS gone
  FROM sets, orders
), shares AS (SELECT part, letter, CAST(sum(CASE WHEN contains(fails, letter) THEN n * 120 // length(fails) ELSE 0 END) AS BIGINT) AS shapley FROM sets, letters GROUP BY part, letter
), steps AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT bad AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (bad AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (bad AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER (bad AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(n_toxic) FILTER (bad AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, own
)
SELECT s.part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley FROM steps s JOIN shares h ON s.part = h.part AND s.own = h.letter
"""

ORACLE_SQL = {
    "op4_decontamination": OP4,
    "op6_quality_rules": OP6,
    "op8_merkle_audit": OP8,
    "op12_filter_audit": OP12,
}
