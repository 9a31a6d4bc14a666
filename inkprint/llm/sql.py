"""The queries of this package in DuckDB SQL, where SQL can express them."""

from inkprint.llm.url_filter import LIMIT, SOFT, STRICT

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Fixed values of the contract.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP6_SQL = r"""
WITH told AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t, """ + _WORDS + r""" AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS x
  FROM documents),
starts AS (SELECT rid, len(w) AS n, unnest(range(1, len(w) - 3)) AS i, w FROM told WHERE len(w) >= 5),
windows AS (SELECT rid, i, w[i:i+4] AS g FROM starts),
again AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) >= 2),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM again) GROUP BY rid),
measured AS (
  SELECT told.rid, doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(x) AS n_lines, len(x) - len(list_distinct(x)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
         length(t) - length(regexp_replace(t, '[!?\\^~=_+]', '', 'g')) AS n_marks
  FROM told LEFT JOIN covered ON told.rid = covered.rid),
rated AS (
  SELECT rid, lang, source, unnest(['symbols', 'repeats', 'dup_lines', 'capitals', 'marks']) AS rate,
         unnest([1000 * n_symbols // greatest(word_chars, 1), 1000 * n_repeat_words // greatest(n_words, 1),
                 1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_capitals // greatest(word_chars, 1),
                 1000 * n_marks // greatest(word_chars, 1)]) AS v,
         unnest([25, 60, 150, 60, 30]) AS least_range
  FROM measured),
celled AS (
  SELECT *, CASE WHEN v < 16 THEN v ELSE (length(bin(v)) - 4) * 16 + (v >> (length(bin(v)) - 5)) - 16 END AS cell FROM rated),
own AS (SELECT lang AS l, source AS s, rate, least_range, cell, count(*) AS n FROM celled GROUP BY ALL),
of_lang AS (SELECT l, rate, least_range, cell, sum(n)::BIGINT AS n FROM own GROUP BY ALL),
of_all AS (SELECT rate, cell, sum(n)::BIGINT AS n FROM of_lang GROUP BY ALL),
all_share AS (SELECT rate, cell, 6400 * n // (sum(n) OVER (PARTITION BY rate))::BIGINT AS n FROM of_all),
lang AS (
  SELECT l, rate, least_range, cell, sum(n)::BIGINT AS n
  FROM (SELECT l, rate, least_range, cell, 64 * n AS n FROM of_lang
        UNION ALL SELECT l, rate, least_range, p.cell, p.n
        FROM (SELECT DISTINCT l, rate, least_range FROM of_lang) JOIN all_share p USING (rate))
  GROUP BY ALL),
lang_share AS (SELECT l, rate, cell, 6400 * n // (sum(n) OVER (PARTITION BY l, rate))::BIGINT AS n FROM lang),
blended AS (
  SELECT l, s, rate, least_range, cell, sum(n)::BIGINT AS n
  FROM (SELECT l, s, rate, least_range, cell, 64 * n AS n FROM own
        UNION ALL SELECT o.l, o.s, o.rate, o.least_range, p.cell, p.n
        FROM (SELECT DISTINCT l, s, rate, least_range FROM own) o
        JOIN lang_share p ON p.l IS NOT DISTINCT FROM o.l AND p.rate = o.rate)
  WHERE n > 0 GROUP BY ALL),
ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY l, s, rate) AS whole, sum(n) OVER (PARTITION BY l, s, rate ORDER BY cell) AS upto FROM blended),
quartiles AS (
  SELECT l, s, rate, least_range, min(cell) FILTER (4 * upto >= whole) AS c1, min(cell) FILTER (4 * upto >= 3 * whole) AS c3
  FROM ranked GROUP BY ALL),
valued AS (
  SELECT *, CASE WHEN c1 < 16 THEN c1 ELSE (c1 % 16 + 16) * pow(2, c1 // 16 - 1) END AS q1,
         CASE WHEN c3 < 16 THEN c3 ELSE (c3 % 16 + 16) * pow(2, c3 // 16 - 1) END AS q3
  FROM quartiles),
fenced AS (SELECT l, s, rate, q3 + 3 * greatest(q3 - q1, least_range) AS fence FROM valued),
beyond AS (
  SELECT c.rid, bool_or(c.v > f.fence) AS beyond
  FROM celled c
  JOIN fenced f ON f.l IS NOT DISTINCT FROM c.lang AND f.s IS NOT DISTINCT FROM c.source AND f.rate = c.rate
  GROUP BY c.rid)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT beyond AS kept
FROM measured JOIN beyond ON measured.rid = beyond.rid"""

OP10_SQL = r"""
WITH told AS (
  SELECT kind, id, list_filter(string_split_regex(regexp_replace(lower(coalesce(text, '')), '[!-/:-@\[-`{-~]+', '', 'g'),
                               '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM (SELECT 'doc' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'item', item_id, text FROM benchmark)),
grams AS (
  SELECT DISTINCT kind, id, array_to_string(w[i:i+k-1], ' ') AS g, k
  FROM (SELECT kind, id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM (SELECT kind, id, w, unnest(CASE WHEN kind = 'doc' THEN range(1, 6) ELSE [least(5, len(w))] END) AS k FROM told)
        WHERE k >= 1 AND len(w) >= k)),
sizes AS (SELECT id, count(*) AS n FROM grams WHERE kind = 'item' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, any_value(s.n) AS n_windows, count(*) AS n_shared
FROM grams i JOIN grams d ON i.kind = 'item' AND d.kind = 'doc' AND i.k = d.k AND i.g = d.g JOIN sizes s ON s.id = i.id
GROUP BY d.id, i.id HAVING count(*) * 5 >= 4 * any_value(s.n)"""


def _op1() -> str:
    rules = sorted(URL_RULES, key=lambda r: (-len(r[0]), r[0]))
    fits = lambda r: f"(host = '{r[: r.index('/')]}' OR ends_with(host, '.{r[: r.index('/')]}')) AND starts_with(path, '{r[r.index('/'):]}')"
    rule = " ".join(f"WHEN {fits(r)} THEN '{r}'" for r, _ in rules)
    verdict = " ".join(f"WHEN {fits(r)} THEN '{v}'" for r, v in rules)
    hit = lambda t: f"CAST(regexp_matches(u, '(^|[^0-9a-z]){t}([^0-9a-z]|$)') AS BIGINT)"
    return f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{UPPER.lower()}') AS u,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{UPPER.lower()}') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
counted AS (
  SELECT *, {" + ".join(hit(t) for t in STRICT)} AS n_strict, {" + ".join(hit(t) for t in SOFT)} AS n_soft FROM parts)
SELECT page_id, host, path, CASE {rule} END AS rule, n_strict, n_soft,
       CASE {verdict} WHEN n_strict > 0 OR n_soft >= {LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM counted"""


OP1_SQL = _op1()

OP13_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS id, CAST(list_dot_product(a.vec, r.vec) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER w <= 3
"""
