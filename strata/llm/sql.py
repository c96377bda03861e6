"""SQL that the registered queries must agree with, where SQL can express them."""

from __future__ import annotations

from strata.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}', '{w.capitalize()}'" for w in STOP_WORDS)

#: Measures of every row of ``documents`` and the verdict of the threshold table.
QUALITY_RULES = rf"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, lang, t,
    list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> '') AS ls
  FROM d),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
dup AS (
  SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
cov AS (
  SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM dup) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, w.lang, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
    len(list_filter(ws, lambda x: x IN ({_STOP}))) AS n_stop,
    len(list_filter(ws, lambda x: x = upper(x) AND x <> lower(x) AND length(x) > 1)) AS n_loud
  FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
v AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    n_words > 0 AND (
      word_chars / n_words < 2.0 OR word_chars / n_words > 14.0
      OR n_symbols / n_words > 0.3
      OR n_words >= 50 AND n_stop / n_words < 0.02 AND coalesce(lang, '') IN ('en', 'fr', 'de', 'es')
      OR n_loud / n_words > 0.3)
    OR n_lines > 0 AND n_dup_lines / n_lines > 0.5 AS broken
  FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND NOT broken AS kept
FROM v
"""

#: Pages as captures, and the last entry of each matching pattern on or before the day of the fetch.
URL_LISTS = r"""
WITH c AS (
  SELECT page_id, url, CAST((page_id * 7919) % 366 AS INTEGER) AS day,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)', 1) AS path,
    page_id * 37 + length(url) AS k
  FROM pages),
e AS (
  SELECT CASE k % 3 WHEN 0 THEN 'host:' || host
      WHEN 1 THEN 'path:' || host || regexp_extract(path, '^(/[^/?#]*/)', 1)
      ELSE 'domain:' || regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) END AS pattern,
    CAST((k * 13) % 366 AS INTEGER) AS day, (k // 11) % 3 <> 0 AS listed
  FROM c WHERE k % 11 = 0),
d AS (
  SELECT pattern, day, bool_or(listed) AS listed FROM e GROUP BY pattern, day),
p AS (
  SELECT DISTINCT url, day, unnest(list_concat(
    ['host:' || host],
    [ 'domain:' || array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.') for i in range(1, len(string_split(host, '.')) + 1) ],
    [ 'path:' || host || array_to_string(list_slice(string_split(path, '/'), 1, i), '/') || '/' for i in range(1, len(string_split(path, '/'))) ]
  )) AS pattern FROM c),
s AS (
  SELECT p.url, p.day, p.pattern, arg_max(d.listed, d.day) AS listed
  FROM p JOIN d ON p.pattern = d.pattern AND d.day <= p.day GROUP BY ALL),
r AS (
  SELECT url, day, pattern AS rule FROM s WHERE listed
  QUALIFY row_number() OVER (PARTITION BY url, day ORDER BY
    CASE split_part(pattern, ':', 1) WHEN 'path' THEN 3 WHEN 'host' THEN 2 ELSE 1 END DESC, length(pattern) DESC, pattern DESC) = 1)
SELECT c.page_id, c.url, c.day, r.rule IS NOT NULL AS blocked, r.rule
FROM c LEFT JOIN r ON c.url = r.url AND c.day = r.day
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Scores of all documents for all items in whole numbers, and the first ten of each item.
LEXICAL_SEARCH = rf"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
d AS (
  SELECT doc_id, CAST(len(ts) AS BIGINT) AS n FROM t WHERE len(ts) > 0),
s AS (
  SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d),
f AS (
  SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM t) GROUP BY ALL),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, CAST(count(*) AS BIGINT) AS df FROM f GROUP BY term), s),
r AS (
  SELECT item_id, f.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
  FROM i JOIN f ON i.term = f.term JOIN w ON w.term = f.term JOIN d ON d.doc_id = f.doc_id, s
  GROUP BY item_id, f.doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 10
"""

#: Every n-gram of a piece counted, and the phrases ranked.
COLLOCATIONS = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (
  SELECT lang, k, unnest([array_to_string(list_slice(ws, i, i + k - 1), ' ') for i in range(1, len(ws) - k + 2)]) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS (
  SELECT lang, k, phrase, CAST(count(*) AS BIGINT) AS f FROM g GROUP BY ALL),
n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
x AS (
  SELECT lang, k, phrase, a, array_to_string(list_slice(ws, 1, j), ' ') AS p1, array_to_string(list_slice(ws, j + 1, k), ' ') AS p2, j
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
y AS (
  SELECT x.lang, x.k, x.phrase, a, u.f AS l, v.f AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (CAST(u.f AS HUGEINT) + v.f) AS BIGINT) AS score
  FROM x JOIN f u ON u.lang = x.lang AND u.phrase = p1 JOIN f v ON v.lang = x.lang AND v.phrase = p2
  QUALIFY row_number() OVER (PARTITION BY x.lang, x.phrase ORDER BY score, j) = 1),
o AS (
  SELECT lang, phrase, max(a) AS b FROM (
    SELECT lang, a, unnest([array_to_string(list_slice(ws, i, i + m - 1), ' ') for i in range(1, k - m + 2)]) AS phrase
    FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k)
  GROUP BY ALL)
SELECT y.lang, row_number() OVER (PARTITION BY y.lang ORDER BY score DESC, a DESC, y.phrase) AS rank, y.phrase, a, l, r, n, score
FROM y JOIN n ON n.lang = y.lang LEFT JOIN o ON o.lang = y.lang AND o.phrase = y.phrase
WHERE o.b IS NULL OR CAST(100 AS HUGEINT) * o.b < CAST(80 AS HUGEINT) * a
QUALIFY rank <= 2000
"""

#: Targets by the level at which the sources fill, and each source's documents in the order of their keys.
SOURCE_MIX = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS BIGINT) AS size FROM documents),
k AS (
  SELECT doc_id, source, size, -ln((CAST(CAST('0x' || md5('mix:' || CAST(doc_id AS VARCHAR))[1:13] AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)
    / CASE WHEN size > 0 THEN CAST(size AS DOUBLE) / CAST(size + 10 * (length(t) - length(translate(t, '#*$%&|<>', ''))) AS DOUBLE) ELSE 1.0 END AS draw
  FROM d),
s AS (
  SELECT source, ss, 3 * ss AS most, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS ss FROM k GROUP BY source)),
o AS (
  SELECT *, row_number() OVER (ORDER BY CAST(most AS DOUBLE) / w, source NULLS LAST) AS i FROM s),
q AS (
  SELECT *, (SELECT sum(ss) FROM s) - coalesce(sum(most) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
    sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS den FROM o),
level AS (
  SELECT num, den FROM q WHERE CAST(most AS HUGEINT) * den > CAST(num AS HUGEINT) * w ORDER BY i LIMIT 1),
g AS (
  SELECT source, ss, CASE WHEN level.num IS NULL OR CAST(most AS HUGEINT) * level.den <= CAST(level.num AS HUGEINT) * w THEN CAST(most AS DOUBLE)
    ELSE w * (CAST(level.num AS DOUBLE) / CAST(level.den AS DOUBLE)) END AS target
  FROM s LEFT JOIN level ON true),
u AS (
  SELECT k.doc_id, k.size, ss, target, CASE WHEN ss > 0 THEN CAST(floor(target / ss) AS BIGINT) ELSE 0 END AS e,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, ss AS source_size, target,
  CAST(size * least(3, e + CASE WHEN ss > 0 AND CAST(2 * upto - size AS DOUBLE) <= 2 * (target - e * ss) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM u
"""

ORACLE = {
    "op2_url_lists": URL_LISTS,
    "op9_quality_rules": QUALITY_RULES,
    "op11_lexical_search": LEXICAL_SEARCH,
    "op12_collocations": COLLOCATIONS,
    "op13_source_mix": SOURCE_MIX,
}
