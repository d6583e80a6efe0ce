"""SQL of the text operators that plain SQL can express, for tables whose doc_ids are unique."""

from __future__ import annotations

import string

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase

OP1_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS a FROM documents
), w AS (
    SELECT doc_id, unnest(a) AS word, unnest(range(1, len(a) + 1)) AS i FROM d
), k AS (
    SELECT doc_id, i, word, CASE WHEN count(*) OVER f = 20 THEN string_agg(word, ' ') OVER f END AS win
    FROM w WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), s AS (
    SELECT doc_id, i, word, win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1 AS late FROM k
), c AS (
    SELECT doc_id, i, word, bool_or(late) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM s
), e AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id
)
SELECT d.doc_id, len(d.a) AS n_words, coalesce(e.n_removed, 0) AS n_removed, sha256(coalesce(e.kept, '')) AS kept_sha256
FROM d LEFT JOIN e ON d.doc_id = e.doc_id
"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Every window of 20 words around the rarest of the five rarest terms of an item; the shortest, then the leftmost, for each place of the rarest.
_NEAR = f"""b AS (
    SELECT DISTINCT item_id, {_WORDS} AS a FROM benchmark
), d AS (
    SELECT doc_id, {_WORDS} AS a FROM documents
), w AS (
    SELECT doc_id, unnest(a) AS word, unnest(range(1, len(a) + 1)) AS i FROM d
), n1 AS (
    SELECT x.item_id, x.word, y.n FROM (SELECT DISTINCT item_id, unnest(a) AS word FROM b) x LEFT JOIN (SELECT word, count(*) AS n FROM w GROUP BY word) y ON x.word = y.word
), n2 AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY n NULLS LAST, word) AS r, least(5, count(*) OVER (PARTITION BY item_id)) AS need, count(n) OVER (PARTITION BY item_id) AS there FROM n1
), n3 AS (
    SELECT w.doc_id, n2.item_id, n2.r, n2.need, w.i FROM n2 JOIN w ON n2.word = w.word WHERE n2.r <= n2.need AND n2.there >= n2.need
), n4 AS (
    SELECT a.doc_id, a.item_id, a.i, a.need, l.i AS low, least(l.i + 19, x.i) AS ends, x.r
    FROM n3 a JOIN n3 l ON a.doc_id = l.doc_id AND a.item_id = l.item_id AND l.i BETWEEN a.i - 19 AND a.i
    JOIN n3 x ON a.doc_id = x.doc_id AND a.item_id = x.item_id AND x.i BETWEEN l.i AND l.i + 19 WHERE a.r = 1
), n5 AS (
    SELECT doc_id, item_id, i, low, greatest(i, max(ends)) - low + 1 AS size
    FROM (SELECT doc_id, item_id, i, need, low, r, min(ends) AS ends FROM n4 GROUP BY ALL) GROUP BY doc_id, item_id, i, need, low HAVING count(*) = need
), near AS (
    SELECT doc_id, item_id, i, arg_min(low, size * 100 - (i - low)) AS low, min(size) AS size FROM n5 GROUP BY doc_id, item_id, i
)"""

OP3_SQL = f"""
WITH {_NEAR}, p AS (
    SELECT DISTINCT item_id, n, array_to_string(a[k:k + n - 1], ' ') AS phrase
    FROM (SELECT item_id, a, least(13, len(a)) AS n, unnest(range(1, len(a) - least(13, len(a)) + 2)) AS k FROM b WHERE len(a) > 0)
), g AS (
    SELECT doc_id, i, n, CASE WHEN count(*) OVER f = n THEN string_agg(word, ' ') OVER f END AS phrase
    FROM w, (SELECT DISTINCT n FROM p)
    WINDOW f AS (PARTITION BY doc_id, n ORDER BY i ROWS BETWEEN CURRENT ROW AND n - 1 FOLLOWING)
), h AS (
    SELECT g.doc_id, g.i, g.n, p.item_id FROM g JOIN p ON g.n = p.n AND g.phrase = p.phrase
), c AS (
    SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS i FROM h) GROUP BY doc_id
), m AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id
), f AS (
    SELECT DISTINCT doc_id, item_id FROM near
)
SELECT d.doc_id, len(d.a) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.items, '')) AS items_sha256, coalesce(c.n_hit > 0 AND 20 * c.n_hit >= len(d.a), false) AS contaminated,
       coalesce(r.n_near, 0) AS n_near
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN m ON d.doc_id = m.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n_near FROM f GROUP BY doc_id) r ON d.doc_id = r.doc_id
"""

OP3_PROXIMITY_SQL = f"""
WITH {_NEAR}
SELECT doc_id, item_id, low - 1 AS start, low + size - 1 AS "end" FROM near
"""


def _repetition(levels: int = 16) -> str:
    """Words in repeated windows, and the longest repeat by halving steps: hashes of 1, 2, 4, ... words, put together
    from the largest step down as long as some window of the document still repeats.  For documents of fewer than
    2 ** ``levels`` words."""
    steps = ["t0 AS (SELECT doc_id, i, hash(word) AS h0 FROM w)"]
    for j in range(1, levels):
        half = 1 << (j - 1)
        ahead = f"lead(h{j - 1}, {half}) OVER (PARTITION BY doc_id ORDER BY i)"
        steps.append(f"t{j} AS (SELECT *, CASE WHEN {ahead} IS NOT NULL THEN hash(h{j - 1}, {ahead}) END AS h{j} FROM t{j - 1})")
    steps.append(f"l{levels} AS (SELECT *, 0 AS length, CAST(0 AS UBIGINT) AS h FROM t{levels - 1})")
    for j in range(levels - 1, -1, -1):
        steps.append(f"a{j} AS (SELECT x.*, CASE WHEN y.h{j} IS NOT NULL AND x.h IS NOT NULL THEN hash(x.h, y.h{j}) END AS longer FROM l{j + 1} x LEFT JOIN t{j} y ON x.doc_id = y.doc_id AND x.i + x.length = y.i)")
        steps.append(f"o{j} AS (SELECT DISTINCT doc_id FROM (SELECT doc_id FROM a{j} WHERE longer IS NOT NULL GROUP BY doc_id, longer HAVING count(*) > 1))")
        steps.append(f"l{j} AS (SELECT a.doc_id, a.i, CASE WHEN o.doc_id IS NULL THEN a.length ELSE a.length + {1 << j} END AS length, CASE WHEN o.doc_id IS NULL THEN a.h ELSE a.longer END AS h FROM a{j} a LEFT JOIN o{j} o ON a.doc_id = o.doc_id)")
    windows = []
    for n in (5, 8):
        windows.append(f"g{n} AS (SELECT doc_id, i, CASE WHEN count(*) OVER f = {n} THEN string_agg(word, ' ') OVER f END AS win FROM w WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING))")
        windows.append(f"r{n} AS (SELECT doc_id, i, win IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, win) > 1 AS again FROM g{n})")
        windows.append(f"c{n} AS (SELECT doc_id, count(*) FILTER (hit) AS n FROM (SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS hit FROM r{n}) GROUP BY doc_id)")
    parts = ",\n".join([*windows, *steps])
    return rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS a FROM documents
), w AS (
    SELECT doc_id, unnest(a) AS word, unnest(range(1, len(a) + 1)) AS i FROM d
), n AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
{parts}
, q AS (SELECT doc_id, max(length) AS longest FROM l0 GROUP BY doc_id
), m AS (
    SELECT d.doc_id, len(a) AS n_words, length(array_to_string(a, '')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n.n_dup_lines, 0) AS n_dup_lines,
           coalesce(c8.n, 0) AS n_repeat_words, coalesce(c5.n, 0) AS n_covered, coalesce(q.longest, 0) AS longest_repeat
    FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN c8 ON d.doc_id = c8.doc_id LEFT JOIN c5 ON d.doc_id = c5.doc_id LEFT JOIN q ON d.doc_id = q.doc_id
), v AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT *, NOT base_failed AND n_covered <= CAST(0.3 AS DOUBLE) * n_words AND longest_repeat <= CAST(0.2 AS DOUBLE) * n_words AS kept FROM v
"""


OP5_SQL = _repetition()
