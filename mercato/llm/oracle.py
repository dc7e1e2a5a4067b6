"""DuckDB SQL for the operators that it can express.

Written for tables of the size that tests use: windows and shingles are listed
one by one. Document ids must be distinct.
"""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Windows of ten words (or one of all words) of the items, found in the documents by their words.
DECONTAMINATE = rf"""
WITH item AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), window_of AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, size, array_to_string(w[p : p + size - 1], ' ') AS words
    FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p
          FROM item WHERE len(w) > 0)
), doc AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), place AS (
    SELECT doc_id, size, p, array_to_string(w[p : p + size - 1], ' ') AS words
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
          FROM doc, (SELECT DISTINCT size FROM window_of) WHERE len(w) >= size)
), found AS (
    SELECT doc_id, p, size, item_id FROM place JOIN window_of USING (size, words)
), hit AS (
    SELECT doc_id, count(DISTINCT q) AS n_hit
    FROM (SELECT DISTINCT doc_id, unnest(range(p, p + size)) AS q FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: Every 400-byte window by its digest, cut from blocks of 800 bytes; removed runs are the unions of those found twice or more.
SUBSTRINGS = """
WITH doc AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n_bytes FROM documents
), block AS (
    SELECT doc_id, k, n_bytes, substr(h, 800 * k + 1, 1600) AS part
    FROM (SELECT doc_id, h, n_bytes, unnest(range(0, n_bytes // 400)) AS k FROM doc)
), win AS (
    SELECT doc_id, 400 * k + r AS p, md5_number(substr(part, 2 * r + 1, 800)) AS d
    FROM (SELECT doc_id, k, part, unnest(range(0, least(400, n_bytes - 400 * k - 399))) AS r FROM block)
), twice AS (
    SELECT doc_id, p FROM win JOIN (SELECT d FROM win GROUP BY d HAVING count(*) > 1) USING (d)
), run AS (
    SELECT doc_id, min(p) AS first, max(p) + 400 AS past
    FROM (SELECT doc_id, p, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY p) AS run
          FROM (SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 400, true) AS fresh
                FROM twice))
    GROUP BY doc_id, run
), kept AS (
    SELECT doc_id, h, coalesce(lag(past) OVER (PARTITION BY doc_id ORDER BY first), 0) AS start, first AS past
    FROM (SELECT doc_id, first, past FROM run UNION ALL SELECT doc_id, n_bytes, n_bytes FROM doc)
    JOIN doc USING (doc_id)
), text AS (
    SELECT doc_id, string_agg(substr(h, 2 * start + 1, 2 * (past - start)), '' ORDER BY start) AS kept
    FROM kept GROUP BY doc_id
), total AS (
    SELECT doc_id, sum(past - first) AS n_removed, count(*) AS n_spans FROM run GROUP BY doc_id
)
SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(kept)) AS kept_sha256
FROM doc JOIN text USING (doc_id) LEFT JOIN total USING (doc_id)
"""

#: Distinct sets, their pairs by shared shingles, and the smallest id that links reach.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE doc AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), shingles AS (
    SELECT doc_id, list_sort(list_distinct(list_transform(
        range(1, len(w) - least(len(w), 5) + 2), lambda p: array_to_string(w[p : p + 4], ' ')))) AS s
    FROM doc WHERE len(w) > 0
), class AS (
    SELECT s, min(doc_id) AS node, len(s) AS n FROM shingles GROUP BY s
), member AS (
    SELECT node, n, unnest(s) AS shingle FROM class
), link AS (
    SELECT a.node AS a, b.node AS b FROM member a JOIN member b ON a.shingle = b.shingle AND a.node <> b.node
    GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
    SELECT node, node AS other FROM class
    UNION
    SELECT reach.node, link.b FROM reach JOIN link ON reach.other = link.a
), label AS (
    SELECT node, min(other) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, coalesce(len(shingles.s), 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       coalesce(component_id, doc_id) = doc_id AS kept
FROM doc LEFT JOIN shingles USING (doc_id) LEFT JOIN class ON shingles.s = class.s LEFT JOIN label USING (node)
"""

#: All phrases of up to four words are listed, with every cut and every longer phrase.
COLLOCATIONS = rf"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents
), words AS (
    SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece
), gram AS (
    SELECT lang, size, phrase, count(*) AS f
    FROM (SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
                 lambda i: array_to_string(w[i : i + size - 1], ' '))) AS phrase
          FROM words, (VALUES (1), (2), (3), (4)) AS sizes(size) WHERE len(w) >= size)
    GROUP BY lang, size, phrase
), total AS (
    SELECT lang, sum(f) AS n FROM gram WHERE size = 1 GROUP BY lang
), candidate AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM gram WHERE size > 1 AND f >= 30
), cut AS (
    SELECT c.lang, c.size, c.phrase, c.a, k, l.f AS l, r.f AS r,
           CAST(2000000 * CAST(c.a AS HUGEINT) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidate) c
    JOIN gram l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
    JOIN gram r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1 :], ' ')
), best AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_part AS (
    SELECT lang, a, array_to_string(w[s : s + m - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, size - m + 2)) AS s FROM (SELECT *, unnest(range(2, size)) AS m FROM candidate))
), longer AS (
    SELECT lang, phrase, max(a) AS most FROM inner_part GROUP BY lang, phrase
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM best JOIN total USING (lang) LEFT JOIN longer USING (lang, phrase)
WHERE most IS NULL OR 100 * CAST(most AS HUGEINT) < 80 * CAST(a AS HUGEINT)
QUALIFY rank <= 2000
"""

#: crc32 by the table of its polynomial; near words by equal keys with one place blanked, or left out.
SPELLING = rf"""
WITH RECURSIVE crc AS (
    SELECT list(c ORDER BY i) AS t
    FROM (SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
          FROM range(256) AS r(i))
), run AS (
    SELECT CAST(doc_id AS VARCHAR) AS id, run, count(*) AS c
    FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
    SELECT run, c, xor(list_reduce(
        flatten(list_transform(string_split(coalesce(id, '') || ':' || run, ''),
                lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, unicode(x) - 64] END)),
        lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]), 4294967295), 4294967295) AS h
    FROM run, crc
), word AS (
    SELECT word, CAST(sum(c) AS BIGINT) AS n
    FROM (SELECT c, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                    ELSE run END AS word FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
), place AS (
    SELECT word, n, substr(word, 1, i - 1) AS x, substr(word, i + 1) AS y
    FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM word)
), shorter AS (
    SELECT DISTINCT p.word AS long, w.word AS short FROM place p JOIN word w ON w.word = x || y
), near AS (
    SELECT a.word, b.word AS other FROM place a JOIN place b ON a.x = b.x AND a.y = b.y AND a.word <> b.word
    UNION ALL SELECT long, short FROM shorter UNION ALL SELECT short, long FROM shorter
), best AS (
    SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near
    FROM near JOIN word o ON o.word = other
    QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) = 1
), formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form,
           CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
    FROM word LEFT JOIN best USING (word)
), chain AS (
    SELECT word, word AS last, 0 AS steps FROM word
    UNION ALL SELECT chain.word, form, steps + 1 FROM chain JOIN formed ON formed.word = last WHERE form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n
FROM formed JOIN (SELECT word, arg_max(last, steps) AS root FROM chain GROUP BY word) USING (word)
"""

ORACLE = {
    "op2_decontaminate": DECONTAMINATE,
    "op6_substrings": SUBSTRINGS,
    "op7_minhash": NEAR_DUPLICATES,
    "op11_collocations": COLLOCATIONS,
    "op12_spelling": SPELLING,
}
