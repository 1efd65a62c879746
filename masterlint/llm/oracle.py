"""The operators in DuckDB SQL, where SQL can say them. The others are tested against plain versions."""

from __future__ import annotations

from masterlint.llm.common import WORD

#: Running sums over sources in the order in which they reach their ceiling.
OP2 = f"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size, md5(coalesce(text, '')) AS digest,
           row_number() OVER (PARTITION BY doc_id, md5(coalesce(text, ''))) - 1 AS place
    FROM documents
),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM per_source),
levels AS (
    SELECT *, row_number() OVER w AS place,
           (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
    FROM weighed WINDOW w AS (ORDER BY 3 * source_size / CAST(weight AS DOUBLE), source NULLS LAST)
),
fill AS (SELECT arg_min(level, place) AS fill FROM levels WHERE level * weight <= 3 * source_size),
targets AS (SELECT source, source_size, least(fill * weight, 3.0 * source_size)::DOUBLE AS target FROM levels, fill),
rated AS (
    SELECT doc_id, size, source_size, target,
           CASE WHEN source_size = 0 THEN 0 ELSE least(target / source_size, 3) END::DOUBLE AS rate,
           CAST('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '') || ':' || digest || ':' || place), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE AS draw
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS n_copies,
       size * n_copies AS taken
FROM rated
"""

#: Windows and lines as rows instead of arrays.
OP3 = f"""
WITH texts AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT n, regexp_extract_all(t, '{WORD}') AS w FROM texts),
places AS (SELECT n, unnest(range(1, len(w) - 3)) AS i, w FROM words WHERE len(w) >= 5),
windows AS (SELECT n, i, count(*) OVER (PARTITION BY n, list_aggregate(w[i:i + 4], 'string_agg', ' ')) AS times FROM places),
covered AS (SELECT n, count(DISTINCT k) AS n_repeat_words FROM (SELECT n, unnest(range(i, i + 5)) AS k FROM windows WHERE times > 1) GROUP BY n),
lines AS (SELECT n, unnest(string_split(t, chr(10))) AS line FROM texts),
line_counts AS (SELECT n, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY n),
measured AS (
    SELECT doc_id, len(w) AS n_words, list_sum([length(x) for x in w]) AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM texts JOIN words USING (n) LEFT JOIN covered USING (n) LEFT JOIN line_counts USING (n)
),
ruled AS (
    SELECT * REPLACE (CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars),
           n_words < 10 AS r0, 100 * n_repeat_words > 20 * n_words AS r1, 100 * n_symbols > 25 * n_words AS r2,
           100 * n_dup_lines > 30 * n_lines AS r3, coalesce(word_chars, 0) < 2 * n_words AS r4,
           coalesce(word_chars, 0) > 20 * n_words AS r5, 100 * n_upper > 50 * coalesce(word_chars, 0) AS r6
    FROM measured
)
SELECT doc_id, n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, r0 OR r1 AS base_failed,
       NOT (r0 OR r1 OR r2 OR r3 OR r4 OR r5 OR r6) AS kept,
       CAST(r0::INT + 2 * r1::INT + 4 * r2::INT + 8 * r3::INT + 16 * r4::INT + 32 * r5::INT + 64 * r6::INT AS BIGINT) AS failed_rules
FROM ruled
"""

#: crc32 by its table; near words by what is left of both without the letter at one place, or of one of them.
OP11 = r"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
),
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
    FROM documents
),
counted AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS key, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(key, ''),
           lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + (unicode(x) >> 6)::BIGINT, 128 + (unicode(x) & 63)::BIGINT] END))),
           lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)])), 4294967295) AS h
    FROM counted, crc
),
words AS (
    SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2
),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
shorter AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM places),
cut AS (SELECT DISTINCT shorter.word, shorter.n, words.word AS other, words.n AS other_n FROM shorter JOIN words ON rest = words.word),
near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i WHERE a.word <> b.word
    UNION ALL SELECT * FROM cut
    UNION ALL SELECT other, other_n, word, n FROM cut
),
best AS (
    SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word, n
),
formed AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN other_n >= 10 * words.n THEN other END AS form, CASE WHEN other_n >= 10 * words.n THEN other_n END AS form_n
    FROM words LEFT JOIN best ON words.word = best.word
),
walked AS (
    SELECT word, form AS root, 1 AS steps FROM formed WHERE form IS NOT NULL
    UNION ALL
    SELECT walked.word, formed.form, steps + 1 FROM walked JOIN formed ON walked.root = formed.word WHERE formed.form IS NOT NULL
),
roots AS (SELECT word, arg_max(root, steps) AS root FROM walked GROUP BY word)
SELECT formed.word, form, coalesce(root, formed.word) AS root, n, n_near, form_n FROM formed LEFT JOIN roots ON formed.word = roots.word
"""

ORACLE_SQL = {"op2_source_mixing": OP2, "op3_quality_rules": OP3, "op11_spelling_variants": OP11}
