"""DuckDB SQL for the operators it can express, stated from their definitions:
every window of every text is compared, without anchors, shards or fingerprints."""

from __future__ import annotations

from . import licenses

# windows[s] starts at word s (from 1); a word goes if a window over it also
# starts in a document with a smaller id
SUBSTRING = """
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
             FROM documents),
win AS (SELECT doc_id, s, array_to_string(words[s:s + 49], ' ') AS w
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS s FROM doc WHERE len(words) >= 50)),
least AS (SELECT w, min(doc_id) AS first FROM win GROUP BY w HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, s + unnest(range(0, 50)) AS i
         FROM win JOIN least USING (w) WHERE doc_id > first),
word AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM doc),
mark AS (SELECT word.*, gone.i IS NOT NULL AS g,
                lag(gone.i IS NOT NULL, 1, false) OVER (PARTITION BY doc_id ORDER BY word.i) AS before
         FROM word LEFT JOIN gone USING (doc_id, i)),
cut AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (g) AS n_removed,
               count(*) FILTER (g AND NOT before) AS n_spans,
               string_agg(word, ' ' ORDER BY i) FILTER (NOT g) AS kept
        FROM mark GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN cut USING (doc_id)"""

SUFFIX = """
WITH doc AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
win AS (SELECT doc_id, s, t[s + 1:s + 100] AS w
        FROM (SELECT doc_id, t, unnest(range(0, octet_length(t) - 99)) AS s
              FROM doc WHERE octet_length(t) >= 100)),
least AS (SELECT w, min(struct_pack(d := doc_id, s := s)) AS first FROM win GROUP BY w HAVING count(*) > 1),
later AS (SELECT doc_id, s FROM win JOIN least USING (w)
          WHERE doc_id > first.d OR (doc_id = first.d AND s > first.s)),
-- windows that overlap or adjoin form one removed run
start AS (SELECT *, coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100, true) AS new FROM later),
run AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b
        FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM start) GROUP BY doc_id, k),
gap AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS kept_from FROM run),
cut AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS tail,
               string_agg(CASE WHEN a > kept_from THEN hex(t[kept_from + 1:a]) ELSE '' END, '' ORDER BY a) AS kept
        FROM gap JOIN doc USING (doc_id) GROUP BY doc_id)
SELECT doc_id, octet_length(t)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || CASE WHEN octet_length(t) > coalesce(tail, 0)
              THEN hex(t[coalesce(tail, 0) + 1:octet_length(t)]) ELSE '' END)) AS kept_sha256
FROM doc LEFT JOIN cut USING (doc_id)"""

_WORDS = ("regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[!-/:-@\\[-`{-~]', ' ', 'g'), '[^\\x20\\x09-\\x0D]+')")

# the window of the item's size with the largest weighted Jaccard similarity of
# five-word shingles, the first of equals; items are longer than five words
DECONTAMINATION = f"""
WITH item AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
item_shingle AS (SELECT item_id, len(words) AS n, array_to_string(words[s:s + 4], ' ') AS shingle
                 FROM (SELECT item_id, words, unnest(range(1, len(words) - 3)) AS s FROM item)),
bag AS (SELECT item_id, n, shingle, count(*) AS times FROM item_shingle GROUP BY ALL),
doc AS (SELECT doc_id, words FROM (SELECT doc_id, {_WORDS} AS words FROM documents) WHERE len(words) >= 5),
doc_shingle AS (SELECT doc_id, len(words) AS n_words, i, array_to_string(words[i:i + 4], ' ') AS shingle
                FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM doc)),
hit AS (SELECT doc_id, item_id, n_words, i, shingle, least(n, n_words) AS size, n, times
        FROM doc_shingle JOIN bag USING (shingle)),
-- each hit counts in every window of the item's size that covers it
win AS (SELECT doc_id, item_id, size, n, s, shingle, times, count(*) AS found
        FROM (SELECT *, unnest(range(greatest(1, i + 5 - size), least(i, n_words - size + 1) + 1)) AS s FROM hit)
        GROUP BY ALL),
score AS (SELECT doc_id, item_id, size, s, sum(least(found, times)) AS shared, (size - 4) + (n - 4) AS total
          FROM win GROUP BY doc_id, item_id, size, n, s),
best AS (SELECT *, shared::DOUBLE / (total - shared)::DOUBLE AS similarity FROM score),
first AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, s) AS nth
          FROM best WHERE similarity >= 0.8)
SELECT doc_id, item_id, s - 1 AS start, size AS n_words, similarity FROM first WHERE nth = 1"""

# f counts every phrase of 1 to 4 words; each candidate is cut in every way and
# held against every longer candidate that has its words
COLLOCATIONS = """
WITH part AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
piece AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM part),
sized AS (SELECT lang, words, unnest(range(1, least(len(words), 4) + 1)) AS k FROM piece),
gram AS (SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
         FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM sized)),
f AS MATERIALIZED (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM gram GROUP BY lang, k, phrase),
total AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS words, f AS a FROM f WHERE k >= 2 AND f >= 30),
cut AS (SELECT lang, k, phrase, a, c, array_to_string(words[1:c], ' ') AS lhs,
               array_to_string(words[c + 1:k], ' ') AS rhs
        FROM (SELECT cand.*, unnest(range(1, k)) AS c FROM cand)),
scored AS (SELECT cut.*, x.f AS l, y.f AS r, (2000000 * a) // (x.f + y.f) AS score
           FROM cut JOIN f AS x ON x.lang = cut.lang AND x.phrase = lhs
                    JOIN f AS y ON y.lang = cut.lang AND y.phrase = rhs),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_part AS (SELECT lang, k, a, array_to_string(words[i:i + s - 1], ' ') AS phrase
               FROM (SELECT cand.*, s, unnest(range(1, k - s + 2)) AS i
                     FROM cand, (VALUES (2), (3)) AS size(s) WHERE s < k)),
longer AS (SELECT lang, phrase, max(a) AS longer FROM inner_part GROUP BY lang, phrase),
ranked AS (SELECT lowest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
           FROM lowest LEFT JOIN longer USING (lang, phrase)
           WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""

ORACLE_SQL = {
    "op3_substring_dedup": SUBSTRING,
    "op5_decontamination": DECONTAMINATION,
    "op8_suffix_dedup": SUFFIX,
    "op10_licenses": licenses.oracle_sql(),
    "op13_collocations": COLLOCATIONS,
}
