"""SQL of the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

#: Sets of shingles as lists, links by shared shingles, components by following links.
JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS shingles
  FROM words),
tokens AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS token FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 75 * (a.n + b.n - COUNT(*))),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles,
       CAST(LEAST(s.doc_id, COALESCE(m.low, s.doc_id)) AS BIGINT) AS component_id
FROM sets s LEFT JOIN (SELECT x, MIN(y) AS low FROM reach GROUP BY x) m ON m.x = s.doc_id"""

#: Sources fill up in the order of limit by weight; the first that stays below its limit sets the level.
MIXING = rf"""
WITH docs AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         md5(COALESCE(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
sources AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT source, source_size, CAST(row_number() OVER (ORDER BY source NULLS LAST) - 1 AS DOUBLE) AS rank FROM sources),
weighed AS (SELECT *, rank % 3 + 1 AS weight, CAST(source_size AS DOUBLE) * 3 AS most FROM ranked),
levels AS (
  SELECT most / weight AS fills_at,
         ((SELECT SUM(CAST(source_size AS DOUBLE)) FROM sources)
          - COALESCE(SUM(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / SUM(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
aimed AS (
  SELECT source, source_size,
         LEAST(most, weight * (SELECT arg_min(level, fills_at) FROM levels WHERE fills_at > level)) AS target,
         -0.6::DOUBLE + 1.2::DOUBLE * rank / GREATEST((SELECT MAX(rank) FROM ranked), 1) AS slope
  FROM weighed),
placed AS (
  SELECT d.doc_id, d.size, a.source_size, a.target, a.slope,
         CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0 END AS epochs,
         SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS place
  FROM docs d JOIN aimed a ON a.source IS NOT DISTINCT FROM d.source),
copied AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE FLOOR(epochs)
         + CASE WHEN place + CAST(size AS DOUBLE) / 2 < (epochs - FLOOR(epochs)) * source_size THEN 1 ELSE 0 END END AS copies,
         LEAST(1, (place + CAST(size AS DOUBLE) / 2) / target) AS done FROM placed)
SELECT doc_id, size, source_size, ROUND(target, 6) AS target, CAST(copies * size AS BIGINT) AS taken,
       ROUND(CASE WHEN copies = 0 THEN NULL WHEN ABS(slope) < 1e-9 THEN done
         ELSE (SQRT((1 - slope) * (1 - slope) + 4 * slope * done) - (1 - slope)) / (2 * slope) END, 6) AS position
FROM copied"""

#: crc32 byte by byte from its table; variants by words with one code point left out; forms followed to their end.
SPELLING = r"""
WITH RECURSIVE remainders AS (
  SELECT list(list_reduce([c]::BIGINT[] || range(8),
                          lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) ORDER BY c) AS t
  FROM range(256) b(c)),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, COUNT(*) AS n FROM runs GROUP BY ALL),
checked AS (
  SELECT run, n, xor(4294967295, list_reduce(
    [4294967295]::BIGINT[] || flatten(list_transform(string_split(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [195, ord(c) - 64] END))::BIGINT[],
    lambda r, b: xor(r >> 8, t[(xor(r, b) & 255) + 1]))) AS h FROM counted, remainders),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM checked),
vocabulary AS (
  SELECT word, CAST(SUM(n) AS BIGINT) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING SUM(n) >= 5),
without AS (
  SELECT word, length(word) AS size, place, left(word, place - 1) || substr(word, place + 1) AS rest
  FROM vocabulary, unnest(range(1, length(word) + 1)) p(place)),
near AS (
  SELECT a.word, b.word AS other FROM without a JOIN without b USING (size, place, rest) WHERE a.word <> b.word
  UNION SELECT w.word, v.word FROM without w JOIN vocabulary v ON v.word = w.rest
  UNION SELECT v.word, w.word FROM without w JOIN vocabulary v ON v.word = w.rest),
judged AS (
  SELECT v.word, v.n, COUNT(*) AS n_near, MAX(o.n) AS most,
         arg_min(o.word, {'rank': -o.n, 'word': hex(o.word)}) AS top
  FROM near JOIN vocabulary v ON v.word = near.word JOIN vocabulary o ON o.word = near.other GROUP BY v.word, v.n),
forms AS (
  SELECT v.word, v.n, COALESCE(j.n_near, 0) AS n_near, CASE WHEN j.most >= 5 * v.n THEN j.top END AS form,
         CASE WHEN j.most >= 5 * v.n THEN j.most END AS form_n
  FROM vocabulary v LEFT JOIN judged j ON j.word = v.word),
steps(word, place) AS (
  SELECT word, word FROM forms UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.place AND f.form IS NOT NULL)
SELECT f.word, f.form, s.place AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN steps s ON s.word = f.word JOIN forms e ON e.word = s.place AND e.form IS NULL"""

#: Every document that shares a term with an item is scored.
SEARCH = r"""
WITH terms AS (
  SELECT doc_id, place, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS place FROM documents)),
counted AS (SELECT place, doc_id, term, COUNT(*) AS tf FROM terms GROUP BY ALL),
sizes AS (SELECT place, CAST(SUM(tf) AS BIGINT) AS n FROM counted GROUP BY place),
totals AS (SELECT COUNT(*) AS docs, CAST(SUM(n) AS BIGINT) AS total FROM sizes),
asked AS (
  SELECT DISTINCT item, item_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
                                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT item_id, text, row_number() OVER () AS item FROM benchmark)),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * (SELECT docs FROM totals) + 2)::DOUBLE / (2 * COUNT(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM counted WHERE term IN (SELECT term FROM asked) GROUP BY term),
scored AS (
  SELECT a.item, a.item_id, c.doc_id, c.place,
         CAST(SUM(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 20 * (50 + (50 * s.n * t.docs) // t.total)))) AS BIGINT) AS score
  FROM asked a JOIN weights w ON w.term = a.term JOIN counted c ON c.term = a.term JOIN sizes s ON s.place = c.place, totals t
  GROUP BY a.item, a.item_id, c.doc_id, c.place)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50"""

#: Base counts; bins of the ratios; steps ranked on texts not labelled good; exact binomial test on the good ones.
QUALITY = rf"""
WITH docs AS (
  SELECT doc_id, text, COALESCE('=' || lang, '') AS stratum, regexp_extract_all(COALESCE(text, ''), '{WORD}') AS w,
         list_filter(string_split(COALESCE(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
         unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g
  FROM docs),
twice AS (SELECT doc_id, i FROM windows QUALIFY COUNT(*) OVER (PARTITION BY doc_id, g) > 1),
spans AS (SELECT doc_id, LEAST(3, COALESCE(LEAD(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 3)) AS span FROM twice),
repeated AS (SELECT doc_id, SUM(span) AS n FROM spans GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, d.text, d.stratum, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(COALESCE(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(COALESCE(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM docs d LEFT JOIN repeated r ON r.doc_id = d.doc_id),
features AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         LEAST(1000, (100 * n_symbols) // NULLIF(n_words, 0)) AS symbols,
         LEAST(1000, (1000 * n_dup_lines) // NULLIF(n_words, 0)) AS dup_lines,
         LEAST(1000, (100 * n_repeat_words) // NULLIF(n_words, 0)) AS repeats,
         LEAST(1000, (10 * word_chars) // NULLIF(n_words, 0)) AS long_words,
         1000 - LEAST(1000, (10 * word_chars) // NULLIF(n_words, 0)) AS short_words
  FROM counted),
marks AS (SELECT doc_id, MIN(quality) AS label FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
marked AS (SELECT f.*, m.label FROM features f LEFT JOIN marks m ON m.doc_id = f.doc_id WHERE NOT base_failed),
by_language AS (SELECT stratum, text, MIN(label) AS label FROM marked GROUP BY stratum, text),
numbers AS (SELECT stratum, COUNT(*) AS n FROM by_language WHERE label = 1 GROUP BY stratum),
pools AS (
  SELECT DISTINCT f.stratum,
         CASE WHEN n.n * ln(0.99) <= ln(0.05 / (SELECT COUNT(*) FROM numbers)) THEN f.stratum ELSE '*' END AS pool
  FROM features f LEFT JOIN numbers n ON n.stratum = f.stratum),
texts AS (
  SELECT pool, text, MIN(label) AS label, MAX(symbols) AS symbols, MAX(dup_lines) AS dup_lines, MAX(repeats) AS repeats,
         MAX(long_words) AS long_words, MAX(short_words) AS short_words
  FROM marked JOIN pools USING (stratum) GROUP BY pool, text),
pairs AS (
  SELECT pool, text, label, unnest(['symbols', 'dup_lines', 'repeats', 'long_words', 'short_words']) AS rule,
         unnest([symbols, dup_lines, repeats, long_words, short_words]) AS value
  FROM texts),
bins AS (
  SELECT pool, rule, value AS cut, COUNT(label) AS bad, COUNT(*) - COUNT(label) AS other
  FROM pairs WHERE label IS NULL OR label = 0 GROUP BY pool, rule, value),
shares AS (
  SELECT pool, rule, cut, bad,
         SUM(bad) OVER down / GREATEST(SUM(bad) OVER (PARTITION BY pool, rule), 1) AS caught,
         SUM(other) OVER down / GREATEST(SUM(other) OVER (PARTITION BY pool, rule), 1) AS common
  FROM bins WINDOW down AS (PARTITION BY pool, rule ORDER BY cut DESC)),
steps AS (
  SELECT pool, rule, cut, row_number() OVER (PARTITION BY pool ORDER BY lift DESC, rule, cut DESC) AS place
  FROM (SELECT *, caught / (common + CAST(0.005 AS DOUBLE)) AS lift FROM shares WHERE bad > 0) WHERE lift > 1),
sizes AS (SELECT pool, COUNT(*) AS n, COUNT(*) OVER () AS strata FROM texts WHERE label = 1 GROUP BY pool),
chances AS (SELECT pool, n, strata, unnest(range(0, CAST(floor(n * 0.01) AS BIGINT) + 1)) AS k FROM sizes),
sums AS (
  SELECT pool, strata, k, SUM(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(0.01) + (n - k) * ln(0.99)))
                            OVER (PARTITION BY pool ORDER BY k) AS chance
  FROM chances),
allowed AS (SELECT pool, COALESCE(MAX(k) FILTER (chance <= 0.05 / strata), -1) AS k FROM sums GROUP BY pool),
firsts AS (
  SELECT p.pool, p.text, MIN(s.place) AS place
  FROM pairs p JOIN steps s ON s.pool = p.pool AND s.rule = p.rule AND s.cut <= p.value WHERE p.label = 1 GROUP BY p.pool, p.text),
lost AS (SELECT pool, place, SUM(COUNT(*)) OVER (PARTITION BY pool ORDER BY place) AS n FROM firsts GROUP BY pool, place),
stops AS (SELECT pool, MIN(place) AS stop FROM lost JOIN allowed USING (pool) WHERE n > k GROUP BY pool),
cuts AS (
  SELECT pool, MIN(cut) FILTER (rule = 'symbols') AS symbols, MIN(cut) FILTER (rule = 'dup_lines') AS dup_lines,
         MIN(cut) FILTER (rule = 'repeats') AS repeats, MIN(cut) FILTER (rule = 'long_words') AS long_words,
         MIN(cut) FILTER (rule = 'short_words') AS short_words
  FROM steps JOIN allowed a USING (pool) LEFT JOIN stops USING (pool)
  WHERE a.k >= 0 AND (stop IS NULL OR place < stop) GROUP BY pool),
judged AS (
  SELECT f.*, COALESCE(a.k >= 0, FALSE) AS certified,
         CASE WHEN NOT base_failed THEN NULLIF(concat_ws(',',
           CASE WHEN f.symbols >= c.symbols THEN 'symbols' END, CASE WHEN f.dup_lines >= c.dup_lines THEN 'dup_lines' END,
           CASE WHEN f.repeats >= c.repeats THEN 'repeats' END, CASE WHEN f.long_words >= c.long_words THEN 'long_words' END,
           CASE WHEN f.short_words >= c.short_words THEN 'short_words' END), '') END AS rejected_by
  FROM features f JOIN pools USING (stratum) LEFT JOIN allowed a USING (pool) LEFT JOIN cuts c USING (pool))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rejected_by IS NULL AS kept, rejected_by, certified
FROM judged"""

ORACLES: dict[str, str] = {
    "op3_jaccard_join": JACCARD,
    "op4_quality_rules": QUALITY,
    "op8_mixing": MIXING,
    "op11_spelling_variants": SPELLING,
    "op12_ranked_search": SEARCH,
}
