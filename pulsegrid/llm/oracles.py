"""SQL (DuckDB) for the queries that SQL can express."""

from __future__ import annotations

from pulsegrid.llm import license_scan as lic
from pulsegrid.llm import mixing, secret_scan

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def license_sql() -> str:
    grams = []
    for t, (phrase, label) in enumerate([*lic.BASE_PHRASES, *lic.MORE_PHRASES]):
        w = phrase.split()
        for i in range(len(w) - 1):
            grams.append(f"('{w[i]}', '{w[i + 1]}', {t}, {i}, {len(w) - 1}, {str(t < len(lic.BASE_PHRASES)).lower()}, '{label}')")
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents),
g(a, b, template, q, n_grams, base, label) AS (VALUES {", ".join(grams)}),
p AS (SELECT doc_id, w, unnest(range(len(w) - 1)) AS p FROM d),
hits AS (
  SELECT doc_id, template, n_grams, base, label, p - q AS diagonal, q FROM p JOIN g ON w[p + 1] = a AND w[p + 2] = b
),
diagonals AS (SELECT DISTINCT doc_id, template, n_grams, diagonal FROM hits),
apart AS (
  SELECT *, CASE WHEN n_grams < {lic.SHORT} OR coalesce(diagonal - lag(diagonal) OVER w, {lic.SHIFT + 1}) > {lic.SHIFT} THEN 1 ELSE 0 END AS apart
  FROM diagonals WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)
),
placed AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS place FROM apart),
banded AS (SELECT *, (diagonal - min(diagonal) OVER (PARTITION BY doc_id, template, place)) // {lic.BAND} AS band FROM placed),
spans AS (
  SELECT doc_id, template, place, band, n_grams, base, label, min(diagonal) AS start, count(DISTINCT q) / n_grams AS score
  FROM hits JOIN banded USING (doc_id, template, n_grams, diagonal) GROUP BY doc_id, template, place, band, n_grams, base, label
),
good AS (SELECT * FROM spans WHERE score >= CASE WHEN n_grams < {lic.SHORT} THEN 1.0 ELSE {lic.LEAST_SCORE} END)
SELECT d.doc_id, len(any_value(w)) AS n_words, count(start) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
       max(start) FILTER (base) AS last_word,
       coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (label IS NOT NULL)), ','), '') AS labels,
       coalesce(max(score), 0.0) AS score
FROM d LEFT JOIN good USING (doc_id) GROUP BY d.doc_id"""


def secret_sql() -> str:
    parts = []
    for rank, r in enumerate(secret_scan.RULES):
        pattern = rf"(?s)(.*?)({r.pattern}|\z)".replace("'", "''")
        group = lambda i: f"unnest(regexp_extract_all(t, '{pattern}', {i}))"  # noqa: B023, E731
        parts.append(
            f"SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, {r.least} AS least, {r.value} AS least_value, "
            f"unnest(range(len(regexp_extract_all(t, '{pattern}', 1)))) AS pos, {group(1)} AS skip, {group(2)} AS found, {group(3 if r.value else 2)} AS value FROM d"
        )
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(parts)}),
e AS (SELECT *, sum(length(skip) + length(found)) OVER (PARTITION BY doc_id, rank ORDER BY pos) AS stop FROM m),
s AS (
  SELECT doc_id, rank, kind, stop - length(found) AS start, stop FROM e
  WHERE length(found) > 0 AND length(found) >= least AND length(coalesce(value, '')) >= least_value
),
j AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, rank) FILTER (rank < {len(secret_scan.BASE_RULES)}) AS base,
         string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, rank) AS spans
  FROM s GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (doc_id)"""


DIVERGENCE = rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id,
         regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM (SELECT lang, source, id, unnest(w) AS term FROM d) GROUP BY ALL),
t AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 10),
l AS (SELECT lang, count(term) AS v, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang FROM d) LEFT JOIN t USING (lang) GROUP BY lang),
k AS (SELECT c.* FROM c JOIN t USING (lang, term)),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN k USING (lang, source) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, t.term, coalesce(k.n, 0) AS n,
         (1 + 1000000000::HUGEINT * (coalesce(k.n, 0) + 2) // (g.n + 2 * l.v))::BIGINT AS p,
         (1 + 1000000000::HUGEINT * (t.n + 2) // (l.n + 2 * l.v))::BIGINT AS q
  FROM g JOIN t USING (lang) JOIN l USING (lang) LEFT JOIN k USING (lang, source, term)
),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q
),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
SELECT * FROM o WHERE part = 'pair' OR rank <= 10"""


_B = mixing.BLOCK_WORDS

MIX = rf"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         substr(md5(concat(coalesce(doc_id::VARCHAR, ''), ' ', coalesce(text, ''))), 1, 15) AS key FROM documents
),
z AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM s GROUP BY source),
w AS (SELECT *, [5, 2, 1][nth % 3 + 1] AS weight FROM z),
o AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER e, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER e, 0) AS "left"
  FROM w WINDOW e AS (ORDER BY source_size::DOUBLE / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (SELECT arg_min(rest, source_size::DOUBLE / weight) AS rest, arg_min("left", source_size::DOUBLE / weight) AS "left" FROM o WHERE weight * rest <= 3 * source_size * "left"),
t AS (
  SELECT source, source_size, nth, CASE WHEN weight * l.rest > 3 * source_size * l."left" THEN (3 * source_size)::DOUBLE ELSE (weight * l.rest)::DOUBLE / l."left"::DOUBLE END AS target
  FROM w, level l
),
k AS (SELECT *, floor(target)::BIGINT AS take, ((floor(target)::BIGINT + {_B - 1}) // {_B}) AS blocks FROM t),
n AS (SELECT sum(take) AS words, sum(blocks)::BIGINT AS n, greatest(1, ceil(log2(greatest(sum(blocks), 1))))::INTEGER AS k FROM k),
lines AS (
  SELECT nth, blocks, ((sum(take) OVER (ORDER BY nth) - take)::HUGEINT * (1::HUGEINT << n.k)) // words AS low, (sum(take) OVER (ORDER BY nth))::HUGEINT * (1::HUGEINT << n.k) // words AS high
  FROM k, n
),
points AS (SELECT slot, ('0b' || reverse(lpad(bin(slot), n.k, '0')))::BIGINT AS point FROM n, range(n.n) r(slot)),
slots AS (SELECT nth, slot, row_number() OVER (PARTITION BY nth ORDER BY slot) - 1 AS rank FROM points JOIN lines ON low <= point AND point < high),
d AS (
  SELECT *, row_number() OVER () AS id, sum(size) OVER (PARTITION BY nth ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS pos
  FROM s JOIN k ON s.source IS NOT DISTINCT FROM k.source
),
used AS (SELECT *, unnest(range(3)) AS epoch FROM d WHERE size > 0 AND pos < take),
spread AS (SELECT id, nth, blocks, epoch * source_size + pos AS "begin", least(epoch * source_size + pos + size, take)::BIGINT AS "end" FROM used WHERE epoch * source_size + pos < take),
cut AS (SELECT *, unnest(range(("begin" // {_B})::BIGINT, (("end" - 1) // {_B} + 1)::BIGINT)) AS rank FROM spread),
p AS (
  SELECT id, least("end", (rank + 1) * {_B}) - greatest("begin", rank * {_B}) AS length, slot, coalesce(slot, (2 * rank + 1) * (SELECT n FROM n) // (2 * blocks))::BIGINT AS turn
  FROM cut LEFT JOIN slots USING (nth, rank)
),
g AS (SELECT id, sum(length) AS taken, min(turn) AS first_slot, sum(length) FILTER (slot IS NULL) AS late FROM p GROUP BY id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot, coalesce(late, 0) AS late FROM d LEFT JOIN g USING (id)"""


LEAKS = rf"""
WITH iw AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM benchmark),
ip AS (SELECT item_id, len(w) AS n_words, len(w) - 4 AS n_shingles, unnest(range(len(w) - 4)) AS q, w FROM iw WHERE len(w) >= 5),
ish AS (SELECT item_id, n_words, n_shingles, q, array_to_string(w[q + 1 : q + 5], ' ') AS s FROM ip),
dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents),
dp AS (SELECT doc_id, w, unnest(range(len(w) - 4)) AS p FROM dw WHERE len(w) >= 5),
dsh AS (SELECT doc_id, p, array_to_string(w[p + 1 : p + 5], ' ') AS s FROM dp),
hits AS (SELECT doc_id, item_id, n_words, n_shingles, q, greatest(p - q, 0) AS start FROM dsh JOIN ish USING (s)),
pairs AS (SELECT doc_id, item_id FROM hits GROUP BY doc_id, item_id, n_shingles HAVING count(DISTINCT q) >= 0.8 * n_shingles),
windows AS (SELECT DISTINCT doc_id, item_id, n_words, n_shingles, start FROM hits JOIN pairs USING (doc_id, item_id)),
wc AS (
  SELECT doc_id, item_id, n_words, n_shingles, start, s, count(*) AS n FROM windows JOIN dsh USING (doc_id)
  WHERE p >= start AND p <= start + n_words - 5 GROUP BY ALL
),
ic AS (SELECT item_id, s, count(*) AS m FROM ish GROUP BY ALL),
common AS (
  SELECT doc_id, item_id, start, n_words, n_shingles, sum(n) AS size, sum(least(n, coalesce(m, 0))) AS common
  FROM wc LEFT JOIN ic USING (item_id, s) GROUP BY ALL
),
scored AS (SELECT *, common / (size + n_shingles - common) AS similarity FROM common),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS r FROM scored WHERE similarity >= 0.8)
SELECT doc_id, item_id, start AS start_word, n_words, similarity FROM best WHERE r = 1"""
