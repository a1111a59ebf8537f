"""SQL for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCHMARK_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SUBSTRING_DEDUP = r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (h) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN hit USING (doc_id, p) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

EMBEDDING_DEDUP = """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lows AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT lows.a AS vec_id, coalesce(n, 0) AS n_links, component_id, lows.a = component_id AS kept
FROM lows LEFT JOIN counts USING (a)"""

DECONTAMINATION = rf"""WITH d AS (SELECT doc_id, {_BENCHMARK_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS k FROM (SELECT item_id, {_BENCHMARK_WORDS} AS w FROM benchmark)),
grams AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM b WHERE k > 0)),
spots AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM grams) WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, k, item_id FROM spots JOIN grams USING (k, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY 1),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""

LINE_DEDUP = r"""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
runs AS (SELECT doc_id, i, row_number() OVER (PARTITION BY l[i], l[i + 1] ORDER BY doc_id, i) AS n
  FROM (SELECT doc_id, l, unnest(range(1, len(l))) AS i FROM d)),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM d),
single AS (SELECT doc_id, p, row_number() OVER (PARTITION BY line ORDER BY doc_id, p) AS n FROM lines
  WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 5),
hit AS (SELECT doc_id, unnest(range(i, i + 2)) AS p FROM runs WHERE n > 1 UNION SELECT doc_id, p FROM single WHERE n > 1),
kept AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS t FROM lines ANTI JOIN hit USING (doc_id, p) GROUP BY 1)
SELECT doc_id, len(l) AS n_lines, len(l) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED_SEARCH = rf"""WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
s AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS tokens FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
df AS (SELECT term, count(*) AS df FROM t WHERE term IN (SELECT term FROM q) GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM df, s),
scores AS (SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // tokens)))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN weights USING (term), s GROUP BY item_id, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

_LETTERS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"

DIVERGENCE = rf"""WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LETTERS} AS w
  FROM documents),
t AS (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM t GROUP BY ALL HAVING count(DISTINCT k) >= 10),
counts AS (SELECT lang, source, term, count(*) AS c FROM t JOIN (SELECT lang, term FROM kept) USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang),
g AS (SELECT lang, source, v, coalesce(s.n, 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL) s USING (lang, source) LEFT JOIN v USING (lang)),
p AS (SELECT lang, source, term, coalesce(counts.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(counts.c, 0) + 2)) // (g.n + 2 * g.v) AS p,
    1 + (1000000000::HUGEINT * (kept.c + 2)) // (v.n + 2 * v.v) AS q
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN counts USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(value, 0) AS value
  FROM g JOIN g o ON g.lang = o.lang AND g.source <> o.source
  LEFT JOIN pairs ON pairs.lang = g.lang AND pairs.source = g.source AND pairs.item = o.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (FROM every UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= 10"""
