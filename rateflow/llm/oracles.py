"""DuckDB SQL for the queries that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ALL = {
    "op1_line_dedup": f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents),
k AS (SELECT *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
j AS (SELECT k.*, r.first IS NOT NULL AND r.first <> doc_id AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
    "op8_decontaminate": f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
bw AS (SELECT item, words, least(13, len(words)) AS k, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS i
       FROM b WHERE len(words) > 0),
keys AS (SELECT DISTINCT item, k, array_to_string(words[i:i + k - 1], ' ') AS key FROM bw),
ks AS (SELECT DISTINCT k FROM keys),
dw AS (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, ks WHERE len(words) >= k),
found AS (SELECT doc_id, i, d.k, item FROM (SELECT *, array_to_string(words[i:i + k - 1], ' ') AS key FROM dw) d
          JOIN keys USING (k, key)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_top_k_search": """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0) q JOIN v c ON q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op12_ranked_search": f"""
WITH d AS (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*) FILTER (len(words) > 0) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_words FROM d),
t AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(words) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s),
m AS (SELECT doc, doc_id, 50 + (50 * len(words) * n_docs) // n_words AS m FROM d, s WHERE len(words) > 0),
x AS (SELECT item_id, doc_id, doc, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN t USING (term) JOIN m USING (doc) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM x WHERE score > 0 AND doc_id IS NOT NULL)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50""",
    "op13_source_divergence": f"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents),
t AS (SELECT doc, lang, source, unnest(words) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
l AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source)
      GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
             1 + (1000000000 * (coalesce(c.c, 0) + 5)) // (g.n + 5 * l.v) AS p,
             1 + (1000000000 * (k.c + 5)) // (l.n + 5 * l.v) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
a AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
u AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(a.value, 0) AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
      LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, rank FROM r WHERE part = 'pair' OR rank <= 50""",
}
