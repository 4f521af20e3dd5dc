"""DuckDB SQL for the queries that SQL can express."""

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_TERMS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""

OP2 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER.format("text"))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b USING (g) JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""

OP5 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
k AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM k),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM f WHERE r > 1),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
p AS (SELECT x.doc_id, count(g.i) AS n_removed, string_agg(word, ' ' ORDER BY x.i) FILTER (WHERE g.i IS NULL) AS kept FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.i = x.i GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN p USING (doc_id)
"""

OP7 = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
k AS (SELECT doc_id, i, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS k FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM d WHERE len(l) >= 3)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM k),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 3)) AS i FROM f WHERE r > 1),
x AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM d),
p AS (SELECT x.doc_id, count(g.i) AS n_removed, string_agg(line, chr(10) ORDER BY x.i) FILTER (WHERE g.i IS NULL) AS kept FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.i = x.i GROUP BY 1)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d JOIN p USING (doc_id)
"""

OP9 = f"""
WITH d AS (SELECT doc_id, {_TERMS.format(_LOWER.format("text"))} AS w FROM documents),
b AS (SELECT item_id, {_TERMS.format(_LOWER.format("text"))} AS w FROM benchmark WHERE item_id IS NOT NULL),
k AS (SELECT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + 9], ' ') AS k FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT DISTINCT m FROM k),
h AS (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS k FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d JOIN s ON len(w) >= m)),
o AS (SELECT doc_id, h.m, i, item_id FROM h JOIN k USING (k, m)),
c AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS x FROM o) GROUP BY 1),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS items FROM o GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format(_LOWER.format("text"))} AS w FROM documents),
s AS (SELECT r, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
a AS (SELECT CAST(count(*) AS BIGINT) AS c, CAST(sum(n) AS BIGINT) AS l FROM s),
b AS (SELECT DISTINCT item_id, unnest({_TERMS.format(_LOWER.format("text"))}) AS term FROM benchmark WHERE item_id IS NOT NULL),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM b) GROUP BY 1, 2),
f AS (SELECT term, CAST(floor(1000 * ln((2 * c + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, a GROUP BY term, c),
i AS (SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * c) // l))) AS impact FROM t JOIN f USING (term) JOIN s USING (r), a),
x AS (SELECT item_id, r, CAST(sum(impact) AS BIGINT) AS score FROM b JOIN i USING (term) GROUP BY 1, 2 HAVING sum(impact) > 0),
o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM x JOIN s USING (r) WHERE doc_id IS NOT NULL)
SELECT * FROM o WHERE rank <= 10
"""

OP13 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, 200) AS k FROM (SELECT r, doc_id, h, unnest(range(0, greatest(len(h) // 2 - 99, 0))) AS i FROM d)),
f AS (SELECT r, i AS j, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS later FROM k),
b AS (SELECT r, j, substr(h, 2 * j + 1, 2) AS x FROM (SELECT r, h, unnest(range(0, len(h) // 2)) AS j FROM d)),
g AS (SELECT r, j, x, coalesce(bool_or(later) OVER (PARTITION BY r ORDER BY j ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), false) AS gone FROM b LEFT JOIN f USING (r, j)),
s AS (SELECT r, j, x, gone, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY j), false) AS starts FROM g),
p AS (SELECT r, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE starts) AS n_spans, string_agg(x, '' ORDER BY j) FILTER (WHERE NOT gone) AS kept FROM s GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN p USING (r)
"""

ORACLES = {"op1_topk": OP1, "op2_near_duplicates": OP2, "op5_substrings": OP5, "op7_line_dedup": OP7, "op9_decontaminate": OP9, "op11_search": OP11, "op13_suffix_dedup": OP13}
