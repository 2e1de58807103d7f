"""DuckDB SQL of the queries that SQL can express."""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP9 = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS r FROM d GROUP BY source),
w AS (SELECT source, source_size, r, CAST(CASE (r - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS most FROM per),
f AS (SELECT *, most / weight AS fill FROM w),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY fill, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY fill, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f),
g AS (SELECT level AS final FROM l WHERE level <= fill ORDER BY fill, r LIMIT 1),
t AS (SELECT source, source_size, least(most, coalesce(weight * (SELECT final FROM g), most)) AS target FROM l),
p AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
c AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS budget,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto, sum(d.size) OVER (PARTITION BY d.source, d.h) AS own
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN upto - own + upto < 2 * budget THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
"""

OP4 = """
WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS h FROM documents),
c AS (SELECT doc_id, c, substr(h, 2 * c + 1, 1824) AS piece FROM (SELECT doc_id, h, CAST(unnest(range(0, length(h) // 2, 512)) AS INTEGER) AS c FROM d)),
b AS (SELECT doc_id, piece, c, CAST(unnest(range(0, least(512, length(piece) // 2))) AS INTEGER) AS j FROM c),
w AS (SELECT doc_id, c + j AS p, substr(piece, 2 * j + 1, 2) AS byte, CASE WHEN length(piece) - 2 * j >= 800 THEN md5(substr(piece, 2 * j + 1, 800)) END AS win FROM b),
n AS (SELECT win, count(*) AS n FROM w WHERE win IS NOT NULL GROUP BY win),
hit AS (SELECT doc_id, p, byte, coalesce(n, 0) > 1 AS hit FROM w LEFT JOIN n USING (win)),
gone AS (SELECT doc_id, p, byte, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 399 PRECEDING AND CURRENT ROW) AS gone FROM hit),
runs AS (SELECT doc_id, p, byte, gone, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY p) AS first FROM gone),
kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (first) AS n_spans, string_agg(CASE WHEN gone THEN '' ELSE byte END, '' ORDER BY p) AS kept FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP5 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 2) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS m FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.m)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(m) AS component_id FROM r GROUP BY doc_id) USING (doc_id)
"""

OP6 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT win, min(doc_id) AS first FROM win GROUP BY win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN f USING (win) WHERE first < doc_id),
kept AS (SELECT t.doc_id, count(gone.p) AS n_removed, string_agg(CASE WHEN gone.p IS NULL THEN word END, ' ' ORDER BY t.p) AS kept
         FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) t LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.p = t.p GROUP BY t.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

OP12 = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY row_number() OVER w <= 3
"""

ORACLE_SQL = {"op2_decontamination": OP2, "op4_suffix_dedup": OP4, "op5_jaccard_join": OP5, "op6_substring_dedup": OP6, "op9_mixing": OP9, "op12_hard_negatives": OP12}
