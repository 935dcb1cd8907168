"""The corpus queries that SQL can express, over the whole tables."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
pos AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT d.*, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hit AS (SELECT p.doc_id, p.k, p.i, w.item_id FROM pos p JOIN win w USING (k, s)),
word AS (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, k, i FROM hit)),
word2 AS (SELECT *, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run FROM word),
longest AS (SELECT doc_id, max(n) AS longest FROM (SELECT doc_id, run, count(*) AS n FROM word2 GROUP BY doc_id, run) GROUP BY doc_id),
nw AS (SELECT doc_id, count(*) AS n_hit FROM word GROUP BY doc_id),
ni AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  CASE WHEN len(d.w) > 0 THEN coalesce(n_hit, 0) / len(d.w) ELSE 0.0 END AS coverage, coalesce(longest, 0) AS longest
FROM d LEFT JOIN nw USING (doc_id) LEFT JOIN ni USING (doc_id) LEFT JOIN longest USING (doc_id)"""

OP3 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT *, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING count(DISTINCT doc_id) > 1),
g AS (SELECT w.doc_id, w.i FROM w JOIN f USING (s) WHERE f.first < w.doc_id),
n AS (SELECT *, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 OR lag(i) OVER (PARTITION BY doc_id ORDER BY i) IS NULL THEN 1 ELSE 0 END AS new FROM g),
k AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM n),
spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM k GROUP BY doc_id, span),
cut AS (SELECT s.*, coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY a), 0) AS before, h FROM spans s JOIN d USING (doc_id)),
left_ AS (SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept, sum(b - a) AS gone, count(*) AS spans FROM cut GROUP BY doc_id)
SELECT d.doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN left_ USING (doc_id)"""

OP5 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS sh FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
e AS (SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, u.b FROM reach JOIN u ON u.a = reach.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r) AS component_id, min(r) = d.doc_id AS kept FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id, n.n"""


def op9(rules) -> str:
    """For each rule the matches and the pieces between them; positions are sums of their lengths."""
    parts = []
    for k, r in enumerate(rules):
        pattern = r.pattern.replace("'", "''")
        parts.append(
            f"""SELECT doc_id, {k} AS ord, '{r.kind}' AS kind, m[i] AS m, g[i] AS g, CAST(list_sum([length(x) FOR x IN p[1:i]]) + coalesce(list_sum([length(x) FOR x IN m[1:i - 1]]), 0) AS BIGINT) AS a, {r.least} AS least
            FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {r.group}) AS g, string_split_regex(t, '{pattern}') AS p FROM d))"""
        )
    union = "\nUNION ALL ".join(parts)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), raw AS ({union}),
f AS (SELECT doc_id, ord, kind, a, kind || ':' || a || ':' || (a + length(m)) AS s FROM raw WHERE length(g) >= least),
c AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(s, ',' ORDER BY a, ord) FILTER (ord < 3) AS base, string_agg(s, ',' ORDER BY a, ord) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, sha256(t) AS blob, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN c USING (doc_id)"""
