"""The same relations in SQL: common table expressions that the oracle queries begin with."""

IMAGES = """
img0 AS (SELECT CAST(vec_id AS VARCHAR) AS rel, vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings),
img1 AS (SELECT *, list_sort(v[2:64])[32] AS med, list_sum([abs(x) FOR x IN v]) AS size FROM img0),
img AS (SELECT rel, vec_id % 2 AS odd, label, v,
  CAST(list_sum([CASE WHEN v[i + 2] > med THEN CAST(1 AS BIGINT) << i ELSE 0 END FOR i IN range(0, 63)]) AS BIGINT) AS phash,
  [abs(x) / size FOR x IN v] AS hist, 100 + (37 * vec_id) % 400 AS w, 100 + (53 * vec_id) % 300 AS h,
  list_sum([CASE WHEN abs(v[i] - v[i + 1]) > 0.1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FOR i IN range(1, 64)]) / 63 AS edge FROM img1)"""

NEAR = (
    IMAGES
    + """,
near AS (SELECT r.rel AS ref, e.rel AS ex, CAST(bit_count(xor(r.phash, e.phash)) AS INTEGER) AS pd, r.hist AS p, e.hist AS q,
  abs(ln((e.w / e.h) / (r.w / r.h))) <= 0.5 AS aspect_ok, abs(e.edge - r.edge) <= 0.30 AS edge_ok
  FROM img r, img e WHERE r.odd = 0 AND e.odd = 1 AND bit_count(xor(r.phash, e.phash)) <= 28)"""
)

CANDIDATES = (
    NEAR
    + """,
rung AS (SELECT *, 20 + CAST(greatest(0, ceil((pd - 20) / 2)) AS INTEGER) * 2 AS rung FROM near WHERE aspect_ok AND edge_ok),
held AS (SELECT *, count(*) OVER (PARTITION BY ref ORDER BY rung RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held FROM rung),
stop AS (SELECT *, coalesce(min(CASE WHEN held >= 4 THEN rung END) OVER (PARTITION BY ref), 28) AS stop FROM held),
dist AS (SELECT ref, ex, pd, sqrt(greatest(0.0, 1.0 - list_sum([sqrt(p[i]) * sqrt(q[i]) FOR i IN range(1, 65)]))) AS hd FROM stop WHERE rung <= stop),
fill AS (SELECT *, hd <= 0.37 AS passed, row_number() OVER (PARTITION BY ref ORDER BY (hd <= 0.37) DESC, hd, pd, ex) AS fill FROM dist),
cand AS (SELECT ref, ex, pd, hd, passed, CAST(row_number() OVER (PARTITION BY ref ORDER BY hd, pd, ex) AS INTEGER) AS cand_ord FROM fill WHERE passed OR fill <= 4)"""
)

SCORES = (
    CANDIDATES
    + """,
vec AS (SELECT c.ref, c.ex, c.cand_ord, r.v AS x, e.v AS y, list_sum(r.v) / 64 AS mx, list_sum(e.v) / 64 AS my FROM cand c JOIN img r ON r.rel = c.ref JOIN img e ON e.rel = c.ex),
stat AS (SELECT *, list_sum([(x[i] - mx) * (y[i] - my) FOR i IN range(1, 65)]) AS cov0,
  list_sum([(a - mx) * (a - mx) FOR a IN x]) AS vx0, list_sum([(b - my) * (b - my) FOR b IN y]) AS vy0,
  list_sum([a * a FOR a IN x]) / 64 - mx * mx AS vx, list_sum([b * b FOR b IN y]) / 64 - my * my AS vy,
  list_sum([x[i] * y[i] FOR i IN range(1, 65)]) / 64 - mx * my AS cov,
  [i FOR i IN range(1, 65) IF sign(x[i]) = sign(y[i])] AS agree FROM vec),
scored AS (SELECT ref, ex, cand_ord, d.detector, len(agree) AS matches, len([i FOR i IN agree IF abs(x[i] - y[i]) <= d.tol]) AS inliers,
  greatest(-1.0, least(1.0, ((2 * mx * my + 0.0001) * (2 * cov + 0.0009)) / ((mx * mx + my * my + 0.0001) * (vx + vy + 0.0009)))) AS ssim,
  greatest(-1.0, least(1.0, cov0 / (sqrt(vx0 * vy0) + 1e-12))) AS ncc
  FROM stat, (VALUES ('SIFT', 0.06::DOUBLE), ('ORB', 0.05::DOUBLE)) AS d(detector, tol)),
rated AS (SELECT *, inliers / greatest(1, matches) AS inlier_ratio, inliers + 5.0::DOUBLE * (inliers / greatest(1, matches)) AS score FROM scored)"""
)

PAIRS = (
    SCORES
    + """,
best AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY ref, ex ORDER BY score DESC, CASE detector WHEN 'SIFT' THEN 1 ELSE 2 END) = 1),
phased AS (SELECT *, CASE WHEN inliers >= 12 AND inlier_ratio >= 0.30 AND (ssim >= 0.30 OR ncc >= 0.30) THEN 'A'
  WHEN inliers >= 8 AND inlier_ratio >= 0.20 AND (ssim >= 0.30 OR ncc >= 0.30) THEN 'B' ELSE '?' END AS phase FROM best WHERE cand_ord <= 64),
acc AS (SELECT *, CASE WHEN max(CASE WHEN phase = 'A' THEN 1 ELSE 0 END) OVER (PARTITION BY ref) = 1 THEN phase = 'A' ELSE phase = 'B' END AS acceptable FROM phased),
numbered AS (SELECT *, row_number() OVER (PARTITION BY ref, acceptable ORDER BY score DESC, cand_ord) AS n,
  coalesce(lead(score) OVER (PARTITION BY ref, acceptable ORDER BY score DESC, cand_ord), 0.0) AS second FROM acc),
pairs AS (SELECT *, CASE WHEN acceptable THEN CAST(n AS INTEGER) END AS rank, CASE WHEN acceptable AND n = 1 THEN score - second ELSE 0.0 END AS margin,
  CASE WHEN acceptable AND n = 1 THEN score / greatest(1e-6, second) ELSE 0.0 END AS mult FROM numbered),
flagged AS (SELECT *, acceptable AND n = 1 AND (margin < 1.0 OR mult < 1.05) AS suspect FROM pairs)"""
)

GREEDY = (
    PAIRS.replace("\nimg0 AS", "\nRECURSIVE_ img0 AS")
    + """,
prio AS (SELECT ref, row_number() OVER (ORDER BY max(score) DESC, ref) AS k FROM flagged WHERE acceptable GROUP BY ref),
serial AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS taken, CAST(NULL AS VARCHAR) AS ref, CAST(NULL AS VARCHAR) AS ex
  UNION ALL
  SELECT o.k, CASE WHEN o.ex IS NULL THEN o.taken ELSE list_append(o.taken, o.ex) END, o.ref, o.ex FROM (
    SELECT p.k, s.taken, p.ref, (SELECT arg_min(f.ex, f.rank) FROM flagged f WHERE f.ref = p.ref AND f.acceptable AND NOT list_contains(s.taken, f.ex)) AS ex
    FROM serial s JOIN prio p ON p.k = s.k + 1) o),
assigned AS (SELECT f.* FROM serial s JOIN flagged f ON f.ref = s.ref AND f.ex = s.ex)"""
).replace("RECURSIVE_ ", "")


def query(parts: str, body: str) -> str:
    return f"WITH {'RECURSIVE ' if 'serial AS' in parts else ''}{parts.strip()}\n{body.strip()}"
