"""DuckDB SQL of the corpus queries that SQL can express on whole tables."""

from __future__ import annotations

WORDS = r"[\x20\x09-\x0D]+"

# first occurrence of every 20-word window; the words of the later ones are gone
OP1 = rf"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{WORDS}'), lambda x: x <> '') AS w
           FROM documents),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS rn FROM k)
          WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM later),
kept AS (SELECT p.doc_id, string_agg(p.x, ' ' ORDER BY p.j) AS t, count(*) AS n
         FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d) p
         ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.j = g.j GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

# the same over bytes, as hexadecimal digits
OP5 = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
k AS (SELECT doc_id, i, md5(x[2 * i - 1:2 * i + 198]) AS h
      FROM (SELECT doc_id, x, unnest(range(1, n - 98)) AS i FROM d)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS rn FROM k)
          WHERE rn > 1),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b
         FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
               FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100
                                            THEN 0 ELSE 1 END AS fresh FROM later))
         GROUP BY doc_id, run),
s AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS spans, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends
      FROM runs GROUP BY 1)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN spans IS NULL THEN x ELSE array_to_string(list_transform(range(0, spans + 1),
           lambda r: x[2 * (CASE WHEN r = 0 THEN 1 ELSE ends[r] END) - 1:
                  2 * (CASE WHEN r = spans THEN n ELSE starts[r + 1] - 1 END)]), '') END)) AS kept_sha256
FROM d LEFT JOIN s ON d.doc_id = s.doc_id"""

# all pairs that share a shingle, exact similarity, reachability
OP4 = rf"""WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{WORDS}'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS s FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id
          GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * s >= 80 * (x.n + y.n - s)),
reach AS (SELECT doc_id AS v, doc_id AS u FROM d
          UNION SELECT reach.v, e.u FROM reach JOIN (SELECT a AS t, b AS u FROM links UNION ALL SELECT b, a FROM links) e
                ON e.t = reach.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(u) FROM reach WHERE v = d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id"""

# k-means on the integers, the rounds written out

def _assigned(name: str, centroids: str) -> str:
    return f"""{name} AS (SELECT r, vec_id, v, c, d FROM (
  SELECT k.r, k.vec_id, k.v, e.c, CAST(list_sum(list_transform(list_zip(k.v, e.v),
         lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM k CROSS JOIN {centroids} e)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""


def _moved(name: str, before: str, assigned: str) -> str:
    return f"""{name} AS (SELECT b.c, coalesce(n.v, b.v) AS v FROM {before} b LEFT JOIN (
  SELECT c, list(m ORDER BY j) AS v FROM (SELECT c, j, (s - ((s % n) + n) % n) // n AS m FROM (
    SELECT c, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
    FROM (SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS j FROM {assigned}) GROUP BY c, j)) GROUP BY c) n ON n.c = b.c)"""


OP11 = f"""WITH k AS (SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM k QUALIFY c < 16),
{_assigned("a1", "c0")}, {_moved("c1", "c0", "a1")}, {_assigned("a2", "c1")}, {_moved("c2", "c1", "a2")},
{_assigned("a3", "c2")}, {_moved("c3", "c2", "a3")}, {_assigned("a4", "c3")}
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM a4 a JOIN c3 ON c3.c = a.c"""

ORACLE_SQL = {"op11_centroid_clusters": OP11, "op1_substring_dedup": OP1, "op4_ngram_join": OP4, "op5_suffix_dedup": OP5}
