"""DuckDB SQL for the operators that SQL can express."""

_KEPT = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _codes(rounds: int) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS (
  SELECT s.vec_id, s.p, arg_min(b.e, {{'d': list_sum(list_transform(list_zip(s.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': b.e}}) AS e,
         min(list_sum(list_transform(list_zip(s.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d
  FROM parts s JOIN b{r} b ON s.p = b.p GROUP BY s.vec_id, s.p)"""
        )
        if r < rounds:
            steps.append(
                f"""m{r} AS (
  SELECT p, e, list(x ORDER BY j) AS c FROM (
    SELECT p, e, j, floor(sum(x) / count(*))::BIGINT AS x
    FROM (SELECT a.p, a.e, unnest(s.c) AS x, unnest(range(len(s.c))) AS j FROM a{r} a JOIN parts s ON a.vec_id = s.vec_id AND a.p = s.p)
    GROUP BY p, e, j) GROUP BY p, e),
b{r + 1} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN m{r} m ON b.p = m.p AND b.e = m.e)"""
            )
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE {_KEPT}),
parts AS (SELECT vec_id, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS c FROM kept, range(8) t(p)),
b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, c FROM parts QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 16),
{", ".join(steps)},
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, j)) AS h FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS j FROM b{rounds}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), books"""


VECTOR_CODES = _codes(6)

HARD_NEGATIVES = f"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND {_KEPT}),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS rank,
         n.other_id AS negative_id, p.positive_score, n.score AS negative_score
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5"""
