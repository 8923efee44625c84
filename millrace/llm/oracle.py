"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

BARE = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"
WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLES: dict[str, str] = {
    "op2_exact_dedup": f"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points, {BARE} AS bare FROM documents),
r AS (SELECT doc_id, bare, count(*) OVER (PARTITION BY bare) AS group_size,
      first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place
      FROM d WINDOW w AS (PARTITION BY bare ORDER BY points DESC, doc_id NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(bare) AS text_sha256 FROM r""",
    "op5_mixing": f"""
WITH d AS (SELECT doc_id, source, {WORDS} AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
c AS (SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
      coalesce(sum(source_size) OVER p, 0) AS full_size, coalesce(sum(weight) OVER p, 0) AS full_weight
      FROM w WINDOW p AS (ORDER BY source_size / weight, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a AS (SELECT *, 4 * source_size::HUGEINT * (weights - full_weight)
      < weight * (3 * total - 4 * full_size) AS above FROM c),
f AS (SELECT max(total) * 3 - 4 * coalesce(sum(source_size) FILTER (above), 0) AS free,
      max(weights) - coalesce(sum(weight) FILTER (above), 0) AS open_weight FROM a),
t AS (SELECT source, source_size, CASE WHEN above THEN 2.0::DOUBLE * source_size
      ELSE weight * free::DOUBLE / (2 * open_weight)::DOUBLE END AS target FROM a, f),
e AS (SELECT d.doc_id, d.size, t.source_size, t.target,
      CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS expected,
      ('0x' || substr(md5('mix|' || coalesce(d.source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS start,
      row_number() OVER (PARTITION BY d.source
        ORDER BY d.size, md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id NULLS FIRST) AS place
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (floor(place * expected + start) - floor((place - 1) * expected + start))::BIGINT * size AS taken FROM e""",
    "op12_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, c.component_id = e.vec_id AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id""",
}
