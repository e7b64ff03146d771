"""SQL of op11: product codes over vectors of `width` components, all distances written out."""

from __future__ import annotations


def sql(width: int = 64, parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    size = width // parts
    distance = " + ".join(f"(a.v[{k}] - b.v[{k}]) * (a.v[{k}] - b.v[{k}])" for k in range(1, size + 1))
    steps = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""",
        f"pieces AS MATERIALIZED (SELECT r, p, x[p * {size} + 1:(p + 1) * {size}] AS v FROM kept, range({parts}) AS t(p))",
        f"book0 AS MATERIALIZED (SELECT p, r - 1 AS entry, v FROM pieces WHERE r <= {entries})",
    ]
    for k in range(rounds + 1):
        # Distance and entry in one number: the least is the nearest entry, the first among equals.
        steps.append(f"near{k} AS MATERIALIZED (SELECT a.r, a.p, min(({distance}) * {entries} + b.entry) AS m FROM pieces a JOIN book{k} b ON a.p = b.p GROUP BY a.r, a.p)")
        if k < rounds:
            steps.append(f"""sums{k} AS MATERIALIZED (
  SELECT a.p, n.m % {entries} AS entry, i, CAST(sum(a.v[i]) AS BIGINT) AS s, count(*) AS c FROM pieces a JOIN near{k} n ON a.r = n.r AND a.p = n.p, range(1, {size + 1}) AS t(i) GROUP BY a.p, n.m % {entries}, i)""")
            steps.append(f"means{k} AS MATERIALIZED (SELECT p, entry, list(CAST((s - ((s % c) + c) % c) / c AS BIGINT) ORDER BY i) AS v FROM sums{k} GROUP BY p, entry)")
            steps.append(f"book{k + 1} AS MATERIALIZED (SELECT b.p, b.entry, coalesce(u.v, b.v) AS v FROM book{k} b LEFT JOIN means{k} u ON b.p = u.p AND b.entry = u.entry)")
    steps += [
        f"coded AS MATERIALIZED (SELECT r, string_agg(lower(printf('%02x', m % {entries})), '' ORDER BY p) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error FROM near{rounds} GROUP BY r)",
        f"digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, entry)) AS h FROM book{rounds})",
    ]
    return "WITH " + ",\n".join(steps) + """
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, d.h AS codebooks_sha256
FROM kept k JOIN coded c USING (r), digest d"""
