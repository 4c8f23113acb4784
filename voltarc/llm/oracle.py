"""SQL for DuckDB of the queries that SQL can express; written apart from the operators."""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"


def _codes() -> str:
    """Lloyd's rounds with full searches, on vectors of 64 components."""
    xs = [f"x{k}" for k in range(4)]
    off = " + ".join(f"(t.{x} - b.{x}) * (t.{x} - b.{x})" for x in xs)
    ctes = [
        "k AS (SELECT vec_id, label, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"t AS MATERIALIZED (SELECT r, vec_id, p, {', '.join(f'v[p * 4 + {k + 1}] AS x{k}' for k in range(4))} FROM k, range(16) AS q(p))",
        f"c0 AS MATERIALIZED (SELECT p, e - 1 AS e, {', '.join(xs)} FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY vec_id) AS e FROM t) WHERE e <= 64)",
    ]
    for n in range(3):
        ctes.append(f"d{n} AS (SELECT t.r, t.p, b.e, {off} AS d FROM t JOIN c{n} AS b USING (p))")
        ctes.append(f"a{n} AS MATERIALIZED (SELECT r, p, min(d) AS d, arg_min(e, d * 64 + e) AS e FROM d{n} GROUP BY r, p)")
        if n < 2:
            means = ", ".join(f"coalesce((s{k} - ((s{k} % n) + n) % n) // n, b.x{k})::BIGINT AS x{k}" for k in range(4))
            sums = ", ".join(f"sum(x{k})::BIGINT AS s{k}" for k in range(4))
            ctes.append(f"c{n + 1} AS MATERIALIZED (SELECT p, e, {means} FROM c{n} AS b LEFT JOIN (SELECT p, e, count(*) AS n, {sums} FROM t JOIN a{n} USING (r, p) GROUP BY p, e) USING (p, e))")
    ctes.append("h AS (SELECT sha256(string_agg(concat_ws(',', x0, x1, x2, x3), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2)")
    ctes.append("f AS (SELECT r, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY r)")
    return f"WITH {', '.join(ctes)} SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM k JOIN f USING (r), h"


#: Where a source is held back is told by the line of all shares: it is if the words of all aren't used up when it is full.
_SCHEDULE = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORD}))::BIGINT AS size, md5(concat(coalesce(doc_id::VARCHAR, ''), ':mix')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM d GROUP BY source),
g AS (SELECT s.*, sum(source_size) OVER () AS whole, (SELECT sum(least(3 * s.source_size / s.w * o.w, 3 * o.source_size)) FROM s AS o) < sum(source_size) OVER () AS held FROM s),
u AS (SELECT *, CASE WHEN held THEN 3.0::DOUBLE * source_size ELSE coalesce((whole - sum(CASE WHEN held THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE * w / sum(CASE WHEN held THEN 0 ELSE w END) OVER (), 0) END AS target FROM g),
v AS (SELECT source, source_size, target, round(target)::BIGINT AS words FROM u),
l AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d)
SELECT doc_id, size, source_size, target, (words // greatest(source_size, 1) * size + greatest(0, least(size, words % greatest(source_size, 1) - start)))::BIGINT AS taken
FROM l JOIN v ON l.source IS NOT DISTINCT FROM v.source
"""

_AUDIT = f"""
WITH l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents),
m AS (SELECT part, coalesce(good, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic, MAP {{
  'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words), 'C': 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * len(text),
  'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false) }} AS fails FROM d LEFT JOIN l USING (doc_id)),
a AS (SELECT * FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS x(f)),
o AS (SELECT concat(p.f, q.f, r.f, s.f, t.f) AS filter_order FROM a AS p, a AS q, a AS r, a AS s, a AS t WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
c AS (SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: fails[f]) AS failing, count(*) AS n FROM m GROUP BY ALL),
x AS (SELECT part, filter_order, step::INT AS step, filter_order[step] AS f, good, toxic, n, list_contains(failing, filter_order[step]) AS hit, len(list_filter(failing, lambda y: strpos(filter_order, y) < step)) > 0 AS gone, failing = [filter_order[step]] AS lone FROM c, o, range(1, 6) AS q(step)),
y AS (SELECT part, filter_order, step, f, sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN hit AND gone THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN lone THEN n ELSE 0 END)::BIGINT AS unique_fails, sum(CASE WHEN hit AND NOT gone AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN hit AND NOT gone AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost FROM x GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM y
"""

SQL: dict[str, str] = {"op11_vector_codes": _codes(), "op12_source_schedule": _SCHEDULE, "op13_filter_audit": _AUDIT}
