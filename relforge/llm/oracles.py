"""DuckDB SQL for the training-data operators that SQL can express."""

from __future__ import annotations

from .vector_codes import ENTRIES, PARTS, ROUNDS, SCALE


def vector_codes_sql() -> str:
    """Product codes: the rounds of k-means as one chain of tables, every part against every entry of its codebook."""
    tables = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, [CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len([1 FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0)""", f"""
cut AS MATERIALIZED (
  SELECT r, part, CAST(list_slice(x, part * len(x) // {PARTS} + 1, (part + 1) * len(x) // {PARTS}) AS DOUBLE[]) AS v
  FROM kept, range({PARTS}) p(part))""", f"""
first AS (SELECT vec_id, min(x) AS x FROM kept GROUP BY vec_id ORDER BY vec_id NULLS LAST LIMIT {ENTRIES})""", f"""
book0 AS MATERIALIZED (
  SELECT part, entry, CAST(list_slice(x, part * len(x) // {PARTS} + 1, (part + 1) * len(x) // {PARTS}) AS DOUBLE[]) AS e
  FROM (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS entry, x FROM first) f, range({PARTS}) p(part))"""]
    for k in range(ROUNDS + 1):
        tables.append(f"""
near{k} AS MATERIALIZED (
  SELECT r, part, v, min({{'d': list_inner_product(v, v) - 2 * list_inner_product(v, e) + list_inner_product(e, e), 'entry': entry}}) AS best
  FROM cut JOIN book{k} USING (part) GROUP BY r, part, v)""")
        if k < ROUNDS:
            tables.append(f"""
mean{k} AS (
  SELECT part, entry, list(m ORDER BY place) AS e FROM (
    SELECT part, best.entry AS entry, place, floor(sum(v[place]) / count(*)) AS m
    FROM near{k}, range(1, (SELECT max(len(v)) + 1 FROM cut)) p(place) GROUP BY part, best.entry, place) s GROUP BY part, entry)""")
            tables.append(f"""
book{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.e, b.e) AS e FROM book{k} b LEFT JOIN mean{k} m USING (part, entry))""")
    return f"""WITH {','.join(tables)},
coded AS (
  SELECT r, string_agg(lpad(to_hex(best.entry), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY r),
digest AS (
  SELECT sha256(string_agg(array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) FOR x IN e], ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


def near_dup_sql(least: int = 75) -> str:
    """Near duplicates: shingle sets, all pairs of documents that share a shingle, and what is reachable over their links."""
    return f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, [w FOR w IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\\x20\\x09-\\x0D]+') IF w <> ''] AS words FROM documents),
shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(words[i:least(i + 4, len(words))], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, least(len(words), 1) + 1))) AS i FROM texts) p),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) c
  JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * common >= {least} * (p.n + q.n - common)),
reach(a, b) AS (SELECT doc_id, doc_id FROM texts UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c LEFT JOIN size USING (doc_id)"""
