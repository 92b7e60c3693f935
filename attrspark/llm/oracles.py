"""SQL of the operators on vectors and conversations, for tables that fit one machine."""

from __future__ import annotations


def trie_sql(groups: int = 5, folds: int = 9) -> str:
    """Every prefix of every rebuilt conversation, grouped as a list; sums over all pairs of a
    node and a node below it."""
    return f"""
        WITH bits AS (
          SELECT list(list_reduce([b] || [0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS tab
          FROM (SELECT unnest(range(256)) AS b)
        ), turns AS (
          SELECT conv_id, turn, coalesce(text, '') AS text,
            left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS digest
          FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
          SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest) AS own FROM turns GROUP BY conv_id
        ), sizes AS (SELECT digest, any_value(strlen(text)) AS size FROM turns GROUP BY digest
        ), folds AS (
          SELECT conv_id, own, conv_id - conv_id % {groups} AS base,
            xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
              lambda c, x: xor(tab[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % {folds} AS h
          FROM own, bits
        ), paths AS (
          SELECT f.conv_id, coalesce(o.own[1:h], []) || f.own[h + 1:] AS path
          FROM folds f LEFT JOIN own o ON o.conv_id = f.base
        ), prefixes AS (
          SELECT conv_id, path[1:d] AS node, d, len(path) = d AS ends
          FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM paths)
        ), nodes AS (
          SELECT node, d, min(conv_id) AS conv_id, count(*) AS n,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
          FROM prefixes GROUP BY node, d
        ), children AS (SELECT node[1:d - 1] AS node, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY 1
        ), costs AS (
          SELECT n.node, n.d, coalesce(kids, 0) AS kids, coalesce((n - 1) * size, 0) AS cost
          FROM nodes n LEFT JOIN children c ON c.node = n.node LEFT JOIN sizes s ON s.digest = n.node[d]
        ), sums AS (
          SELECT node[1:a] AS node, sum(cost) AS saved, count(*) FILTER (WHERE kids = 0) AS leaves
          FROM (SELECT node, cost, kids, unnest(range(d + 1)) AS a FROM costs) GROUP BY 1
        )
        SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs,
          coalesce(kids, 0) AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, n.ends_sha256
        FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN children c ON c.node = n.node
        LEFT JOIN nodes p ON n.d > 0 AND p.node = n.node[1:n.d - 1]
    """


def codes_sql(entries: int = 256, parts: int = 4, rounds: int = 4) -> str:
    """Full scans of all entries in every round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
        near{k} AS MATERIALIZED (
          SELECT v.row, v.p, any_value(v.v) AS v, arg_min(e, [d, e]) AS e, min(d) AS d FROM (
            SELECT v.row, v.p, v.v, b.e,
              list_sum(list_transform(range(1, len(v.v) + 1), lambda i: (v.v[i] - b.v[i]) * (v.v[i] - b.v[i])))::BIGINT AS d
            FROM parts v JOIN book{k} b ON v.p = b.p) v
          GROUP BY v.row, v.p
        )""")
        if k < rounds:
            steps.append(f"""
        mean{k} AS (
          SELECT p, e, list(m ORDER BY i) AS v FROM (
            SELECT p, e, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m
            FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM near{k}) GROUP BY p, e, i)
          GROUP BY p, e
        ), book{k + 1} AS MATERIALIZED (
          SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN mean{k} m ON m.p = b.p AND m.e = b.e
        )""")
    return f"""
        WITH kept AS (
          SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
          FROM embeddings WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS MATERIALIZED (
          SELECT row, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS v
          FROM kept, (SELECT unnest(range({parts})) AS p)
        ), firsts AS (SELECT row, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}
        ), book0 AS MATERIALIZED (SELECT p.p, f.e, p.v FROM parts p JOIN firsts f USING (row)
        ), {",".join(steps)},
        codes AS (
          SELECT row, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
          FROM near{rounds} GROUP BY row
        ), text AS (
          SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
        )
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM kept JOIN codes USING (row), text
    """
