"""SQL beside the queries, written from the rules, where SQL can express one."""

from __future__ import annotations


def _clusters(rounds: int = 10, clusters: int = 8) -> str:
    """Every round is a pair of tables: each vector's nearest centroid, and the moved centroids."""
    parts = [
        """kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)""",
        f"""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, p) - 1 AS cluster, p
    FROM (SELECT sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, p FROM kept ORDER BY h, p LIMIT {clusters})
)""",
    ]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (
    SELECT r, any_value(vec_id) AS vec_id, any_value(p) AS p, min(struct_pack(d := d, c := cluster)) AS best
    FROM (
        SELECT kept.r, kept.vec_id, kept.p, c.cluster,
               CAST(list_sum(list_transform(list_zip(kept.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM kept CROSS JOIN c{n} AS c
    ) GROUP BY r
)""")
        if n < rounds:
            parts.append(f"""c{n + 1} AS MATERIALIZED (
    SELECT c.cluster, coalesce(moved.p, c.p) AS p
    FROM c{n} AS c LEFT JOIN (
        SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY place) AS p
        FROM (
            SELECT best.c AS cluster, place, sum(x) AS total, count(*) AS n
            FROM (SELECT best, unnest(p) AS x, generate_subscripts(p, 1) AS place FROM a{n})
            GROUP BY best.c, place
        ) GROUP BY cluster
    ) AS moved USING (cluster)
)""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.p, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} AS c ON c.cluster = best.c"""


def _crc32(text: str) -> str:
    """Bits of CRC-32 one by one: a code point is mixed in, then eight shifts (-1) follow."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda x: [ord(x), -1, -1, -1, -1, -1, -1, -1, -1]))"
    one = "CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, (s & 1) * 3988292384) END"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda s, x: {one}), 4294967295)"


_TRIE = f"""
WITH turns AS MATERIALIZED (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS MATERIALIZED (
    SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), parts AS (
    SELECT c.conv_id, 0 AS part, t.place, t.role, t.text FROM convs AS c JOIN turns AS t ON t.conv_id = c.base AND t.place <= c.h
    UNION ALL
    SELECT c.conv_id, 1, t.place, t.role, t.text FROM convs AS c JOIN turns AS t ON t.conv_id = c.conv_id AND t.place > c.h
), rebuilt AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth FROM parts
), steps AS MATERIALIZED (
    SELECT conv_id, depth, strlen(text) AS n_bytes,
           sha256(string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '')
                  OVER (PARTITION BY conv_id ORDER BY depth)) AS prefix
    FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs
), lengths AS (
    SELECT conv_id, max(depth) AS depth FROM steps GROUP BY conv_id
), nodes AS MATERIALIZED (
    SELECT depth, prefix, min(s.conv_id) AS conv_id, count(*) AS n_convs, any_value(n_bytes) AS n_bytes,
           sha256(coalesce(string_agg(CAST(l.conv_id AS VARCHAR), ',' ORDER BY l.conv_id), '')) AS ends_sha256
    FROM steps AS s LEFT JOIN lengths AS l USING (conv_id, depth)
    GROUP BY depth, prefix
), path AS MATERIALIZED (
    SELECT s.conv_id, n.depth, n.conv_id AS node FROM steps AS s JOIN nodes AS n USING (depth, prefix)
), linked AS MATERIALIZED (
    SELECT n.*, p.node AS parent FROM nodes AS n LEFT JOIN path AS p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
), children AS MATERIALIZED (
    SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL
), sums AS (
    SELECT p.node AS conv_id, p.depth, count(*) FILTER (c.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.n_bytes) AS saved
    FROM linked AS n LEFT JOIN children AS c USING (conv_id, depth)
    JOIN path AS p ON p.conv_id = n.conv_id AND p.depth <= n.depth
    GROUP BY ALL
)
SELECT n.conv_id, n.depth, n.parent AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM linked AS n LEFT JOIN children AS c USING (conv_id, depth) JOIN sums AS s USING (conv_id, depth)"""

SQL: dict[str, str] = {"op12_prefix_trie": _TRIE, "op13_centroid_clusters": _clusters()}
