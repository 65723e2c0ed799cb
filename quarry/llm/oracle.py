"""DuckDB SQL for the numbered queries that SQL can express on whole tables."""

ORACLE = {
    "op5_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
                   WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
                   FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 10""",
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents""",
    "op12_merkle_manifest": """
        WITH RECURSIVE leaves AS (
            SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                   sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')]),
                       lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, (r & 1) * 3988292384))) & 1 AS odd,
                   replace(text, chr(10), '') AS less,
                   CASE WHEN odd = 1 THEN sha256(head || coalesce(strlen(less) || ':' || less, '-')) ELSE leaf END AS tampered
            FROM documents),
        trees AS (
            SELECT source, 0 AS lvl, list(leaf ORDER BY doc_id, leaf) AS nodes FROM leaves GROUP BY source
            UNION ALL
            SELECT source, lvl + 1, [sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], '')) for i in range(0, (len(nodes) + 2) // 3)]
            FROM trees WHERE len(nodes) > 1),
        subroots AS (SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM trees WHERE len(nodes) = 1),
        top AS (
            SELECT 0 AS lvl, list(subroot ORDER BY place) AS nodes FROM subroots
            UNION ALL
            SELECT lvl + 1, [sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], '')) for i in range(0, (len(nodes) + 2) // 3)]
            FROM top WHERE len(nodes) > 1),
        ranked AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS id, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS place FROM leaves),
        met AS (
            SELECT id, t.lvl, t.nodes, r.place // (3 ** t.lvl)::BIGINT AS spot FROM ranked r JOIN trees t ON r.source IS NOT DISTINCT FROM t.source WHERE len(t.nodes) > 1
            UNION ALL
            SELECT id, 1000 + t.lvl, t.nodes, s.place // (3 ** t.lvl)::BIGINT AS spot
            FROM ranked r JOIN subroots s ON r.source IS NOT DISTINCT FROM s.source JOIN top t ON len(t.nodes) > 1),
        proofs AS (
            SELECT id, list([array_to_string(nodes[spot - spot % 3 + 1 : spot], ''), array_to_string(nodes[spot + 2 : spot - spot % 3 + 3], '')] ORDER BY lvl) AS steps
            FROM met GROUP BY id),
        whole AS (SELECT r.*, s.subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root, coalesce(p.steps, []) AS steps
                  FROM ranked r JOIN subroots s ON r.source IS NOT DISTINCT FROM s.source LEFT JOIN proofs p ON p.id = r.id)
        SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string([x[1] || x[2] for x in steps], ''), '')) AS proof_sha256,
               list_reduce(list_prepend([tampered, ''], steps), lambda a, x: [sha256(x[1] || a[1] || x[2]), ''])[1] AS folded_root,
               folded_root = root AS verified
        FROM whole""",
}
