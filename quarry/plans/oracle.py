"""DuckDB oracle SQL for the registered queries.

The oracles do not parse anything: they restate the corpus rules of ``quarry/sources/corpus.py``
and compute, straight from the star tables, which objects, references, definitions, requests and
links the analysis must find. Spark has to arrive at the same rows by scanning the generated text.
Raw-text operators (line split, brace depth, imports) are checked with DuckDB string/regex functions.
"""

from __future__ import annotations

# ------------------------------------------------------------------------------------------------
# shared CTEs — schema corpus expectations
# ------------------------------------------------------------------------------------------------
SCHEMA = """
sp AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS pk FROM lineitem),
spz AS (SELECT sp.s, sp.pk, p.p_size AS z, CAST(sp.pk % 3 AS INTEGER) AS r
        FROM sp LEFT JOIN part p ON p.p_partkey = sp.pk),
spr AS (SELECT *, row_number() OVER (PARTITION BY s, r ORDER BY pk) AS rk FROM spz),
cnt AS (SELECT su.s_suppkey AS s,
               count(spz.pk) FILTER (WHERE spz.r = 0) AS nq,
               count(spz.pk) FILTER (WHERE spz.r = 1) AS nm,
               count(spz.pk) FILTER (WHERE spz.r = 2) AS ns
        FROM supplier su LEFT JOIN spz ON spz.s = su.s_suppkey GROUP BY su.s_suppkey),
decl AS (SELECT su.s_suppkey AS s, t.z FROM supplier su CROSS JOIN range(1, 51) t(z)
         WHERE (t.z % 4 = 0 AND su.s_suppkey % 3 = 0) OR (t.z % 4 = 1 AND su.s_suppkey = t.z % 10) OR t.z % 4 = 3),
dsz AS (SELECT s, z, CASE WHEN z % 8 = 0 THEN 1 ELSE 3 END AS size FROM decl),
doff AS (SELECT s, z, size, coalesce(sum(size) OVER (PARTITION BY s ORDER BY z
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM dsz),
itot AS (SELECT s, sum(size) AS itot FROM dsz GROUP BY s),
sup AS (SELECT c.s, printf('svc/s%07d.graphqls', c.s) AS path, c.nq, c.nm, c.ns,
               c.nq + c.nm + c.ns + 7 AS b, c.nq + c.nm + c.ns + 7 + coalesce(i.itot, 0) + 1 AS e,
               c.nq + c.nm + c.ns + 7 + coalesce(i.itot, 0) + 1 + 3 + CASE WHEN c.s % 2 = 1 THEN 3 ELSE 0 END AS n_lines
        FROM cnt c LEFT JOIN itot i ON i.s = c.s),
fld AS (SELECT u.path, spr.s, spr.pk, spr.z, spr.r,
               CASE spr.r WHEN 0 THEN 'Query' WHEN 1 THEN 'Mutation' ELSE 'Subscription' END AS rt,
               CASE spr.r WHEN 0 THEN spr.rk + 2 WHEN 1 THEN u.nq + 4 + spr.rk ELSE u.nq + u.nm + 6 + spr.rk END AS line
        FROM spr JOIN sup u ON u.s = spr.s),
inp AS (SELECT u.path, d.s, d.z, d.size, u.b + 1 + d.off AS line FROM doff d JOIN sup u ON u.s = d.s),
obj0 AS (
  SELECT path, 'GraphQLProgram' AS type, printf('s%07d.graphqls', s) AS name, path AS fullname,
         CAST(NULL AS VARCHAR) AS parent_fullname, 1 AS start_line, n_lines AS end_line, 0 AS gline FROM sup
  UNION ALL SELECT path, 'GraphQLType', 'Query', path || '.Query', path, 2, nq + 3, 2 FROM sup
  UNION ALL SELECT path, 'GraphQLType', 'Mutation', path || '.Mutation', path, nq + 4, nq + nm + 5, nq + 4 FROM sup
  UNION ALL SELECT path, 'GraphQLType', 'Subscription', path || '.Subscription', path, nq + nm + 6, nq + nm + ns + 7,
                   nq + nm + 6 FROM sup
  UNION ALL SELECT path, 'GraphQLField', printf('p%d', pk), path || '.' || rt || '.' || printf('p%d', pk),
                   path || '.' || rt, line, line, line FROM fld
  UNION ALL SELECT path, 'GraphQLInput', printf('In%d', z), path || '.' || printf('In%d', z), path, line,
                   line + size - 1, line FROM inp
  UNION ALL SELECT path, 'GraphQLField', 'v', path || '.' || printf('In%d', z) || '.v', path || '.' || printf('In%d', z),
                   line + 1, line + 1, line + 1 FROM inp WHERE size = 3
  UNION ALL SELECT path, 'GraphQLEnum', printf('Kind%d', s), path || '.' || printf('Kind%d', s), path, e, e + 3, e FROM sup
  UNION ALL SELECT path, 'GraphQLEnumValue', 'LOW', path || '.' || printf('Kind%d', s) || '.LOW',
                   path || '.' || printf('Kind%d', s), e + 1, e + 1, e + 1 FROM sup
  UNION ALL SELECT path, 'GraphQLEnumValue', 'HIGH', path || '.' || printf('Kind%d', s) || '.HIGH',
                   path || '.' || printf('Kind%d', s), e + 2, e + 2, e + 2 FROM sup
  UNION ALL SELECT path, 'GraphQLField', printf('x%d', s), path || '.Query.' || printf('x%d', s), path || '.Query',
                   e + 5, e + 5, e + 5 FROM sup WHERE s % 2 = 1
),
obj AS (SELECT *, type || '?[' || replace(path, '?', '_') || '].' || fullname || '@' || CAST(gline AS VARCHAR) AS guid
        FROM obj0),
refs AS (SELECT path, s, z, line, path || '.' || rt || '.' || printf('p%d', pk) AS caller, 0 AS arg_pos,
                printf('In%d', z) AS callee FROM fld
         UNION ALL
         SELECT path, s, z, line, path || '.' || rt || '.' || printf('p%d', pk), 1, printf('In%d', z)
         FROM fld WHERE pk % 4 = 0),
ndecl AS (SELECT z, count(*) AS n, min(s) AS first_s FROM decl GROUP BY z),
res AS (SELECT r.*,
               CASE WHEN d.s IS NOT NULL THEN 'same_file' WHEN nd.n = 1 THEN 'cross_unique'
                    WHEN nd.n > 1 THEN 'cross_tiebreak' ELSE 'unresolved' END AS resolution,
               CASE WHEN d.s IS NOT NULL THEN r.path || '.' || r.callee
                    WHEN nd.n >= 1 THEN printf('svc/s%07d.graphqls', nd.first_s) || '.' || r.callee END AS target
        FROM refs r LEFT JOIN decl d ON d.s = r.s AND d.z = r.z LEFT JOIN ndecl nd ON nd.z = r.z),
sidx AS (SELECT parent_fullname, name, fullname, path FROM obj WHERE type = 'GraphQLField'),
stypes AS (SELECT fullname AS parent_fullname, name AS op FROM obj WHERE type = 'GraphQLType'
           AND name IN ('Query', 'Mutation', 'Subscription')),
idx AS (SELECT t.op, f.name AS field_name, arg_max(f.fullname, f.path) AS field_fullname
        FROM sidx f JOIN stypes t ON t.parent_fullname = f.parent_fullname GROUP BY t.op, f.name)
"""

# ------------------------------------------------------------------------------------------------
# client corpus expectations
# ------------------------------------------------------------------------------------------------
CLIENT = """
ordr AS (SELECT o_orderkey AS ok, o_custkey AS c,
                row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS j FROM orders),
ordf AS (SELECT *, 0 AS chunk, j - 1 AS t, ok % 11 <> 10 AS inside FROM ordr),
ordh AS (SELECT *, row_number() OVER (PARTITION BY c, chunk, inside ORDER BY ok) - 1 AS h FROM ordf),
cfiles0 AS (SELECT c_custkey AS c, 0 AS chunk FROM customer UNION SELECT DISTINCT c, chunk FROM ordf),
cfiles AS (SELECT f.c, f.chunk, printf('web/c%07d-%04d.jsx', f.c, f.chunk) AS path,
                  count(o.ok) AS n, count(o.ok) FILTER (WHERE o.inside) AS n_in, f.c % 10 <> 7 AS apollo
           FROM cfiles0 f LEFT JOIN ordf o ON o.c = f.c AND o.chunk = f.chunk GROUP BY f.c, f.chunk),
lrow AS (SELECT l_orderkey AS ok, l_partkey AS pk, CAST(l_quantity AS BIGINT) AS qty,
                row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS rn FROM lineitem),
lines_of AS (SELECT ok, list(DISTINCT printf('p%d', pk) ORDER BY printf('p%d', pk)) AS fields, arg_min(pk, rn) AS first_pk,
                    string_agg(CASE WHEN rn = 1 AND ok % 5 = 0 THEN printf('a%d: ', pk) ELSE '' END || printf('p%d(q: %d)', pk, qty),
                               ' ' ORDER BY rn) AS ftxt
             FROM lrow GROUP BY ok),
ordx AS (SELECT o.*, f.path, f.n, f.n_in, f.apollo,
                CASE WHEN o.ok % 10 = 3 THEN printf('SHARED_%d', o.ok % 4) ELSE printf('Q_%d', o.ok) END AS dname,
                CASE o.ok % 3 WHEN 0 THEN 'query' WHEN 1 THEN 'mutation' ELSE 'subscription' END AS op,
                CASE WHEN o.ok % 8 = 5 THEN 'useLazyQuery'
                     ELSE CASE o.ok % 3 WHEN 0 THEN 'useQuery' WHEN 1 THEN 'useMutation' ELSE 'useSubscription' END
                END AS hook,
                CASE WHEN o.inside THEN 3 + 5 * f.n + 2 + o.h ELSE 3 + 5 * f.n + 4 + f.n_in + o.h END AS hline,
                l.fields, l.first_pk, l.ftxt
         FROM ordh o JOIN cfiles f ON f.c = o.c AND f.chunk = o.chunk LEFT JOIN lines_of l ON l.ok = o.ok),
cdefs AS (
  SELECT path, 3 + 5 * t AS line, dname AS name,
         CASE op WHEN 'query' THEN 'GraphQLClientQuery' WHEN 'mutation' THEN 'GraphQLClientMutation'
              ELSE 'GraphQLClientSubscription' END AS type,
         path || ':' || CAST(3 + 5 * t AS VARCHAR) AS fullname, printf('Order%d', ok) AS operation_name,
         CASE WHEN ok % 4 = 0 THEN '$id, $n' WHEN ok % 4 = 1 THEN '$id' ELSE '' END AS variables,
         array_to_string(fields, ', ') AS fields_selected, fields AS field_list,
         CASE WHEN ok % 5 = 0 THEN 1 ELSE 0 END AS n_aliases, ok, c, first_pk, 'd' || ok AS dkey,
         printf('%s Order%d%s {', op, ok, CASE WHEN ok % 4 = 0 THEN '($id: ID!, $n: Int)' WHEN ok % 4 = 1 THEN '($id: ID!)' ELSE '' END)
           || chr(10) || '    ' || ftxt || chr(10) || '  }' AS raw
  FROM ordx WHERE apollo AND fields IS NOT NULL
  UNION ALL
  SELECT path, hline, hook, 'GraphQLClientQuery', path || ':' || CAST(hline AS VARCHAR), NULL, '', '',
         CAST([] AS VARCHAR[]), 0, ok, c, NULL, 'i' || ok, 'query { ping }'
  FROM ordx WHERE apollo AND ok % 13 = 6
),
creqs AS (
  SELECT path, hline AS line, ok, c, 'useQuery' AS hook, dname AS query_name, 'GraphQLQueryRequest' AS type,
         path || ':' || CAST(hline AS VARCHAR) AS fullname, printf('%s.Customer%d', path, c) AS parent,
         CAST(NULL AS VARCHAR) AS fetch_policy, CAST(NULL AS VARCHAR) AS error_policy, 's' || ok AS rkey
  FROM ordx WHERE apollo AND inside AND ok % 17 = 5
  UNION ALL
  SELECT path, hline AS line, ok, c, hook,
         CASE WHEN ok % 13 = 6 THEN 'gql' WHEN ok % 7 = 2 THEN printf('Q_%d', ok + 1)
              WHEN ok % 7 = 5 THEN printf('q_%d', ok) ELSE dname END AS query_name,
         CASE hook WHEN 'useQuery' THEN 'GraphQLQueryRequest' WHEN 'useLazyQuery' THEN 'GraphQLLazyQueryRequest'
              WHEN 'useMutation' THEN 'GraphQLMutationRequest' ELSE 'GraphQLSubscriptionRequest' END AS type,
         path || ':' || CAST(hline AS VARCHAR) AS fullname,
         printf('%s.Customer%d', path, c) AS parent,
         CASE WHEN ok % 4 = 0 THEN 'cache-first' WHEN ok % 4 = 1 THEN 'network-only' END AS fetch_policy,
         CASE WHEN ok % 4 = 1 THEN 'all' END AS error_policy, 'r' || ok
  FROM ordx WHERE apollo AND inside
  UNION ALL
  SELECT path, 3 + 5 * n + 4 + n, NULL, c, x.hook, x.q, x.type, path || ':' || CAST(3 + 5 * n + 4 + n AS VARCHAR),
         path || '.' || x.fn, NULL, NULL, 'b' || x.fn
  FROM (SELECT *, unnest(CASE c % 4 WHEN 2 THEN [{'hook': 'useMutation', 'q': 'SHARED_2', 'type': 'GraphQLMutationRequest', 'fn': 'load'}]
                         ELSE [{'hook': 'useQuery', 'q': 'SHARED_0', 'type': 'GraphQLQueryRequest', 'fn': printf('A%d', c)},
                               {'hook': 'useLazyQuery', 'q': 'SHARED_1', 'type': 'GraphQLLazyQueryRequest', 'fn': printf('B%d', c)}] END) AS x
        FROM cfiles WHERE apollo AND c % 4 >= 2)
),
cdd AS (SELECT name, path, arg_max(fullname, line) AS def_fullname, arg_max(dkey, line) AS def_key FROM cdefs GROUP BY name, path),
creql AS (SELECT r.*,
                 (SELECT arg_max(d.def_fullname, d.path) FROM cdd d WHERE d.name = r.query_name AND d.path <= r.path)
                   AS definition,
                 (SELECT arg_max(d.def_key, d.path) FROM cdd d WHERE d.name = r.query_name AND d.path <= r.path) AS dkey,
                 (SELECT count(*) FROM cdd d WHERE upper(d.name) = upper(r.query_name) AND d.path <= r.path) AS n_ci
          FROM creqs r)
"""

BACKEND = """
kb AS (
  SELECT s_suppkey AS obj_id, 'JV_CLASS' AS type, printf('Ctl%d', s_suppkey // 2) AS name,
         printf('com.acme.s%d.Ctl%d', s_suppkey, s_suppkey // 2) AS fullname,
         CASE s_suppkey % 5 WHEN 0 THEN ['@Service'] WHEN 1 THEN ['@ControllerAdvice'] WHEN 2 THEN ['@RestController']
              ELSE ['@Controller'] END AS annotations
  FROM supplier
  UNION ALL
  SELECT (s + 1) * 10000000 + pk, 'JV_METHOD', printf('p%d', pk), printf('com.acme.s%d.Ctl%d.p%d', s, s // 2, pk),
         CASE WHEN (s + pk) % 11 = 0 THEN CAST([] AS VARCHAR[]) WHEN (s + pk) % 7 = 0 THEN ['@QueryMapping']
              ELSE [CASE pk % 3 WHEN 0 THEN '@QueryMapping' WHEN 1 THEN '@MutationMapping' ELSE '@SubscriptionMapping' END]
         END
  FROM (SELECT DISTINCT l_suppkey AS s, l_partkey AS pk FROM lineitem)
  UNION ALL
  SELECT (s_suppkey + 1) * 10000000 + 9999999, 'JV_METHOD', printf('helper%d', s_suppkey),
         printf('com.acme.s%d.Ctl%d.helper%d', s_suppkey, s_suppkey // 2, s_suppkey), ['@Bean']
  FROM supplier
),
kcls AS (SELECT name, arg_min(annotations, obj_id) AS cann, arg_min(fullname, obj_id) AS class_fullname
         FROM kb WHERE type = 'JV_CLASS' GROUP BY name),
kmeth AS (SELECT m.*, string_split(m.fullname, '.')[-2] AS parent_name FROM kb m WHERE type = 'JV_METHOD'),
kgate AS (SELECT m.*, k.class_fullname,
                 coalesce(contains(array_to_string(k.cann, chr(1)), '@Controller'), false)
                   AS controller_ok
          FROM kmeth m LEFT JOIN kcls k ON k.name = m.parent_name),
kmatch AS (SELECT g.*,
                  CASE WHEN iq.field_fullname IS NOT NULL THEN 'Query' WHEN im.field_fullname IS NOT NULL THEN 'Mutation'
                       WHEN isub.field_fullname IS NOT NULL THEN 'Subscription' END AS op,
                  coalesce(iq.field_fullname, im.field_fullname, isub.field_fullname) AS field_fullname
           FROM kgate g
           LEFT JOIN idx iq ON iq.op = 'Query' AND iq.field_name = g.name
           LEFT JOIN idx im ON im.op = 'Mutation' AND im.field_name = g.name
           LEFT JOIN idx isub ON isub.op = 'Subscription' AND isub.field_name = g.name),
kstat AS (SELECT *, CASE WHEN NOT controller_ok THEN 'gated_out' WHEN op IS NULL THEN 'not_matched'
                         WHEN contains(array_to_string(annotations, chr(1)), CASE op WHEN 'Query' THEN '@QueryMapping'
                              WHEN 'Mutation' THEN '@MutationMapping' ELSE '@SubscriptionMapping' END) THEN 'linked'
                         ELSE 'missing_annotation' END AS status FROM kmatch)
"""


def _with(*blocks: str) -> str:
    return "WITH " + ",".join(b.strip().rstrip(",") for b in blocks) + "\n"


S = _with(SCHEMA)
SC = _with(SCHEMA, CLIENT)
SCB = _with(SCHEMA, CLIENT, BACKEND)
SB = _with(SCHEMA, BACKEND)

DEF_OP = "CASE type WHEN 'GraphQLClientQuery' THEN 'Query' WHEN 'GraphQLClientMutation' THEN 'Mutation' ELSE 'Subscription' END"

ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------- raw text
ORACLE["corpus_lines"] = """
WITH x AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t,
                  generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents)
SELECT doc_id, CAST(line AS BIGINT) AS line, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS digest,
       CAST(length(t) - length(replace(t, '{', '')) AS BIGINT) AS opens,
       CAST(length(t) - length(replace(t, '}', '')) AS BIGINT) AS closes
FROM x
"""
ORACLE["brace_depth"] = """
WITH x AS (SELECT page_id, unnest(string_split(html, chr(10))) AS t,
                  generate_subscripts(string_split(html, chr(10)), 1) AS line FROM pages),
y AS (SELECT page_id, line, length(t) - length(replace(t, '{', '')) - (length(t) - length(replace(t, '}', ''))) AS net FROM x)
SELECT page_id, CAST(line AS BIGINT) AS line,
       CAST(sum(net) OVER (PARTITION BY page_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS depth
FROM y
"""

# ---------------------------------------------------------------- files
PAGE_FILES = """
WITH f AS (SELECT page_id % 16 AS bucket, string_agg(coalesce(html, '') || chr(10), '' ORDER BY page_id) AS content FROM pages GROUP BY page_id % 16)
"""
ORACLE["scanned_lines"] = PAGE_FILES + r"""
, x AS (SELECT bucket, string_split_regex(content, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]') AS parts FROM f),
y AS (SELECT bucket, unnest(parts[:-2]) AS t, generate_subscripts(parts[:-2], 1) AS line FROM x)
SELECT bucket, CAST(line AS BIGINT) AS line, md5(t) AS digest FROM y
"""
ORACLE["scanned_files"] = PAGE_FILES + """
SELECT bucket, CAST(length(content) AS BIGINT) AS n_chars, md5(content) AS digest FROM f WHERE strlen(content) <= 32768
"""
ORACLE["scan_errors"] = PAGE_FILES + """
SELECT bucket, 'scan' AS stage, printf('%d bytes, more than 32768', strlen(content)) AS error FROM f WHERE strlen(content) > 32768
"""

# ---------------------------------------------------------------- schema objects
ORACLE["classify_lines"] = S + """
SELECT path, CAST(start_line AS BIGINT) AS line,
       CASE WHEN type = 'GraphQLType' THEN 'type_def' WHEN type = 'GraphQLInput' THEN 'input_def'
            WHEN type = 'GraphQLEnum' THEN 'enum_def' WHEN type = 'GraphQLEnumValue' THEN 'enum_value'
            WHEN type = 'GraphQLField' AND name = 'v' THEN 'field_def'
            WHEN type = 'GraphQLField' AND starts_with(name, 'x') THEN 'field_def'
            ELSE 'field_def_with_args' END AS pattern_key,
       replace(type, 'GraphQL', '') AS obj_type, name
FROM obj WHERE type <> 'GraphQLProgram'
UNION ALL
SELECT path, CAST(e + 4 AS BIGINT), 'type_extend', 'Type', 'Query' FROM sup WHERE s % 2 = 1
"""
def _forms() -> str:
    from ..functions.patterns import OBJECTS
    from ..sources.corpus import FORMS
    types = {k: t for t, _, keys in OBJECTS for k in keys}
    said = lambda x: "NULL" if x is None else f"'{x}'"
    return ", ".join(f"({i}, {said(k)}, {said(types.get(k))}, {said(n)})" for i, (_, k, n) in enumerate(FORMS))


ORACLE["classify_catalogue"] = f"""
WITH forms(i, pattern_key, obj_type, name) AS (VALUES {_forms()})
SELECT p_partkey AS pk, pattern_key, obj_type, replace(name, '%d', p_partkey::VARCHAR) AS name
FROM part JOIN forms ON i = p_partkey % (SELECT count(*) FROM forms)
"""
ORACLE["nested_objects"] = """
WITH f AS (SELECT s_suppkey AS s, s_suppkey % 6 + 1 AS n, printf('deep/s%07d.graphqls', s_suppkey) AS path FROM supplier),
t AS (SELECT *, unnest(range(1, n + 1)) AS k FROM f),
c AS (SELECT *, array_to_string([printf('N%d', i) for i in range(1, k + 1)], '.') AS chain, array_to_string(range(1, k + 1), '/') AS lines FROM t)
SELECT 'GraphQLType' AS type, path || '.' || chain AS fullname, CASE WHEN k = 1 THEN path ELSE path || '.' || left(chain, length(chain) - length(printf('.N%d', k))) END AS parent_fullname,
       k::BIGINT AS start_line, (n + 2 + 2 * (n - k))::BIGINT AS end_line, lines AS order_key FROM c
UNION ALL SELECT 'GraphQLField', path || '.' || chain || printf('.f%d', s), path || '.' || chain, n + 1, n + 1, lines || '/' || (n + 1) FROM c WHERE k = n
UNION ALL SELECT 'GraphQLField', path || '.' || chain || printf('.g%d', k), path || '.' || chain, n + 1 + 2 * (n - k), n + 1 + 2 * (n - k),
          lines || '/' || (n + 1 + 2 * (n - k)) FROM c WHERE k < n
"""
ORACLE["schema_objects"] = S + """
SELECT path, type, name, fullname, parent_fullname, CAST(start_line AS BIGINT) AS start_line,
       CAST(end_line AS BIGINT) AS end_line, guid FROM obj
"""
ORACLE["object_bookmarks"] = S + """
SELECT fullname, path AS bm_path, CAST(start_line AS BIGINT) AS bm_line, CAST(1 AS BIGINT) AS bm_col,
       CAST(end_line + 1 AS BIGINT) AS bm_end_line, CAST(1 AS BIGINT) AS bm_end_col FROM obj
"""
ORACLE["written_objects"] = S + """
SELECT type, fullname, CAST(start_line AS BIGINT) AS bm_line, CAST(end_line + 1 AS BIGINT) AS bm_end_line FROM obj
"""
ORACLE["extend_merge"] = S + """
SELECT fullname, parent_fullname, CAST(start_line AS BIGINT) AS start_line FROM obj
WHERE type = 'GraphQLField' AND starts_with(name, 'x') AND parent_fullname LIKE '%.Query'
"""
ORACLE["subtree_sizes"] = S + """
SELECT o.fullname, o.type,
       CAST((SELECT count(*) FROM obj c WHERE c.parent_fullname = o.fullname) AS BIGINT) AS n_children,
       CAST((SELECT count(*) FROM obj c WHERE c.path = o.path AND starts_with(c.fullname, o.fullname || '.')) AS BIGINT)
         AS n_descendants
FROM obj o
"""

# ---------------------------------------------------------------- references and links
ORACLE["type_references"] = S + """
SELECT path, CAST(line AS BIGINT) AS line, CAST(arg_pos AS BIGINT) AS arg_pos, caller, callee FROM refs
"""
ORACLE["schema_links"] = S + """
SELECT 'useLink' AS link_type, caller, target AS callee, path, CAST(line AS BIGINT) AS line, resolution
FROM res WHERE target IS NOT NULL
"""
for _k, _r in [("links_same_file", "same_file"), ("links_cross_unique", "cross_unique"),
               ("links_cross_tiebreak", "cross_tiebreak")]:
    ORACLE[_k] = S + f"""
SELECT 'useLink' AS link_type, caller, target AS callee, CAST(line AS BIGINT) AS line FROM res
WHERE resolution = '{_r}'
"""
ORACLE["unresolved_refs"] = S + """
SELECT path, CAST(line AS BIGINT) AS line, caller, callee, CAST(arg_pos AS BIGINT) AS arg_pos FROM res
WHERE target IS NULL
"""
ORACLE["ambiguous_symbols"] = S + """
SELECT name AS short_name, CAST(count(*) AS BIGINT) AS n_symbols FROM obj GROUP BY name HAVING count(*) > 1
"""

# ---------------------------------------------------------------- generic resolver
ORACLE["resolve_prefer_file"] = S + """
, req AS (SELECT DISTINCT path AS context_path, callee AS name FROM refs),
cand AS (SELECT r.context_path, r.name, o.fullname, starts_with(o.fullname, r.context_path || '.') AS in_file
         FROM req r JOIN obj o ON o.name = r.name),
agg AS (SELECT context_path, name, count(*) AS n_all, count(*) FILTER (WHERE in_file) AS n_file,
               max(fullname) FILTER (WHERE in_file) AS f_file, max(fullname) AS f_any FROM cand GROUP BY ALL)
SELECT r.context_path, r.name,
       CASE WHEN a.n_file = 1 THEN a.f_file WHEN a.n_file > 1 THEN NULL WHEN a.n_all = 1 THEN a.f_any END AS target
FROM req r LEFT JOIN agg a USING (context_path, name)
"""
ORACLE["resolve_class"] = S + """
, req AS (SELECT DISTINCT parent_fullname AS restrict_to_class, name FROM obj WHERE type = 'GraphQLField'),
cand AS (SELECT r.restrict_to_class, r.name, o.fullname FROM req r JOIN obj o
         ON o.name = r.name AND starts_with(o.fullname, r.restrict_to_class || '.'))
SELECT r.restrict_to_class, r.name,
       (SELECT CASE WHEN count(*) = 1 THEN max(c.fullname) END FROM cand c
        WHERE c.restrict_to_class = r.restrict_to_class AND c.name = r.name) AS target
FROM req r
"""
ORACLE["resolve_suffix"] = S + """
, req AS (SELECT DISTINCT path AS context_path, string_split(parent_fullname, '.')[-1] || '.' || name AS name FROM obj WHERE type = 'GraphQLField'),
tails AS (SELECT fullname, array_to_string(string_split(fullname, '.')[-2:], '.') AS tail FROM obj),
cand AS (SELECT r.context_path, r.name, o.fullname, starts_with(o.fullname, r.context_path || '.') AS in_file
         FROM req r JOIN tails o ON o.tail = r.name),
agg AS (SELECT context_path, name, count(*) AS n_all, count(*) FILTER (WHERE in_file) AS n_file,
               max(fullname) FILTER (WHERE in_file) AS f_file, max(fullname) AS f_any FROM cand GROUP BY ALL)
SELECT r.context_path, r.name,
       CASE WHEN a.n_file = 1 THEN a.f_file WHEN a.n_file > 1 THEN NULL WHEN a.n_all = 1 THEN a.f_any END AS target
FROM req r LEFT JOIN agg a USING (context_path, name)
"""
ORACLE["resolve_exact"] = S + """
SELECT DISTINCT caller AS name, caller AS target FROM refs
"""

# ---------------------------------------------------------------- client
ORACLE["client_files"] = SC + """
SELECT path FROM cfiles WHERE apollo
"""
ORACLE["client_definitions"] = SC + """
SELECT path, CAST(line AS BIGINT) AS line, name, type, fullname, operation_name, variables, fields_selected,
       CAST(n_aliases AS BIGINT) AS n_aliases FROM cdefs
"""
ORACLE["operation_fields"] = SC + """
SELECT fullname, unnest(field_list) AS field_name FROM cdefs
"""
ORACLE["operation_root_fields"] = SC + """
SELECT fullname, unnest(field_list) AS field_name FROM cdefs UNION ALL SELECT fullname, 'ping' FROM cdefs WHERE raw = 'query { ping }'
"""
ORACLE["operation_variables"] = SC + """
SELECT fullname, unnest(string_split(variables, ', ')) AS variable FROM cdefs WHERE variables <> ''
"""
ORACLE["operation_aliases"] = SC + """
SELECT fullname, printf('a%d', first_pk) AS alias, printf('p%d', first_pk) AS field_name FROM cdefs
WHERE n_aliases = 1
"""
ORACLE["hook_requests"] = SC + """
SELECT path, CAST(line AS BIGINT) AS line, hook || ':' || query_name AS name, type, fullname, parent,
       fetch_policy, error_policy FROM creqs
"""
ORACLE["hook_options"] = SC + """
SELECT fullname, 'fetchPolicy' AS option, fetch_policy AS value FROM creqs WHERE fetch_policy IS NOT NULL
UNION ALL SELECT fullname, 'errorPolicy', error_policy FROM creqs WHERE error_policy IS NOT NULL
"""
ORACLE["component_request_links"] = SC + """
SELECT 'callLink' AS link_type, parent AS caller, fullname AS callee, CAST(line AS BIGINT) AS line FROM creqs
"""
ORACLE["request_definition_links"] = SC + """
SELECT 'useLink' AS link_type, fullname AS caller, definition AS callee FROM creql WHERE definition IS NOT NULL
"""
ORACLE["unmatched_hooks"] = SC + """
SELECT fullname, query_name, n_ci > 0 AS case_mismatch FROM creql WHERE definition IS NULL
"""
ORACLE["definition_properties"] = SC + """
SELECT fullname, 'GraphQL_Client_Definition.operationName' AS prop, operation_name AS value FROM cdefs
UNION ALL SELECT fullname, 'GraphQL_Client_Definition.rawQueryText', raw FROM cdefs
UNION ALL SELECT fullname, 'GraphQL_Client_Definition.variables', variables FROM cdefs WHERE variables <> ''
UNION ALL SELECT fullname, 'GraphQL_Client_Definition.fieldsSelected', fields_selected FROM cdefs WHERE fields_selected <> ''
UNION ALL SELECT fullname, 'GraphQL_Client_Definition.alias.' || printf('a%d', first_pk), printf('p%d', first_pk)
          FROM cdefs WHERE n_aliases = 1
"""

# ---------------------------------------------------------------- application level
ORACLE["schema_index"] = S + """
SELECT op, field_name, field_fullname FROM idx
"""
ORACLE["definition_field_links"] = SC + f"""
, df AS (SELECT fullname, {DEF_OP} AS op, unnest(field_list) AS field_name FROM cdefs)
SELECT 'useLink' AS link_type, df.fullname AS caller, i.field_fullname AS callee FROM df
JOIN idx i ON i.op = df.op AND i.field_name = df.field_name
"""
ORACLE["missing_fields"] = SC + f"""
, df AS (SELECT fullname, {DEF_OP} AS op, unnest(field_list) AS field_name FROM cdefs)
SELECT df.fullname AS definition, df.op, df.field_name, 'field_not_in_schema' AS reason FROM df
WHERE NOT EXISTS (SELECT 1 FROM idx i WHERE i.op = df.op AND i.field_name = df.field_name)
UNION ALL
SELECT fullname, {DEF_OP}, NULL, 'no_fields_selected' FROM cdefs WHERE len(field_list) = 0
"""
ORACLE["controller_methods"] = SB + """
SELECT fullname AS method_fullname, class_fullname, controller_ok FROM kgate
"""
ORACLE["field_method_links"] = SB + """
SELECT 'callLink' AS link_type, field_fullname AS caller, fullname AS callee FROM kstat WHERE status = 'linked'
"""
ORACLE["method_matches"] = SB + """
SELECT fullname AS method_fullname, op, field_fullname, status FROM kstat
"""
ORACLE["link_summary"] = SB + """
SELECT CAST(count(*) FILTER (WHERE status = 'linked' AND op = 'Query') AS BIGINT) AS query_links,
       CAST(count(*) FILTER (WHERE status = 'linked' AND op = 'Mutation') AS BIGINT) AS mutation_links,
       CAST(count(*) FILTER (WHERE status = 'linked' AND op = 'Subscription') AS BIGINT) AS subscription_links,
       CAST(count(*) FILTER (WHERE status = 'linked') AS BIGINT) AS total_links,
       CAST(count(*) FILTER (WHERE status = 'not_matched') AS BIGINT) AS not_matched
FROM kstat
"""
ORACLE["definition_counts"] = SC + """
SELECT type, CAST(count(*) AS BIGINT) AS n_definitions FROM cdefs GROUP BY type
"""

# ---------------------------------------------------------------- lineage
ORACLE["outgoing_links"] = SC + """
SELECT fullname AS caller, 'useLink' AS link_type, definition AS callee FROM creql WHERE definition IS NOT NULL
"""
ORACLE["incoming_links"] = SC + f"""
, df AS (SELECT fullname, {DEF_OP} AS op, unnest(field_list) AS field_name FROM cdefs)
SELECT i.field_fullname AS callee, 'useLink' AS link_type, df.fullname AS caller FROM df
JOIN idx i ON i.op = df.op AND i.field_name = df.field_name
"""
ORACLE["request_fields"] = SC + """
SELECT r.fullname AS request, r.definition, d.type AS definition_type, nullif(d.fields_selected, '') AS fields_selected
FROM creql r LEFT JOIN cdefs d ON d.dkey = r.dkey
"""
ORACLE["first_use_target"] = SC + """
SELECT fullname AS request, definition AS target FROM creql WHERE definition IS NOT NULL
"""
ORACLE["resolver_verdicts"] = SCB + """
, rv AS (SELECT r.fullname AS request, r.definition, d.type AS dtype, d.field_list[1] AS field
         FROM creql r LEFT JOIN cdefs d ON d.dkey = r.dkey),
mn AS (SELECT name, count(*) AS n_methods,
              count(*) FILTER (WHERE controller_ok AND contains(array_to_string(annotations, chr(1)), '@QueryMapping')) AS okq,
              count(*) FILTER (WHERE controller_ok AND contains(array_to_string(annotations, chr(1)), '@MutationMapping')) AS okm,
              count(*) FILTER (WHERE controller_ok AND contains(array_to_string(annotations, chr(1)), '@SubscriptionMapping')) AS oks
       FROM kgate GROUP BY name),
j AS (SELECT rv.*, coalesce(mn.n_methods, 0) AS n_methods,
             coalesce(CASE rv.dtype WHEN 'GraphQLClientQuery' THEN mn.okq WHEN 'GraphQLClientMutation' THEN mn.okm
                                    WHEN 'GraphQLClientSubscription' THEN mn.oks END, 0) AS n_valid
      FROM rv LEFT JOIN mn ON mn.name = rv.field)
SELECT request, definition, field, CAST(n_methods AS BIGINT) AS n_methods, CAST(n_valid AS BIGINT) AS n_valid,
       CASE WHEN definition IS NULL THEN 'no_definition' WHEN field IS NULL THEN 'no_fields'
            WHEN n_methods = 0 THEN 'no_method' WHEN n_valid > 0 THEN 'valid' ELSE 'all_filtered' END AS verdict
FROM j
"""
ORACLE["method_index"] = SB + """
SELECT name AS method_name, CAST(count(*) AS BIGINT) AS n_methods FROM kb WHERE type = 'JV_METHOD' GROUP BY name
"""
TRACE = f"""
, df AS (SELECT dkey, {DEF_OP} AS op, unnest(field_list) AS field_name FROM cdefs),
dfl AS (SELECT df.dkey, i.field_fullname AS field FROM df
        JOIN idx i ON i.op = df.op AND i.field_name = df.field_name),
fm AS (SELECT field_fullname AS field, fullname AS method FROM kstat WHERE status = 'linked'),
tr AS (SELECT r.parent AS component, r.fullname AS request, r.definition, dfl.field
       FROM creql r LEFT JOIN dfl ON dfl.dkey = r.dkey)
"""
ORACLE["full_stack_trace"] = SCB + TRACE + """
SELECT tr.*, CAST(coalesce((SELECT count(*) FROM fm WHERE fm.field = tr.field), 0) AS BIGINT) AS n_methods FROM tr
"""
ORACLE["trace_methods"] = SCB + TRACE + """
SELECT field, method FROM fm WHERE field IN (SELECT field FROM tr)
"""
ORACLE["component_stack"] = SCB + TRACE + """
, top AS (SELECT parent FROM creqs GROUP BY parent ORDER BY count(*) DESC, parent LIMIT 1)
SELECT tr.component, tr.request, tr.definition, tr.field, fm.method FROM tr JOIN top ON top.parent = tr.component
LEFT JOIN fm ON fm.field = tr.field
"""
ORACLE["method_stack"] = SCB + TRACE + """
SELECT tr.component, tr.request, tr.definition, tr.field, fm.method FROM tr JOIN fm ON fm.field = tr.field
WHERE fm.method = (SELECT min(method) FROM fm WHERE field IN (SELECT field FROM tr))
"""
ORACLE["search_objects"] = SC + """
SELECT fullname, name, operation_name, nullif(fields_selected, '') AS fields_selected FROM cdefs WHERE type = 'GraphQLClientQuery'
"""
ORACLE["link_bookmarks"] = S + """
SELECT caller, target AS callee, path AS bm_path, CAST(line AS BIGINT) AS bm_line, CAST(1 AS BIGINT) AS bm_col,
       CAST(line AS BIGINT) AS bm_end_line, CAST(-1 AS BIGINT) AS bm_end_col FROM res WHERE target IS NOT NULL
"""
ORACLE["resolve_file"] = S + """
, req AS (SELECT DISTINCT path AS context_path, callee AS name FROM refs),
cand AS (SELECT r.context_path, r.name, count(o.fullname) AS n, max(o.fullname) AS f FROM req r
         LEFT JOIN obj o ON o.name = r.name AND o.path = r.context_path AND o.fullname <> o.path GROUP BY ALL)
SELECT context_path, name, CASE WHEN n = 1 THEN f END AS target FROM cand
"""
ORACLE["object_order"] = S + """
SELECT o.fullname, CASE WHEN p.type = 'GraphQLProgram' THEN CAST(o.start_line AS VARCHAR)
                        WHEN o.type = 'GraphQLField' AND starts_with(o.name, 'x')  -- in the type's extension, a block of its own
                        THEN CAST(o.start_line - 1 AS VARCHAR) || '/' || CAST(o.start_line AS VARCHAR)
                        ELSE CAST(coalesce(p.start_line, 0) AS VARCHAR) || '/' || CAST(o.start_line AS VARCHAR) END AS order_key
FROM obj o LEFT JOIN obj p ON p.fullname = o.parent_fullname WHERE o.type <> 'GraphQLProgram'
"""
ORACLE["methods_by_name"] = SB + """
SELECT name AS method_name, fullname AS method_fullname FROM kb WHERE type = 'JV_METHOD'
"""
ORACLE["resolver_methods"] = SCB + """
SELECT d.type AS definition_type, d.field AS field, g.fullname AS method, g.controller_ok,
       g.controller_ok AND contains(array_to_string(g.annotations, chr(1)),
         CASE d.type WHEN 'GraphQLClientQuery' THEN '@QueryMapping' WHEN 'GraphQLClientMutation' THEN '@MutationMapping'
                     ELSE '@SubscriptionMapping' END) AS valid
FROM (SELECT DISTINCT type, field_list[1] AS field FROM cdefs WHERE len(field_list) > 0) d JOIN kgate g ON g.name = d.field
"""

# ---------------------------------------------------------------- reports
ORACLE["report_totals"] = S + """
SELECT CAST((SELECT count(*) FROM sup) AS BIGINT) AS n_files, CAST((SELECT count(*) FROM obj) AS BIGINT) AS n_objects,
       CAST((SELECT count(*) FROM res WHERE target IS NOT NULL) AS BIGINT) AS n_links, CAST(0 AS BIGINT) AS n_errors
"""
ORACLE["report_by_file"] = S + """
SELECT path, CAST(count(*) AS BIGINT) AS n_objects FROM obj WHERE type <> 'GraphQLProgram' GROUP BY path
"""
ORACLE["report_by_type"] = S + """
SELECT type, CAST(count(*) AS BIGINT) AS n_objects FROM obj GROUP BY type
"""
ORACLE["index_sizes"] = S + """
SELECT op, CAST(count(*) AS BIGINT) AS n_fields FROM idx GROUP BY op
"""
ORACLE["client_totals"] = SC + """
SELECT CAST((SELECT count(*) FROM cfiles WHERE apollo) AS BIGINT) AS n_client_files,
       CAST((SELECT count(*) FROM cdefs) AS BIGINT) AS n_definitions,
       CAST((SELECT count(DISTINCT name) FROM cdefs) AS BIGINT) AS n_definition_names
"""


def _type_category_values() -> str:
    from ..sources.catalog import CATEGORY_PARENTS, TYPE_CATEGORIES
    above = dict(CATEGORY_PARENTS)
    rows = {(t, x) for t, cats in TYPE_CATEGORIES for c in cats for x in (c, *above.get(c, []))}
    return "tc(type, category) AS (VALUES " + ", ".join(f"('{t}', '{c}')" for t, c in sorted(rows)) + ")"


ORACLE["objects_by_category"] = _with(SCHEMA, CLIENT, _type_category_values()) + """
, typed AS (SELECT type FROM obj UNION ALL SELECT type FROM cdefs UNION ALL SELECT type FROM creqs)
SELECT tc.category, CAST(count(*) AS BIGINT) AS n_objects FROM typed JOIN tc ON tc.type = typed.type GROUP BY tc.category
"""
ORACLE["property_inventory"] = SC + """
, d AS (SELECT type, count(*) FILTER (WHERE operation_name IS NOT NULL) AS op_n, count(*) AS raw_n,
               count(*) FILTER (WHERE variables <> '') AS var_n, count(*) FILTER (WHERE fields_selected <> '') AS fs_n
        FROM cdefs GROUP BY type),
r AS (SELECT type, count(*) AS hook_n, count(fetch_policy) AS fp_n, count(error_policy) AS ep_n FROM creqs GROUP BY type)
SELECT type, 'GraphQL_Client_Definition.operationName' AS prop, CAST(op_n AS BIGINT) AS n_with_value FROM d
UNION ALL SELECT type, 'GraphQL_Client_Definition.rawQueryText', CAST(raw_n AS BIGINT) FROM d
UNION ALL SELECT type, 'GraphQL_Client_Definition.variables', CAST(var_n AS BIGINT) FROM d
UNION ALL SELECT type, 'GraphQL_Client_Definition.fieldsSelected', CAST(fs_n AS BIGINT) FROM d
UNION ALL SELECT type, 'GraphQL_Hook_Request.hookType', CAST(hook_n AS BIGINT) FROM r
UNION ALL SELECT type, 'GraphQL_Hook_Request.fetchPolicy', CAST(fp_n AS BIGINT) FROM r
UNION ALL SELECT type, 'GraphQL_Hook_Request.errorPolicy', CAST(ep_n AS BIGINT) FROM r
"""

# ---------------------------------------------------------------- imports (I1-I4), masking (T4)
IMPORTS = """
ip AS (SELECT p_partkey AS pk, printf('lib/b%02d.src', CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER)) AS path,
              'brand/' || regexp_extract(p_brand, '#(\\d+)', 1) AS m, regexp_extract(p_brand, '#(\\d+)', 1) AS n,
              string_split(p_name, ' ')[1] AS w1, string_split(p_name, ' ')[2] AS w2, lower(p_type) AS t FROM part),
ipl AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY pk) AS line FROM ip),
imp AS (
  SELECT path, line, w1 AS name, m AS source FROM ipl WHERE pk % 5 = 0
  UNION ALL SELECT path, line, w2, m FROM ipl WHERE pk % 5 = 0
  UNION ALL SELECT path, line, w2 || 'x', m FROM ipl WHERE pk % 5 = 0
  UNION ALL SELECT path, line, t || '.' || w1, w2 || ', ' || w1 FROM ipl WHERE pk % 5 = 1
  UNION ALL SELECT path, line, w1, w1 FROM ipl WHERE pk % 5 = 2
  UNION ALL SELECT path, line, n, m FROM ipl WHERE pk % 5 IN (3, 4)
)
"""
ORACLE["imports"] = _with(IMPORTS) + """
SELECT path, CAST(line AS BIGINT) AS line, name, source FROM imp
"""
ORACLE["import_map"] = _with(IMPORTS) + """
SELECT path, name, arg_max(source, line) AS source FROM imp GROUP BY path, name
"""
# the same tokens by DuckDB's engine, which needs no possessive runs; a masked token keeps its newlines
ORACLE["masked_text"] = r"""
WITH tok AS (SELECT page_id, regexp_extract_all(html,
  '(?s)#[^\n]*|/\*.*?(?:\*/|$)|"{3}.*?(?:"{3}|$)|''{3}.*?(?:''{3}|$)|"(?:\\[^\n]|[^"\\\n])*"?|''(?:\\[^\n]|[^''\\\n])*''?|[^#/"'']+|.') AS t
  FROM pages)
SELECT CAST(page_id AS BIGINT) AS page_id,
       array_to_string(list_transform(t, lambda x: CASE WHEN regexp_matches(x, '^(#|/\*|"|'')') THEN regexp_replace(x, '[^\n]', ' ', 'g') ELSE x END), '') AS masked
FROM tok
"""

# ---------------------------------------------------------------- handlers
ORACLE["custom_handlers"] = S + """
SELECT 'type_def' AS pattern_key, CAST(3 * count(*) AS BIGINT) AS n_roots FROM sup
UNION ALL SELECT 'enum_def', CAST(count(*) AS BIGINT) FROM sup
UNION ALL SELECT 'input_def', CAST(count(*) AS BIGINT) FROM decl
UNION ALL SELECT 'type_extend', CAST(count(*) AS BIGINT) FROM sup WHERE s % 2 = 1
"""

# ---------------------------------------------------------------- other block styles
KWB = """
ksp AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS pk FROM lineitem),
kk AS (SELECT s, pk, row_number() OVER (PARTITION BY s ORDER BY pk) AS k FROM ksp),
kn AS (SELECT su.s_suppkey AS s, printf('rb/s%07d.rb', su.s_suppkey) AS path, count(kk.pk) AS n
       FROM supplier su LEFT JOIN kk ON kk.s = su.s_suppkey GROUP BY su.s_suppkey),
kdef AS (SELECT kn.path, kn.n, kk.k FROM kk JOIN kn ON kn.s = kk.s)
"""
ORACLE["handler_outcomes"] = S + """
SELECT 'count_by_key:type_extend' AS handler, CAST(count(*) > 0 AS BIGINT) AS n_rows, false AS failed FROM sup WHERE s % 2 = 1
UNION ALL SELECT 'broken:enum_def', CAST(0 AS BIGINT), true
UNION ALL SELECT 'count_by_key:.*_def', CAST((SELECT count(*) > 0 FROM decl) AS BIGINT) + 2 * CAST(count(*) > 0 AS BIGINT), false FROM sup
"""
ORACLE["receiver_objects"] = _with(KWB) + """
SELECT 'GraphQLKind' AS type, path || printf('.S%d', s) AS fullname, path AS parent_fullname, CAST(1 AS BIGINT) AS start_line, CAST(2 * n + 2 AS BIGINT) AS end_line FROM kn
UNION ALL SELECT 'GraphQLMethod', kn.path || printf('.R%d.p%d', kk.s, kk.pk), kn.path || printf('.S%d', kk.s), CAST(2 * kk.k AS BIGINT), CAST(2 * kk.k AS BIGINT)
          FROM kk JOIN kn ON kn.s = kk.s
"""
ORACLE["blocks_end_keyword"] = _with(KWB) + """
SELECT path, CAST(1 AS BIGINT) AS line, CAST(2 * n + 2 AS BIGINT) AS end_line FROM kn
UNION ALL SELECT path, CAST(2 * k AS BIGINT), CAST(2 * k + 1 AS BIGINT) FROM kdef
"""
ORACLE["blocks_indentation"] = _with(KWB) + """
SELECT path, CAST(1 AS BIGINT) AS line, CAST(2 * n + 1 AS BIGINT) AS end_line FROM kn
UNION ALL SELECT path, CAST(2 * k AS BIGINT), CAST(2 * k AS BIGINT) FROM kdef
"""
ORACLE["blocks_sequential"] = _with(KWB) + """
SELECT path, CAST(1 AS BIGINT) AS line, CAST(2 * n + 2 AS BIGINT) AS end_line FROM kn
UNION ALL SELECT path, CAST(2 * k AS BIGINT), CAST(CASE WHEN k < n THEN 2 * k + 1 ELSE 2 * n + 2 END AS BIGINT) FROM kdef
"""
ORACLE["object_listing"] = S + """
SELECT path, name AS short_name, replace(type, 'GraphQL', '') AS kind, CAST(start_line AS BIGINT) AS start_line
FROM obj WHERE type <> 'GraphQLProgram'
"""
