"""Client operation extraction.

Input is ``files(path, content)`` of client sources. The analysed tool walks a JavaScript AST; here one lexical scan
per file (``functions.lexer``) finds hook calls, tagged templates and the bodies that may be functions', each with
the code before it and the places of the bodies around it. Names, options and operations are expressions over these
rows, and the enclosing component is a join by place.

Definitions and requests have a ``key`` (path and place in the file): several can share a line, so
joins use the key and ``fullname`` (path:line) is for output.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lexer import Event, scan
from ..functions.materialize import stored
from ..functions.prefix import asof_last, path_order
from ..functions.shipping import map_rows
from ..sources.files import to_lines
from . import imports as I

# FIXED VALUES: names that mark a GraphQL client file, the hook names and their request types,
# operation types and definition types, option names.
CLIENT_IMPORT_NAMES = ["useQuery", "useLazyQuery", "useMutation", "useSubscription", "gql"]
HOOK_TYPES = [("useQuery", "GraphQLQueryRequest"), ("useLazyQuery", "GraphQLLazyQueryRequest"),
              ("useMutation", "GraphQLMutationRequest"), ("useSubscription", "GraphQLSubscriptionRequest")]
DEF_TYPES = [("query", "GraphQLClientQuery"), ("mutation", "GraphQLClientMutation"),
             ("subscription", "GraphQLClientSubscription")]
OPTION_NAMES = ["fetchPolicy", "errorPolicy"]

# FIXED VALUES: operation header and selection patterns.
NAMED_OP_RE = r"(?i)^\s*(query|mutation|subscription)\s+([A-Z][A-Za-z0-9_]*)\s*(\([^)]*\))?\s*\{\s*([a-zA-Z_][a-zA-Z0-9_]*)"
ANON_OP_RE = r"(?i)^\s*(query|mutation|subscription)\s*(\([^)]*\))?\s*\{\s*([a-zA-Z_][a-zA-Z0-9_]*)"
VAR_RE = r"\$([a-zA-Z_][a-zA-Z0-9_]*)"
BODY_RE = r"\{([^}]+)\}"
ALIAS_IN_BODY_RE = r"([a-zA-Z_][a-zA-Z0-9_]*+)\s*+:\s*+([a-zA-Z_][a-zA-Z0-9_]*+)"
FIELD_RE = r"\b([a-z][a-zA-Z0-9_]*+)\s*+[{\(]"
ALIAS_RE = r"([a-zA-Z_][a-zA-Z0-9_]*+)\s*+:\s*+([a-zA-Z_][a-zA-Z0-9_]*+)\s*+[\(\{]"

_ID = r"[A-Za-z_$][A-Za-z0-9_$]*"
_TYPE_ARGS = r"(?:\s*<[^;()]*>)?"
# the clause of an import statement, which may span lines: import React, {\n  useQuery,\n} from "x"
# (it begins with its word, which is searched for as such; what stands before the word is looked at after it)
IMPORT_CLAUSE_RE = r"import(?<![A-Za-z0-9_$.]import)\s+([^;'\"`()=]*?)\s*from\s*['\"]"
CLIENT_NAME_RE = r"(?<![A-Za-z0-9_$])(?:" + "|".join(CLIENT_IMPORT_NAMES) + r")(?![A-Za-z0-9_$])"
# variable that a template is assigned to: declared with a type, or assigned
TYPED_RE = r"(?:const|let|var)\s+(" + _ID + r")\s*:[^=;\n]*=\s*$"
ASSIGNED_RE = r"(" + _ID + r")\s*=\s*$"
_WRAP = r"(?:" + _ID + r"(?:\." + _ID + r")*" + _TYPE_ARGS + r"(?:\(\))?\(\s*)*"
_ARROW = _TYPE_ARGS + r"\s*\(\)\s*(?::[^;=]*)?=>|" + _ID + r"\s*=>"
_TYPED = r"(?::[^=]*(?:=>[^=]*)*)?"
# the name of the function that a head ends in (closed brackets of a head are empty)
FUNC_RES = [
    r"(?<![A-Za-z0-9_$])function\s*\*?\s*(" + _ID + r")" + _TYPE_ARGS + r"\s*\(\)\s*(?::[^;=]*)?$",
    r"(?<![A-Za-z0-9_$])(?:const|let|var)\s+(" + _ID + r")\s*" + _TYPED + r"=\s*" + _WRAP + r"(?:async\s*)?(?:"
    + _ARROW + r"|function\s*\*?" + _TYPE_ARGS + r"\s*\(\)\s*(?::[^;=]*)?)\s*$",
    r"(?:^|[;{}.\s])#?(" + _ID + r")\s*" + _TYPED + r"=\s*(?:async\s*)?(?:" + _ARROW + r")\s*$",
    r"(?:^|[;,{}\n])\s*(?:(?:static|async|public|private|protected|override|get|set)\s+)*\*?\s*#?"
    r"(?!(?:if|for|while|switch|catch|function|return|with|do|else|constructor)\b)(" + _ID + r")" + _TYPE_ARGS + r"\s*\(\)\s*(?::[^={;]*)?$",
]
#: Events of files travel together up to about so many rows, or characters of the files.
EVENT_ROWS = 4096
EVENT_CHARS = 4 << 20
EVENTS = "path string, kind string, pos int, line int, name string, head string, text string, options string, bodies array<int>"


def client_events(files: DataFrame) -> DataFrame:
    """What the lexical scan of each file finds: the bodies that may be functions' (kind ``body``), hook calls
    (``hook``) and tagged templates (``gql``), with the code before them and the bodies around them. Braces, calls and
    templates in strings, comments and regular expressions are none of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), *[pa.string()] * 4, pa.list_(pa.int32())]
        rows, size = [], 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["path", *Event._fields])

        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                text = content.as_py() or ""
                rows += [(path, *event) for event in scan(text)]
                size += len(text)
                if len(rows) >= EVENT_ROWS or size >= EVENT_CHARS:  # many small files share a batch
                    if rows:
                        yield batch_of(rows)
                    rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return stored(map_rows(files.select("path", "content"), run, EVENTS), "client-events")


def functions(events: DataFrame) -> DataFrame:
    """Named functions: path, body (place of the body), name, fullname, line."""
    head = F.col("head")
    name = F.coalesce(*[T.nullif_empty(F.regexp_extract(head, r, 1)) for r in FUNC_RES])
    found = events.filter("kind = 'body'").select("path", F.col("pos").alias("body"), "line", name.alias("name")).filter(F.col("name").isNotNull())
    return found.withColumn("fullname", F.concat("path", F.lit("."), "name"))


def _type_map(pairs) -> Column:
    items = []
    for k, v in pairs:
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def _key(kind: str) -> Column:
    """Unique key of a definition or request: its path and place in the file."""
    return F.concat_ws("#", F.col("path"), F.lit(kind), F.col("pos").cast("string")).alias("key")


def client_files(files: DataFrame) -> DataFrame:
    """Keep files importing any of the client names (each file once): by an import clause of the
    text, which may span lines, or by any other import form of I1."""
    clauses = F.regexp_extract_all(F.col("content"), F.lit(IMPORT_CLAUSE_RE), 1)
    by_clause = F.coalesce(F.exists(clauses, lambda c: c.rlike(CLIENT_NAME_RE)), F.lit(False))
    named = reduce(lambda a, b: a | b, [F.col("content").contains(n) for n in CLIENT_IMPORT_NAMES])  # no import has a name that its file has nowhere
    # files with a clause stay where they are: only the text of the others meets the paths
    files = files.filter("path is not null").withColumn("__clause", by_clause)
    lines = stored(to_lines(files.filter(~F.col("__clause") & named)).filter(I.telling(F.col("text"))), "import-lines")
    by_line = I.extract_imports(lines).filter(F.col("name").isin(CLIENT_IMPORT_NAMES)).select("path")
    found = files.filter("__clause").select("path").union(by_line).distinct()
    rest = files.filter("not __clause").join(found, "path", "left_semi")
    return files.filter("__clause").unionByName(rest).drop("__clause")


# ---------------------------------------------------------------------------------------------
# Operation parsing (column expressions on the template text)
# ---------------------------------------------------------------------------------------------

# FIXED VALUES: tokens of an operation's text: comments, strings, arguments with neither of these nor parentheses in them
# (nothing in parentheses counts), the spread, names, punctuation.
OP_TOKEN_RE = r"#[^\n]*|\"\"\"(?s:.*?)\"\"\"|\"(?:[^\"\\\n]|\\.)*\"|\([^()\"#]*+\)|\.\.\.|[A-Za-z_][A-Za-z0-9_]*|[{}()@:]"


def root_fields(text: Column) -> Column:
    """Every field of the operation's outermost selection set, in order and each once: leaf fields too, the field's
    own name where it has an alias, nothing of arguments, directives, nested sets or fragment spreads. Fields of an inline
    fragment in the outermost set are fields of that set. A fold over the tokens keeps the depths of braces and
    parentheses, how many inline fragments of the outermost set are open, and what the tokens before lead to."""
    tokens = F.filter(F.regexp_extract_all(text, F.lit(OP_TOKEN_RE), 0), lambda t: ~(t.startswith("#") | t.startswith('"') | (t.startswith("(") & (t != "("))))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("paren"), F.lit(0).alias("inline"), F.lit("").alias("after"),
                     F.lit(False).alias("done"), F.array().cast("array<string>").alias("fields"))

    def step(a: Column, t: Column) -> Column:
        inside, name, after = a["paren"] > 0, ~t.isin("...", "{", "}", "(", ")", "@", ":"), a["after"]
        outer = a["depth"] == 1
        into = ~inside & (t == "{") & outer & after.isin("...", "fragment")  # an inline fragment's set is no level of its own
        out = ~inside & (t == "}") & outer & (a["inline"] > 0)
        depth = a["depth"] + F.when(~inside & (t == "{") & ~into, 1).when(~inside & (t == "}") & ~out, -1).otherwise(0)
        field = name & ~inside & outer & after.isin("", ":")
        kept = F.when(after == ":", F.slice(a["fields"], 1, F.greatest(F.size(a["fields"]) - 1, F.lit(0)))).otherwise(a["fields"])
        leads = F.when(inside | t.isin("(", ")"), after).when(t.isin("...", ":"), t) \
            .when(t == "@", F.when(after.isin("...", "fragment"), F.lit("...@")).otherwise(F.lit("@"))) \
            .when((after == "...") & (t == "on"), F.lit("on")).when(name & after.isin("on", "...@"), F.lit("fragment")).otherwise(F.lit(""))
        return F.when(a["done"], a).otherwise(F.struct(
            depth.cast("int").alias("depth"), (a["paren"] + F.when(t == "(", 1).when(t == ")", -1).otherwise(0)).cast("int").alias("paren"),
            (a["inline"] + F.when(into, 1).when(out, -1).otherwise(0)).cast("int").alias("inline"), leads.alias("after"),
            (~inside & (t == "}") & (depth == 0)).alias("done"), F.when(field, F.concat(kept, F.array(t))).otherwise(a["fields"]).alias("fields")))

    return F.aggregate(tokens, start, step, lambda a: F.array_distinct(a["fields"]))


def operation_parts(t: Column) -> Column:
    """What the patterns read from the (stripped) text of an operation, a struct: ``parse_operation`` names each part
    several times, and each name would run its pattern again where the text is all there is."""
    named, anon = t.rlike(NAMED_OP_RE), t.rlike(ANON_OP_RE)
    none = F.array().cast("array<string>")
    op_type = F.when(named, F.lower(F.regexp_extract(t, NAMED_OP_RE, 1))) \
        .when(anon, F.lower(F.regexp_extract(t, ANON_OP_RE, 1)))
    var_src = F.when(named, F.regexp_extract(t, NAMED_OP_RE, 3)).when(anon, F.regexp_extract(t, ANON_OP_RE, 2))
    return F.struct(
        op_type.alias("type"), F.when(named, F.regexp_extract(t, NAMED_OP_RE, 2)).alias("name"), var_src.alias("vars"),
        t.rlike(BODY_RE).alias("has_body"), F.regexp_extract(t, BODY_RE, 1).alias("body"),
        *[F.when(t.contains(":"), F.regexp_extract_all(t, F.lit(ALIAS_RE), i)).otherwise(none).alias(c) for i, c in ((1, "a_keys"), (2, "a_vals"))])


def parse_operation(text: Column, root_fields_exact: bool = False, parts: Column | None = None) -> Column:
    """struct(type, operationName, variables, fieldsSelected, aliases) or null when the text is
    not an operation (C3/C4). ``text`` must already be stripped (see ``client_definitions``).
    ``root_fields_exact`` (D14): fieldsSelected holds every root field, as ``root_fields`` reads them,
    in place of what the first brace pair shows. ``parts``: a column that holds its ``operation_parts``."""
    t = text
    p = operation_parts(t) if parts is None else parts
    op_type, op_name = p["type"], p["name"]
    variables = F.transform(F.regexp_extract_all(F.coalesce(p["vars"], F.lit("")), F.lit(VAR_RE), 1),
                            lambda v: F.concat(F.lit("$"), v))
    body = p["body"]
    none = F.array().cast("array<string>")
    aliased, targets = (F.when(body.contains(":"), F.regexp_extract_all(body, F.lit(ALIAS_IN_BODY_RE), i)).otherwise(none) for i in (1, 2))
    plain = F.regexp_extract_all(body, F.lit(FIELD_RE), 1)
    fields = F.array_sort(F.array_distinct(F.concat(F.array_except(plain, aliased), targets)))
    fields = F.when(p["has_body"], fields).otherwise(F.array().cast("array<string>"))
    if root_fields_exact:
        fields = F.array_sort(root_fields(t))
    # Alias map over the whole text, last writer wins
    a_keys, a_vals = p["a_keys"], p["a_vals"]
    a_idx = F.sequence(F.lit(1), F.greatest(F.size(a_keys), F.lit(1)))
    last_of_key = F.filter(a_idx, lambda i: (i <= F.size(a_keys)) & ~F.exists(
        F.slice(a_keys, i + 1, F.greatest(F.size(a_keys) - i, F.lit(1))),
        lambda k: (k == F.element_at(a_keys, i)) & (i < F.size(a_keys))))
    aliases = F.map_from_arrays(F.transform(last_of_key, lambda i: F.element_at(a_keys, i)),
                                F.transform(last_of_key, lambda i: F.element_at(a_vals, i)))
    return F.when(op_type.isNotNull(), F.struct(
        op_type.alias("type"), op_name.alias("operationName"), variables.alias("variables"),
        fields.alias("fieldsSelected"), aliases.alias("aliases")))


# ---------------------------------------------------------------------------------------------
# Templates -> definitions
# ---------------------------------------------------------------------------------------------

def templates(events: DataFrame) -> DataFrame:
    """Every gql`…` template with its line, variable name and text."""
    head, line = F.col("head"), F.col("line")
    assigned = F.coalesce(*[T.nullif_empty(F.regexp_extract(head, r, 1)) for r in (TYPED_RE, ASSIGNED_RE)])
    in_call = T.nullif_empty(F.regexp_extract(head, r"(" + _ID + r")" + _TYPE_ARGS + r"\s*\(\s*$", 1))
    var = F.coalesce(assigned, in_call, F.concat(F.lit("anonymous_gql_"), F.col("path"), F.lit(":"), line.cast("string")))
    return events.filter("kind = 'gql'").select("path", "pos", "line", var.alias("name"), T.clean_template(F.col("text")).alias("text"))


def client_definitions(files: DataFrame, events: DataFrame | None = None, root_fields_exact: bool = False) -> DataFrame:
    """Definition rows (key, path, pos, line, name, type, fullname, op struct, raw_text). ``events``: those of
    ``client_events``, if they are there already."""
    t = templates(client_events(files) if events is None else events).filter(F.col("text") != "")
    # the text is read by many conditional expressions, which common-subexpression elimination does
    # not share; the generator makes the (stripped) text and the header test a computed column once
    t = t.select("*", F.explode(F.array(F.struct(T.strip_ws(F.col("text")).alias("s")))).alias("__t"))
    # (a function of an array: a method generated for all patterns would be too long for the JVM to compile)
    t = t.select("*", F.explode(F.transform(F.array("__t.s"), operation_parts)).alias("__p")).filter(F.col("__p.type").isNotNull())
    t = t.withColumn("op", parse_operation(F.col("__t.s"), root_fields_exact, F.col("__p"))).drop("__t", "__p")
    return t.select(_key("d"), "path", "pos", "line", "name",
                    F.element_at(_type_map(DEF_TYPES), F.col("op.type")).alias("type"),
                    F.concat(F.col("path"), F.lit(":"), F.col("line").cast("string")).alias("fullname"),
                    "op", F.col("text").alias("raw_text"))


def definition_properties(defs: DataFrame) -> DataFrame:
    """One row per saved property; absent lists give no row, operationName is always saved."""
    p = "GraphQL_Client_Definition."
    base = defs.select("key", "fullname", F.explode(F.array(
        F.struct(F.lit(p + "operationName").alias("prop"), F.col("op.operationName").alias("value")),
        F.struct(F.lit(p + "rawQueryText").alias("prop"), F.col("raw_text").alias("value")),
        F.struct(F.lit(p + "variables").alias("prop"),
                 F.when(F.size("op.variables") > 0, T.join_list(F.col("op.variables"))).alias("value")),
        F.struct(F.lit(p + "fieldsSelected").alias("prop"),
                 F.when(F.size("op.fieldsSelected") > 0, T.join_list(F.col("op.fieldsSelected"))).alias("value")),
    )).alias("x")).select("key", "fullname", "x.*")
    base = base.filter(F.col("value").isNotNull() | (F.col("prop") == p + "operationName"))
    aliases = defs.select("key", "fullname", F.explode("op.aliases").alias("k", "value")) \
        .select("key", "fullname", F.concat(F.lit(p + "alias."), F.col("k")).alias("prop"), "value")
    return base.unionByName(aliases)


def request_properties(reqs: DataFrame) -> DataFrame:
    """S9 for requests: hookType always, fetchPolicy / errorPolicy when present."""
    p = "GraphQL_Hook_Request."
    return reqs.select("key", "fullname", F.explode(F.array(
        F.struct(F.lit(p + "hookType").alias("prop"), F.col("hook").alias("value")),
        F.struct(F.lit(p + "fetchPolicy").alias("prop"), F.col("fetch_policy").alias("value")),
        F.struct(F.lit(p + "errorPolicy").alias("prop"), F.col("error_policy").alias("value")))).alias("x")) \
        .select("key", "fullname", "x.*").filter(F.col("value").isNotNull())


# ---------------------------------------------------------------------------------------------
# Hooks -> requests
# ---------------------------------------------------------------------------------------------

def hook_calls(events: DataFrame) -> DataFrame:
    """(path, pos, line, hook, query_name, fetch_policy, error_policy, bodies). Only the options object's own
    options count: objects and functions inside it are empty brackets in ``options``."""
    query = T.nullif_empty(F.regexp_extract("text", r"^\s*(" + _ID + r")", 1))
    own = r"(?:^|[\s,'\"])%s['\"]?\s*:\s*([\"'][^\"']*[\"'])"
    fetch, error = (T.clean_option(F.regexp_extract("options", own % name, 1)).alias(c) for name, c in zip(OPTION_NAMES, ("fetch_policy", "error_policy")))
    return events.filter("kind = 'hook'").select("path", "pos", "line", F.col("name").alias("hook"), query.alias("query_name"), fetch, error, "bodies")


def enclosed(points: DataFrame, funcs: DataFrame) -> DataFrame:
    """C17: points(path, pos, bodies, …) with ``parent``, the fullname of the innermost named function around them; a
    point outside named functions goes. One join by place: a point asks for each body around it."""
    rest = [c for c in points.columns if c not in ("path", "pos", "bodies")]
    asked = points.select("path", "pos", *rest, F.posexplode("bodies").alias("nth", "body"))
    found = asked.join(funcs.select("path", "body", F.col("fullname").alias("parent")), ["path", "body"])
    inner = found.groupBy("path", "pos").agg(F.min_by(F.struct(*rest, "parent"), "nth").alias("x"))
    return inner.select("path", "pos", "x.*")


def requests(files: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Request rows; dropped when the first argument has no name or no enclosing function."""
    events = client_events(files) if events is None else events
    h = enclosed(hook_calls(events).filter(F.col("query_name").isNotNull()), functions(events))
    return h.select(_key("r"), "path", "pos", "line", F.concat(F.col("hook"), F.lit(":"), F.col("query_name")).alias("name"),
                    F.element_at(_type_map(HOOK_TYPES), F.col("hook")).alias("type"),
                    F.concat(F.col("path"), F.lit(":"), F.col("line").cast("string")).alias("fullname"),
                    "hook", "query_name", "fetch_policy", "error_policy", "parent")


# ---------------------------------------------------------------------------------------------
# As-of definition lookup and links
# ---------------------------------------------------------------------------------------------

def definition_lookup(reqs: DataFrame, defs: DataFrame) -> DataFrame:
    """A hook in file k sees the last definition with its name in files 1..k (path order; in file
    k all definitions come before the hooks). Both sides are first reduced to one row per
    (name, path). A name can be in any number of files, so paths get numbers in their order, and the as-of
    runs inside stretches of these and over one row per (name, stretch): a stretch holds so many paths at every
    size. C16: the same lookup by upper-case name flags case-only mismatches."""
    reqs = stored(reqs, "requests")
    d = stored(defs.groupBy("name", "path").agg(F.max_by(F.struct("fullname", "key"), "pos").alias("d")), "definition-names")
    k = reqs.select(F.col("query_name").alias("name"), "path").distinct()
    none = F.lit(None).cast(d.schema["d"].dataType).alias("d")
    exact = d.select("name", "path", F.lit(0).alias("phase"), "d").unionByName(k.select("name", "path", F.lit(1).alias("phase"), none))
    loose = d.groupBy(F.upper("name").alias("name"), "path").agg(F.first("d").alias("d")).select("name", "path", F.lit(0).alias("phase"), "d") \
        .unionByName(k.select(F.upper("name").alias("name"), "path").distinct().select("name", "path", F.lit(1).alias("phase"), none))
    both = exact.withColumn("by_case", F.lit(True)).unionByName(loose.withColumn("by_case", F.lit(False)))
    placed = both.join(path_order(reqs.select("path").union(d.select("path"))), "path")
    seen = asof_last(placed, ["by_case", "name"], "place", "phase", "d", "hit", plain=both).filter("phase = 1")
    hits = seen.filter("by_case").select(F.col("name").alias("query_name"), "path", "hit")
    near = seen.filter("not by_case").select(F.col("name").alias("uname"), "path", F.col("hit").isNotNull().alias("ci"))
    out = reqs.join(hits, ["query_name", "path"], "left").withColumn("uname", F.upper("query_name")) \
        .join(near, ["uname", "path"], "left").drop("uname")
    return out.withColumn("definition", F.col("hit.fullname")).withColumn("definition_key", F.col("hit.key")) \
        .withColumn("case_mismatch", F.col("hit").isNull() & F.coalesce(F.col("ci"), F.lit(False))) \
        .drop("hit", "ci")


def client_links(looked_up: DataFrame) -> DataFrame:
    """C14 + C15: callLink component -> request (with bookmark), useLink request -> definition."""
    call = looked_up.select(F.lit("callLink").alias("link_type"), F.col("parent").alias("caller"),
                            F.col("fullname").alias("callee"), "path", "line",
                            T.link_bookmark(F.col("path"), F.col("line")).alias("bookmark"),
                            F.col("parent").alias("caller_key"), F.col("key").alias("callee_key"))
    use = looked_up.filter(F.col("definition").isNotNull()).select(
        F.lit("useLink").alias("link_type"), F.col("fullname").alias("caller"), F.col("definition").alias("callee"),
        "path", "line", F.lit(None).cast(call.schema["bookmark"].dataType).alias("bookmark"),
        F.col("key").alias("caller_key"), F.col("definition_key").alias("callee_key"))
    return call.unionByName(use)


def unmatched_hooks(looked_up: DataFrame) -> DataFrame:
    """Requests whose query name has no visible definition; flags case-only mismatches."""
    return looked_up.filter(F.col("definition").isNull()).select(
        "path", "line", "fullname", "query_name", "case_mismatch")


# ---------------------------------------------------------------------------------------------
# Pre-parsed calls: js_calls(path, line, pos, callee, arg0, arg1_text, assigned_to, enclosing)
# (a caller that already has a JavaScript AST enters here instead of the text scan)
# ---------------------------------------------------------------------------------------------

def definitions_from_calls(calls: DataFrame, root_fields_exact: bool = False) -> DataFrame:
    """C2-C8 from pre-parsed ``gql`` calls: arg0 is the template text, assigned_to the variable."""
    g = calls.filter(F.col("callee") == "gql").select(
        "path", "pos", "line",
        F.coalesce(T.nullif_empty(F.col("assigned_to")), T.nullif_empty(F.col("enclosing")),
                   F.concat(F.lit("anonymous_gql_"), F.col("path"), F.lit(":"), F.col("line").cast("string"))).alias("name"),
        T.clean_template(F.col("arg0")).alias("text"))
    g = g.filter(F.col("text") != "").withColumn("op", parse_operation(F.col("text"), root_fields_exact)).filter(F.col("op").isNotNull())
    return g.select(_key("d"), "path", "pos", "line", "name", F.element_at(_type_map(DEF_TYPES), F.col("op.type")).alias("type"),
                    F.concat(F.col("path"), F.lit(":"), F.col("line").cast("string")).alias("fullname"),
                    "op", F.col("text").alias("raw_text"))


def requests_from_calls(calls: DataFrame) -> DataFrame:
    """C10-C13 from pre-parsed hook calls: arg0 is the first argument's name, arg1_text the options
    object text, enclosing the fullname of the nearest named ancestor (requests without one drop)."""
    h = calls.filter(F.col("callee").isin([k for k, _ in HOOK_TYPES]) & T.nullif_empty(F.col("arg0")).isNotNull()
                     & T.nullif_empty(F.col("enclosing")).isNotNull())
    opts = F.coalesce(F.col("arg1_text"), F.lit(""))
    fetch = T.clean_option(F.regexp_extract(opts, r"fetchPolicy\s*:\s*([\"'][^\"']*[\"'])", 1))
    error = T.clean_option(F.regexp_extract(opts, r"errorPolicy\s*:\s*([\"'][^\"']*[\"'])", 1))
    return h.select(_key("r"), "path", "pos", "line", F.concat(F.col("callee"), F.lit(":"), F.col("arg0")).alias("name"),
                    F.element_at(_type_map(HOOK_TYPES), F.col("callee")).alias("type"),
                    F.concat(F.col("path"), F.lit(":"), F.col("line").cast("string")).alias("fullname"),
                    F.col("callee").alias("hook"), F.col("arg0").alias("query_name"),
                    fetch.alias("fetch_policy"), error.alias("error_policy"), F.col("enclosing").alias("parent"))
