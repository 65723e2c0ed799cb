"""Registered queries: name -> (spark, sf_dir) -> DataFrame. Column names match ``oracle.ORACLE``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import client as C
from ..operators import link as L
from ..operators import resolve as R
from ..operators import schema as Sch
from ..functions.materialize import stored
from ..sources.corpus import catalogue_corpus, nested_corpus, read_table
from ..functions.patterns import PatternSet
from ..session import ensure_checkpoint_dir
from ..sources.files import from_table, scan_checked, scan_lines, to_lines
from ..sources.sinks import write_objects
from .pipeline import analysis_for

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _big(*cols):
    return [F.col(c).cast("bigint").alias(c) for c in cols]


# ---------------------------------------------------------------- raw text
@query("corpus_lines")
def corpus_lines(spark, d):
    docs = from_table(read_table(spark, d, "documents"), "doc_id", "text")
    lines = to_lines(docs)
    return lines.select(F.col("path").cast("bigint").alias("doc_id"), *_big("line"),
                        F.length("text").cast("bigint").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("digest"),
                        T.count_char(F.col("text"), "{").cast("bigint").alias("opens"),
                        T.count_char(F.col("text"), "}").cast("bigint").alias("closes"))


@query("brace_depth")
def brace_depth(spark, d):
    pages = from_table(read_table(spark, d, "pages"), "page_id", "html")
    lines = Sch.with_depth(to_lines(pages))
    return lines.select(F.col("path").cast("bigint").alias("page_id"), *_big("line", "depth"))


# ---------------------------------------------------------------- files
def _page_files(spark, d):
    """Text files that Spark writes from ``pages``: a file for each remainder of page_id by 16."""
    def build():
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry/pages-{uuid.uuid4().hex}"
        pages = read_table(spark, d, "pages").select((F.col("page_id") % 16).alias("bucket"), "page_id", F.coalesce("html", F.lit("")).alias("html"))
        pages = pages.repartition("bucket").sortWithinPartitions("bucket", "page_id")
        pages.select("bucket", "html").write.partitionBy("bucket").text(path)
        return path
    return analysis_for(spark, d)._get("page_files", build)


def _bucket():
    return F.regexp_extract("path", r"bucket=(\d+)/", 1).cast("bigint").alias("bucket")


@query("scanned_lines")
def scanned_lines(spark, d):
    """The files' lines, read by blocks."""
    return scan_lines(spark, _page_files(spark, d), ["txt"]).select(_bucket(), *_big("line"), F.md5(F.col("text").cast("binary")).alias("digest"))


@query("scanned_files")
def scanned_files(spark, d):
    """The files as rows; those of more than 32 KiB are errors."""
    files, _ = scan_checked(spark, _page_files(spark, d), ["TXT"], max_bytes=1 << 15)
    return files.select(_bucket(), F.length("content").cast("bigint").alias("n_chars"), F.md5(F.col("content").cast("binary")).alias("digest"))


@query("scan_errors")
def scan_errors(spark, d):
    """A row per file that could not be a row."""
    _, errors = scan_checked(spark, _page_files(spark, d), ["txt"], max_bytes=1 << 15)
    return errors.select(_bucket(), "stage", "error")


# ---------------------------------------------------------------- schema objects
@query("classify_lines")
def classify_lines(spark, d):
    n = analysis_for(spark, d).nodes()
    return n.select("path", *_big("line"), "pattern_key", "obj_type", "name")


@query("classify_catalogue")
def classify_catalogue(spark, d):
    """X1-X3 over a line of every form that the catalogue knows."""
    n = Sch.classify(catalogue_corpus(spark, d))
    return n.select(F.col("pk").cast("bigint").alias("pk"), "pattern_key", "obj_type", "name")


@query("nested_objects")
def nested_objects(spark, d):
    """Objects of blocks inside blocks."""
    lines = stored(nested_corpus(spark, d), "nested-lines")
    o = Sch.extract_objects(lines, lines.groupBy("path").agg(F.max("line").alias("n_lines")))["objects"].filter("type <> 'GraphQLProgram'")
    return o.select("type", "fullname", "parent_fullname", *_big("start_line", "end_line"), F.array_join(F.col("order_key").cast("array<string>"), "/").alias("order_key"))


@query("schema_objects")
def schema_objects(spark, d):
    o = analysis_for(spark, d).objects()
    return o.select("path", "type", "name", "fullname", "parent_fullname", *_big("start_line", "end_line"), "guid")


@query("object_bookmarks")
def object_bookmarks(spark, d):
    o = analysis_for(spark, d).objects()
    b = T.object_bookmark(F.col("path"), F.col("start_line"), F.col("end_line"))
    return o.select("fullname", b.alias("b")).select(
        "fullname", F.col("b.path").alias("bm_path"), F.col("b.line").cast("bigint").alias("bm_line"),
        F.col("b.col").cast("bigint").alias("bm_col"), F.col("b.end_line").cast("bigint").alias("bm_end_line"),
        F.col("b.end_col").cast("bigint").alias("bm_end_col"))


@query("written_objects")
def written_objects(spark, d):
    """The objects as the sink wrote them, a folder for each type, with their bookmarks."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry/objects-{uuid.uuid4().hex}"
    write_objects(analysis_for(spark, d).objects(), path)
    o = spark.read.parquet(path)
    return o.select("type", "fullname", F.col("bookmark.line").cast("bigint").alias("bm_line"), F.col("bookmark.end_line").cast("bigint").alias("bm_end_line"))


@query("receiver_objects")
def receiver_objects(spark, d):
    """Methods with a receiver, by a pattern set of one's own over the keyword-block corpus in another syntax."""
    ps = PatternSet(patterns=[("method", [r"^\s*func\s+\((?P<receiver>\*?[A-Za-z0-9]+)\)\s+(?P<n>[A-Za-z0-9]+)"]), ("kind_kw", [r"^\s*kind\s+([A-Za-z0-9]+)"])],
                    objects=[("Program", "file", []), ("Method", "Kind", ["method"]), ("Kind", "file", ["kind_kw"])])
    lines, _ = analysis_for(spark, d).keyword_blocks()
    t = F.col("text")
    text = F.when(t.startswith("class"), F.concat(F.replace(t, F.lit("class"), F.lit("kind")), F.lit(" {"))).when(t == "end", F.lit("}")) \
        .when(t.startswith("  def"), F.replace(t, F.lit("def"), F.concat(F.lit("func (*R"), F.regexp_extract("path", r"s0*(\d+)\.rb", 1), F.lit(")")))).otherwise(F.lit(""))
    lines = lines.withColumn("text", text)
    n_lines = lines.groupBy("path").agg(F.max("line").cast("int").alias("n_lines"))
    o = Sch.extract_objects(lines, n_lines, ps)["objects"].filter("type <> 'GraphQLProgram'")
    return o.select("type", "fullname", "parent_fullname", *_big("start_line", "end_line"))


@query("extend_merge")
def extend_merge(spark, d):
    """Objects merged into an earlier object of the same fullname (they lie outside its block)."""
    o = analysis_for(spark, d).objects()
    parents = o.select(F.col("fullname").alias("parent_fullname"), F.col("start_line").alias("p_start"),
                       F.col("end_line").alias("p_end"), F.col("type").alias("p_type"))
    j = o.filter(F.col("type") != "GraphQLProgram").join(parents, "parent_fullname")
    return j.filter((F.col("p_type") != "GraphQLProgram") &
                    ((F.col("start_line") > F.col("p_end")) | (F.col("start_line") < F.col("p_start")))) \
        .select("fullname", "parent_fullname", *_big("start_line"))


@query("subtree_sizes")
def subtree_sizes(spark, d):
    """Direct children and all descendants of every object (ancestors by '.'-prefix)."""
    return Sch.subtree_sizes(analysis_for(spark, d).objects())


# ---------------------------------------------------------------- references and links
@query("type_references")
def type_references(spark, d):
    r = analysis_for(spark, d).references()
    return r.select("path", *_big("line", "arg_pos"), "caller", "callee")


@query("schema_links")
def schema_links(spark, d):
    s = analysis_for(spark, d).schema_links()
    return s.select("link_type", "caller", "callee", "path", *_big("line"), "resolution")


def _links_kind(kind):
    def q(spark, d):
        s = analysis_for(spark, d).schema_links().filter(F.col("resolution") == kind)
        return s.select("link_type", "caller", "callee", *_big("line"))
    return q


QUERIES["links_same_file"] = _links_kind("same_file")
QUERIES["links_cross_unique"] = _links_kind("cross_unique")
QUERIES["links_cross_tiebreak"] = _links_kind("cross_tiebreak")


@query("unresolved_refs")
def unresolved_refs(spark, d):
    u = R.unresolved_references(analysis_for(spark, d).references())
    return u.select("path", *_big("line"), "caller", "callee", *_big("arg_pos"))


@query("ambiguous_symbols")
def ambiguous_symbols(spark, d):
    o = analysis_for(spark, d).objects()
    return R.symbols(o).groupBy("short_name").agg(F.count("*").cast("bigint").alias("n_symbols")) \
        .filter(F.col("n_symbols") > 1)


# ---------------------------------------------------------------- generic resolver
def _requests(df: DataFrame, name: str, ctx=None, cls=None, rtf=False) -> DataFrame:
    return df.select(F.col(name).alias("name"),
                     (F.col(ctx) if ctx else F.lit(None).cast("string")).alias("context_path"),
                     F.lit(rtf).alias("restrict_to_file"),
                     (F.col(cls) if cls else F.lit(None).cast("string")).alias("restrict_to_class")) \
        .distinct().withColumn("req_id", F.monotonically_increasing_id())


@query("resolve_prefer_file")
def resolve_prefer_file(spark, d):
    a = analysis_for(spark, d)
    req = _requests(a.references(), "callee", ctx="path")
    return R.generic_resolve(req, a.objects()).select("context_path", "name", "target")


@query("resolve_class")
def resolve_class(spark, d):
    a = analysis_for(spark, d)
    fields = a.objects().filter(F.col("type") == "GraphQLField")
    req = _requests(fields, "name", cls="parent_fullname")
    return R.generic_resolve(req, a.objects()).select("restrict_to_class", "name", "target")


@query("resolve_suffix")
def resolve_suffix(spark, d):
    a = analysis_for(spark, d)
    o = a.objects()
    roots = o.filter(F.col("type") == "GraphQLField") \
        .select("path", F.concat(T.short_name(F.col("parent_fullname")), F.lit("."), F.col("name")).alias("qname"))
    req = _requests(roots, "qname", ctx="path")
    return R.generic_resolve(req, o).select("context_path", "name", "target")


@query("resolve_exact")
def resolve_exact(spark, d):
    a = analysis_for(spark, d)
    req = _requests(a.references(), "caller")
    return R.generic_resolve(req, a.objects()).select("name", "target")


# ---------------------------------------------------------------- client
@query("client_files")
def client_files(spark, d):
    return analysis_for(spark, d).client_files().select("path")


def _defs(spark, d):
    return analysis_for(spark, d).definitions()


@query("client_definitions")
def client_definitions(spark, d):
    x = _defs(spark, d)
    return x.select("path", *_big("line"), "name", "type", "fullname",
                    F.col("op.operationName").alias("operation_name"),
                    T.join_list(F.col("op.variables")).alias("variables"),
                    T.join_list(F.col("op.fieldsSelected")).alias("fields_selected"),
                    F.size("op.aliases").cast("bigint").alias("n_aliases"))


@query("operation_fields")
def operation_fields(spark, d):
    return _defs(spark, d).select("fullname", F.explode("op.fieldsSelected").alias("field_name"))


@query("operation_root_fields")
def operation_root_fields(spark, d):
    """C6 with the option ``root_fields_exact``: leaf fields and all fields of the outermost set."""
    a = analysis_for(spark, d)
    defs = C.client_definitions(a.client_files(), a.client_events(), root_fields_exact=True)
    return defs.select("fullname", F.explode("op.fieldsSelected").alias("field_name"))


@query("operation_variables")
def operation_variables(spark, d):
    return _defs(spark, d).select("fullname", F.explode("op.variables").alias("variable"))


@query("operation_aliases")
def operation_aliases(spark, d):
    return _defs(spark, d).select("fullname", F.explode("op.aliases").alias("alias", "field_name"))


@query("definition_properties")
def definition_properties(spark, d):
    return C.definition_properties(_defs(spark, d)).select("fullname", "prop", "value")


@query("hook_requests")
def hook_requests(spark, d):
    r = analysis_for(spark, d).requests()
    return r.select("path", *_big("line"), "name", "type", "fullname", "parent", "fetch_policy", "error_policy")


@query("hook_options")
def hook_options(spark, d):
    r = analysis_for(spark, d).requests()
    opts = r.select("fullname", F.explode(F.array(
        F.struct(F.lit("fetchPolicy").alias("option"), F.col("fetch_policy").alias("value")),
        F.struct(F.lit("errorPolicy").alias("option"), F.col("error_policy").alias("value")))).alias("o"))
    return opts.select("fullname", "o.*").filter(F.col("value").isNotNull())


@query("component_request_links")
def component_request_links(spark, d):
    l = analysis_for(spark, d).client_links().filter(F.col("link_type") == "callLink")
    return l.select("link_type", "caller", "callee", *_big("line"))


@query("request_definition_links")
def request_definition_links(spark, d):
    l = analysis_for(spark, d).client_links().filter(F.col("link_type") == "useLink")
    return l.select("link_type", "caller", "callee")


@query("unmatched_hooks")
def unmatched_hooks(spark, d):
    return C.unmatched_hooks(analysis_for(spark, d).requests()).select("fullname", "query_name", "case_mismatch")


# ---------------------------------------------------------------- application level
@query("schema_index")
def schema_index(spark, d):
    return analysis_for(spark, d).schema_index().select("op", "field_name", "field_fullname")


@query("definition_field_links")
def definition_field_links(spark, d):
    return analysis_for(spark, d).definition_field_links().select("link_type", "caller", "callee")


@query("missing_fields")
def missing_fields(spark, d):
    a = analysis_for(spark, d)
    return L.missing_fields(a.definitions(), a.schema_index())


@query("controller_methods")
def controller_methods(spark, d):
    m = L.controller_methods(analysis_for(spark, d).backend())
    return m.select(F.col("fullname").alias("method_fullname"), "class_fullname", "controller_ok")


@query("method_matches")
def method_matches(spark, d):
    m = analysis_for(spark, d).method_matches()
    return m.select("method_fullname", "op", "field_fullname", "status")


@query("field_method_links")
def field_method_links(spark, d):
    return analysis_for(spark, d).field_method_links().select("link_type", "caller", "callee")


@query("link_summary")
def link_summary(spark, d):
    a = analysis_for(spark, d)
    return L.link_summary(a.method_matches(), a.schema_index())


@query("definition_counts")
def definition_counts(spark, d):
    return L.definition_counts(_defs(spark, d))


# ---------------------------------------------------------------- lineage
from ..operators import extend as X  # noqa: E402
from ..operators import imports as I  # noqa: E402
from ..operators import lineage as G  # noqa: E402
from ..operators import report as A  # noqa: E402


@query("outgoing_links")
def outgoing_links(spark, d):
    a = analysis_for(spark, d)
    return G.outgoing_links(a.all_links(), a.requests()).select("caller", "link_type", "callee")


@query("incoming_links")
def incoming_links(spark, d):
    a = analysis_for(spark, d)
    fields = a.objects().filter(F.col("type") == "GraphQLField")
    return G.incoming_links(a.all_links(), fields).select("callee", "link_type", "caller")


@query("request_fields")
def request_fields(spark, d):
    a = analysis_for(spark, d)
    return G.request_fields(a.requests(), a.definitions()).select("request", "definition", "definition_type",
                                                                   "fields_selected")


@query("first_use_target")
def first_use_target(spark, d):
    a = analysis_for(spark, d)
    use = a.client_links().filter(F.col("link_type") == "useLink")
    return use.groupBy("caller_key").agg(F.first("caller").alias("request"), F.min_by("callee", F.struct("path", "line")).alias("target")) \
        .select("request", "target")


@query("resolver_verdicts")
def resolver_verdicts(spark, d):
    a = analysis_for(spark, d)
    return G.resolver_verdicts(a.requests(), a.definitions(), a.backend())


@query("method_index")
def method_index(spark, d):
    return G.method_index(analysis_for(spark, d).backend())


@query("methods_by_name")
def methods_by_name(spark, d):
    """The methods themselves, a row each under their name."""
    return G.methods_by_name(analysis_for(spark, d).backend())


@query("full_stack_trace")
def full_stack_trace(spark, d):
    a = analysis_for(spark, d)
    return G.full_stack_trace(a.requests(), a.definition_field_links(), a.field_method_links()).drop("request_key")


@query("trace_methods")
def trace_methods(spark, d):
    """G8, the far end of the trace: every backend method of every field that a request reaches."""
    a = analysis_for(spark, d)
    trace = G.full_stack_trace(a.requests(), a.definition_field_links(), a.field_method_links())
    return G.trace_methods(trace, a.field_method_links())


@query("component_stack")
def component_stack(spark, d):
    """G8 written out in full for chosen components: here the one with the most requests."""
    a = analysis_for(spark, d)
    trace = G.full_stack_trace(a.requests(), a.definition_field_links(), a.field_method_links())
    seed = a.requests().groupBy(F.col("parent").alias("component")).count().orderBy(F.desc("count"), "component").limit(1)
    return G.expand_trace(trace, a.field_method_links(), components=seed).drop("request_key", "n_methods")


@query("method_stack")
def method_stack(spark, d):
    """G8 upwards: every component that reaches the first method that any does."""
    a = analysis_for(spark, d)
    trace = G.full_stack_trace(a.requests(), a.definition_field_links(), a.field_method_links())
    seed = G.trace_methods(trace, a.field_method_links()).agg(F.min("method").alias("method"))
    return G.expand_trace(trace, a.field_method_links(), methods=seed).drop("request_key", "n_methods")


@query("resolver_methods")
def resolver_methods(spark, d):
    """G5 in full: every method named like a first field and whether it passes for a type of definition."""
    a = analysis_for(spark, d)
    return G.resolver_methods(a.definitions(), a.backend())


# ---------------------------------------------------------------- reports
@query("report_totals")
def report_totals(spark, d):
    a = analysis_for(spark, d)
    return a.report_totals()


@query("report_by_file")
def report_by_file(spark, d):
    return A.report_by_file(analysis_for(spark, d).objects())


@query("report_by_type")
def report_by_type(spark, d):
    return A.report_by_type(analysis_for(spark, d).objects())


@query("index_sizes")
def index_sizes(spark, d):
    return A.index_sizes(analysis_for(spark, d).schema_index())


@query("client_totals")
def client_totals(spark, d):
    a = analysis_for(spark, d)
    return A.client_totals(a.client_files(), a.definitions())


def _typed(a):
    return a.objects().select("fullname", "type") \
        .unionByName(a.definitions().select("fullname", "type")) \
        .unionByName(a.requests().select("fullname", "type"))


@query("objects_by_category")
def objects_by_category(spark, d):
    return A.objects_by_category(_typed(analysis_for(spark, d)))


@query("property_inventory")
def property_inventory(spark, d):
    a = analysis_for(spark, d)
    props = C.definition_properties(a.definitions()).unionByName(C.request_properties(a.requests()))
    typed = a.definitions().select("key", "type").unionByName(a.requests().select("key", "type"))
    return A.property_inventory(typed, props)


@query("search_objects")
def search_objects(spark, d):
    """Every query definition with its saved properties attached."""
    a = analysis_for(spark, d)
    found = G.search_objects(a.definitions().select("key", "fullname", "name", "type"), C.definition_properties(a.definitions()),
                             type_="GraphQLClientQuery")
    return found.select("fullname", "name", F.element_at("properties", "GraphQL_Client_Definition.operationName").alias("operation_name"),
                        F.try_element_at("properties", F.lit("GraphQL_Client_Definition.fieldsSelected")).alias("fields_selected"))


@query("link_bookmarks")
def link_bookmarks(spark, d):
    """T6 on links: where a schema link's reference stands."""
    links = analysis_for(spark, d).schema_links()
    return links.select("caller", "callee", F.col("bookmark.path").alias("bm_path"), *[F.col(f"bookmark.{c}").cast("bigint").alias(f"bm_{c}")
                        for c in ("line", "col", "end_line", "end_col")])


@query("resolve_file")
def resolve_file(spark, d):
    """Names looked up in one file only."""
    a = analysis_for(spark, d)
    return R.generic_resolve(_requests(a.references(), "callee", ctx="path", rtf=True), a.objects()).select("context_path", "name", "target")


@query("object_order")
def object_order(spark, d):
    """The pre-order key of every object, as its containers' lines and its own."""
    o = analysis_for(spark, d).objects().filter("type <> 'GraphQLProgram'")
    return o.select("fullname", F.array_join(F.col("order_key").cast("array<string>"), "/").alias("order_key"))


# ---------------------------------------------------------------- imports (I1-I4), masking (T4)
@query("imports")
def imports(spark, d):
    return I.extract_imports(analysis_for(spark, d).import_lines()).select("path", *_big("line"), "name", "source")


@query("import_map")
def import_map(spark, d):
    return I.import_map(I.extract_imports(analysis_for(spark, d).import_lines()))


@query("masked_text")
def masked_text(spark, d):
    pages = read_table(spark, d, "pages")
    m = T.mask_source(F.col("html"))
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), m.alias("masked"))


# ---------------------------------------------------------------- handlers
@query("custom_handlers")
def custom_handlers(spark, d):
    reg = X.HandlerRegistry()
    reg.register("type_extend", X.count_by_key)
    reg.register_pattern(r".*_def", X.count_by_key)
    return reg.apply(analysis_for(spark, d).nodes()).select("pattern_key", "n_roots")


@query("handler_outcomes")
def handler_outcomes(spark, d):
    """What became of each handler, one of which fails in its tasks."""
    def broken(df):
        return df.select(F.raise_error(F.concat(F.lit("no handler for "), "name")).alias("x"))

    reg = X.HandlerRegistry()
    reg.register("type_extend", X.count_by_key), reg.register("enum_def", broken), reg.register_pattern(r".*_def", X.count_by_key)
    _, outcomes = reg.run(analysis_for(spark, d).nodes())
    return outcomes.select("handler", "n_rows", F.col("error").isNotNull().alias("failed"))


# ---------------------------------------------------------------- other block styles
from ..operators import blocks as B  # noqa: E402


def _blocks(fn):
    def q(spark, d):
        lines, nodes = analysis_for(spark, d).keyword_blocks()
        return fn(lines, nodes).select("path", *_big("line", "end_line"))
    return q


QUERIES["blocks_end_keyword"] = _blocks(B.end_keyword_ends)
QUERIES["blocks_indentation"] = _blocks(B.indentation_ends)
QUERIES["blocks_sequential"] = _blocks(B.sequential_ends)


@query("object_listing")
def object_listing(spark, d):
    """A2 listing: every non-Program object of each file with its short name and kind."""
    o = A.object_listing(analysis_for(spark, d).objects())
    return o.select("path", "short_name", "kind", F.element_at("order_key", -1).cast("bigint").alias("start_line"))
