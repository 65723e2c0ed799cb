"""Reference extraction and name resolution (R1-R14, S10 for schema links).

Every lookup the analysed tool does by scanning a dict or list is an equi-join here:

* caller lookup (R3): the node on the reference line itself, else the innermost registered container
  around it, both found in ``schema.extract_objects`` (no range join);
* same-file resolution (R4): equi-join on (path, last name segment);
* cross-file resolution (R5/R6): symbols pre-aggregated per short name (count + first candidate in
  registration order), so a short name shared by millions of objects is one row before the join;
* suffix resolution (R14): every '.'/':' suffix of a fullname exploded into an index, then equi-join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.materialize import stored
from ..functions.patterns import BUILTIN_SCALARS

# FIXED VALUES: argument reference patterns (case-sensitive, one line).
REF_LINE_RE = r"^\s*([a-z][A-Za-z0-9_]*)\s*\(([^)]+)\)\s*:"
REF_ARG_RE = r"([a-z][A-Za-z0-9_]*)\s*:\s*\[?([A-Z][A-Za-z0-9_]+)"
TIEBREAK_RE = r"\.graphql|\.gql"


def type_references(lines: DataFrame, keep_builtins: bool = False) -> DataFrame:
    """R1 (+R2): (path, line, field, arg_pos, callee) for every `arg: Type` pair on `name(args):` lines."""
    txt = F.col("text")
    refs = lines.filter(txt.rlike(REF_LINE_RE)).select(
        "path", "line", F.regexp_extract(txt, REF_LINE_RE, 1).alias("field"),
        F.regexp_extract(txt, REF_LINE_RE, 2).alias("args"))
    refs = refs.select("path", "line", "field",
                       F.posexplode(F.regexp_extract_all(F.col("args"), F.lit(REF_ARG_RE), 2)).alias("arg_pos", "callee"))
    refs = refs.withColumn("arg_pos", F.col("arg_pos").cast("int"))
    if not keep_builtins:
        refs = refs.filter(~F.col("callee").isin(*BUILTIN_SCALARS))
    return refs


def reference_callers(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """caller = smallest registered object whose [start, end] contains the line (tie: creation
    order), else the Program (path): the registered node of the line itself, or the registered container
    around it that the schema pass found."""
    at = nodes.select("path", "line", F.when(F.col("is_registered"), F.col("fullname")).otherwise(F.col("enclosing")).alias("caller"))
    return refs.join(at, ["path", "line"], "left").withColumn("caller", F.coalesce(F.col("caller"), F.col("path")))


def symbols(objects: DataFrame) -> DataFrame:
    """Symbol table (short_name, fullname, path, order_key); registration order = (path, order_key)."""
    return objects.select(F.col("name").alias("short_name"), "fullname", "path", "order_key", "type")


def resolve_references(pending: DataFrame, objects: DataFrame) -> DataFrame:
    """R4-R6 (+R8): add ``target`` and ``resolution`` (same_file / cross_unique / cross_tiebreak /
    unresolved) to pending(path, callee, ...)."""
    keys = pending.select("path", "callee").distinct()
    # First object (creation order) of the same file whose fullname ends with '.callee'
    last_seg = objects.filter(F.instr(F.col("fullname"), ".") > 0).select(
        "path", T.short_name(F.col("fullname")).alias("callee"), "fullname", "order_key")
    same = last_seg.join(keys, ["path", "callee"], "left_semi").groupBy("path", "callee").agg(
        F.min_by("fullname", "order_key").alias("same_target"))
    # Per short name, number of symbols and the first one (registration order) with a marker
    names = keys.select("callee").distinct()
    sym = symbols(objects).join(names.withColumnRenamed("callee", "short_name"), "short_name", "left_semi")
    per_name = sym.groupBy("short_name").agg(
        F.count("*").alias("n_cand"),
        F.min_by("fullname", F.struct("path", "order_key")).alias("only"),
        F.min_by(F.when(F.col("fullname").rlike(TIEBREAK_RE), F.col("fullname")),
                 F.when(F.col("fullname").rlike(TIEBREAK_RE), F.struct("path", "order_key"))).alias("marked"))
    r = keys.join(same, ["path", "callee"], "left") \
        .join(per_name.withColumnRenamed("short_name", "callee"), "callee", "left")
    target = F.coalesce(F.col("same_target"),
                        F.when(F.col("n_cand") == 1, F.col("only")),
                        F.when(F.col("n_cand") > 1, F.col("marked")))
    kind = F.when(F.col("same_target").isNotNull(), "same_file") \
        .when(F.col("n_cand") == 1, "cross_unique") \
        .when((F.col("n_cand") > 1) & F.col("marked").isNotNull(), "cross_tiebreak") \
        .otherwise("unresolved")
    r = r.select("path", "callee", target.alias("target"), kind.alias("resolution"))
    return pending.join(r, ["path", "callee"], "left")


def schema_links(resolved: DataFrame) -> DataFrame:
    """R7 + S10: link rows (link_type, caller, callee, path, line, bookmark); unresolved skipped."""
    return resolved.filter(F.col("target").isNotNull()).select(
        F.lit("useLink").alias("link_type"), "caller", F.col("target").alias("callee"), "path", "line",
        "arg_pos", "resolution", T.link_bookmark(F.col("path"), F.col("line")).alias("bookmark"))


def unresolved_references(resolved: DataFrame) -> DataFrame:
    """Pending references with no target."""
    return resolved.filter(F.col("target").isNull()).select("path", "line", "caller", "callee", "arg_pos")


# ----------------------------------------------------------------------------------------------
# Generic resolver (R10-R14): names -> symbol, with the optional restrictions of the helper.
# requests(req_id, name, context_path, restrict_to_file bool, restrict_to_class string)
# ----------------------------------------------------------------------------------------------

def _under(objects: DataFrame, by: str, asked: DataFrame) -> DataFrame:
    """(prefix, by, fullname) of objects(by, fullname) for the pairs of asked(prefix, by): 'fullname starts with
    X.' as the equality key X, one row per dot of the objects of asked names only, and only where an X has as many dots."""
    depths = T.depths(asked, F.col("prefix"), ".")
    if depths is None:
        objects = objects.join(asked.select(by).distinct(), by, "left_semi")
    return objects.select(by, "fullname", F.explode(T.prefixes(F.col("fullname"), depths)).alias("prefix")).join(asked, ["prefix", by], "left_semi")


def _suffixes(objects: DataFrame, loose: DataFrame) -> DataFrame:
    """(fullname, sfx) of objects(fullname), each once, for the names that loose(name) asks for: what follows a '.' or ':' of
    the fullname, only where a name has as many of these."""
    depths = T.depths(loose, F.col("name"), ".:")
    if depths is None:
        last = loose.select(T.last_segment(F.col("name")).alias("last")).distinct()
        objects = objects.withColumn("last", T.last_segment(F.col("fullname"))).join(last, "last", "left_semi")
    sfx = objects.select("fullname", F.explode(T.suffixes(F.col("fullname"), depths)).alias("sfx"))
    return sfx.join(loose.select(F.col("name").alias("sfx")), "sfx", "left_semi").distinct()


def generic_resolve(requests: DataFrame, objects: DataFrame) -> DataFrame:
    """R10-R14 over requests(req_id, name, context_path, restrict_to_file, restrict_to_class).

    Rules in order: exact fullname; else, when the short name is known: class-restricted (exactly one
    under the class), file-restricted (exactly one in the file), prefer the file (one -> it, several ->
    none), else exactly one overall; else suffix match ('.name' or ':name') with the same file
    preference. Every candidate count is an aggregate joined on equality keys, and no index holds more
    than was asked for: a name that is a fullname asks for nothing more, and prefixes or suffixes are made only
    as deep as those asked for (where these are many, of objects of asked names or last segments only).
    """
    objs = objects.select("name", "fullname")
    columns = requests.columns
    requests = stored(requests, "resolver-requests")
    names = requests.select("name").distinct()
    exact = objs.join(names.withColumnRenamed("name", "fullname"), "fullname", "left_semi").select(F.col("fullname").alias("name")) \
        .distinct().withColumn("__exact", F.lit(True))
    met = stored(requests.join(exact, "name", "left"), "resolver-exact")
    found = met.filter("__exact").select(*columns, F.col("name").alias("target"), F.lit("exact").alias("rule"))
    requests = met.filter("__exact is null").select(*columns)  # only these go on
    ask = requests.agg(F.count("*").alias("n"), F.count("restrict_to_class").alias("n_class"), F.count("context_path").alias("n_path")).first()
    if not ask["n"]:
        return found
    names = requests.select("name").distinct()
    named = objs.join(names, "name", "left_semi")
    per_name = stored(named.groupBy("name").agg(F.count("*").alias("n_all"), F.max("fullname").alias("f_any")), "resolver-names")
    by_class, by_path = (requests.filter(F.col(c).isNotNull()).select(F.col(c).alias("prefix"), "name") for c in ("restrict_to_class", "context_path"))
    asked = (by_class.unionByName(by_path) if ask["n_class"] and ask["n_path"] else by_class if ask["n_class"] else by_path).distinct()
    loose = stored(names.join(per_name, "name", "left_anti"), "resolver-loose")
    r = requests.join(per_name, "name", "left")

    def joined(r: DataFrame, there: bool, table: Callable[[], DataFrame], keys: list[str], values: dict[str, str]) -> DataFrame:
        """``r`` with the values of the table, which are null where nothing asks for it."""
        return r.join(table(), keys, "left") if there else r.withColumns({c: F.lit(None).cast(t) for c, t in values.items()})

    def inside(prefix: str, n: str, f: str) -> DataFrame:
        return pidx.select(F.col("prefix").alias(prefix), F.col("short_name").alias("name"), F.col("n_in").alias(n), F.col("f_in").alias(f))

    if ask["n_class"] or ask["n_path"]:
        pidx = _under(named, "name", asked).groupBy("prefix", F.col("name").alias("short_name")).agg(
            F.count("*").alias("n_in"), F.max("fullname").alias("f_in"))
        if ask["n_class"] and ask["n_path"]:
            pidx = stored(pidx, "resolver-prefixes")
    r = joined(r, ask["n_class"] > 0, lambda: inside("restrict_to_class", "n_class", "f_class"), ["restrict_to_class", "name"], {"n_class": "long", "f_class": "string"})
    r = joined(r, ask["n_path"] > 0, lambda: inside("context_path", "n_file", "f_file"), ["context_path", "name"], {"n_file": "long", "f_file": "string"})
    any_loose = bool(loose.limit(1).count())
    if any_loose:
        sfx = stored(_suffixes(objs.select("fullname"), loose), "resolver-suffixes")
    r = joined(r, any_loose, lambda: sfx.groupBy("sfx").agg(F.count("*").alias("s_all"), F.max("fullname").alias("sf_any")).withColumnRenamed("sfx", "name"),
               ["name"], {"s_all": "long", "sf_any": "string"})
    r = joined(r, any_loose and ask["n_path"] > 0, lambda: _under(sfx, "sfx", asked.withColumnRenamed("name", "sfx")).groupBy("sfx", "prefix").agg(
        F.count("*").alias("s_file"), F.max("fullname").alias("sf_file")).withColumnRenamed("sfx", "name").withColumnRenamed("prefix", "context_path"),
        ["name", "context_path"], {"s_file": "long", "sf_file": "string"})
    n_file = F.coalesce(F.col("n_file"), F.lit(0))
    has_short = F.coalesce(F.col("n_all"), F.lit(0)) > 0
    cls_ = F.col("restrict_to_class").isNotNull()
    ctx = F.col("context_path").isNotNull()
    rtf = F.coalesce(F.col("restrict_to_file"), F.lit(False)) & ctx
    short_target = F.when(cls_, F.when(F.col("n_class") == 1, F.col("f_class"))) \
        .when(rtf, F.when(n_file == 1, F.col("f_file"))) \
        .when(ctx & (n_file == 1), F.col("f_file")) \
        .when(ctx & (n_file > 1), F.lit(None)) \
        .when(F.col("n_all") == 1, F.col("f_any"))
    short_rule = F.when(cls_, F.lit("class")).when(rtf, F.lit("file")) \
        .when(ctx & (n_file >= 1), F.lit("prefer_file")).otherwise(F.lit("unique"))
    s_file = F.coalesce(F.col("s_file"), F.lit(0))
    s_any = F.coalesce(F.col("s_all"), F.lit(0))
    suffix_target = F.when(ctx & (s_file == 1), F.col("sf_file")) \
        .when(ctx & (s_file > 1), F.lit(None)) \
        .when(s_any == 1, F.col("sf_any"))
    target = F.when(has_short, short_target).otherwise(suffix_target)
    rule = F.when(has_short, short_rule).when(s_any > 0, F.lit("suffix")).otherwise(F.lit("none"))
    return found.unionByName(r.select(*columns, target.alias("target"), F.when(target.isNotNull(), rule).alias("rule")))
