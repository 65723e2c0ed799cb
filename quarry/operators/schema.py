"""Schema object extraction (X2, X4-X12, T5, T6): lines -> nodes -> objects.

Plan, per file but without any per-file loop:

* classify every line with one anchored regex alternation (first pattern in priority order wins);
* running brace depth with a chunked prefix sum (skew-safe for very long files);
* a node on a line with opening braces is a *container* with marker m = depth - opens. It ends at the
  first later line whose depth is <= m, which is the first later *close event* at level m + 1 (a line
  whose depth falls from a to b emits close events for levels a .. b+1). That is an as-of lookup
  per (path, level), done with a window — no range join;
* a line in depth n stands in the latest block of level n opened before it: one as-of lookup per node
  and per block gives the tree of blocks, without a stack per line;
* a node's parent (the nearest container of the type it expects) and its full name come from that tree
  by pointer doubling: as many joins as the logarithm of the deepest nesting, none where blocks do not nest;
* first-wins dedupe per (path, fullname) in pre-order (the pre-order key is the array of ancestor
  start lines, compared lexicographically).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.patterns import DEFAULT_PATTERNS, PatternSet, classifier_branches
from ..functions.materialize import stored
from ..functions.prefix import asof_last, next_line, running_sum
from ..sources.files import brace_counts

ROOT_PARENTS = ("Program", "file")
#: Names that come again are sent to all tasks if they are fewer than these.
FEW = 1 << 17


def classify(lines: DataFrame, ps: PatternSet = DEFAULT_PATTERNS, text_col: str = "text") -> DataFrame:
    """X2 + X3: add pattern_key, name, obj_type, expected_parent (all null when no pattern matches).

    Lines are dispatched on their first word / first character to the branch holding only the
    alternatives that can match them (``classifier_branches``), in the original priority order.
    Per line one regex of one branch runs, as a ``regexp_replace`` whose replacement prints every
    alternative's whole-match group separated by U+0001, then U+0002 and the name groups: groups that
    did not take part print as empty, so the number of leading U+0001 is the index of the winning
    alternative. An unmatched line comes back unchanged; lines that already contain U+0001 are
    checked with ``rlike`` first, so a coincidental equality can never hide a match."""
    txt = F.col(text_col)
    branches = classifier_branches(ps)
    # columns of their own: inside the conditions each branch would run these regexes again
    lines = lines.withColumns({"__w": F.lower(F.regexp_extract(txt, r"^\s*([A-Za-z][A-Za-z0-9_]*)", 1)),
                               "__c": F.regexp_extract(txt, r"^\s*(\S)", 1), "__c0": F.substring(txt, 1, 1)})
    w, c, c0 = F.col("__w"), F.col("__c"), F.col("__c0")
    bid = None
    default = None
    for i, (kind, val, _, _, _) in enumerate(branches):
        cond = {"col0": c0 == val, "kw": w == val, "name": w != "", "char": c == val}.get(kind)
        if cond is None:
            default = i
            continue
        bid = F.when(cond, F.lit(i)) if bid is None else bid.when(cond, F.lit(i))
    bid = (bid.otherwise(F.lit(default)) if default is not None else bid) if bid is not None else F.lit(default)
    df = lines.withColumn("__b", bid).drop("__w", "__c", "__c0")
    b = F.col("__b")

    def by_branch(f: Callable[[str, str], Column]) -> Column:
        out = None
        for i, (_, _, regex, repl, _) in enumerate(branches):
            out = F.when(b == i, f(regex, repl)) if out is None else out.when(b == i, f(regex, repl))
        return out

    # the generator is an evaluation barrier: the branch regex runs once per line even though its
    # result is read several times below (projections are not collapsed through a Generate). The branches stand in
    # functions of an array: a method generated for all of them would be too long for the JVM to compile
    df = df.select("*", F.explode(F.transform(F.array(txt), lambda t: by_branch(lambda regex, repl: F.regexp_replace(t, regex, repl)))).alias("__r"))
    chk = F.exists(F.array(txt), lambda t: by_branch(lambda regex, repl: t.rlike(regex)))
    matched = F.when(F.instr(txt, "\u0001") > 0, F.coalesce(chk, F.lit(False))) \
        .otherwise(F.col("__r") != txt)
    df = df.withColumn("__r", F.when(matched, F.col("__r")))
    lead = F.length(F.regexp_extract(F.col("__r"), "^\u0001*", 0))
    types, parents = ps.key_to_type(), ps.key_to_expected_parent()

    def known(k: str) -> Column:
        return F.struct(F.lit(k).alias("key"), F.lit(types.get(k)).cast("string").alias("type"), F.lit(parents.get(k)).cast("string").alias("parent"))

    # type and parent come with the key from one place: maps of all keys would be searched for every line
    keys_by_branch = F.array(*[F.array(*[known(k) for k in keys]) for _, _, _, _, keys in branches])
    key = F.element_at(F.element_at(keys_by_branch, (b + 1).cast("int")), (lead + 1).cast("int"))
    return (df.withColumn("__key", F.when(F.col("__r").isNotNull(), key))
            .withColumn("pattern_key", F.col("__key.key"))
            .withColumn("name", F.when(F.col("__r").isNotNull(),
                                       F.substring_index(F.substring_index(F.col("__r"), "\u0002", -1), "\u0003", 1)))
            .withColumn("receiver", F.nullif(F.regexp_replace(F.substring_index(F.col("__r"), "\u0003", -1), r"^\*+", ""),
                                             F.lit("")))
            .withColumn("obj_type", F.col("__key.type"))
            .withColumn("expected_parent", F.col("__key.parent"))
            .drop("__r", "__b", "__key"))


def with_depth(lines: DataFrame, keep_text: bool = True, plain: DataFrame | None = None) -> DataFrame:
    """Opens, closes, depth after the line and depth before it (may be negative).
    With ``keep_text=False`` the text is dropped before any shuffle (rows stay narrow). ``plain``: the same lines before
    costly columns were added. The sum reads its input twice, and a generator among these columns would run twice."""
    net = F.col("opens") - F.col("closes")
    d = brace_counts(lines).withColumn("net", net)
    if not keep_text:
        d = d.drop("text")
    if plain is not None:
        plain = brace_counts(plain).select("path", "line", net.alias("net"))
    d = running_sum(d, ["path"], "line", "net", "depth", plain=plain)
    return d.withColumn("depth_prev", F.col("depth") - F.col("net"))


def _close_events(lines_d: DataFrame) -> DataFrame:
    """Lines whose depth falls from a to b emit close events for levels a, a-1, .., b+1."""
    return lines_d.filter(F.col("net") < 0).select(
        "path", F.explode(F.sequence(F.col("depth") + 1, F.col("depth_prev"))).alias("level"),
        "line")


def build_nodes(lines: DataFrame, ps: PatternSet = DEFAULT_PATTERNS):
    """Classify lines, compute depth, and the close line of every multi-line container.

    Returns (lines with depth, nodes, closed containers).
    """
    d = stored(with_depth(classify(lines, ps), keep_text=False, plain=lines), "classified")
    nodes = d.filter(F.col("pattern_key").isNotNull()).select(
        "path", "line", "pattern_key", "name", "receiver", "obj_type", "expected_parent", "opens", "closes",
        "depth", "depth_prev")
    nodes = nodes.withColumn("is_container", F.col("opens") > 0) \
        .withColumn("single_line", (F.col("opens") > 0) & (F.col("opens") == F.col("closes"))) \
        .withColumn("level", F.col("depth") - F.col("opens") + 1)
    closes = _close_events(d)

    proper = nodes.filter(F.col("is_container") & ~F.col("single_line"))
    # --- pass 1: close line of each proper container = next close event at its level --------
    closed = next_line(proper.select("path", "level", "line"), closes, ["path", "level"], "close_line") \
        .withColumnRenamed("line", "start")
    return d, nodes, closed


def doubled(tree: DataFrame, rounds: int, merge: dict[str, Callable[[Column, Column], Column]], name: str) -> DataFrame:
    """Pointer doubling: tree(path, line, level, to_line, to_level, …) in which a row points to another by (line, level).
    Each round every row takes in the columns of ``merge`` from the row that it points to (own value, other's value) and
    points where that one does, so ``rounds`` reach ``2 ** rounds`` rows up."""
    for _ in range(rounds):
        far = tree.select("path", F.col("line").alias("to_line"), F.col("level").alias("to_level"), F.col("to_line").alias("__line"),
                          F.col("to_level").alias("__level"), *[F.col(c).alias(f"__{c}") for c in merge])
        met = tree.filter("to_line is not null").join(far, ["path", "to_line", "to_level"], "left")
        kept = [c for c in tree.columns if c not in ("to_line", "to_level", *merge)]
        met = met.select(*kept, F.col("__line").alias("to_line"), F.col("__level").alias("to_level"),
                         *[F.coalesce(f(F.col(c), F.col(f"__{c}")), F.col(c)).alias(c) for c, f in merge.items()])
        tree = stored(tree.filter("to_line is null").unionByName(met), name)
    return tree


def repeated(df: DataFrame, keys: list[str]) -> bool:
    """Whether any two rows have the same ``keys``."""
    return bool(df.groupBy(*keys).agg(F.count("*").alias("__n")).filter("__n > 1").limit(1).count())


def enclosing_blocks(d: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(nodes and unnamed blocks with up_line, up_level, the block they stand in, and around_line, the start of the one
    whose range covers their line; the other nodes, which neither open nor leave a block, with up_level, the level of the
    block that they stand in; the number of levels that blocks are on, at least 1).

    A block is a brace level that a line opens: a container's or an unnamed one (``unnamed``). A line in depth n stands in
    the latest block of level n that was opened before it, so each node and each block asks one (path, level) for its
    latest line: as many rows as nodes and braces, however deep they nest. A node that closes braces stands in what
    they leave open."""
    proper = F.col("pattern_key").isNotNull() & (F.col("opens") > 0) & (F.col("opens") != F.col("closes"))
    own = F.col("depth") - F.col("opens") + 1
    opened = d.filter((F.col("net") > 0) & ~(proper & (F.col("opens") == 1))).select(
        "path", "line", "depth_prev", F.when(proper, own).alias("own"), F.explode(F.sequence(F.col("depth_prev") + 1, F.col("depth"))).alias("level"))
    opened = opened.filter(F.col("own").isNull() | (F.col("level") != F.col("own")))
    same_line = (F.col("level") - 1 > F.col("depth_prev")) | (F.col("level") - 1 == F.coalesce("own", F.col("level")))
    unnamed = opened.select("path", "line", "level", (F.col("level") - 1).alias("up_level"), F.when(same_line, F.col("line")).alias("own_line"), F.lit(True).alias("unnamed"))
    stands, covers = F.least("depth_prev", "depth"), F.col("depth_prev")
    starts = nodes.filter(F.col("is_container") & ~F.col("single_line")).select("path", "line", "level").unionByName(unnamed.select("path", "line", "level"))
    starts = starts.select("path", F.col("level").alias("up_level"), "line", F.lit(1).alias("kind"), F.col("line").cast("int").alias("at"))
    # nodes that neither open nor leave a block, nearly all, ask one level, and take all that they need along (``standing``)
    flat = F.coalesce(stands == covers, F.lit(False)) & ~(F.col("is_container") & ~F.col("single_line"))
    still = nodes.filter(flat).withColumn("up_level", stands)
    nodes = nodes.filter(~flat)
    rows = nodes.withColumn("up_level", stands).withColumn("unnamed", F.lit(False)).unionByName(unnamed, allowMissingColumns=True)
    asked = nodes.select("path", "line", F.explode(F.array_distinct(F.array(stands, covers))).alias("up_level")) \
        .unionByName(unnamed.filter("own_line is null").select("path", "line", "up_level")).distinct()
    events = asked.select("path", "up_level", "line", F.lit(0).alias("kind"), F.lit(None).cast("int").alias("at")).unionByName(starts)
    found = asof_last(events, ["path", "up_level"], "line", "kind", "at", "o", plain=events.select("path", "up_level")).filter("kind = 0 and o is not null")
    found = found.groupBy("path", "line").agg(F.map_from_entries(F.collect_list(F.struct("up_level", "o"))).alias("found"))  # one or two levels a line
    rows = rows.join(found, ["path", "line"], "left")
    rows = rows.withColumn("up_line", F.coalesce("own_line", F.try_element_at("found", F.col("up_level")))) \
        .withColumn("around_line", F.try_element_at("found", covers)).drop("found", "own_line")
    is_block = F.col("unnamed") | (F.col("is_container") & ~F.col("single_line"))
    span = Observation()
    rows = stored(rows.observe(span, F.max(F.when(is_block, F.col("level"))).alias("top"), F.min(F.when(is_block, F.col("level"))).alias("low")), "nodes")
    seen = span.get
    return rows, still, (seen["top"] - seen["low"] + 1 if seen.get("top") is not None else 1)


def standing(still: DataFrame, above: DataFrame) -> DataFrame:
    """``still`` (nodes with up_level) with up_line, around_line and ``near`` of the block of ``above(path, up_line, up_level,
    near)`` that they stand in: the latest one of their level. They take ``near`` along from the as-of and meet no join, unless
    blocks come several times: then they meet each."""
    alone = not repeated(above, ["path", "up_line", "up_level"])
    taken = [F.col("up_line").cast("int").alias("line"), *(["near"] if alone else [])]
    starts = above.select("path", "up_level", F.col("up_line").alias("line"), F.lit(1).alias("kind"), F.when(F.col("up_line").isNotNull(), F.struct(*taken)).alias("up"))
    rows = still.withColumn("kind", F.lit(0)).unionByName(starts, allowMissingColumns=True)
    counted = still.select("path", "up_level").unionByName(above.select("path", "up_level"))
    rows = asof_last(rows, ["path", "up_level"], "line", "kind", "up", "up", plain=counted).filter("kind = 0").drop("kind")
    rows = rows.withColumn("up_line", F.col("up.line")).withColumn("around_line", F.col("up.line"))
    if not alone:
        return rows.drop("up").join(above, ["path", "up_line", "up_level"], "left")
    known = F.col("path").isNotNull() & F.col("up_level").isNotNull()
    return rows.withColumn("near", F.when(known, F.col("up.near"))).drop("up")


def extract_objects(lines: DataFrame, files_n_lines: DataFrame, ps: PatternSet = DEFAULT_PATTERNS) -> dict[str, DataFrame]:
    """objects(path, type, name, fullname, parent_fullname, start_line, end_line, guid,
    order_key, pattern_key, bookmark). ``files_n_lines(path, n_lines)`` gives Program rows.

    Also returns the nodes, with is_registered and, for R3, the fullname of the innermost registered container around
    those that are not.
    """
    d, nodes, closed = build_nodes(lines, ps)
    is_block = F.col("is_container") & ~F.col("single_line")

    # --- the block that each node stands in, and the tree of blocks ---------------------------
    rows, still, span = enclosing_blocks(d, nodes)
    rounds = (int(span) - 1).bit_length()
    blocks = rows.filter(F.col("unnamed") | is_block).select("path", "line", "level", "name", "obj_type", "up_line", "up_level")
    here = F.struct("line", "level", "name")
    kind = "map<string, struct<line: int, level: bigint, name: string>>"
    # the nearest container of each type on the way up, and the nearest of any type under ''
    near = F.when(F.col("obj_type").isNotNull(), F.map_from_arrays(F.array(F.col("obj_type"), F.lit("")), F.array(here, here))).otherwise(F.create_map())
    tree = blocks.select("path", "line", "level", F.col("up_line").alias("to_line"), F.when(F.col("up_line").isNotNull(), F.col("up_level")).alias("to_level"),
                         near.cast(kind).alias("near"))
    tree = doubled(tree, rounds, {"near": lambda a, b: F.map_zip_with(a, b, lambda k, x, y: F.coalesce(x, y))}, "block-types")

    # --- parents: the nearest container of the expected type, else the nearest one, else the root ----
    above = tree.select("path", F.col("line").alias("up_line"), F.col("level").alias("up_level"), "near")
    rooted = F.col("expected_parent").isNull() | F.col("expected_parent").isin(*ROOT_PARENTS)
    parent = F.when(~rooted, F.coalesce(F.try_element_at("near", F.col("expected_parent")), F.try_element_at("near", F.lit(""))))
    none = F.struct(F.array().cast("array<string>").alias("names"), F.array().cast("array<int>").alias("starts"))
    # n: nodes that open or leave blocks, few; still: the others, which are read once
    n = rows.filter("not unnamed").drop("unnamed").join(above, ["path", "up_line", "up_level"], "left").withColumn("p", parent).drop("near")
    still = standing(still, above).withColumn("p", parent).drop("near")
    if rounds:
        n, still = (x.withColumn("p_line", F.col("p.line")).withColumn("p_level", F.col("p.level")).drop("p") for x in (n, still))
        n = stored(n, "node-parents")
        chain = n.filter(is_block).select("path", "line", "level", F.col("p_line").alias("to_line"), F.col("p_level").alias("to_level"),
                                          F.array("name").alias("names"), F.array(F.col("line").cast("int")).alias("starts"))
        chain = doubled(chain, rounds, {c: lambda a, b: F.concat(b, a) for c in ("names", "starts")}, "block-names")
        chain = chain.select("path", F.col("line").alias("p_line"), F.col("level").alias("p_level"), F.struct("names", "starts").alias("chain"))
        n, still = (x.join(chain, ["path", "p_line", "p_level"], "left").withColumn("chain", F.coalesce("chain", none)).drop("p_line", "p_level") for x in (n, still))
    else:  # no block is inside another: a parent has none itself
        own = F.when(F.col("p").isNotNull(), F.struct(F.array("p.name").alias("names"), F.array("p.line").alias("starts"))).otherwise(none)
        n, still = (x.withColumn("chain", own).drop("p") for x in (n, still))

    # end line of every node
    # only blocks have a close line and may end with the file: the other nodes, nearly all, need not meet those
    ends = closed.withColumnRenamed("start", "line")
    flat = n.filter(~is_block).unionByName(still).withColumn("close_line", F.lit(None).cast(ends.schema["close_line"].dataType))
    n = n.filter(is_block).join(ends, on=["path", "level", "line"], how="left")
    sizes = files_n_lines.select("path", "n_lines")
    if repeated(sizes, ["path"]):  # a node is there once for each row of its file
        n = n.unionByName(flat).join(sizes, on="path", how="left")
    else:
        n = n.join(sizes, on="path", how="left").unionByName(flat.withColumn("n_lines", F.lit(None).cast(sizes.schema["n_lines"].dataType)))
    n = n.withColumn("end_line", F.when(is_block, F.coalesce(F.col("close_line"), F.col("n_lines"))).otherwise(F.col("line"))).drop("close_line", "n_lines")
    n = n.withColumn("parent_fullname",
                     F.when(F.size("chain.names") > 0, F.concat(F.col("path"), F.lit("."), F.array_join(F.col("chain.names"), ".")))
                     .otherwise(F.col("path"))) \
        .withColumn("fullname", F.when(F.col("receiver").isNotNull(),  # X16: a receiver replaces the prefix
                                       F.concat_ws(".", F.col("path"), F.col("receiver"), F.col("name")))
                    .otherwise(F.concat(F.col("parent_fullname"), F.lit("."), F.col("name")))) \
        .withColumn("order_key", F.concat(F.col("chain.starts"), F.array(F.col("line"))))

    n = stored(n, "node-paths")
    # a name that comes once is its own first: only rows of names that (by their hash) come again are compared
    named = F.xxhash64("path", "fullname").alias("__named")
    again = stored(n.groupBy(named).agg(F.count("*").alias("__n")).filter("__n > 1").select("__named"), "names-again")
    first = n.select("path", "fullname", "order_key", named).join(again, "__named", "left_semi") \
        .groupBy("path", "fullname").agg(F.min("order_key").alias("__first"))  # pre-aggregated, no window
    first = stored(first, "names-first")
    n = n.join(F.broadcast(first) if first.count() < FEW else first, ["path", "fullname"], "left")
    is_first = F.col("path").isNotNull() & F.col("fullname").isNotNull() & F.coalesce(F.col("order_key") == F.col("__first"), F.col("__first").isNull())
    n = n.withColumn("is_registered", is_first).drop("__first")

    # --- R3: the innermost registered container around nodes that are not registered ------------------
    known = n.filter(is_block).select("path", "line", "level", F.when(F.col("is_registered"), F.col("fullname")).alias("object"))
    known = blocks.select("path", "line", "level", F.col("up_line").alias("to_line"), F.when(F.col("up_line").isNotNull(), F.col("up_level")).alias("to_level")) \
        .join(known, ["path", "line", "level"], "left")
    known = doubled(known, rounds, {"object": lambda a, b: F.coalesce(a, b)}, "block-objects")
    inner = known.select("path", F.col("line").alias("around_line"), F.col("level").alias("depth_prev"), F.col("object").alias("enclosing"))
    loose = n.filter("not is_registered").join(inner, ["path", "around_line", "depth_prev"], "left").select(*n.columns, "enclosing")
    n = n.filter("is_registered").withColumn("enclosing", F.lit(None).cast("string")).unionByName(loose) \
        .drop("up_line", "up_level", "around_line", "is_container", "single_line", "level")

    typ = F.concat(F.lit("GraphQL"), F.col("obj_type"))
    objs = n.filter("is_registered").select(
        "path", typ.alias("type"), "name", "fullname", "parent_fullname", F.col("line").alias("start_line"),
        "end_line", "order_key", "pattern_key")
    program = files_n_lines.select(
        "path", F.lit("GraphQLProgram").alias("type"), T.file_name(F.col("path")).alias("name"),
        F.col("path").alias("fullname"), F.lit(None).cast("string").alias("parent_fullname"),
        F.lit(1).alias("start_line"), F.greatest(F.col("n_lines"), F.lit(1)).alias("end_line"),
        F.array().cast("array<int>").alias("order_key"), F.lit(None).cast("string").alias("pattern_key"))
    objs = program.unionByName(objs)
    objs = objs.withColumn("guid", T.guid(F.col("type"), F.col("path"), F.col("fullname"),
                                          F.when(F.col("type") == "GraphQLProgram", F.lit(0))
                                          .otherwise(F.col("start_line"))))
    return {"objects": objs, "nodes": n, "lines": d}


def objects_of(lines: DataFrame, files_n_lines: DataFrame, ps: PatternSet = DEFAULT_PATTERNS) -> DataFrame:
    return extract_objects(lines, files_n_lines, ps)["objects"]


def subtree_sizes(objects: DataFrame) -> DataFrame:
    """(fullname, type, n_children, n_descendants). The walk is a join on the names of ancestors: a '.'-prefix of
    a fullname that is an object of the file."""
    kids = objects.filter(F.col("parent_fullname").isNotNull()).groupBy(F.col("parent_fullname").alias("fullname")) \
        .agg(F.count("*").alias("n_children"))
    pre = T.prefixes(F.col("fullname"), T.depths(objects, F.col("fullname"), "."))  # an ancestor has as many dots as an object
    above = objects.select("path", F.explode(pre).alias("anc"))
    desc = above.join(objects.select("path", F.col("fullname").alias("anc")), ["path", "anc"], "left_semi") \
        .groupBy(F.col("anc").alias("fullname")).agg(F.count("*").alias("n_descendants"))
    out = objects.select("fullname", "type").join(kids, "fullname", "left").join(desc, "fullname", "left")
    return out.select("fullname", "type", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
                      F.coalesce("n_descendants", F.lit(0)).cast("bigint").alias("n_descendants"))
