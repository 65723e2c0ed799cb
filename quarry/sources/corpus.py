"""Generated corpora derived from the driver's star tables (test and bench inputs, SURVEY §7.2).

The star tables hold no source code, so a schema corpus, a client corpus and a backend catalogue are
*derived* from them by fixed rules. The text is produced directly as ``lines(path, line, text)`` —
each generated line is one row, line numbers come from skew-safe prefix sums — so no file is ever
assembled into one giant string and the work grows with the tables. The same rules are restated in
``quarry/plans/oracle.py`` as DuckDB SQL that predicts the analysis result without parsing.

Schema corpus — one file per supplier ``svc/s<7 digits>.graphqls``:

    1                 # supplier <s>
    2                 type Query {            fields p<pk> for parts with pk % 3 = 0
                      }
                      type Mutation {         pk % 3 = 1
                      }
                      type Subscription {     pk % 3 = 2
                      }
                      input In<z> { ... }     z in 1..50 by the declaration rule, 3 lines, or one
                                              single-line block when z % 8 = 0
                      enum Kind<s> { LOW HIGH }   4 lines
                      extend type Query { x<s>: Int }   3 lines, odd suppliers only

Field line: ``  p<pk>(a: In<z>, b: In<z>): Item`` (pk % 4 = 0), ``(a: In<z>, b: ID)`` (pk % 4 = 1),
``(a: In<z>)`` otherwise; z = p_size.
Declaration of In<z> in file s: z % 4 = 0 -> s % 3 = 0; z % 4 = 1 -> s = z % 10; z % 4 = 2 -> never;
z % 4 = 3 -> always.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.materialize import stored
from ..functions.prefix import dense_position, running_sums

SCHEMA_PATH_FMT = "svc/s%07d.graphqls"
CLIENT_PATH_FMT = "web/c%07d.jsx"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def declared_inputs(suppliers: DataFrame) -> DataFrame:
    """(s, z) pairs: input In<z> is declared in the file of supplier s."""
    z = F.col("z")
    s = F.col("s")
    rule = (((z % 4) == 0) & ((s % 3) == 0)) | (((z % 4) == 1) & (s == (z % 10))) | ((z % 4) == 3)
    return suppliers.select(F.col("s_suppkey").alias("s"), F.explode(F.sequence(F.lit(1), F.lit(50))).alias("z")) \
        .filter(rule)


def supplier_parts(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Distinct (supplier, part) with the part size and its root type r = pk % 3."""
    sp = lineitem.select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("pk")).distinct()
    return sp.join(part.select(F.col("p_partkey").alias("pk"), F.col("p_size").alias("z")), "pk", "left") \
        .withColumn("r", (F.col("pk") % 3).cast("int"))


def schema_corpus(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Returns (lines(path, line, text), files(path, n_lines))."""
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey")
    sp = stored(supplier_parts(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part")), "supplier-parts")
    sp = stored(dense_position(sp, ["s", "r"], "pk", "rk"), "schema-parts")  # counted, and a line each
    counts = sp.groupBy("s").agg(
        F.sum(F.when(F.col("r") == 0, 1).otherwise(0)).alias("nq"),
        F.sum(F.when(F.col("r") == 1, 1).otherwise(0)).alias("nm"),
        F.sum(F.when(F.col("r") == 2, 1).otherwise(0)).alias("ns"))
    sup = supplier.select(F.col("s_suppkey").alias("s")).join(counts, "s", "left").fillna(0, ["nq", "nm", "ns"])
    sup = sup.withColumn("path", F.format_string(SCHEMA_PATH_FMT, F.col("s")))

    # input section
    di = declared_inputs(supplier).withColumn("size", F.when(F.col("z") % 8 == 0, 1).otherwise(3))
    w = Window.partitionBy("s").orderBy("z")  # at most 50 rows per supplier
    di = di.withColumn("off", F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    itot = di.groupBy("s").agg(F.sum("size").alias("itot"))
    sup = sup.join(itot, "s", "left").fillna(0, ["itot"]) \
        .withColumn("B", F.col("nq") + F.col("nm") + F.col("ns") + 7) \
        .withColumn("E", F.col("B") + F.col("itot") + 1) \
        .withColumn("n_lines", F.col("E") + 3 + F.when(F.col("s") % 2 == 1, 3).otherwise(0))
    sup = stored(sup, "schema-suppliers")  # every kind of line reads it

    def fixed(*rows):
        cols = [F.struct(ln.cast("int").alias("line"), tx.alias("text")) for ln, tx in rows]
        return sup.select("path", F.explode(F.array(*cols)).alias("x")).select(
            "path", F.col("x.line").cast("int").alias("line"), F.col("x.text").alias("text"))

    nq, nm, ns, E = F.col("nq"), F.col("nm"), F.col("ns"), F.col("E")
    head = fixed(
        (F.lit(1), F.format_string("# supplier %d", F.col("s"))),
        (F.lit(2), F.lit("type Query {")),
        (nq + 3, F.lit("}")),
        (nq + 4, F.lit("type Mutation {")),
        (nq + nm + 5, F.lit("}")),
        (nq + nm + 6, F.lit("type Subscription {")),
        (nq + nm + ns + 7, F.lit("}")),
        (E, F.format_string("enum Kind%d {", F.col("s"))),
        (E + 1, F.lit("  LOW")),
        (E + 2, F.lit("  HIGH")),
        (E + 3, F.lit("}")),
    )
    ext = sup.filter(F.col("s") % 2 == 1)
    ext_rows = ext.select("path", F.explode(F.array(
        F.struct((E + 4).alias("line"), F.lit("extend type Query {").alias("text")),
        F.struct((E + 5).alias("line"), F.format_string("  x%d: Int", F.col("s")).alias("text")),
        F.struct((E + 6).alias("line"), F.lit("}").alias("text")))).alias("x")) \
        .select("path", F.col("x.line").cast("int").alias("line"), F.col("x.text").alias("text"))

    pk = F.col("pk")
    args = F.when(pk % 4 == 0, F.format_string("a: In%d, b: In%d", F.col("z"), F.col("z"))) \
        .when(pk % 4 == 1, F.format_string("a: In%d, b: ID", F.col("z"))) \
        .otherwise(F.format_string("a: In%d", F.col("z")))
    fl = sp.join(sup.select("s", "path", "nq", "nm"), "s")
    fline = F.when(F.col("r") == 0, F.col("rk") + 2) \
        .when(F.col("r") == 1, F.col("nq") + 4 + F.col("rk")) \
        .otherwise(F.col("nq") + F.col("nm") + 6 + F.col("rk"))
    fields = fl.select("path", fline.cast("int").alias("line"),
                       F.format_string("  p%d(%s): Item", pk, args).alias("text"))

    inp = di.join(sup.select("s", "path", "B"), "s")
    start = F.col("B") + 1 + F.col("off")
    single = inp.filter(F.col("size") == 1).select(
        "path", start.cast("int").alias("line"), F.format_string("input In%d { v: Int }", F.col("z")).alias("text"))
    multi = inp.filter(F.col("size") == 3).select("path", F.explode(F.array(
        F.struct(start.alias("line"), F.format_string("input In%d {", F.col("z")).alias("text")),
        F.struct((start + 1).alias("line"), F.lit("  v: Int").alias("text")),
        F.struct((start + 2).alias("line"), F.lit("}").alias("text")))).alias("x")) \
        .select("path", F.col("x.line").cast("int").alias("line"), F.col("x.text").alias("text"))

    lines = head.unionByName(ext_rows).unionByName(fields).unionByName(single).unionByName(multi)
    files = sup.select("path", F.col("n_lines").cast("int").alias("n_lines"))
    return lines, files


def lines_to_files(lines: DataFrame) -> DataFrame:
    """Assemble whole-file text from lines: one source file is one row."""
    return lines.groupBy("path").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]),
                     "\n").alias("content"))


# ----------------------------------------------------------------------------------------------
# Client corpus — one file per customer ``web/c<7 digits>-0000.jsx``, whatever the number of its orders
# ----------------------------------------------------------------------------------------------
#   1-2          import (c % 10 = 7: a React-only import, so the file is not a GraphQL client file):
#                c % 4 = 1 over two lines, c % 4 = 2 default and named, else named on one line
#   per order t (orderkey order), 5 lines from 3 + 5t:
#       const <NAME><type> = gql<open>`  NAME = SHARED_<ok % 4> when ok % 10 = 3, else Q_<ok>
#         <op> Order<ok><vars> {         op by ok % 3: query, mutation, subscription
#           <fields>                     p<pk>(q: <qty>) per lineitem by line number; the first one
#         }                              is aliased as a<pk>: p<pk>(...) when ok % 5 = 0
#       `<close>;                        type: ": DocumentNode" when ok % 6 = 1; "(" and ")" when ok % 6 = 2
#   component header and the line after it, by c % 3:
#       0  export default function Customer<c>({ id }) {
#            const pick = ({ id }) => { return id; };
#       1  export const Customer<c>: React.FC<Props> = () => {
#            const pick = ({ id }) => { return id; };
#       2  const Customer<c> = ({ id }) =>
#          {
#     const r<ok> = <hook><args>(<arg><opts>);    one per order unless ok % 11 = 10; args:
#     (each of these second lines ends in a decoy by c % 5: a brace in a string, a brace and a hook in a line
#     comment, a brace and a template in a block comment, a brace in a regular expression, none)
#     return null;                                "<Data, { id: string }>" when ok % 9 = 4; when
#   }                                             ok % 17 = 5 a second call on the line, useQuery(NAME)
#   const t<ok> = <hook>(<arg><opts>);      orders with ok % 11 = 10: outside any function
#   and a last line when c % 4 = 2 or 3:
#       2  class K<c> { load = async () => { useMutation(SHARED_2) } }
#       3  function A<c>(){ return useQuery(SHARED_0) } function B<c>(){ return useLazyQuery(SHARED_1) }
# vars: ok % 4 = 0 -> ($id: ID!, $n: Int); ok % 4 = 1 -> ($id: ID!); else none.
# hook: ok % 8 = 5 -> useLazyQuery, else by ok % 3: useQuery, useMutation, useSubscription.
# arg: ok % 13 = 6 -> inline gql`query { ping }`; ok % 7 = 2 -> Q_<ok + 1>; ok % 7 = 5 -> q_<ok>;
#      else NAME.
# opts: ok % 4 = 0 -> , { fetchPolicy: "cache-first" };
#       ok % 4 = 1 -> , { variables: { a: { b: { c: { d: { e: [1] } } } } }, fetchPolicy: 'network-only',
#       onError: (e) => { log({ errorPolicy: "none" }); }, errorPolicy: "all" }; else none.

APOLLO_NAMES = "gql, useQuery, useLazyQuery, useMutation, useSubscription"
DEEP_OPTIONS = (", { variables: { a: { b: { c: { d: { e: [1] } } } } }, fetchPolicy: 'network-only', "
                "onError: (e) => { log({ errorPolicy: \"none\" }); }, errorPolicy: \"all\" }")
DECOYS = [' const brace = "}";', " // } useQuery(NOPE)", " /* } gql`query Nope { nope }` */", " const close = /}/;", ""]
REACT_IMPORT = 'import React from "react";'


def client_order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its file, local position and generated snippets."""
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ok"), F.col("o_custkey").alias("c"))
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("pk"),
        F.col("l_quantity").cast("long").alias("qty"))
    ok = F.col("ok")
    flds = li.join(orders.select("ok"), "ok").groupBy("ok").agg(
        F.array_sort(F.collect_list(F.struct("ln", "pk", "qty"))).alias("items"))
    first_alias = (ok % 5) == 0
    field_txt = F.array_join(F.transform(
        F.col("items"),
        lambda x, i: F.when((i == 0) & first_alias, F.format_string("a%d: p%d(q: %d)", x["pk"], x["pk"], x["qty"]))
        .otherwise(F.format_string("p%d(q: %d)", x["pk"], x["qty"]))), " ")
    o = orders.join(flds, "ok", "left").withColumn("fields", F.coalesce(field_txt, F.lit("")))
    # 1-based rank of the order within its customer, and the number of orders up to it whose hooks are inside
    o = running_sums(o, ["c"], "ok", {"j": F.lit(1), "n_inside": (ok % 11 != 10).cast("int")}, plain=orders)
    o = o.withColumn("t", F.col("j") - 1)
    name = F.when(ok % 10 == 3, F.format_string("SHARED_%d", ok % 4)).otherwise(F.format_string("Q_%d", ok))
    op = F.element_at(F.array(F.lit("query"), F.lit("mutation"), F.lit("subscription")), (ok % 3 + 1).cast("int"))
    vars_ = F.when(ok % 4 == 0, F.lit("($id: ID!, $n: Int)")).when(ok % 4 == 1, F.lit("($id: ID!)")).otherwise(F.lit(""))
    hook = F.when(ok % 8 == 5, F.lit("useLazyQuery")).otherwise(
        F.element_at(F.array(F.lit("useQuery"), F.lit("useMutation"), F.lit("useSubscription")), (ok % 3 + 1).cast("int")))
    arg = F.when(ok % 13 == 6, F.lit("gql`query { ping }`")) \
        .when(ok % 7 == 2, F.format_string("Q_%d", ok + 1)) \
        .when(ok % 7 == 5, F.format_string("q_%d", ok)).otherwise(name)
    opts = F.when(ok % 4 == 0, F.lit(', { fetchPolicy: "cache-first" }')) \
        .when(ok % 4 == 1, F.lit(DEEP_OPTIONS)).otherwise(F.lit(""))
    return o.withColumn("name", name).withColumn("op", op).withColumn("vars", vars_).withColumn("hook", hook) \
        .withColumn("arg", arg).withColumn("opts", opts).withColumn("inside", ok % 11 != 10)


def client_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """files(path, content) of the client corpus."""
    customers = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c"))
    o = client_order_rows(spark, sf_dir)
    h = F.when(F.col("inside"), F.col("n_inside")).otherwise(F.col("j") - F.col("n_inside"))  # ranks of inside / outside hooks in a file
    o = stored(o.withColumn("h", h - 1).drop("n_inside"), "client-orders")
    per_file = o.groupBy("c").agg(F.count("*").alias("n"), F.sum(F.col("inside").cast("int")).alias("n_in"))
    files = customers.join(per_file, "c", "left").fillna(0, ["n", "n_in"]) \
        .withColumn("path", F.format_string("web/c%07d-0000.jsx", F.col("c")))
    snip = o.join(files.select("c", "path", "n", "n_in"), "c")
    ok, c = F.col("ok"), F.col("c")
    base = 3 + 5 * F.col("t")
    fs = 3 + 5 * F.col("n")
    typed = F.when(ok % 6 == 1, F.lit(": DocumentNode")).otherwise(F.lit(""))
    opened = F.when(ok % 6 == 2, F.lit("(")).otherwise(F.lit(""))
    closed = F.when(ok % 6 == 2, F.lit(")")).otherwise(F.lit(""))

    def line(at, text):
        return F.struct(at.cast("long").alias("line"), text.alias("text"))

    args = F.when(ok % 9 == 4, F.lit("<Data, { id: string }>")).otherwise(F.lit(""))
    again = F.when(ok % 17 == 5, F.format_string(", s%d = useQuery(%s)", ok, F.col("name"))).otherwise(F.lit(""))
    call = F.format_string("%s%s(%s%s)", F.col("hook"), args, F.col("arg"), F.col("opts"))
    by_order = snip.select("path", F.explode(F.array(
        line(base, F.format_string("const %s%s = gql%s`", F.col("name"), typed, opened)),
        line(base + 1, F.format_string("  %s Order%d%s {", F.col("op"), ok, F.col("vars"))),
        line(base + 2, F.concat(F.lit("    "), F.col("fields"))),
        line(base + 3, F.lit("  }")),
        line(base + 4, F.concat(F.lit("`"), closed, F.lit(";"))),
        line(F.when(F.col("inside"), fs + 2 + F.col("h")).otherwise(fs + 4 + F.col("n_in") + F.col("h")),
             F.when(F.col("inside"), F.format_string("  const r%d = %s%s;", ok, call, again))
             .otherwise(F.format_string("const t%d = %s;", ok, call))))).alias("x")).select("path", "x.*")
    named = F.lit("{ " + APOLLO_NAMES + " }")
    first = F.when(c % 10 == 7, F.lit(REACT_IMPORT)).when(c % 4 == 1, F.lit("import React, {")) \
        .otherwise(F.concat(F.when(c % 4 == 2, F.lit("import React, ")).otherwise(F.lit("import ")), named, F.lit(' from "@apollo/client";')))
    second = F.when((c % 10 != 7) & (c % 4 == 1), F.lit("  " + APOLLO_NAMES + ' } from "@apollo/client";')).otherwise(F.lit(""))
    header = F.when(c % 3 == 0, F.format_string("export default function Customer%d({ id }) {", c)) \
        .when(c % 3 == 1, F.format_string("export const Customer%d: React.FC<Props> = () => {", c)) \
        .otherwise(F.format_string("const Customer%d = ({ id }) =>", c))
    after = F.when(c % 3 == 2, F.lit("{")).otherwise(F.lit("  const pick = ({ id }) => { return id; };"))
    after = F.concat(after, F.element_at(F.array(*[F.lit(x) for x in DECOYS]), (c % 5 + 1).cast("int")))
    last = F.when(c % 4 == 2, F.format_string("class K%d { load = async () => { useMutation(SHARED_2) } }", c)) \
        .when(c % 4 == 3, F.format_string("function A%d(){ return useQuery(SHARED_0) } function B%d(){ return useLazyQuery(SHARED_1) }", c, c))
    bundle = files.filter(c % 4 >= 2).select("path", (fs + 4 + F.col("n")).cast("long").alias("line"), last.alias("text"))
    frame = files.select("path", F.explode(F.array(
        line(F.lit(1), first), line(F.lit(2), second), line(fs, header), line(fs + 1, after),
        line(fs + 2 + F.col("n_in"), F.lit("  return null;")), line(fs + 3 + F.col("n_in"), F.lit("}")))).alias("x")).select("path", "x.*")
    lines = frame.unionByName(by_order).unionByName(bundle)
    return lines_to_files(lines.withColumn("line", F.col("line").cast("int")))


# ----------------------------------------------------------------------------------------------
# Backend catalogue — kb_objects(obj_id, type, name, fullname, annotations)
# ----------------------------------------------------------------------------------------------
# JV_CLASS per supplier s: obj_id = s, name Ctl<s div 2> (two suppliers share a simple name),
#   fullname com.acme.s<s>.Ctl<s div 2>, annotations by s % 5: 0 [@Service], 1 [@ControllerAdvice],
#   2 [@RestController], 3 and 4 [@Controller].
# JV_METHOD per distinct (supplier, part): obj_id = (s + 1) * 10^7 + pk, name p<pk>, fullname
#   <class fullname>.p<pk>, annotations: (s + pk) % 11 = 0 -> none; (s + pk) % 7 = 0 -> [@QueryMapping];
#   else the mapping of the part's root type (pk % 3: Query, Mutation, Subscription).
# One extra JV_METHOD helper<s> per supplier: obj_id = (s + 1) * 10^7 + 9999999, annotations [@Bean].

def backend_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"))
    sp = read_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("pk")).distinct()
    s = F.col("s")
    cls_name = F.format_string("Ctl%d", (s / 2).cast("long"))
    cls_full = F.format_string("com.acme.s%d.%s", s, cls_name)
    ann = F.element_at(F.array(F.array(F.lit("@Service")), F.array(F.lit("@ControllerAdvice")),
                               F.array(F.lit("@RestController")), F.array(F.lit("@Controller")),
                               F.array(F.lit("@Controller"))), (s % 5 + 1).cast("int"))
    classes = supplier.select(s.alias("obj_id"), F.lit("JV_CLASS").alias("type"), cls_name.alias("name"),
                              cls_full.alias("fullname"), ann.alias("annotations"))
    pk = F.col("pk")
    mapping = F.element_at(F.array(F.lit("@QueryMapping"), F.lit("@MutationMapping"), F.lit("@SubscriptionMapping")),
                           (pk % 3 + 1).cast("int"))
    mann = F.when((s + pk) % 11 == 0, F.array().cast("array<string>")) \
        .when((s + pk) % 7 == 0, F.array(F.lit("@QueryMapping"))).otherwise(F.array(mapping))
    methods = sp.select(((s + 1) * 10000000 + pk).alias("obj_id"), F.lit("JV_METHOD").alias("type"),
                        F.format_string("p%d", pk).alias("name"),
                        F.format_string("%s.p%d", cls_full, pk).alias("fullname"), mann.alias("annotations"))
    helpers = supplier.select(((s + 1) * 10000000 + 9999999).alias("obj_id"), F.lit("JV_METHOD").alias("type"),
                              F.format_string("helper%d", s).alias("name"),
                              F.format_string("%s.helper%d", cls_full, s).alias("fullname"),
                              F.array(F.lit("@Bean")).alias("annotations"))
    return classes.unionByName(methods).unionByName(helpers).withColumn("obj_id", F.col("obj_id").cast("long"))


# ----------------------------------------------------------------------------------------------
# Import line corpus — one file per brand ``lib/b<2 digits>.src``, one line per part (pk order)
# ----------------------------------------------------------------------------------------------
# module m = brand/<n> for Brand#<n>; words w1 w2 of p_name; t = lower(p_type); by pk % 5:
#   0  import { w1, w2 as w2x } from "m";
#   1  from t.w1 import w2, w1
#   2  import w1 from 'm';
#   3  const w1 = require("m");
#   4  import "m";

def import_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pk"), F.regexp_extract("p_brand", r"#(\d+)", 1).alias("n"),
        F.split("p_name", " ").alias("w"), F.lower("p_type").alias("t"))
    part = part.withColumn("path", F.format_string("lib/b%02d.src", F.col("n").cast("int")))
    part = dense_position(part, ["path"], "pk", "line")
    pk, w1, w2 = F.col("pk"), F.element_at("w", 1), F.element_at("w", 2)
    m = F.concat(F.lit("brand/"), F.col("n"))
    text = F.when(pk % 5 == 0, F.format_string('import { %s, %s as %sx } from "%s";', w1, w2, w2, m)) \
        .when(pk % 5 == 1, F.format_string("from %s.%s import %s, %s", F.col("t"), w1, w2, w1)) \
        .when(pk % 5 == 2, F.format_string("import %s from '%s';", w1, m)) \
        .when(pk % 5 == 3, F.format_string('const %s = require("%s");', w1, m)) \
        .otherwise(F.format_string('import "%s";', m))
    return part.select("path", F.col("line").cast("int").alias("line"), text.alias("text"))


# ----------------------------------------------------------------------------------------------
# Keyword-block corpus — one file per supplier ``rb/s<7 digits>.rb``
#   1            class S<s>
#   2k, 2k + 1   "  def p<pk>" / "  end" for the k-th part of the supplier (pk order)
#   2n + 2       end
# ----------------------------------------------------------------------------------------------

def keyword_block_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"))
    sp = read_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("pk")).distinct()
    sp = dense_position(sp, ["s"], "pk", "k")
    n = sp.groupBy("s").agg(F.count("*").alias("n"))
    sup = supplier.join(n, "s", "left").fillna(0, ["n"]).withColumn("path", F.format_string("rb/s%07d.rb", F.col("s")))
    frame = sup.select("path", F.explode(F.array(
        F.struct(F.lit(1).cast("long").alias("line"), F.format_string("class S%d", F.col("s")).alias("text")),
        F.struct((2 * F.col("n") + 2).cast("long").alias("line"), F.lit("end").alias("text")))).alias("x")).select("path", "x.*")
    body = sp.withColumn("path", F.format_string("rb/s%07d.rb", F.col("s"))).select("path", F.explode(F.array(
        F.struct((2 * F.col("k")).cast("long").alias("line"), F.format_string("  def p%d", F.col("pk")).alias("text")),
        F.struct((2 * F.col("k") + 1).cast("long").alias("line"), F.lit("  end").alias("text")))).alias("x")).select("path", "x.*")
    return frame.unionByName(body).withColumn("line", F.col("line").cast("int"))


# ----------------------------------------------------------------------------------------------
# Catalogue corpus — one line per part, the form of its number modulo the number of forms
# (text, pattern key or none, name or none; %d is the part's number). Expected keys are by hand, from the
# catalogue's priority order: a bare word is an enum value, and so is what follows a quoted text.
# ----------------------------------------------------------------------------------------------
FORMS = [
    ("schema {", None, None), ("type T%d {", "type_def", "T%d"), ('type T%d @key(fields: "id") {', "type_def", "T%d"), ("type T%d", "type_def", "T%d"),
    ("type T%d implements Node {", "type_def_implements", "T%d"), ("type T%d implements Node & Entity {", "type_def_implements_multiple", "T%d"),
    ("extend type T%d {", "type_extend", "T%d"), ("extend type T%d implements Node {", "type_extend_implements", "T%d"),
    ('"""text""" type T%d {', "type_def_description", "T%d"), ("interface I%d {", "interface_def", "I%d"),
    ("interface I%d implements Node {", "interface_def_implements", "I%d"), ("extend interface I%d {", "interface_extend", "I%d"),
    ('"text" interface I%d {', "interface_def_description", "I%d"), ("enum E%d {", "enum_def", "E%d"), ("extend enum E%d", "enum_extend", "E%d"),
    ('"""text""" enum E%d {', "enum_def_description", "E%d"), ("  V%d", "enum_value", "V%d"), ('  V%d @deprecated(reason: "old")', "enum_value_deprecated", "V%d"),
    ("  V%d @internal", "enum_value_directive", "V%d"), ('  "text" V%d', "enum_value_description", "V%d"), ("input N%d {", "input_def", "N%d"),
    ("extend input N%d {", "input_extend", "N%d"), ('"text" input N%d {', "enum_value_description", "input"), ("union U%d = A | B", "union_def", "U%d"),
    ("extend union U%d = C", "union_extend", "U%d"), ("scalar S%d", "scalar_def", "S%d"), ('scalar S%d @specifiedBy(url: "x")', "scalar_directive", "S%d"),
    ("directive @d%d on FIELD", "enum_value_directive", "directive"), ("  f%d: Int", "field_def", "f%d"), ("  f%d(a: Int): Int", "field_def_with_args", "f%d"),
    ("  f%d: Int!", "field_def", "f%d"), ("  f%d: [T]!", "field_def", "f%d"), ("  f%d(a: Int): [T!]!", "field_def_with_args", "f%d"),
    ('  f%d: "x" @deprecated', "field_def_deprecated", "f%d"), ('  f%d: "x" @live', "field_def_directive", "f%d"), ('  "text" f%d: Int', "enum_value_description", "f%d"),
    ("query {", "query_operation", "query"), ("query Q%d {", "query_operation_named", "Q%d"), ("query Q%d($a: ID) {", "query_operation_with_vars", "Q%d"),
    ("{ q%d }", None, None), ("mutation {", "mutation_operation", "mutation"), ("mutation M%d {", "mutation_operation_named", "M%d"),
    ("mutation M%d($a: ID) {", "mutation_operation_with_vars", "M%d"), ("subscription {", "subscription_operation", "subscription"),
    ("subscription B%d {", "subscription_operation_named", "B%d"), ("subscription B%d($a: ID) {", "subscription_operation_with_vars", "B%d"),
    ("fragment G%d on T {", "fragment_def", "G%d"), ("fragment G%d on T @live {", "fragment_def_directive", "G%d"), ("... on T%d {", "inline_fragment", "T%d"),
    ("$v%d: ID", "variable_def", "v%d"), ("$v%d: ID!", "variable_def", "v%d"), ("  $v%d: ID", None, None), ("# type T%d {", None, None), ("", None, None), ("}", None, None),
]


def catalogue_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pk"))
    form = F.element_at(F.array(*[F.lit(t) for t, _, _ in FORMS]), (F.col("pk") % len(FORMS) + 1).cast("int"))
    return part.select("pk", F.lit("catalogue").alias("path"), F.col("pk").cast("int").alias("line"), F.replace(form, F.lit("%d"), F.col("pk").cast("string")).alias("text"))


# ----------------------------------------------------------------------------------------------
# Nested corpus — one file per supplier ``deep/s<7 digits>.graphqls``, n = s % 6 + 1 types inside each other
#   k (1..n)           type N<k> {
#   n + 1              f<s>: Int                in the innermost
#   n + 2 + 2 (n - k)  }                        closes N<k>
#   the line after it  g<k - 1>: Int            in N<k - 1>, where k > 1
# ----------------------------------------------------------------------------------------------

def nested_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"), (F.col("s_suppkey") % 6 + 1).alias("n"))
    s = s.select("s", "n", F.format_string("deep/s%07d.graphqls", F.col("s")).alias("path"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("k"))
    n, k = F.col("n"), F.col("k")
    close = n + 2 + 2 * (n - k)
    rows = s.select("path", F.explode(F.array(
        F.struct(k.alias("line"), F.format_string("type N%d {", k).alias("text")),
        F.struct(close.alias("line"), F.lit("}").alias("text")),
        F.struct(F.when(k > 1, close + 1).alias("line"), F.format_string("g%d: Int", k - 1).alias("text")),
        F.struct(F.when(k == 1, n + 1).alias("line"), F.format_string("f%d: Int", F.col("s")).alias("text")))).alias("x"))
    return rows.select("path", F.col("x.line").cast("int").alias("line"), F.col("x.text").alias("text")).filter("line is not null")
