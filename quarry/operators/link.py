"""Cross-technology linking.

* schema root-field index (L1): fields whose parent is a type named exactly Query / Mutation /
  Subscription, last writer wins per (operation, field name) in file order then creation order;
* definition -> field (L2/L3): explode the selected fields and equi-join the index;
* field -> backend method (L4-L7): parent class by simple name (first class by obj_id), controller
  gate, then the first operation index holding the method name decides, and the matching mapping
  annotation is required — no fall-through.
Joins are plain equi-joins; AQE picks broadcast only when the runtime size is under the threshold
and splits skewed partitions, so nothing is broadcast on a guess.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# FIXED VALUES: root operation types, their client definition types and mapping annotations.
ROOT_OPS = ["Query", "Mutation", "Subscription"]
DEF_TYPE_OP = [("GraphQLClientQuery", "Query"), ("GraphQLClientMutation", "Mutation"),
               ("GraphQLClientSubscription", "Subscription")]
OP_ANNOTATION = [("Query", "@QueryMapping"), ("Mutation", "@MutationMapping"),
                 ("Subscription", "@SubscriptionMapping")]
CONTROLLER = "@Controller"


def _map(pairs):
    items = []
    for k, v in pairs:
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def schema_index(objects: DataFrame) -> DataFrame:
    """L1: (op, field_name, field_fullname)."""
    types = objects.filter((F.col("type") == "GraphQLType") & F.col("name").isin(ROOT_OPS)) \
        .select(F.col("fullname").alias("parent_fullname"), F.col("name").alias("op"))
    fields = objects.filter(F.col("type") == "GraphQLField") \
        .select("parent_fullname", F.col("name").alias("field_name"), "fullname", "path", "order_key")
    f = fields.join(types, "parent_fullname")
    return f.groupBy("op", "field_name").agg(
        F.max_by("fullname", F.struct("path", "order_key")).alias("field_fullname"))


def definition_fields(defs: DataFrame) -> DataFrame:
    """Selected fields of each definition (stored list form split back, T7)."""
    stored = F.when(F.size("op.fieldsSelected") > 0, T.join_list(F.col("op.fieldsSelected")))
    d = defs.select("key", "fullname", "name", "type", stored.alias("fields_selected"),
                    F.element_at(_map(DEF_TYPE_OP), F.col("type")).alias("op"))
    return d.filter(F.col("fields_selected").isNotNull()) \
        .select("key", "fullname", "name", "type", "op", F.posexplode(T.split_list(F.col("fields_selected"))).alias("k", "field_name"))


def definition_field_links(defs: DataFrame, index: DataFrame) -> DataFrame:
    """L2: useLink definition -> schema field, one per selected field found in the op's index."""
    df = definition_fields(defs)
    j = df.join(index, ["op", "field_name"], "inner")
    return j.select(F.lit("useLink").alias("link_type"), F.col("fullname").alias("caller"),
                    F.col("field_fullname").alias("callee"), "op", "field_name", F.col("key").alias("caller_key"))


def missing_fields(defs: DataFrame, index: DataFrame) -> DataFrame:
    """L3: selected fields not in the op's index, and definitions that select nothing."""
    df = definition_fields(defs)
    miss = df.join(index, ["op", "field_name"], "left_anti") \
        .select(F.col("fullname").alias("definition"), "op", "field_name", F.lit("field_not_in_schema").alias("reason"))
    empty = defs.filter(F.size("op.fieldsSelected") == 0).select(
        F.col("fullname").alias("definition"), F.element_at(_map(DEF_TYPE_OP), F.col("type")).alias("op"),
        F.lit(None).cast("string").alias("field_name"), F.lit("no_fields_selected").alias("reason"))
    return miss.unionByName(empty)


def controller_methods(kb: DataFrame) -> DataFrame:
    """L4 + L5: methods with their parent class (first JV_CLASS with the simple name, by obj_id)
    and the controller gate."""
    classes = kb.filter(F.col("type") == "JV_CLASS").groupBy("name").agg(
        F.min_by("annotations", "obj_id").alias("class_annotations"),
        F.min_by("fullname", "obj_id").alias("class_fullname"),
        F.min("obj_id").alias("class_id"))
    methods = kb.filter(F.col("type") == "JV_METHOD").withColumn("parent_name", T.parent_simple_name(F.col("fullname")))
    m = methods.join(classes.withColumnRenamed("name", "parent_name"), "parent_name", "left")
    gate = F.col("class_id").isNotNull() & T.has_annotation(F.col("class_annotations"), CONTROLLER)
    return m.withColumn("controller_ok", gate)


def match_methods(kb: DataFrame, index: DataFrame) -> DataFrame:
    """Per method the decision: linked / missing_annotation / not_matched / gated_out."""
    m = controller_methods(kb)
    idx = {op: index.filter(F.col("op") == op).select(F.col("field_name").alias("name"),
                                                      F.col("field_fullname").alias(f"f_{op}"))
           for op in ROOT_OPS}
    for op in ROOT_OPS:
        m = m.join(idx[op], "name", "left")
    op = F.when(F.col("f_Query").isNotNull(), F.lit("Query")) \
        .when(F.col("f_Mutation").isNotNull(), F.lit("Mutation")) \
        .when(F.col("f_Subscription").isNotNull(), F.lit("Subscription"))
    field = F.coalesce(F.col("f_Query"), F.col("f_Mutation"), F.col("f_Subscription"))
    has_map = F.coalesce(F.exists(F.col("annotations"), lambda a: F.contains(a, F.element_at(_map(OP_ANNOTATION), op))),
                         F.lit(False))
    status = F.when(~F.col("controller_ok"), F.lit("gated_out")) \
        .when(op.isNull(), F.lit("not_matched")) \
        .when(has_map, F.lit("linked")).otherwise(F.lit("missing_annotation"))
    return m.select("obj_id", F.col("name").alias("method_name"), F.col("fullname").alias("method_fullname"),
                    "annotations", "parent_name", "class_fullname", "controller_ok", op.alias("op"),
                    field.alias("field_fullname"), status.alias("status"))


def field_method_links(matches: DataFrame) -> DataFrame:
    """callLink schema field -> backend method."""
    return matches.filter(F.col("status") == "linked").select(
        F.lit("callLink").alias("link_type"), F.col("field_fullname").alias("caller"),
        F.col("method_fullname").alias("callee"), "op")


def link_summary(matches: DataFrame, index: DataFrame) -> DataFrame:
    """One row of counts; nothing counted when there are no schema fields (the tool stops)."""
    rows = matches.select(
        F.when((F.col("status") == "linked") & (F.col("op") == "Query"), 1).otherwise(0).alias("q"),
        F.when((F.col("status") == "linked") & (F.col("op") == "Mutation"), 1).otherwise(0).alias("m"),
        F.when((F.col("status") == "linked") & (F.col("op") == "Subscription"), 1).otherwise(0).alias("s"),
        F.when(F.col("status") == "not_matched", 1).otherwise(0).alias("nm"),
        F.lit(0).alias("idx")).unionByName(
        index.select(F.lit(0).alias("q"), F.lit(0).alias("m"), F.lit(0).alias("s"), F.lit(0).alias("nm"),
                     F.lit(1).alias("idx")))
    a = rows.agg(F.sum("q").alias("q"), F.sum("m").alias("m"), F.sum("s").alias("s"), F.sum("nm").alias("nm"),
                 F.sum("idx").alias("idx"))
    on = F.coalesce(F.col("idx"), F.lit(0)) > 0
    z = F.lit(0).cast("bigint")
    return a.select(F.when(on, F.col("q")).otherwise(z).cast("bigint").alias("query_links"),
                    F.when(on, F.col("m")).otherwise(z).cast("bigint").alias("mutation_links"),
                    F.when(on, F.col("s")).otherwise(z).cast("bigint").alias("subscription_links"),
                    F.when(on, F.col("q") + F.col("m") + F.col("s")).otherwise(z).cast("bigint").alias("total_links"),
                    F.when(on, F.col("nm")).otherwise(z).cast("bigint").alias("not_matched"))


def definition_counts(defs: DataFrame) -> DataFrame:
    """Number of client definitions per type."""
    return defs.groupBy("type").agg(F.count("*").cast("bigint").alias("n_definitions"))
