"""Aggregations and reports (A1-A8). All are single-pass aggregates with map-side partial
aggregation; no per-file loop and nothing collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.catalog import declared_properties_by_type, meta_type_category


def report_totals(files: DataFrame, objects: DataFrame, links: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """A1: files analysed, objects (Program included), links created, files with errors. Built as
    one union + one aggregate (no join of scalars)."""
    parts = [files.select(F.lit(1).alias("f"), F.lit(0).alias("o"), F.lit(0).alias("l"), F.lit(0).alias("e")),
             objects.select(F.lit(0).alias("f"), F.lit(1).alias("o"), F.lit(0).alias("l"), F.lit(0).alias("e")),
             links.select(F.lit(0).alias("f"), F.lit(0).alias("o"), F.lit(1).alias("l"), F.lit(0).alias("e"))]
    if failed is not None:
        parts.append(failed.select(F.lit(0).alias("f"), F.lit(0).alias("o"), F.lit(0).alias("l"), F.lit(1).alias("e")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n)
                   for c, n in [("f", "n_files"), ("o", "n_objects"), ("l", "n_links"), ("e", "n_errors")]])


def report_by_file(objects: DataFrame) -> DataFrame:
    """A2: per file, the number of objects other than the Program; files without objects are
    omitted. The per-object listing is ``object_listing`` (a long table, never one list per file)."""
    o = objects.filter(F.col("type") != "GraphQLProgram")
    return o.groupBy("path").agg(F.count("*").cast("bigint").alias("n_objects"))


def object_listing(objects: DataFrame) -> DataFrame:
    """A2 listing: (path, order_key, short name, kind) for every non-Program object."""
    return objects.filter(F.col("type") != "GraphQLProgram").select(
        "path", "order_key", T.short_name(F.col("fullname")).alias("short_name"),
        F.regexp_replace("type", "^GraphQL", "").alias("kind"))


def report_by_type(objects: DataFrame) -> DataFrame:
    """A3: objects per type."""
    return objects.groupBy("type").agg(F.count("*").cast("bigint").alias("n_objects"))


def index_sizes(index: DataFrame) -> DataFrame:
    """A5: root fields per operation."""
    return index.groupBy("op").agg(F.count("*").cast("bigint").alias("n_fields"))


def client_totals(client_files: DataFrame, defs: DataFrame) -> DataFrame:
    """Client files kept, definitions created, distinct definition names (cache size)."""
    u = client_files.select(F.lit(1).alias("f"), F.lit(0).alias("d"), F.lit(None).cast("string").alias("name")) \
        .unionByName(defs.select(F.lit(0).alias("f"), F.lit(1).alias("d"), "name"))
    return u.agg(F.sum("f").cast("bigint").alias("n_client_files"), F.sum("d").cast("bigint").alias("n_definitions"),
                 F.count_distinct("name").cast("bigint").alias("n_definition_names"))


def objects_by_category(typed: DataFrame) -> DataFrame:
    """Objects counted per inherited category (type catalogue is a fixed-size broadcast)."""
    spark = typed.sparkSession
    per_type = typed.groupBy("type").agg(F.count("*").alias("n"))
    return per_type.join(F.broadcast(meta_type_category(spark)), "type") \
        .groupBy("category").agg(F.sum("n").cast("bigint").alias("n_objects"))


def property_inventory(typed: DataFrame, props: DataFrame) -> DataFrame:
    """For each object type and declared property, how many objects carry a value.
    ``typed(key, type)``, ``props(key, prop, value)``: objects are told apart by key, as fullnames repeat."""
    spark = typed.sparkSession
    decl = declared_properties_by_type(spark)
    have = props.filter(F.col("value").isNotNull()).join(typed, "key") \
        .groupBy("type", "prop").agg(F.count_distinct("key").alias("n"))
    present = typed.select("type").distinct()
    grid = F.broadcast(decl).join(present, "type", "left_semi")
    return grid.join(have, ["type", "prop"], "left") \
        .select("type", "prop", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n_with_value"))
