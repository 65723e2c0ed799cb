"""Type catalogue (S11): object types, their inherited categories and declared properties.

FIXED VALUES below restate the analysed tool's meta-model declarations (type -> inherited categories,
category -> declared properties). They are tiny dimension tables; joins against them are broadcast
because their size is fixed by this file, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA_CATS = ["UAObject", "GraphQL_Artifacts", "GraphQL", "GraphQL_Module"]
_CHILD_CATS = ["UAObject", "GraphQL_Artifacts"]
_CLIENT_CATS = ["UAObject", "GraphQL_Artifacts", "GraphQL", "GraphQL_Module"]

# FIXED VALUES: type -> inherited categories.
TYPE_CATEGORIES = [
    ("GraphQLProgram", ["UAObject", "METRICABLE", "GraphQL", "GraphQL_Artifacts"]),
    ("GraphQLSchema", _SCHEMA_CATS),
    ("GraphQLType", _SCHEMA_CATS),
    ("GraphQLInterface", _SCHEMA_CATS),
    ("GraphQLEnum", _SCHEMA_CATS),
    ("GraphQLEnumValue", _CHILD_CATS),
    ("GraphQLInput", _SCHEMA_CATS),
    ("GraphQLUnion", _SCHEMA_CATS),
    ("GraphQLScalar", _SCHEMA_CATS),
    ("GraphQLDirective", _SCHEMA_CATS),
    ("GraphQLField", _CHILD_CATS),
    ("GraphQLArgument", _CHILD_CATS),
    ("GraphQLQuery", _SCHEMA_CATS),
    ("GraphQLMutation", _SCHEMA_CATS),
    ("GraphQLSubscription", _SCHEMA_CATS),
    ("GraphQLFragment", _SCHEMA_CATS),
    ("GraphQLVariable", _CHILD_CATS),
    ("GraphQLClientQuery", _CLIENT_CATS + ["GraphQL_Client_Definition"]),
    ("GraphQLClientMutation", _CLIENT_CATS + ["GraphQL_Client_Definition"]),
    ("GraphQLClientSubscription", _CLIENT_CATS + ["GraphQL_Client_Definition"]),
    ("GraphQLQueryRequest", _CLIENT_CATS + ["GraphQL_Hook_Request"]),
    ("GraphQLLazyQueryRequest", _CLIENT_CATS + ["GraphQL_Hook_Request"]),
    ("GraphQLMutationRequest", _CLIENT_CATS + ["GraphQL_Hook_Request"]),
    ("GraphQLSubscriptionRequest", _CLIENT_CATS + ["GraphQL_Hook_Request"]),
    ("GraphQLProject", ["UAProject", "GraphQL", "GraphQL_Module"]),
]

# FIXED VALUES: category -> inherited categories.
CATEGORY_PARENTS = [
    ("GraphQL", ["UniversalLanguage", "CsvLanguage"]),
    ("GraphQL_Artifacts", ["APM Client Language Artifacts"]),
    ("GraphQL_Module", ["APM Client Modules"]),
]

# FIXED VALUES: category -> declared properties.
CATEGORY_PROPERTIES = [
    ("GraphQL_Client_Definition", ["operationName", "rawQueryText", "variables", "fieldsSelected"]),
    ("GraphQL_Hook_Request", ["hookType", "fetchPolicy", "errorPolicy"]),
]


def inherited(own: DataFrame, parents: DataFrame) -> DataFrame:
    """own(type, category) with every category that its categories inherit from parents(category, parent), directly or
    through others, each once, by a recursive query (categories must not inherit in a circle)."""
    return own.sparkSession.sql(
        """WITH RECURSIVE closure(type, category) AS (
               SELECT type, category FROM {own}
               UNION ALL
               SELECT c.type, p.parent FROM closure c JOIN {parents} p ON p.category = c.category)
           SELECT DISTINCT type, category FROM closure""", own=own, parents=parents)


def meta_type_category(spark: SparkSession) -> DataFrame:
    """Type -> category, those that its categories inherit included."""
    rows = [(t, c) for t, cats in TYPE_CATEGORIES for c in cats]
    parents = [(c, p) for c, ps in CATEGORY_PARENTS for p in ps]
    return inherited(spark.createDataFrame(rows, "type string, category string"), spark.createDataFrame(parents, "category string, parent string"))


def meta_properties(spark: SparkSession) -> DataFrame:
    rows = [(c, f"{c}.{p}") for c, props in CATEGORY_PROPERTIES for p in props]
    return spark.createDataFrame(rows, "category string, prop string")


def declared_properties_by_type(spark: SparkSession) -> DataFrame:
    """type -> declared property (through its categories)."""
    return F.broadcast(meta_type_category(spark)).join(F.broadcast(meta_properties(spark)), "category") \
        .select("type", "prop")
