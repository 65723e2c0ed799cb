"""Sinks (S8-S10): objects, properties and links written as partitioned parquet tables.

Objects are partitioned by type, links by link type, properties by property name: readers that need
one kind prune whole directories. Writes are plain DataFrame writes (atomic per job through the
output committer), so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def write_objects(objects: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One row per object with its bookmark; partitioned by type."""
    out = objects.withColumn("bookmark", T.object_bookmark(F.col("path"), F.col("start_line"), F.col("end_line")))
    out.write.mode(mode).partitionBy("type").parquet(path)


def write_properties(props: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One row per saved property (absent values were never emitted)."""
    props.filter(F.col("value").isNotNull() | F.col("prop").endswith(".operationName")) \
        .write.mode(mode).partitionBy("prop").parquet(path)


def write_links(links: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One row per link, no dedupe; partitioned by link type."""
    links.write.mode(mode).partitionBy("link_type").parquet(path)
