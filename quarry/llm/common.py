"""Shared helpers: tables in the cluster's shared folder, Arrow row building, word rule."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir

#: Fixed value: a word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-llm/{name}-{uuid.uuid4().hex}"


_SHIPPED: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Give the executors this package once per application, so that tasks can import it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="quarry-"), "quarry.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED[app] = path


def map_batches(df: DataFrame, func: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose tasks can import this package."""
    ship(df.sparkSession)
    return df.mapInArrow(func, schema)


def table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage ends there, later readers prune columns, and a lost executor costs only its running
    tasks, because the rows live in shared storage.
    """
    path = shared_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that their names cannot clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unpacked(df: DataFrame, schema: StructType, row: str = "row") -> DataFrame:
    """The columns that ``packed_row`` folded into ``row``."""
    return df.select(*[F.col(row).getField(c).alias(c) for c in schema.fieldNames()])


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def checked(rows: list, limit: int, what: str) -> list:
    """Refuse to go on, rather than drop rows, if a table meant to be small is not."""
    if len(rows) > limit:
        raise ValueError(f"more than {limit} {what}; raise the limit if the driver can hold them")
    return rows


def few_of_each(rows: DataFrame, key: str, most: int, keys: int) -> DataFrame:
    """At most ``most`` different texts of each value of ``key`` (at most ``keys`` values), those with the smallest
    hash, each once; all of a value that has fewer. Rows are thinned by hash before texts meet, to about three
    times as many texts as wanted, and copies count as one, so neither a frequent value nor a frequent text
    meets in one task or thins out the others."""
    rows = rows.select(key, "text")
    different = rows.select(key, F.xxhash64("text").alias("hash_")).distinct()
    found = checked(different.groupBy(key).agg(F.count("*").alias("n")).limit(keys + 1).collect(), keys, f"values of {key}")
    span = 1 << 40
    rates = rows.sparkSession.createDataFrame([(r[key], min(span, span * 3 * most // r["n"])) for r in found], f"{key} {dict(rows.dtypes)[key]}, below_ long")
    thin = rows.withColumn("order_", F.pmod(F.xxhash64("text"), F.lit(span))).join(F.broadcast(rates), key).filter(F.col("order_") < F.col("below_")).drop("below_")
    once = thin.distinct()
    return once.selectExpr("*", f"row_number() over (partition by {key} order by order_, text) as nth_").filter(F.col("nth_") <= most).drop("nth_")


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; null counts as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_string(col.type):
        col = col.cast(pa.binary())
    elif pa.types.is_large_string(col.type):
        col = col.cast(pa.large_binary())
    return [x or b"" for x in col.to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` text bytes, so that long texts do not add up."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
