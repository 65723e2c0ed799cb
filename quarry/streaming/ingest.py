"""Incremental ingestion of source files with Structured Streaming.

The analysed tool has one event surface: "file seen" for every file, then "all files seen". The
per-file pass (schema objects) depends on one file only, so it runs per micro-batch: a stream of
``files(path, content)`` rows (parquet drops in a folder) is turned into objects with
``foreachBatch`` and appended to an objects table. The cross-file pass (name resolution, links)
needs the barrier, so ``finish`` runs it as a batch job over everything ingested.
A file re-delivered in a later batch is re-analysed; readers keep its latest batch
(``latest_objects``). Each batch also keeps the references it found with their callers, and which paths it
analysed, so the barrier takes the same delivery of every path as the objects came from and analyses none again.
Of two deliveries of a path in one batch the one with the greater text counts, a fixed if arbitrary
choice, as a batch has no order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.materialize import release, stored
from ..operators import resolve as R
from ..operators import schema as S
from ..sources.files import file_line_counts, filter_extensions, to_lines

FILES_SCHEMA = "path string, content string"


def _per_batch(objects_dir: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        files = filter_extensions(batch.select("path", "content")).groupBy("path").agg(F.max("content").alias("content"))
        # a batch that is run again after a failure replaces what it wrote before
        files.write.mode("overwrite").parquet(f"{objects_dir}/files/batch_id={batch_id}")
        kept = batch.sparkSession.read.schema(FILES_SCHEMA).parquet(f"{objects_dir}/files/batch_id={batch_id}")
        lines = stored(to_lines(kept), "stream-lines")
        found = S.extract_objects(lines, file_line_counts(kept))
        found["objects"].write.mode("overwrite").parquet(f"{objects_dir}/objects/batch_id={batch_id}")
        refs = R.reference_callers(R.type_references(lines), found["nodes"])
        refs.write.mode("overwrite").parquet(f"{objects_dir}/references/batch_id={batch_id}")
        release()
    return run


def start(spark: SparkSession, source_dir: str, objects_dir: str, checkpoint_dir: str, available_now: bool = True):
    """Start the per-file pass; ``checkpoint_dir`` must be shared storage on a cluster."""
    stream = spark.readStream.schema(FILES_SCHEMA).parquet(source_dir)
    w = stream.writeStream.foreachBatch(_per_batch(objects_dir)).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def latest_files(spark: SparkSession, objects_dir: str) -> DataFrame:
    """Path and batch of the latest delivery of every path."""
    return spark.read.parquet(f"{objects_dir}/files").groupBy("path").agg(F.max("batch_id").alias("batch_id"))


def _latest(df: DataFrame, deliveries: DataFrame) -> DataFrame:
    return df.join(deliveries, ["path", "batch_id"], "left_semi").drop("batch_id")


def latest_objects(spark: SparkSession, objects_dir: str) -> DataFrame:
    return _latest(spark.read.parquet(f"{objects_dir}/objects"), latest_files(spark, objects_dir))


def latest_references(spark: SparkSession, objects_dir: str) -> DataFrame:
    """The references of every path's latest delivery, with their callers."""
    return _latest(spark.read.parquet(f"{objects_dir}/references"), latest_files(spark, objects_dir))


def finish(spark: SparkSession, objects_dir: str) -> DataFrame:
    """The barrier pass: the references of every ingested file, found with its objects, resolved against all objects.
    No file is analysed again."""
    refs, objs = latest_references(spark, objects_dir), latest_objects(spark, objects_dir)
    links = stored(R.schema_links(R.resolve_references(refs, objs)), "stream-links")
    release()
    return links
