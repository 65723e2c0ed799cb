"""Materialisation points.

Operators reuse an intermediate table in several branches (e.g. the classified lines feed the depth
sum, the node table and the close events). Without a materialisation point Spark re-plans and
re-executes the shared subtree once per branch.

* ``persist`` keeps a table in memory/disk; lost blocks are recomputed from lineage, so executor loss
  is survivable.
* ``cut`` writes the table as parquet into the session's ``spark.checkpoint.dir`` (the shared folder
  a cluster names there; tests get a scratch folder only when it is unset) and reads it back. The
  lineage is truncated, the data is computed exactly once (``Dataset.checkpoint`` would compute it
  twice unless cached), and later stages get column pruning and filter pushdown on the stored table.
  A lost executor cannot lose it: the files live in shared storage.
"""

from __future__ import annotations

import threading
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir


#: Caches of the pass under way in this thread; passes of other threads keep theirs.
_LIVE = threading.local()


def _held() -> list[DataFrame]:
    if not hasattr(_LIVE, "frames"):
        _LIVE.frames = []
    return _LIVE.frames


def persist(df: DataFrame) -> DataFrame:
    """Cache an intermediate reused by several branches of the stage being built. It is released by
    the next ``cut`` (the stage result is then durable parquet, so nothing needs it any more; a
    released intermediate used again is simply recomputed)."""
    p = df.persist(StorageLevel.MEMORY_AND_DISK)
    _held().append(p)
    return p


def release() -> None:
    while _held():
        _held().pop().unpersist()


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """Write an intermediate of a long pass and read it back: the plan ends there, so plans of passes that
    use it several times do not multiply. Caches stay as they are."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/quarry/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame, name: str = "stage") -> DataFrame:
    return cut_many([(df, name)])[0]


def cut_many(items: list[tuple[DataFrame, str]]) -> list[DataFrame]:
    """Write several tables of one stage (sharing cached inputs) before releasing the caches."""
    out = []
    for df, name in items:
        spark = df.sparkSession
        root = ensure_checkpoint_dir(spark).rstrip("/")
        path = f"{root}/quarry/{name}-{uuid.uuid4().hex}"
        df.write.mode("error").parquet(path)
        out.append((spark, path))
    release()
    return [spark.read.parquet(path) for spark, path in out]
