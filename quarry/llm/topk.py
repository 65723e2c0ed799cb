"""Exact top-k search by tiled matrix products (operator 5).

Vectors become integers, floor(scale * x), and are packed into tiles of ``TILE`` rows, queries and candidates
alike. Tiles meet on a grid of groups x shards: a candidate tile goes to one shard in each query group, a
query tile to every shard of one group, by an equi-join on (group, shard). With T cells the copies sent are
least at about sqrt(T / 100) groups, as one row in a hundred is a query. A pair of tiles is one row of the
join and one matrix product; per query the best ``k`` are partially selected and carried along while the query
tile stays the same. The lists of the shards are then merged in a tree, ``FAN_IN`` lists at a time.

Products are taken in doubles while no sum can pass 2**53, else in exact integers; a score beyond a long
raises an error.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part; of two
vectors of different length the shorter counts as padded with zeros; a query's own row is every row with its
vec_id; rows without a vec_id take no part; repeated rows of other ids each count; repeated query rows are
separate queries, told apart by ``query_row``; ties go to the smaller vec_id; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

SCALE = 1024
K = 10
TILE = 2048
FAN_IN = 8
QUERY_EVERY = 100
TILE_SHAPE = "tile long, rows int, width int, ids binary, numbers binary"


def tiles(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """(tile, rows, width, ids, numbers): up to ``size`` vectors as integers, row after row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        held_ids: list[np.ndarray] = []
        held: list[np.ndarray] = []
        width = 0

        def out():
            nonlocal nth
            ids, numbers = np.concatenate(held_ids), np.concatenate(held)
            for i in range(0, len(ids), size):
                x = numbers[i : i + size]
                yield pa.RecordBatch.from_pydict({
                    "tile": pa.array([(part << 32) + nth], pa.int64()), "rows": pa.array([len(x)], pa.int32()), "width": pa.array([width], pa.int32()),
                    "ids": pa.array([ids[i : i + size].astype("<i8").tobytes()], pa.binary()), "numbers": pa.array([x.astype("<f8").tobytes()], pa.binary()),
                })
                nth += 1
            held_ids.clear(), held.clear()

        for batch in batches:
            lists, ids = batch.column("vec"), batch.column("vec_id")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for w in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == w)
                if held and w != width:
                    yield from out()
                width = w
                x = np.floor(scale * values[starts[own][:, None] + np.arange(w)].astype(np.float64))
                held_ids.append(ids.to_numpy(zero_copy_only=False)[own])
                held.append(x)
                if sum(map(len, held_ids)) >= size:
                    yield from out()
        if held:
            yield from out()

    good = F.col("vec").isNotNull() & F.col("vec_id").isNotNull() & (F.size("vec") > 0)
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    clean = vectors.filter(good & F.coalesce(finite, F.lit(False)))
    return map_batches(clean, run, TILE_SHAPE)


def product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    width = min(q.shape[1], c.shape[1])
    q, c = q[:, :width], c[:, :width]
    bound = (np.abs(q).max(initial=0)) * (np.abs(c).max(initial=0)) * max(1, width)
    if bound < 2.0**53:
        return (q @ c.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in row] for row in m], object)
    scores = whole(q) @ whole(c).T
    if max(map(abs, scores.ravel().tolist()), default=0) >= 2**63 - 1:
        raise OverflowError("an inner product does not fit a long")
    return scores.astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the ``k`` highest scores, ties to smaller ids: everything above the k-th score stays and the
    smallest ids of that score fill up."""
    if scores.shape[1] > k:
        kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        most = int((scores >= kth).sum(axis=1).max())
        if most <= 4 * k:
            at = np.argpartition(-scores, min(most, scores.shape[1]) - 1, axis=1)[:, :most]
            scores, ids = np.take_along_axis(scores, at, 1), np.take_along_axis(ids, at, 1)
        order = np.lexsort((ids, -scores), axis=1)[:, :k]
    else:
        order = np.lexsort((ids, -scores), axis=1)
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


NONE = 1 - (1 << 63)  # its negative is a long too


def search(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, scale: int = SCALE, tile: int = TILE) -> DataFrame:
    """query_id, query_row, rank, vec_id, score. ``vectors``: vec_id and vec; rows whose vec_id is divisible
    by ``query_every`` are the queries."""
    spark = vectors.sparkSession
    cells = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    groups = max(1, round((cells / query_every) ** 0.5))
    shards = max(1, cells // groups)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast("array<double>").alias("vec"))
    spread = F.pmod(F.xxhash64("tile"), F.lit(1 << 30))
    wanted = tiles(vectors.filter(F.col("vec_id") % query_every == 0), max(64, tile // 8), scale)
    wanted = wanted.select("tile", "width", F.col("ids").alias("q_ids"), F.col("numbers").alias("q"), (spread % groups).alias("grp"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    offered = tiles(vectors, tile, scale)
    offered = offered.select(F.col("width").alias("c_width"), F.col("ids").alias("c_ids"), F.col("numbers").alias("c"), (spread % shards).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("grp"))
    pairs = wanted.join(offered, ["grp", "shard"]).select("tile", "width", "q_ids", "q", "c_width", "c_ids", "c")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, scores, ids, own = None, None, None, None

        def out():
            rows, _ = np.nonzero(scores > NONE)
            keep = scores > NONE
            return pa.RecordBatch.from_pydict({"query_id": pa.array(own[rows]), "query_row": pa.array((now << 12) + rows), "vec_id": pa.array(ids[keep]), "score": pa.array(scores[keep])})

        for batch in batches:
            for i in range(batch.num_rows):
                at, width, c_width = (batch.column(x)[i].as_py() for x in ("tile", "width", "c_width"))
                if at != now:
                    if now is not None:
                        yield out()
                    now, own = at, np.frombuffer(batch.column("q_ids")[i].as_buffer(), "<i8")
                    q = np.frombuffer(batch.column("q")[i].as_buffer(), "<f8").reshape(-1, width)
                    scores, ids = np.full((len(own), 0), NONE), np.zeros((len(own), 0), np.int64)
                c_ids = np.frombuffer(batch.column("c_ids")[i].as_buffer(), "<i8")
                found = product(q, np.frombuffer(batch.column("c")[i].as_buffer(), "<f8").reshape(-1, c_width))
                found[own[:, None] == c_ids[None, :]] = NONE
                top, top_ids = best(found, np.broadcast_to(c_ids, found.shape), k)
                scores, ids = best(np.concatenate((scores, top), axis=1), np.concatenate((ids, top_ids), axis=1), k)
        if now is not None:
            yield out()

    lists = map_batches(pairs, multiply, "query_id long, query_row long, vec_id long, score long")
    order = "order by score desc, vec_id"
    merged, count = lists.withColumn("list", F.pmod(F.spark_partition_id(), F.lit(shards))), shards
    while count > FAN_IN:  # FAN_IN lists of a query at a time
        merged = merged.withColumn("list", F.floor(F.col("list") / FAN_IN))
        merged = merged.selectExpr("*", f"row_number() over (partition by query_row, list {order}) as nth").filter(F.col("nth") <= k).drop("nth")
        count = -(-count // FAN_IN)
    ranked = merged.selectExpr("*", f"row_number() over (partition by query_row {order}) as rank").filter(F.col("rank") <= k)
    return ranked.select("query_id", "query_row", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
