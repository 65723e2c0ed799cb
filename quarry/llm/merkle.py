"""Merkle manifest of a dataset by time-forward processing (operator 12).

Each row is a leaf, the digest of its columns. The leaves of a source, in the order of their ids, are the lowest
level of its tree; every ``ARITY`` consecutive nodes become the digest of their digests, until one remains. The
sources' roots, in the order of the sources, are the leaves of one more tree, whose root stands for the dataset.

Time-forward processing turns the tree into messages. Nodes are labelled by height and place, so that parents
come after their children. The forward sweep takes nodes in the order of their labels: each sends its digest to
its parent's label through a priority queue that keeps what exceeds its memory in sorted runs on disk. The
reversed sweep goes from the root down: each node gets its proof (the siblings met on the way to the root) from
the queue and sends it, with the children's siblings before it, to its children, until proofs reach the leaves.

A tree is swept in blocks of ``ARITY ** HEIGHT`` consecutive nodes, each a whole subtree of that height, so a source
with a third of all rows spreads over as many tasks as it has blocks. The roots of the blocks are the nodes of
the next round, a ``ARITY ** HEIGHT``-th in number; proofs come down round by round, one row per block, and are
unfolded to the leaves only where these are. Nothing but the dataset's root reaches the driver.

Order within a source: null doc_ids first, then by doc_id, equal ids by their leaves; equal leaves are alike.

Defined results: null values are digested as ``-``, empty texts as ``0:``; a null doc_id is not tampered with;
null sources form one group, before the others; repeated rows are leaves of their own; an empty table gives an
empty result; extra columns are not digested.
"""

from __future__ import annotations

import heapq
import os
import struct
import tempfile
from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, table

ARITY = 3
HEIGHT = 6
#: Hexadecimal digits of a digest.
DIGITS = 64


class ExternalQueue:
    """A priority queue of (label, order, data). Beyond ``most`` bytes what it holds goes to a sorted file; the
    smallest entry is the smaller of the heap's and the files' next ones."""

    def __init__(self, most: int = 64 << 20):
        self.most, self.held, self.heap = most, 0, []
        self.runs: list[tuple[int, int, bytes, int]] = []
        self.files: list = []

    def push(self, label: int, order: int, data: bytes) -> None:
        heapq.heappush(self.heap, (label, order, data))
        self.held += len(data) + 120
        if self.held > self.most:
            f = tempfile.TemporaryFile(prefix="queue-")  # one task's own, gone with it
            for key, place, body in sorted(self.heap):
                f.write(struct.pack("<qqq", key, place, len(body)))
                f.write(body)
            f.seek(0, os.SEEK_SET)
            self.files.append(f)
            self.heap, self.held = [], 0
            self.advance(len(self.files) - 1)

    def advance(self, run: int) -> None:
        head = self.files[run].read(24)
        if head:
            label, order, size = struct.unpack("<qqq", head)
            heapq.heappush(self.runs, (label, order, self.files[run].read(size), run))
        else:
            self.files[run].close()

    def first(self) -> int | None:
        """The smallest label."""
        tops = [x[0][0] for x in (self.heap, self.runs) if x]
        return min(tops) if tops else None

    def pop(self) -> tuple[int, int, bytes]:
        if self.runs and (not self.heap or self.runs[0][:3] < self.heap[0]):
            label, order, data, run = heapq.heappop(self.runs)
            self.advance(run)
            return label, order, data
        got = heapq.heappop(self.heap)
        self.held -= len(got[2]) + 120
        return got

    def taken(self, label: int) -> list[bytes]:
        """All data for a label, in order."""
        out = []
        while self.first() == label:
            out.append(self.pop()[2])
        return out


def digest(parts: list[bytes]) -> bytes:
    return sha256(b"".join(parts)).hexdigest().encode()


def label_of(height: int, place: int) -> int:
    return height << 48 | place


def forward(leaves: list[bytes], height: int, queue: ExternalQueue) -> tuple[bytes, list[tuple[int, list[bytes]]]]:
    """Sweep ``height`` levels up from the leaves: (root, (label, digests of the children) of every inner node)."""
    root, nodes = leaves[0], []
    if height:
        for place, leaf in enumerate(leaves):
            queue.push(label_of(1, place // ARITY), place, leaf)
    while (label := queue.first()) is not None:
        children = queue.taken(label)
        nodes.append((label, children))
        root = digest(children)
        level, place = label >> 48, label & (1 << 48) - 1
        if level < height:
            queue.push(label_of(level + 1, place // ARITY), place, root)
    return root, nodes


def step(children: list[bytes], slot: int) -> bytes:
    """A proof's lowest level: the place among the siblings, their number, their digests."""
    return bytes((slot, len(children) - 1)) + b"".join(children[:slot] + children[slot + 1 :])


def backward(nodes: list[tuple[int, list[bytes]]], proof: bytes, queue: ExternalQueue) -> Iterator[tuple[int, bytes]]:
    """(place, proof) of every leaf, the root's proof being ``proof``: the forward sweep's nodes in reverse."""
    if not nodes:
        yield 0, proof
        return
    queue.push(-nodes[-1][0], 0, proof)
    for label, children in reversed(nodes):
        (own,) = queue.taken(-label)
        level, place = label >> 48, label & (1 << 48) - 1
        for slot in range(len(children)):
            child = ARITY * place + slot
            if level == 1:
                yield child, step(children, slot) + own
            else:
                queue.push(-label_of(level - 1, child), 0, step(children, slot) + own)


def steps(proof: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(place among the siblings, siblings) of each level of a proof, from the leaf up."""
    at = 0
    while at < len(proof):
        slot, many = proof[at], proof[at + 1]
        yield slot, [proof[a : a + DIGITS] for a in range(at + 2, at + 2 + DIGITS * many, DIGITS)]
        at += 2 + DIGITS * many


def siblings_digest(proof: bytes) -> bytes:
    return digest([x for _, siblings in steps(proof) for x in siblings])


def folded(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and a proof lead to."""
    for slot, siblings in steps(proof):
        leaf = digest([*siblings[:slot], leaf, *siblings[slot:]])
    return leaf


def height_of(n: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    height = 0
    while n > 1:
        n, height = -(-n // ARITY), height + 1
    return height


def value_of(value: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(text: Column) -> Column:
    """The digest of a row of ``documents``."""
    rest = [value_of(F.col(c).cast("string")) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*rest, value_of(text)).cast("binary"), 256)


def tampered_with() -> Column:
    """Fixed rule: rows whose crc32 of the doc_id as text is even."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with pos, the number of the row among those of its ``key`` in this order, and n, their count. Ranges
    of all rows are sorted apart and counted; only the counts of a key's ranges meet."""
    ranged = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            nth = []
            for key in batch.column("key").to_pylist():
                last, seen = key, seen + 1 if key == last else 0
                nth.append(seen)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(nth), pa.int32()), pa.array(nth, pa.int64())], [*batch.schema.names, "part", "nth"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    placed = table(map_batches(ranged, run, f"{shape}, part int, nth long"), "numbered")
    sizes = placed.groupBy("key", "part").agg(F.count("*").alias("many"))
    sizes = sizes.selectExpr("key", "part", "coalesce(sum(many) over (partition by key order by part rows between unbounded preceding and 1 preceding), 0) as base", "sum(many) over (partition by key) as n")
    return placed.join(sizes, ["key", "part"]).select(*rows.columns, (F.col("base") + F.col("nth")).alias("pos"), "n")


def in_blocks(nodes: DataFrame, span: int) -> DataFrame:
    """Rows with a key, a place and maybe a block: those of a block together, by place."""
    if "block" not in nodes.columns:
        nodes = nodes.withColumn("block", F.expr(f"pos div {span}"))
    return nodes.repartition("key", "block").sortWithinPartitions("key", "block", "pos")


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[dict]]]:
    rows = (r for batch in batches for r in batch.to_pylist())
    for (key, block), found in groupby(rows, key=lambda r: (r["key"], r["block"])):
        yield key, block, list(found)


def block_height(n: int, height: int) -> int:
    """Levels of a block: all, unless it is its tree's only one and fewer nodes need fewer."""
    return height_of(n) if n <= ARITY**height else height


def upward(nodes: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """(the nodes of each round: key, pos, n, leaf; the root and the number of leaves of each key)."""
    span = ARITY**height

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = ExternalQueue()
        for key, block, rows in blocks(batches):
            n = rows[0]["n"]
            root, _ = forward([r["leaf"].encode() for r in rows], block_height(n, height), queue)
            yield pa.RecordBatch.from_pydict({
                "key": pa.array([key]), "pos": pa.array([block], pa.int64()), "n": pa.array([-(-n // span)], pa.int64()),
                "total": pa.array([rows[0]["total"]], pa.int64()), "leaf": pa.array([root.decode()]),
            })

    levels = [nodes.withColumn("total", F.col("n"))]
    most = nodes.agg(F.max("n")).first()[0] or 0
    roots = None
    while True:
        above = map_batches(in_blocks(levels[-1].select("key", "pos", "n", "total", "leaf"), span), run, "key string, pos long, n long, total long, leaf string")
        above = table(above, "block-roots")
        done = above.filter("n = 1").select("key", "total", "leaf")
        roots = done if roots is None else roots.unionByName(done)
        most = -(-most // span)
        if most <= 1:
            return levels, roots
        levels.append(above.filter("n > 1"))


def downward(levels: list[DataFrame], starts: DataFrame, height: int, finish=None, shape: str = "") -> DataFrame:
    """The proof of every node of the lowest round: key, pos, proof, subroot. ``starts``: key, total, proof and
    subroot of each root. ``finish`` makes batches of ``shape`` out of (row, proof, subroot) in the lowest round."""
    span = ARITY**height

    def sent(found: Iterator[tuple[dict, bytes, str]]) -> Iterator[pa.RecordBatch]:
        rows, proofs, subroots = zip(*found)
        yield pa.RecordBatch.from_pydict({
            "key": pa.array([r["key"] for r in rows]), "pos": pa.array([r["pos"] for r in rows], pa.int64()),
            "proof": pa.array(proofs, pa.binary()), "subroot": pa.array(subroots, pa.string()),
        })

    def runner(emit):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            queue = ExternalQueue()
            for _, _, (head, *rows) in blocks(batches):  # the block's proof stands before its nodes
                _, nodes = forward([r["leaf"].encode() for r in rows], block_height(rows[0]["n"], height), queue)
                yield from emit((rows[place], proof, head["subroot"]) for place, proof in backward(nodes, head["proof"], queue))

        return run

    proofs = None
    for level in range(len(levels) - 1, -1, -1):
        above = starts.filter(F.col("total") <= span ** (level + 1))
        if level:
            above = above.filter(F.col("total") > span**level)
        above = above.select("key", F.lit(0).cast("long").alias("block"), "proof", "subroot")
        if proofs is not None:
            above = above.unionByName(proofs.select("key", F.col("pos").alias("block"), "proof", "subroot"))
        whole = levels[level].drop("total").withColumn("block", F.expr(f"pos div {span}"))
        whole = whole.unionByName(above.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
        last = level == 0 and finish is not None
        out = map_batches(in_blocks(whole, span), runner(finish if last else sent), shape if last else "key string, pos long, proof binary, subroot string")
        if last:
            return out
        proofs = table(out, "proofs")
    return proofs


def manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. ``height``: levels of a
    block."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "n_chars", "text")
    touched = F.when(tampered_with(), leaf_of(F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    leaves = base.select("doc_id", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("key"), leaf_of(F.col("text")).alias("leaf"), touched.alias("tampered"), F.monotonically_increasing_id().alias("at"))
    leaves = table(leaves, "leaves")
    levels, subroots = upward(table(numbered(leaves, ["doc_id", "leaf", "at"]).drop("at"), "placed-leaves"), height)
    tops = subroots.select(F.lit("").alias("key"), F.col("key").alias("source"), F.col("total").alias("many"), "leaf")
    tops = table(numbered(tops, ["source"]), "subroots")
    top_levels, root = upward(tops, height)
    found = root.select("leaf").first()
    root = found["leaf"] if found else ""
    start = spark.createDataFrame([("", 1, b"", None)], "key string, total long, proof binary, subroot string")
    start = start.withColumn("total", F.lit(tops.count()).cast("long"))  # the tree above has a leaf for each source
    proofs = downward(top_levels, start.filter("total > 0"), height)
    starts = tops.join(proofs.select("pos", "proof"), "pos").select(F.col("source").alias("key"), F.col("many").alias("total"), "proof", F.col("leaf").alias("subroot"))

    def finish(found: Iterator[tuple[dict, bytes, str]]) -> Iterator[pa.RecordBatch]:
        rows, proofs, subroots = zip(*found)
        ends = [folded((r["tampered"] or r["leaf"]).encode(), p).decode() for r, p in zip(rows, proofs)]
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()), "leaf": pa.array([r["leaf"] for r in rows]),
            "subroot": pa.array(subroots), "root": pa.array([root] * len(rows)), "proof_sha256": pa.array([siblings_digest(p).decode() for p in proofs]),
            "folded_root": pa.array(ends), "verified": pa.array([x == root for x in ends]),
        })

    shape = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return downward(levels, starts, height, finish, shape)
