"""Exact deduplication by Grace hashing (operator 10).

Records are partitioned by a hash of their content, recursively and with a new seed at each level, into
spill files until a bucket's distinct contents fit an open-addressing table. The table compares complete
contents, so equal hashes never merge different texts.

Two rounds keep hot contents apart. Round one runs in each input partition and leaves one record per
content there (its best row, the number of rows). Only these meet by content hash in round two, so a
content that fills a third of all rows sends one record per input partition. Rows learn the outcome
through (partition, local group), a key that no content can make hot.

Spill files belong to one task, lie in its executor's temporary folder and go when the task ends.

Defined results: a null text equals the empty text; texts differ if any byte differs; the row with the
largest doc_id stays, null doc_ids lose to any other; of repeated rows with that doc_id the first in
partition order stays; an empty table gives an empty result; other columns stay as they are, whatever
their names.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import struct
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, packed_row, slices, table, texts_of

NO_ID = -(1 << 63)
FAN_OUT = 16
MAX_LEVEL = 12


class ContentTable:
    """Open addressing with linear probing; a slot matches only if the whole content does."""

    def __init__(self, capacity: int = 1024):
        self.slots = np.full(capacity, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, key: int, content: bytes) -> int:
        """The index of ``content``, added if it is new."""
        slots, mask = self.slots, len(self.slots) - 1
        at = key & mask
        while (got := slots[at]) >= 0:
            if self.hashes[got] == key and self.contents[got] == content:
                return int(got)
            at = (at + 1) & mask
        slots[at] = new = len(self.contents)
        self.hashes.append(key)
        self.contents.append(content)
        self.bytes += len(content) + 200
        if 2 * (new + 1) > len(slots):
            self.grow()
        return new

    def grow(self) -> None:
        self.slots = np.full(4 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for i, key in enumerate(self.hashes):
            at = key & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i


def seeded(content: bytes, level: int) -> int:
    return xxhash.xxh3_64_intdigest(content, seed=level)


def grace(records: Iterable[tuple[int, bytes]], budget: int, folder: str, level: int = 0) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Groups of (record number, content): per finished bucket the record numbers, the content index of
    each, and the contents. Beyond ``budget`` bytes of distinct content the rest of a bucket goes to
    spill files, each then treated alike with the next seed; contents already in the table stay there,
    so copies never spill and a bucket of equal contents always fits."""
    held = ContentTable()
    numbers: list[int] = []
    groups: list[int] = []
    files: list = []
    paths: list[str] = []
    known: set[int] | None = None
    for number, content in records:
        key = seeded(content, level)
        if known is None and held.bytes > budget and level < MAX_LEVEL:
            known = set(held.hashes)
            paths = [os.path.join(folder, f"{level}-{os.urandom(6).hex()}") for _ in range(FAN_OUT)]
            files = [open(p, "wb", buffering=1 << 18) for p in paths]
        if known is not None and key not in known:
            f = files[(key >> 40) % FAN_OUT]
            f.write(struct.pack("<qq", number, len(content)))
            f.write(content)
            continue
        numbers.append(number)
        groups.append(held.find(key, content))
    for f in files:
        f.close()
    yield numbers, groups, held.contents
    del held, numbers, groups, known
    for p in paths:
        yield from grace(spilled(p), budget, folder, level + 1)
        os.remove(p)


def spilled(path: str) -> Iterator[tuple[int, bytes]]:
    with open(path, "rb", buffering=1 << 18) as f:
        while head := f.read(16):
            number, size = struct.unpack("<qq", head)
            yield number, f.read(size)


def runs(sizes: list[int], most: int = 8 << 20, rows: int = 20_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes."""
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and (held + size > most or i - start >= rows):
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def local_round(budget: int):
    """Round one: every row gets its local group, the best row of each group also the text and totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, folder = TaskContext.get().partitionId(), tempfile.mkdtemp(prefix="grace-")
        ids: list[int] = []
        rest: list[pa.Array] = []

        def records():
            for batch in slices(batches):
                start = len(ids)
                ids.extend(NO_ID if x is None else x for x in batch.column("doc_id").to_pylist())
                rest.append(batch.column("row"))
                yield from enumerate(texts_of(batch), start)

        try:
            base = 0
            for numbers, groups, contents in grace(records(), budget, folder):
                if numbers:
                    yield from emitted(numbers, groups, contents, base, ids, rest, part)
                base += len(contents)
        finally:
            shutil.rmtree(folder, ignore_errors=True)

    def emitted(numbers, groups, contents, base, ids, rest, part):
        rest[:] = [pa.concat_arrays(rest)]
        n, g = np.array(numbers, np.int64), np.array(groups, np.int64)
        own = np.array(ids, np.int64)[n]
        order = np.lexsort((n, np.invert(own), g))  # by group, then the largest id, then the first row
        first = np.ones(len(n), bool)
        first[1:] = g[order][1:] != g[order][:-1]
        best = np.zeros(len(n), bool)
        best[order[first]] = True
        size = np.bincount(g, minlength=len(contents))
        texts = [contents[x] if y else None for x, y in zip(groups, best.tolist())]
        for a, b in runs([len(x or b"") for x in texts]):
            yield pa.RecordBatch.from_pydict({
                "row": rest[0].take(pa.array(n[a:b])),
                "doc_id": pa.array(own[a:b], pa.int64(), mask=own[a:b] == NO_ID),
                "part": pa.array(np.full(b - a, part, np.int32)),
                "gid": pa.array(g[a:b] + base),
                "best": pa.array(best[a:b]),
                "n_local": pa.array(size[g[a:b]]),
                "content": pa.array(texts[a:b], pa.binary()),
            })

    return run


def global_round(budget: int):
    """Round two: the local groups of one content meet; one of them holds the row that stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = tempfile.mkdtemp(prefix="grace-")
        kept: list[list] = [[], [], [], []]
        rest: list[pa.Array] = []

        def records():
            at = 0
            for batch in slices(batches, "content"):
                for store, name in zip(kept, ("doc_id", "part", "gid", "n_local")):
                    store.extend(batch.column(name).to_pylist())
                rest.append(batch.column("row"))
                yield from enumerate(texts_of(batch, "content"), at)
                at += batch.num_rows

        try:
            for numbers, groups, contents in grace(records(), budget, folder):
                if not numbers:
                    continue
                rest[:] = [pa.concat_arrays(rest)]
                members: list[list[int]] = [[] for _ in contents]
                for n, g in zip(numbers, groups):
                    members[g].append(n)
                yield from merged(members, contents, kept, rest[0])
        finally:
            shutil.rmtree(folder, ignore_errors=True)

    def merged(members, contents, kept, row):
        doc_id, part, gid, n_local = kept
        out: list[tuple] = []
        held = 0
        for found, content in zip(members, contents):
            best = min(found, key=lambda i: (doc_id[i] is None, -(doc_id[i] or 0), part[i], gid[i]))
            total, sha = sum(n_local[i] for i in found), hashlib.sha256(content).hexdigest()
            for i in found:
                out.append((i, i == best, doc_id[best], total, sha, content if i == best else None))
            held += len(content)
            if held > 8 << 20 or len(out) > 20_000:
                yield batch_of(out, part, gid, row)
                out, held = [], 0
        if out:
            yield batch_of(out, part, gid, row)

    def batch_of(out, part, gid, row):
        at, wins, keep, total, sha, content = zip(*out)
        return pa.RecordBatch.from_pydict({
            "row": row.take(pa.array(at, pa.int64())),
            "part": pa.array([part[i] for i in at], pa.int32()),
            "gid": pa.array([gid[i] for i in at], pa.int64()),
            "wins": pa.array(wins),
            "keep_id": pa.array(keep, pa.int64()),
            "group_size": pa.array(total, pa.int64()),
            "text_sha256": pa.array(sha),
            "content": pa.array(content, pa.binary()),
        })

    return run


def rounds(docs: DataFrame, budget: int, carry: bool) -> tuple[DataFrame, DataFrame]:
    """(every row with its local group, every local group with its outcome). ``carry``: the best rows
    take all other columns along."""
    others = docs.drop("text") if carry else docs.select("doc_id")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), packed_row(others).alias("row"))
    kind = source.schema["row"].dataType.simpleString()
    local = map_batches(source, local_round(budget), f"row {kind}, doc_id long, part int, gid long, best boolean, n_local long, content binary")
    local = table(local, "grace-local", compression="zstd")
    met = local.filter("best").withColumn("key", F.xxhash64("content"))
    met = met.repartition("key").select("row", "doc_id", "part", "gid", "n_local", "content")
    merged = map_batches(met, global_round(budget), f"row {kind}, part int, gid long, wins boolean, keep_id long, group_size long, text_sha256 string, content binary")
    return local, merged


def deduplicate(docs: DataFrame, budget: int = 48 << 20) -> DataFrame:
    """One row of each group of equal texts, with all columns of ``docs``. ``budget``: bytes of distinct
    content that a task's table may hold before it spills."""
    _, merged = rounds(docs, budget, True)
    kept = merged.filter("wins")
    # a null text equals the empty text, and comes back as that
    return kept.select(*[F.col("content").cast("string").alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def duplicate_report(docs: DataFrame, budget: int = 48 << 20) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    local, merged = rounds(docs, budget, False)
    outcome = merged.drop("row", "content")
    joined = local.select("doc_id", "part", "gid", "best").join(outcome, ["part", "gid"])
    return joined.select("doc_id", "keep_id", "group_size", (F.col("best") & F.col("wins")).alias("kept"), "text_sha256")
