"""Best-fit packing with large-item matching (operator 9).

Documents become token ids plus an end id; longer ones than a sequence are cut into full pieces, the first
piece taking the rest. Pieces of one length are interchangeable, so the plan is made on the histogram of
lengths (at most ``capacity`` rows, whatever the input):

* a full piece is a sequence of its own;
* large items, above a third of the capacity, fit at most twice into a sequence: taken from the longest
  down, each is matched with the longest other large item that fits beside it;
* small items, from the longest down, go to the smallest gap that holds them, where sequences with equal
  gaps are handled as one class; what fits nowhere opens new sequences.

Each piece knows its number among the pieces of its length in its own partition. Counts per partition
and length (again bounded per partition) make that a global number, and the plan, a table of ranges,
tells sequence and offset. Only the pieces' numbers are joined with these counts; the ids stay where they
were written unless they are asked for.

Defined results: a null text is empty and packs as a single end id; ties are settled by partition order;
repeated rows pack separately; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, slices, table, texts_of
from .tokens import END_ID, encoder, tokenizer_path

CAPACITY = 1024
TOKENIZER = "byte_bpe_50k.json"


def pieces_of(docs: DataFrame, path: str, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids, ids_crc32, part, nth): ``ids`` little-endian 32-bit, ``nth`` the number of
    the piece among those of its length in its partition."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc, seen = TaskContext.get().partitionId(), encoder(path, "spaced"), [0] * (capacity + 1)
        for batch in slices(batches, limit=4 << 20):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.many(texts_of(batch))):
                ids += end
                total = len(ids) // 4
                stop, piece, start = total % capacity or capacity, 0, 0
                while start < total:
                    rows.append((doc_id, piece, start, stop - start, ids[4 * start : 4 * stop], seen[stop - start]))
                    seen[stop - start] += 1
                    start, stop, piece = stop, stop + capacity, piece + 1
            doc, piece, start, length, ids, nth = zip(*rows)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(doc, pa.int64()), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()), "ids": pa.array(ids, pa.binary()), "ids_crc32": pa.array(map(crc32, ids), pa.int64()),
                "part": pa.array([part] * len(rows), pa.int32()), "nth": pa.array(nth, pa.int64()),
            })

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return map_batches(source, run, "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, part int, nth long")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, how many, first sequence, offset): the pieces of a length with consecutive
    numbers go to consecutive sequences at one offset."""
    rest = {n: c for n, c in counts.items() if c}
    used: dict[int, int] = defaultdict(int)
    out: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    #: gap -> runs (first sequence, how many); all sequences of a run are filled alike up to the gap
    open_runs: dict[int, list[list[int]]] = defaultdict(list)
    gaps: list[int] = []

    def place(length, many, first, offset):
        out.append((length, used[length], many, first, offset))
        used[length] += many
        rest[length] -= many

    def leave(gap, first, many):
        if gap and many:
            if not open_runs[gap]:
                insort(gaps, gap)
            open_runs[gap].append([first, many])

    third = capacity / 3
    large = sorted(n for n in rest if n > third)
    while large:
        top = large[-1]
        if not rest[top]:
            large.pop()
            continue
        fits = next((n for n in reversed(large) if n <= capacity - top and rest[n] and (n != top or rest[n] > 1)), None)
        if fits is None:
            many = rest[top]
            place(top, many, sequences, 0)
            leave(capacity - top, sequences, many)
        elif fits == top:
            many = rest[top] // 2
            place(top, many, sequences, 0)
            place(top, many, sequences, top)
            leave(capacity - 2 * top, sequences, many)
        else:
            many = min(rest[top], rest[fits])
            place(top, many, sequences, 0)
            place(fits, many, sequences, top)
            leave(capacity - top - fits, sequences, many)
        sequences += many

    for length in sorted((n for n in rest if n <= third), reverse=True):
        while rest[length]:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = min(capacity // length, rest[length])
                many = rest[length] // each
                for k in range(each):
                    place(length, many, sequences, k * length)
                leave(capacity - each * length, sequences, many)
                sequences += many
                continue
            gap = gaps[at]
            run = open_runs[gap][-1]
            many = min(rest[length], run[1])
            first = run[0] + run[1] - many
            place(length, many, first, capacity - gap)
            run[1] -= many
            if not run[1]:
                open_runs[gap].pop()
                if not open_runs[gap]:
                    gaps.pop(at)
            leave(gap - length, first, many)
    return out


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, ids (if asked for), sequence_id, offset."""
    pieces = table(pieces_of(docs, path or tokenizer_path(TOKENIZER), capacity), "pieces", compression="zstd")
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    totals = by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    steps = plan({r["length"]: r["n"] for r in totals}, capacity)
    lookup: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    by_length: dict[int, list] = defaultdict(list)
    for length, number, _, first, offset in steps:
        by_length[length].append((number, first, offset))
    for length, found in by_length.items():
        lookup[length] = tuple(np.array(x, np.int64) for x in zip(*sorted(found)))
    before = by_part.selectExpr("length", "part", "sum(n) over (partition by length order by part rows between unbounded preceding and 1 preceding) as base")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for one in np.unique(length).tolist():
                own = length == one
                first, to, at = lookup[one]
                step = np.searchsorted(first, number[own], "right") - 1
                sequence[own], offset[own] = to[step] + number[own] - first[step], at[step]
            kept = [c for c in batch.schema.names if c != "number"]  # doc_id to ids
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    ids = ["ids"] if with_ids else []
    numbered = pieces.select("doc_id", "piece", "start", "length", "ids_crc32", *ids, "part", "nth").join(before, ["length", "part"])
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", *ids, (F.col("nth") + F.coalesce("base", F.lit(0))).alias("number"))
    shape = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return map_batches(numbered, settle, f"{shape}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids binary): the sequences themselves, each of at most ``capacity`` ids."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
