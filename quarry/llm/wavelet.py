"""Token ids as one wavelet matrix per shard (operator 1).

Documents are dealt by ranges of doc_id and sorted, so the shards, in order, hold all ids in ascending
doc_id order. A task encodes its documents as they come and closes a shard after ``SHARD_IDS`` ids; a shard
is one row and one file of the written table.

A shard's bytes (little-endian): ``WVM1``, the length of a JSON header, the header, then zstd frames, each
found through its length in the header, so a reader opens only what it needs:

* for each bit from the highest down, a plane of bits (64-byte blocks) and its directory, the number of
  ones before each 512-bit block. Ids are stably parted by the bit, zeros first, before the next plane;
* doc_ids, their null flags, and where each document starts.

Rank and select on the planes answer which id is at a place (``access``), how often an id occurs before a
place (``rank``, ``count``) and where it occurs (``select``, ``occurrences``), without decoding the shard.

Defined results: a null text is empty and gives the end id alone; null doc_ids come first; of equal doc_ids
the order is that of the input; an empty table gives no shard; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, shared_path, slices, texts_of
from .tokens import END_ID, encoder, tokenizer_path

TOKENIZER = "word_bpe_49k.json"
SHARD_IDS = 1 << 23
MAGIC = b"WVM1"


def shard_bytes(ids: np.ndarray, doc_ids: list, starts: np.ndarray) -> bytes:
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    x = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    pack = zstandard.ZstdCompressor(level=1).compress
    frames, zeros = [], []
    for k in range(bits - 1, -1, -1):
        one = (x & x.dtype.type(1 << k)) != 0
        plane = np.packbits(one, bitorder="little")
        plane = np.pad(plane, (0, -len(plane) % 64)).view("<u8").reshape(-1, 8)
        ones = np.bitwise_count(plane).sum(axis=1, dtype=np.int64)
        directory = np.cumsum(ones) - ones
        frames += [pack(plane.tobytes()), pack(directory.astype("<u4").tobytes())]
        zeros.append(len(x) - int(one.sum()))
        x = np.concatenate((x[~one], x[one]))
    null = np.array([d is None for d in doc_ids], bool)
    known = np.array([0 if d is None else d for d in doc_ids], "<i8")
    frames += [pack(known.tobytes()), pack(np.packbits(null).tobytes()), pack(starts.astype("<i8").tobytes())]
    head = json.dumps({"ids": len(ids), "docs": len(doc_ids), "bits": bits, "zeros": zeros, "frames": [len(f) for f in frames]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *frames])


class WaveletShard:
    """A shard read from its bytes; frames are opened as they are needed."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        size = int.from_bytes(data[4:8], "little")
        head = json.loads(bytes(data[8 : 8 + size]))
        self.n, self.n_docs, self.bits, self.zeros = head["ids"], head["docs"], head["bits"], head["zeros"]
        self.data, self.ends = data, np.cumsum([8 + size, *head["frames"]]).tolist()
        self.open: dict[int, np.ndarray] = {}

    def frame(self, i: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.data[self.ends[i] : self.ends[i + 1]])

    def plane(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        if level not in self.open:
            self.open[level] = (np.frombuffer(self.frame(2 * level), "<u8").reshape(-1, 8), np.frombuffer(self.frame(2 * level + 1), "<u4"))
        return self.open[level]

    def documents(self) -> tuple[list, np.ndarray]:
        """(doc_ids, start of each document and the end)."""
        first = 2 * self.bits
        ids = np.frombuffer(self.frame(first), "<i8").tolist()
        null = np.unpackbits(np.frombuffer(self.frame(first + 1), np.uint8), count=self.n_docs)
        starts = np.frombuffer(self.frame(first + 2), "<i8")
        return [None if z else d for d, z in zip(ids, null.tolist())], np.append(starts, self.n)

    def ones(self, level: int, place: np.ndarray) -> np.ndarray:
        """Ones of a plane before each place (rank)."""
        blocks, directory = self.plane(level)
        place = np.asarray(place, np.int64)
        if not len(blocks):
            return np.zeros(len(place), np.int64)
        block = np.minimum(place >> 9, len(blocks) - 1)
        within = (place - (block << 9))[:, None] - 64 * np.arange(8)[None, :]
        mask = np.where(within >= 64, np.uint64(2**64 - 1), (np.uint64(1) << np.clip(within, 0, 63).astype(np.uint64)) - np.uint64(1))
        return directory[block].astype(np.int64) + np.bitwise_count(blocks[block] & mask).sum(axis=1, dtype=np.int64)

    def bit(self, level: int, place: np.ndarray) -> np.ndarray:
        blocks, _ = self.plane(level)
        word = blocks.reshape(-1)[place >> 6]
        return ((word >> (place & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)

    def place_of(self, level: int, one: bool, nth: np.ndarray) -> np.ndarray:
        """Place of the nth one or zero of a plane (select)."""
        blocks, directory = self.plane(level)
        before = directory.astype(np.int64) if one else (np.arange(len(directory)) << 9) - directory
        block = np.searchsorted(before, nth, "right") - 1
        bits = np.unpackbits(blocks[block].view(np.uint8), axis=1, bitorder="little")
        seen = np.cumsum(bits if one else 1 - bits, axis=1, dtype=np.int64)
        return (block << 9) + (seen > (nth - before[block])[:, None]).argmax(axis=1)

    def access(self, places) -> np.ndarray:
        """The ids at these places."""
        place, value = np.asarray(places, np.int64), np.zeros(len(places), np.uint32)
        for level in range(self.bits):
            one, ones = self.bit(level, place), self.ones(level, place)
            value = (value << np.uint32(1)) | one
            place = np.where(one, self.zeros[level] + ones, place - ones)
        return value

    def rank(self, token: int, place: int) -> int:
        """How often ``token`` occurs before ``place``."""
        begin, end = self.stretch(token, place)
        return end - begin

    def stretch(self, token: int, place: int) -> tuple[int, int]:
        if token < 0 or token >> self.bits:
            return 0, 0
        begin, end = 0, place
        for level in range(self.bits):
            a, b = self.ones(level, np.array([begin, end])).tolist()
            begin, end = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.bits - 1 - level) & 1 else (begin - a, end - b)
        return begin, end

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, nth) -> np.ndarray:
        """Places of the nth occurrences (from 0), which must exist."""
        place = self.stretch(token, self.n)[0] + np.asarray(nth, np.int64)
        for level in range(self.bits - 1, -1, -1):
            one = bool(token >> (self.bits - 1 - level) & 1)
            place = self.place_of(level, one, place - self.zeros[level] if one else place)
        return place

    def occurrences(self, token: int) -> np.ndarray:
        return self.select(token, np.arange(self.count(token))) if self.count(token) else np.empty(0, np.int64)

    def decode(self) -> np.ndarray:
        """All ids: from the lowest plane up, each undoes its parting."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        value = np.zeros(self.n, kind)
        for level in range(self.bits - 1, -1, -1):
            one = np.unpackbits(np.frombuffer(self.frame(2 * level), np.uint8), count=self.n, bitorder="little").view(bool)
            merged = np.empty(self.n, kind)
            merged[~one] = value[: self.zeros[level]]
            merged[one] = value[self.zeros[level] :] | kind(1 << (self.bits - 1 - level))
            value = merged
        return value


def write(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, shard_ids: int = SHARD_IDS) -> str:
    """Write all texts as shards, a file each, and return the folder. Columns: part and nth (order of the
    shards), before (ids before the shard in its part), n_ids, n_docs, shard."""
    spark = docs.sparkSession
    path, tokenizer = path or shared_path(spark, "wavelet"), tokenizer or tokenizer_path(TOKENIZER)
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer, "words")
        nth = before = held = 0
        found: list[bytes] = []
        doc_ids: list = []
        starts: list[int] = []

        def shard():
            data = shard_bytes(np.frombuffer(b"".join(found), "<u4"), doc_ids, np.array(starts, np.int64))
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "nth": pa.array([nth], pa.int32()), "before": pa.array([before], pa.int64()),
                "n_ids": pa.array([held], pa.int64()), "n_docs": pa.array([len(doc_ids)], pa.int64()), "shard": pa.array([data], pa.binary()),
            })

        for batch in slices(batches, limit=4 << 20):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.many(texts_of(batch))):
                ids += end
                found.append(ids), doc_ids.append(doc_id), starts.append(held)
                held += len(ids) // 4
                if held >= shard_ids:
                    yield shard()
                    nth, before, held = nth + 1, before + held, 0
                    found.clear(), doc_ids.clear(), starts.clear()
        if doc_ids:
            yield shard()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("nth"))
    source = source.repartitionByRange(parts, "doc_id", "nth").sortWithinPartitions("doc_id", "nth").select("doc_id", "text")
    shards = map_batches(source, run, "part int, nth int, before long, n_ids long, n_docs long, shard binary")
    shards.write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(path)
    return path


SHAPE = "part int, nth int, before long, n_ids long, n_docs long, shard binary"


def placed(shards: DataFrame) -> DataFrame:
    """Shards with ``first``, the number of ids before them. One row per part meets in one task, as many
    rows as there were shuffle partitions."""
    base = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).selectExpr("part", "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0) as base")
    return shards.join(F.broadcast(base), "part").withColumn("first", F.col("base") + F.col("before"))


def documents(shards: DataFrame) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data in zip(batch.column("first").to_pylist(), batch.column("shard")):
                shard = WaveletShard(data.as_buffer().to_pybytes())
                ids, (doc_ids, starts) = shard.decode(), shard.documents()
                for a in range(0, len(doc_ids), 2000):
                    b = min(a + 2000, len(doc_ids))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(doc_ids[a:b], pa.int64()),
                        "start": pa.array(first + starts[a:b]),
                        "n_tokens": pa.array(np.diff(starts[a : b + 1])),
                        "ids": pa.array([ids[x:y].astype("<u4").tobytes() for x, y in zip(starts[a:b], starts[a + 1 : b + 1])], pa.binary()),
                    })

    return map_batches(placed(shards).select("first", "shard"), run, "doc_id long, start long, n_tokens long, ids binary")


def lookup(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """Every occurrence of some ids: token, doc_id, place among all ids, place in the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data in zip(batch.column("first").to_pylist(), batch.column("shard")):
                shard = WaveletShard(data.as_buffer().to_pybytes())
                doc_ids, starts = shard.documents()
                for token in tokens:
                    place = shard.occurrences(token)
                    doc = np.searchsorted(starts, place, "right") - 1
                    yield pa.RecordBatch.from_pydict({"token": pa.array([token] * len(place), pa.int64()), "doc_id": pa.array([doc_ids[d] for d in doc.tolist()], pa.int64()), "place": pa.array(first + place), "in_document": pa.array(place - starts[doc])})

    return map_batches(placed(shards).select("first", "shard"), run, "token long, doc_id long, place long, in_document long")


def read(spark, path: str) -> DataFrame:
    return spark.read.schema(SHAPE).parquet(path)


def digest(docs: DataFrame, **options) -> DataFrame:
    """Write the files, read them back: doc_id, start, n_tokens, ids_crc32."""
    shards = read(docs.sparkSession, write(docs, **options))
    return documents(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
